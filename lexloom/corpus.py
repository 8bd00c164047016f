"""The corpus as a library and as commands: every reading endpoint as a method that returns a DataFrame."""

from __future__ import annotations

import argparse
import json
from dataclasses import dataclass, fields
from urllib.parse import parse_qsl, urlencode

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import text as t
from lexloom.operators import diff, documents, effects, entities, publish, search
from lexloom.operators.documents import TYPES
from lexloom.sources import clml, feeds, files
from lexloom.streaming import poll

#: Words that mean yes or no in a query string.
WORDS = {"1": True, "true": True, "yes": True, "0": False, "false": False, "no": False}


def list_params(raw: dict[str, str]) -> dict:
    """Arguments of ``list_documents`` from a query string's values: blank is absent, numbers are held in range."""
    given = {k: v.strip() for k, v in raw.items() if v and v.strip()}
    out: dict = {k: given[k] for k in ("legislation_type", "number", "status", "extent", "q", "sort") if k in given}
    if "year" in given:
        out["year"] = int(given["year"])
    if "metadata_only" in given:
        if given["metadata_only"].lower() not in WORDS:
            raise ValueError("metadata_only must be true or false")
        out["metadata_only"] = WORDS[given["metadata_only"].lower()]
    out["limit"] = min(max(int(given.get("limit", 50)), 1), 500)
    out["offset"] = max(int(given.get("offset", 0)), 0)
    return out


def page_links(query: str, rows: int, limit: int, offset: int) -> tuple[str | None, str | None]:
    """Query strings of the pages before and after; there is a next page if this one is full."""
    rest = [(k, v) for k, v in parse_qsl(query) if k != "offset"]
    at = lambda n: urlencode([*rest, ("offset", str(n))])
    return at(max(offset - limit, 0)) if offset > 0 else None, at(offset + limit) if rows >= limit else None


def search_plan(raw: dict) -> search.Plan:
    """A plan from loose values: unknown fields go, "minister" stands for the pattern of ministers, the limit is held in range."""
    known = {f.name for f in fields(search.Plan)}
    given = {k: v for k, v in raw.items() if k in known and v not in (None, "", [])}
    if str(given.get("actor", "")).lower() == "minister":
        given["actor"] = t.MINISTERIAL
    if isinstance(given.get("terms"), str):
        given["terms"] = [given["terms"]]
    return search.Plan(**given).checked()


@dataclass
class Corpus:
    """Tables below ``root``: documents, versions, provisions, texts, effects, refs, files, duties, enrichments, targets, entities, members."""

    spark: SparkSession
    root: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def summary(self) -> DataFrame:
        return documents.corpus_summary(self.table("documents"))

    def documents(self, **filters) -> DataFrame:
        return documents.list_documents(self.table("documents"), self.table("versions"), **filters)

    def document(self, document_id: str) -> DataFrame:
        return documents.get_document(self.table("documents"), self.table("versions"), document_id)

    def versions(self, document_id: str) -> DataFrame:
        return self.table("versions").where(F.col("document_id") == document_id).orderBy(*documents.version_order())

    def version(self, version_id: str) -> DataFrame:
        return self.table("versions").where(F.col("version_id") == version_id)

    def provisions(self, version_id: str, with_text: bool = False) -> DataFrame:
        own = self.table("provisions").where(F.col("version_id") == version_id)
        return (documents.provision_texts(own, self.table("texts")) if with_text else own).orderBy("ordinal")

    def provision(self, version_id: str, anchor: str) -> DataFrame:
        return documents.get_provision(self.table("provisions").where(F.col("version_id") == version_id), self.table("texts"), anchor)

    def effects(self, document_id: str, **filters) -> DataFrame:
        return effects.list_effects(self.table("effects"), self.table("refs"), document_id=document_id, **filters)

    def changeset(self, affecting_id: str) -> DataFrame:
        own = self.table("effects").where(F.col("affecting_document_id") == affecting_id)
        return effects.changesets(own, self.table("documents")).orderBy(F.col("effect_count").desc(), "affected_document_id")

    def files(self, version_id: str) -> DataFrame:
        return self.table("files").where(F.col("version_id") == version_id).orderBy(F.col("is_canonical").desc(), "file_kind", "file_id")

    def diff(self, pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(entries, attached effects, unattached effects) of pairs (pair_id, document_id, from_version_id, to_version_id), any number of them."""
        v, e = self.table("versions"), self.table("effects")
        entries = diff.provision_diff(pairs, self.table("provisions"), self.table("texts"))
        targets = diff.effect_targets(effects.affected_arrays(self.table("refs")))
        attached, rest = diff.attach_effects(entries, diff.window_candidates(pairs, v, e), targets)
        return diff.with_texts(entries, self.table("texts")), attached, rest

    def diff_versions(self, from_id: str, to_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """``diff`` of one pair; ValueError if a version is missing or they belong to different documents."""
        found = {r["version_id"]: r["document_id"] for r in self.table("versions").where(F.col("version_id").isin(from_id, to_id)).select("version_id", "document_id").collect()}
        if from_id not in found or to_id not in found:
            raise ValueError("no such version")
        if found[from_id] != found[to_id]:
            raise ValueError("the versions belong to different documents")
        return self.diff(self.spark.createDataFrame([("1", found[to_id], from_id, to_id)], "pair_id string, document_id string, from_version_id string, to_version_id string"))

    def search(self, plan: search.Plan) -> DataFrame:
        return search.search_powers(plan, *[self.table(n) for n in ("duties", "enrichments", "targets", "entities", "members")])

    def verify_effects(self) -> DataFrame:
        return effects.confirmation_rates(effects.verify_effects(effects.confirmation_facts(*[self.table(n) for n in ("effects", "refs", "versions", "provisions")])))

    def effects_coverage(self) -> DataFrame:
        return effects.effects_coverage(*[self.table(n) for n in ("effects", "refs", "provisions")])

    def duplicate_versions(self) -> DataFrame:
        return publish.duplicate_map(self.table("versions"))

    def ingest(self, xml_path: str, out: str) -> tuple[DataFrame, DataFrame]:
        """Landed XML rendered to Markdown under ``out``: (documents, failures)."""
        clml.clml_to_markdown(clml.scan_xml(self.spark, xml_path)).write.mode("overwrite").parquet(out)
        done = self.spark.read.parquet(out)
        return done.where("error is null").withColumn("ref", clml.document_ref(F.col("path"))), done.where("error is not null")

    def ingest_effects(self, feed_path: str) -> tuple[DataFrame, DataFrame]:
        return feeds.parse_effects(self.spark.read.format("binaryFile").load(feed_path).select("path", "content"))

    def ingest_duties(self, paths: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
        return entities.load_duties(files.read_duties(self.spark, paths)[0], self.table("documents"))

    def poll(self, landed: str, state: str, checkpoint: str, taken: DataFrame | None = None, since: str | None = None, types: tuple[str, ...] | None = TYPES) -> DataFrame | None:
        """Documents due among the publication events landed as Parquet (document_id, legislation_type, updated, ...).

        ``taken`` (document_id, updated) says what was ingested before; a document published again since is due again.
        """
        schema = self.spark.read.parquet(landed).schema
        seen = poll.poll(self.spark.readStream.schema(schema).parquet(landed), poll.TableState(self.spark, state, ["document_id", "updated"]), checkpoint, since=since, types=types)
        return None if seen is None else poll.to_ingest(seen, taken)

    def counts(self) -> DataFrame:
        out = None
        for n in ("documents", "versions", "provisions", "texts", "effects", "refs", "files"):
            own = self.table(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n")
            out = own if out is None else out.unionByName(own)
        return out


COMMANDS = {
    "summary": lambda c, a: c.summary(), "documents": lambda c, a: c.documents(**list_params(dict(parse_qsl(a.query)))), "document": lambda c, a: c.document(a.id), "versions": lambda c, a: c.versions(a.id),
    "provisions": lambda c, a: c.provisions(a.id), "effects": lambda c, a: c.effects(a.id), "changeset": lambda c, a: c.changeset(a.id), "files": lambda c, a: c.files(a.id), "diff": lambda c, a: c.diff_versions(*a.id.split(",", 1))[0].orderBy("gap", "rank", "index"),
    "search": lambda c, a: c.search(search_plan(json.loads(a.query or "{}"))), "verify-effects": lambda c, a: c.verify_effects(), "effects-coverage": lambda c, a: c.effects_coverage(), "duplicates": lambda c, a: c.duplicate_versions(), "corpus-counts": lambda c, a: c.counts(),
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lexloom", description="Reads a corpus of Parquet tables and prints rows as JSON lines.")
    parser.add_argument("command", choices=sorted(COMMANDS))
    parser.add_argument("--root", required=True)
    parser.add_argument("--id", default="", help="document or version; two versions with a comma for diff")
    parser.add_argument("--query", default="", help="query string, or a search plan as JSON")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("lexloom").getOrCreate()
    for row in COMMANDS[args.command](Corpus(spark, args.root), args).toJSON().toLocalIterator():
        print(row)


if __name__ == "__main__":
    main()
