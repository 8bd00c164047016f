"""What publishing leaves besides texts: runs and their observations, objects, files; the order in which tables are loaded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import text as t
from lexloom.operators.keyed import insert_absent, upsert
from lexloom.sources import clml
from lexloom.sources.files import gunzipped, put_objects

RUN = "run_id string, mode string, snapshot_date date, notes string, finished boolean"


def run_row(like: DataFrame, run_id: str, collection: str, snapshot_date: str | None = None, types: tuple[str, ...] = ()) -> DataFrame:
    """A run that has begun; its notes name the collection and the document types, sorted."""
    notes = f"collection={collection}" + (f"; legislation_types={','.join(sorted(set(types)))}" if types else "")
    rows = like.sparkSession.createDataFrame([(run_id, "publish", snapshot_date, notes, False)], "run_id string, mode string, snapshot_date string, notes string, finished boolean")
    return rows.withColumn("snapshot_date", F.to_date("snapshot_date"))


def finish(runs: DataFrame, run_id: str) -> DataFrame:
    return runs.withColumn("finished", F.col("finished") | (F.col("run_id") == run_id))


def observations(published: DataFrame, run_id: str) -> DataFrame:
    """One row for each published document (document_id, version_id, created, source_uri, source_sha256): fetched if it made a version."""
    return published.select(
        F.lit(run_id).alias("run_id"), "document_id", "version_id", F.coalesce("source_uri", "document_id").alias("source_url"),
        F.when(F.col("created"), "fetched").otherwise("not_modified").alias("status"), "source_sha256",
    )


def published_objects(objects: DataFrame, published: DataFrame) -> DataFrame:
    """``objects`` (key, sha256, source_url) with the Markdown and, where there is one, the source of each published document, by key."""
    markdown = published.select(F.col("markdown_key").alias("key"), F.col("markdown_sha256").alias("sha256"), F.lit(None).cast("string").alias("source_url"))
    source = published.where("source_key is not null").select(F.col("source_key").alias("key"), F.col("source_sha256").alias("sha256"), F.col("source_uri").alias("source_url"))
    return upsert(objects, markdown.unionByName(source), ["key"], [F.col("sha256"), F.col("source_url").asc_nulls_last()])


FILE = ("document_id", "version_id", "file_kind", "object_key", "sha256", "source_url", "is_canonical")


def published_files(files: DataFrame, published: DataFrame) -> DataFrame:
    """``files`` (FILE) and what a publication adds: Markdown, XML source, and the PDFs that it names, none of them twice."""
    own = published.select(
        "document_id", "version_id",
        F.explode(
            F.concat(
                F.array(F.struct(F.lit("markdown").alias("file_kind"), F.col("markdown_key").alias("object_key"), F.col("markdown_sha256").alias("sha256"), F.lit(None).cast("string").alias("source_url"), F.lit(True).alias("is_canonical"))),
                F.filter(F.array(F.struct(F.lit("clml_xml").alias("file_kind"), F.col("source_key").alias("object_key"), F.col("source_sha256").alias("sha256"), F.col("source_uri").alias("source_url"), F.lit(True).alias("is_canonical"))), lambda x: x.object_key.isNotNull()),
                F.transform(F.coalesce("pdf_alternatives", F.array().cast("array<string>")), lambda u: F.struct(F.lit("pdf").alias("file_kind"), F.lit(None).cast("string").alias("object_key"), F.lit(None).cast("string").alias("sha256"), u.alias("source_url"), F.lit(False).alias("is_canonical"))),
            )
        ).alias("f"),
    ).select("document_id", "version_id", "f.*")
    return insert_absent(files.select(*FILE), own.select(*FILE), ["document_id", "version_id", "file_kind", "source_url", "object_key"], [F.col("sha256").asc_nulls_last()])


def pdf_alternatives(markdown: str) -> Column:
    """The addresses that front matter lists, in order; an empty array without a list."""
    block = F.regexp_extract(F.coalesce(t.frontmatter(F.col(markdown)), F.lit("")), r"(?s)(?:^|\n)pdf_alternatives:\n((?:  - [^\n]*(?:\n|$))*)", 1)
    return F.transform(F.filter(F.split(block, "\n"), lambda x: x != ""), lambda x: F.regexp_replace(x, r'^  - "?|"?$', ""))


# --- rendering again ------------------------------------------------------------------------------


def rerender_metadata_only(versions: DataFrame, documents: DataFrame, files: DataFrame, objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(outcomes, counts) of rendering anew the sources of latest versions that hold metadata only.

    ``objects`` (key, content) holds sources; outcomes (document_id, version_id, outcome, markdown): missing
    where the store lacks the source, failed, still where the new text is metadata only as well, and
    recovered, whose Markdown can be published.  Texts travel only for what is rendered.
    """
    latest = versions.where("is_metadata_only and version_kind in ('point_in_time', 'enacted')").join(documents.select(F.col("latest_version_id").alias("version_id")), "version_id", "left_semi")
    source = files.where("file_kind = 'clml_xml' and object_key is not null").select("version_id", F.col("object_key").alias("key"))
    due = latest.select("version_id", "document_id").join(source, "version_id")
    held = objects.join(due.select("key").distinct(), "key", "left_semi").select(F.col("key").alias("path"), "content")
    rendered = clml.clml_to_markdown(held).withColumnRenamed("path", "key")
    rows = due.join(rendered.withColumn("_held", F.lit(True)), "key", "left")
    outcome = F.when(F.col("_held").isNull(), "missing").when(F.col("error").isNotNull(), "failed").when(F.col("markdown").contains(clml.METADATA_ONLY), "still").otherwise("recovered")
    outcomes = rows.withColumn("outcome", outcome).select("document_id", "version_id", "outcome", F.when(outcome == "recovered", F.col("markdown")).alias("markdown"))
    return outcomes, outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


# --- compressing ----------------------------------------------------------------------------------


def compress_objects(objects: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stored, mapping, report) of objects (key, content) that are not compressed yet.

    ``stored`` (key, stored, sha256, byte_size) are the objects of compressible kinds whose packed form
    unpacks to the same bytes; ``mapping`` (old_key, new_key) moves references (see ``publish.rekey``).
    The report counts scanned, other kinds, missing content, compressed, failed, and bytes before and after.
    """
    todo = objects.where(~F.col("key").endswith(".gz"))
    packed = put_objects(todo.where("content is not null"))
    done = packed.where(F.col("key").endswith(".gz")).withColumn("_back", gunzipped("stored"))
    checked = done.select("*", F.regexp_replace("key", r"\.gz$", "").alias("old_key"), (F.sha2("_back", 256) == F.col("sha256")).alias("_good"), F.octet_length("_back").cast("long").alias("_before")).drop("_back")
    good = checked.where("_good")
    counts = todo.select("key", F.col("content").isNull().alias("_missing")).join(checked.select(F.col("old_key").alias("key"), "_good", "_before", "byte_size"), "key", "left")
    report = counts.agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if(~F.col("_missing") & F.col("_good").isNull()).alias("other_kinds"), F.count_if("_missing").alias("missing"),
        F.count_if("_good").alias("compressed"), F.count_if(~F.col("_good")).alias("failed"), F.coalesce(F.sum(F.when(F.col("_good"), F.col("_before"))), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum(F.when(F.col("_good"), F.col("byte_size"))), F.lit(0)).alias("bytes_after"),
    )
    return good.select("key", "stored", "sha256", "byte_size"), good.select("old_key", F.col("key").alias("new_key")), report


# --- loading --------------------------------------------------------------------------------------

#: Tables by what they refer to: parents first.
LOAD_ORDER = ("documents", "versions", "texts", "provisions", "objects", "files", "effects", "refs")


def load_in_order(tables: dict[str, DataFrame], write: Callable[[str, DataFrame], None]) -> list[str]:
    """Writes tables parents first, and documents' pointers last, when what they point at is there.

    Documents go first without their latest version and are written again with it; a pointer to a version
    that is not loaded stays null.  Returns the names in the order written.
    """
    done = []
    for name in [*LOAD_ORDER, *sorted(set(tables) - set(LOAD_ORDER))]:
        if name in tables:
            df = tables[name]
            write(name, df.withColumn("latest_version_id", F.lit(None).cast("string")) if name == "documents" else df)
            done.append(name)
    if "documents" in tables and "versions" in tables:
        known = tables["versions"].select(F.col("version_id").alias("latest_version_id"), F.lit(True).alias("_known"))
        docs = tables["documents"].join(known, "latest_version_id", "left").withColumn("latest_version_id", F.when(F.col("_known"), F.col("latest_version_id")))
        write("documents", docs.select(tables["documents"].columns))
        done.append("documents")
    return done
