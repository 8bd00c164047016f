"""Publishing: Markdown into documents, versions, provisions and texts with content identity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions import text as t
from lexloom.operators.diff import compare_code
from lexloom.operators.keyed import distinct_on, insert_absent, replace_children, upsert


def split_provisions(docs: DataFrame, body: str = "body", strict_suffix: bool = True) -> DataFrame:
    """``docs`` with one row for each level-2 heading of ``body``, up to the next one.

    Text before the first heading is dropped; a body without headings is one provision named Document.
    Signs without a heading take the next line for it, even if that is a heading: such a line is held
    back from the split by a character that no text has.
    """
    has = F.col(body).rlike(r"(?md)^##(?U:\s)+(?U:\S)")
    held = F.regexp_replace(F.col(body), r"(?md)^##((?U:\s)+)##(?=(?U:\s)|\z)", "##$1\x00##")
    starts = F.split(held, r"(?md)(?=^##(?U:\s)+(?U:\S))")
    parts = F.when(has, F.filter(starts, lambda x: x.rlike(r"(?d)\A##(?U:\s)+(?U:\S)"))).otherwise(F.array(F.col(body)))
    rows = docs.withColumn("_has", has).select("*", F.posexplode(F.transform(parts, lambda x: F.translate(x, "\x00", ""))).alias("_pos", "_part"))
    heading = F.when(F.col("_has"), F.trim(F.regexp_extract(F.col("_part"), r"(?d)\A##(?U:\s)+(.+?)(?U:\s)*(?:\n|\z)", 1))).otherwise("Document")
    rows = rows.withColumn("ordinal", F.col("_pos") + 1).withColumn("heading", heading).withColumn("provision_markdown", F.regexp_replace("_part", r"(?U)\A\s+|\s+\z", ""))
    rows = rows.withColumn("number", F.when(F.col("_has"), t.heading_number(F.col("heading"), strict_suffix))).withColumn("extent", F.when(F.col("_has"), t.extent_suffix(F.col("heading"))))
    slug = t.slugify(F.col("heading"))
    return rows.withColumns({
        "anchor": F.when(~F.col("_has"), "document").otherwise(F.coalesce(t.or_null(slug), F.concat(F.lit("provision-"), F.col("ordinal").cast("string")))),
        "provision_type": t.provision_type(F.col("heading"), F.col("number")),
        "plain_text": t.markdown_to_text(F.col("provision_markdown")),
        "text_sha256": F.sha2("provision_markdown", 256),
        "compare_code": compare_code(F.col("provision_markdown")),
    }).drop("_has", "_pos", "_part", body)


@dataclass
class State:
    """Tables as of the last publication.  Versions: version_id, document_id, version_kind, snapshot_date, source_sha256, markdown_sha256, canonical_sha256, publish_seq, word_count, is_metadata_only."""

    documents: DataFrame
    versions: DataFrame
    provisions: DataFrame
    texts: DataFrame


def prepared(batch: DataFrame) -> DataFrame:
    """Hashes, ids and flags of a batch of (document_id, version_kind, snapshot_date, source_sha256, markdown, publish_seq)."""
    md = F.col("markdown")
    preferred = F.when(F.col("version_kind") == "enacted", F.concat(F.lit("enacted:"), F.col("document_id"))).otherwise(F.concat(F.lit("point-in-time:"), F.col("snapshot_date").cast("string"), F.lit(":"), F.col("document_id")))
    return batch.withColumns({
        "markdown_sha256": t.content_sha256(md), "canonical_sha256": t.canonical_sha256(md), "preferred_id": preferred, "body": t.body_of(t.normalize_markdown(md)),
        "title": t.fallback_title(md, F.coalesce(t.frontmatter_value(md, "title"), F.col("document_id"))),
    })


def assign_versions(versions: DataFrame, batch: DataFrame) -> DataFrame:
    """``batch`` with ``version_id`` and ``created``.

    Equal content of a document and kind is one version: a stored one whose canonical hash agrees (or,
    where it has none, both raw hashes do), the earliest if several; else the first of the batch.  A new
    version takes its preferred id, with twelve digits of its hash where the id is already taken.
    """
    v = versions.select("document_id", "version_kind", F.col("canonical_sha256").alias("vc"), F.col("source_sha256").alias("vs"), F.col("markdown_sha256").alias("vm"), F.struct("publish_seq", "version_id").alias("old"))
    by_hash = batch.join(v.where("vc is not null"), (batch.document_id == v.document_id) & (batch.version_kind == v.version_kind) & (batch.canonical_sha256 == v.vc)).select(batch.publish_seq, "old")
    by_raw = batch.join(v.where("vc is null"), (batch.document_id == v.document_id) & (batch.version_kind == v.version_kind) & (batch.source_sha256 == v.vs) & (batch.markdown_sha256 == v.vm)).select(batch.publish_seq, "old")
    stored = by_hash.union(by_raw).groupBy("publish_seq").agg(F.min("old").getField("version_id").alias("stored_id"))
    same = Window.partitionBy("document_id", "version_kind", "canonical_sha256").orderBy("publish_seq")
    rows = batch.join(stored, "publish_seq", "left").withColumn("lead", F.row_number().over(same) == 1)
    taken = versions.select(F.col("version_id").alias("preferred_id"), F.lit(True).alias("taken"))
    fresh = rows.where("stored_id is null and lead").join(taken, "preferred_id", "left")
    clash = Window.partitionBy("preferred_id").orderBy("publish_seq")
    new_id = F.when(F.col("taken") | (F.row_number().over(clash) > 1), F.concat_ws(":", "preferred_id", F.substring("markdown_sha256", 1, 12))).otherwise(F.col("preferred_id"))
    named = fresh.select("document_id", "version_kind", "canonical_sha256", new_id.alias("new_id"))
    out = rows.join(named, ["document_id", "version_kind", "canonical_sha256"], "left")
    return out.withColumn("version_id", F.coalesce("stored_id", "new_id")).withColumn("created", F.col("stored_id").isNull() & F.col("lead")).drop("stored_id", "new_id", "lead")


def publish(state: State, batch: DataFrame) -> State:
    """``state`` after ``batch``.  Publishing the same batch again changes nothing but the latest pointers."""
    rows = assign_versions(state.versions, prepared(batch))
    created = rows.where("created")
    new_versions = created.select("version_id", "document_id", "version_kind", F.when(F.col("version_kind") == "point_in_time", F.col("snapshot_date")).alias("snapshot_date"), "source_sha256", "markdown_sha256", "canonical_sha256", "publish_seq", t.word_count(t.markdown_to_text(F.col("body"))).alias("word_count"), F.lit(False).alias("is_metadata_only"))
    split = split_provisions(created.select("version_id", "document_id", "body"))
    new_provisions = split.select("version_id", "document_id", "ordinal", "provision_type", "number", "heading", "anchor", "extent", "text_sha256")
    new_texts = split.select(F.col("text_sha256"), F.col("provision_markdown").alias("markdown"), "plain_text")
    latest = rows.groupBy("document_id").agg(F.max(F.struct("publish_seq", "version_id", "title")).alias("m")).select("document_id", F.col("m.title").alias("title"), F.col("m.version_id").alias("latest_version_id"))
    return State(
        upsert(state.documents, latest, ["document_id"]),
        state.versions.unionByName(new_versions),
        replace_children(state.provisions, new_provisions, ["version_id"]),
        insert_absent(state.texts, new_texts, ["text_sha256"], [F.col("markdown")]),
    )


def backfill_canonical(versions: DataFrame, markdown: DataFrame) -> DataFrame:
    """Canonical hashes where they are missing and the Markdown is at hand."""
    own = markdown.select("version_id", t.canonical_sha256(F.col("markdown")).alias("_c"))
    return versions.join(own, "version_id", "left").withColumn("canonical_sha256", F.coalesce("canonical_sha256", "_c")).select(versions.columns)


def duplicate_map(versions: DataFrame) -> DataFrame:
    """(version_id, keeper_id, n) of versions with equal content; the earliest by date, publication and id is kept."""
    w = Window.partitionBy("document_id", "version_kind", "canonical_sha256")
    first = F.first("version_id").over(w.orderBy(F.col("snapshot_date").asc_nulls_last(), "publish_seq", "version_id"))
    return versions.where("canonical_sha256 is not null").select("version_id", first.alias("keeper_id"), F.count(F.lit(1)).over(w).alias("n")).where("n > 1")


def merge_duplicates(documents: DataFrame, versions: DataFrame, provisions: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The four tables with duplicate versions merged: pointers moved, files the keeper lacks moved, the rest dropped."""
    keep = duplicate_map(versions)
    moved = keep.where("version_id <> keeper_id").select("version_id", "keeper_id")
    docs = documents.join(moved.withColumnRenamed("version_id", "latest_version_id"), "latest_version_id", "left").withColumn("latest_version_id", F.coalesce("keeper_id", "latest_version_id")).select(documents.columns)
    left = versions.join(moved, "version_id", "left_anti").select(versions.columns)
    provs = provisions.join(moved, "version_id", "left_anti").select(provisions.columns)
    owned = files.join(moved, "version_id", "left").withColumn("_own", F.col("keeper_id").isNull()).withColumn("_was", F.col("version_id")).withColumn("version_id", F.coalesce("keeper_id", "version_id"))
    owned = owned.withColumn("_u", F.coalesce("source_url", F.lit(""))).withColumn("_k", F.coalesce("object_key", F.lit("")))
    kept = distinct_on(owned, ["version_id", "file_kind", "_u", "_k"], [F.col("_own").desc(), F.col("_was"), F.col("file_id")]).select(files.columns)
    return docs, left, provs, kept


def rerender(versions: DataFrame, rendered: DataFrame) -> DataFrame:
    """Outcome of new renderings (version_id, markdown): unchanged, updated, or conflict where another version has that content."""
    new = rendered.select("version_id", t.content_sha256(F.col("markdown")).alias("new_sha256"))
    rows = versions.join(new, "version_id").select("version_id", "document_id", "version_kind", "source_sha256", "markdown_sha256", "new_sha256")
    others = versions.select("document_id", "version_kind", "source_sha256", F.col("markdown_sha256").alias("new_sha256"), F.lit(True).alias("held")).distinct()
    marked = rows.join(others, ["document_id", "version_kind", "source_sha256", "new_sha256"], "left")
    outcome = F.when(F.col("new_sha256") == F.col("markdown_sha256"), "unchanged").when(F.col("held"), "conflict").otherwise("updated")
    return marked.select("version_id", "new_sha256", outcome.alias("outcome"))


def rekey(df: DataFrame, mapping: DataFrame, *columns: str) -> DataFrame:
    """``df`` with old keys in ``columns`` replaced through ``mapping`` (old_key, new_key)."""
    for c in columns:
        df = df.join(mapping.select(F.col("old_key").alias(c), F.col("new_key").alias("_new")), c, "left").withColumn(c, F.coalesce("_new", c)).drop("_new")
    return df


def missing_versions(advertised: DataFrame, stored: DataFrame, most: int) -> DataFrame:
    """Advertised (document_id, date) that are not stored, the latest ``most`` of each document."""
    left = advertised.distinct().join(stored, ["document_id", "date"], "left_anti")
    return left.withColumn("_n", F.row_number().over(Window.partitionBy("document_id").orderBy(F.col("date").desc()))).where(F.col("_n") <= most).drop("_n")
