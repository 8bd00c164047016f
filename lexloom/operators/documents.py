"""Reading documents, versions, provisions and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Document types.
TYPES = (
    "aep", "aosp", "aip", "apgb", "gbppa", "gbla", "ukpga", "ukla", "ukppa", "uksi", "ukmo", "ukcm", "ukci", "asp", "ssi", "asc", "anaw",
    "mwa", "wsi", "nia", "nisr", "nisi", "apni", "mnia", "nisro",
)
SORTS = ("default", "newest")


def checked_page(limit: int, offset: int, most: int = 500) -> tuple[int, int]:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be from 1 to {most}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    return limit, offset


def newest_order() -> list[Column]:
    """By legal date, or the start of the year; then by number as a number; then by id; latest first."""
    number = F.when(F.col("number").rlike("^[0-9]+$"), F.col("number").cast("decimal(38,0)"))
    return [F.coalesce("legal_date", F.make_date("calendar_year", F.lit(1), F.lit(1))).desc_nulls_last(), number.desc_nulls_last(), F.col("id").desc()]


def default_order() -> list[Column]:
    return [F.col("calendar_year").asc_nulls_last(), F.col("legislation_type").asc_nulls_last(), F.col("number").asc_nulls_last(), F.col("id").asc()]


def with_latest_version(documents: DataFrame, versions: DataFrame) -> DataFrame:
    """Documents with latest_word_count and latest_is_metadata_only, null where there is no latest version."""
    latest = versions.select(F.col("version_id").alias("latest_version_id"), F.col("word_count").alias("latest_word_count"), F.col("is_metadata_only").alias("latest_is_metadata_only"))
    return documents.join(latest, "latest_version_id", "left")


def list_documents(
    documents: DataFrame, versions: DataFrame, *, legislation_type: str | None = None, year: int | None = None, number: str | None = None, status: str | None = None,
    extent: str | None = None, metadata_only: bool | None = None, q: str | None = None, sort: str = "default", limit: int = 50, offset: int = 0, types: tuple[str, ...] | None = TYPES,
) -> DataFrame:
    """A page of documents; only the filters that are given enter the plan.

    ``metadata_only`` drops documents without a latest version.  ``q`` is a substring in any case whose
    wildcards act as such.
    """
    if sort not in SORTS:
        raise ValueError(f"sort must be one of {SORTS}")
    if legislation_type is not None and types and legislation_type not in types:
        raise ValueError("unknown document type")
    limit, offset = checked_page(limit, offset)
    for column, value in (("legislation_type", legislation_type), ("calendar_year", year), ("number", number), ("status", status), ("extent", extent)):
        if value is not None:
            documents = documents.where(F.col(column) == value)
    if q:
        documents = documents.where(F.col("title").ilike(f"%{q}%"))
    found = with_latest_version(documents, versions)
    if metadata_only is not None:
        found = found.where(F.col("latest_is_metadata_only") == metadata_only)
    return found.orderBy(*(newest_order() if sort == "newest" else default_order())).offset(offset).limit(limit)


def get_document(documents: DataFrame, versions: DataFrame, document_id: str) -> DataFrame:
    latest = versions.select(F.struct(*versions.columns).alias("latest_version"), F.col("version_id").alias("latest_version_id"))
    return documents.where(F.col("id") == document_id).join(latest, "latest_version_id", "left")


def version_order() -> list[Column]:
    return [F.col("version_kind").asc(), F.col("snapshot_date").asc_nulls_first(), F.col("version_id").asc()]


def list_versions(versions: DataFrame, document_ids: DataFrame) -> DataFrame:
    return versions.join(document_ids, "document_id", "left_semi")


def provision_texts(provisions: DataFrame, texts: DataFrame, version_ids: DataFrame | None = None) -> DataFrame:
    """Provisions with their text, which is stored once for each hash."""
    if version_ids is not None:
        provisions = provisions.join(version_ids, "version_id", "left_semi")
    return provisions.join(texts, "text_sha256")


def get_provision(provisions: DataFrame, texts: DataFrame, anchor: str) -> DataFrame:
    """For each version the first provision in order with ``anchor``, which need not be unique."""
    first = provisions.where(F.col("anchor") == anchor).groupBy("version_id").agg(F.min("ordinal").alias("ordinal"))
    return provisions.join(first, ["version_id", "ordinal"]).join(texts, "text_sha256")


def preferred_file(files: DataFrame, prefixes: list[str]) -> DataFrame:
    """For each version the text file whose key starts with the earliest of ``prefixes``; canonical ones come after all."""
    rank = F.lit(None).cast("int")
    for k in reversed(range(len(prefixes))):
        rank = F.when(F.col("object_key").startswith(prefixes[k]), k).otherwise(rank)
    rank = F.coalesce(rank, F.when(F.col("is_canonical"), len(prefixes)))
    best = files.withColumn("rank", rank).where("rank is not null").groupBy("version_id").agg(F.min(F.struct("rank", "object_key")).alias("best"))
    return best.select("version_id", F.col("best.rank").alias("rank"), F.col("best.object_key").alias("object_key"))


def corpus_summary(documents: DataFrame) -> DataFrame:
    return documents.groupBy("legislation_type").agg(F.count(F.lit(1)).alias("document_count"), F.min("calendar_year").alias("first_year"), F.max("calendar_year").alias("last_year"))


def timeline(summary: DataFrame, groups: dict[str, list[str]], first: int, last: int) -> DataFrame:
    """Bars of a corpus timeline: left edge and width in percent, at least 0.6 wide."""
    series = F.explode(F.array(*[F.struct(F.lit(g).alias("group"), F.lit(c).alias("legislation_type")) for g, codes in groups.items() for c in codes]))
    names = summary.sparkSession.range(1).select(series.alias("s")).select("s.*")
    span = float(last - first)
    left = F.round((F.col("first_year") - first) / span * 100, 2)
    width = F.greatest(F.lit(0.6), F.round((F.col("last_year") - F.col("first_year")) / span * 100, 2))
    return names.join(summary, "legislation_type").select("group", "legislation_type", "document_count", left.alias("left_percent"), width.alias("width_percent"))


def timeline_ticks(first: int, last: int, step: int = 100, from_year: int = 1300) -> list[tuple[int, float]]:
    """(year, left edge in percent) of the marks below a timeline: every ``step`` years before the last."""
    return [(y, round((y - first) / (last - first) * 100, 2)) for y in range(from_year, last, step)]


def timeline_totals(bars: DataFrame) -> DataFrame:
    """Documents of each group and of all groups (``all``)."""
    rolled = bars.rollup("group").agg(F.sum("document_count").alias("document_count"), F.grouping("group").alias("g"))
    return rolled.select(F.when(F.col("g") == 1, "all").otherwise(F.col("group")).alias("group"), "document_count")
