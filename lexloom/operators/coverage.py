"""Coverage of a corpus: what was fetched, what could be rendered, what failed and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions.text import error_category
from lexloom.sources.clml import xml_facts


def xml_class(content: Column) -> Column:
    """What a landed file holds, from its text: no XML, a page of HTML, only metadata, or a full document."""
    text = F.coalesce(content, F.lit(""))
    return (
        F.when(F.trim(text) == "", "empty").when(text.rlike(r"(?i)<html[\s>]"), "html").when(~text.rlike(r"<(\w+:)?Legislation[\s>]"), "other")
        .when(text.rlike(r"<(\w+:)?(Body|Schedules|Versions)[\s>]"), "full").otherwise("metadata_only")
    )


CLASSES = ("full", "metadata_only", "html", "empty", "other")


def coverage_audit(xml_files: DataFrame, markdown_files: DataFrame) -> DataFrame:
    """For each document type, and in all, how many files of each class and how many renderings there are."""
    counted = xml_files.withColumn("class", xml_class(F.col("content"))).groupBy("legislation_type").agg(F.count(F.lit(1)).alias("xml_files"), *[F.count_if(F.col("class") == c).alias(c) for c in CLASSES])
    rendered = markdown_files.groupBy("legislation_type").agg(F.count(F.lit(1)).alias("markdown_files"))
    both = counted.join(rendered, "legislation_type", "full_outer").na.fill(0)
    sums = ("xml_files", *CLASSES, "markdown_files")
    rolled = both.rollup("legislation_type").agg(*[F.sum(c).alias(c) for c in sums], F.grouping("legislation_type").alias("g"))
    return rolled.select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("legislation_type")).alias("legislation_type"), *sums)


XML_COUNTERS = ("xml_files", "valid_legislation_xml", "metadata_only_xml", "full_text_xml", "pdf_linked_xml", "empty_xml", "malformed_xml", "non_legislation_xml")


def coverage_counters(xml_files: DataFrame, markdown_files: DataFrame, fetched: DataFrame, failures: DataFrame) -> DataFrame:
    """For each document type, and in all as ``all``: XML_COUNTERS, Markdown files, fetched paths, failures by stage.

    ``xml_files`` (legislation_type, content) are parsed; ``fetched`` (legislation_type, path) counts each path
    once; ``failures`` has legislation_type and stage (fetch or convert).  A type that only one side knows
    has zeros on the others.
    """
    x = xml_facts(xml_files)
    is_ = lambda *kinds: F.col("kind").isin(*kinds)
    counted = x.groupBy("legislation_type").agg(
        F.count(F.lit(1)).alias("xml_files"), F.count_if(is_("full_text", "metadata_only")).alias("valid_legislation_xml"), F.count_if(is_("metadata_only")).alias("metadata_only_xml"), F.count_if(is_("full_text")).alias("full_text_xml"),
        F.count_if("pdf_linked").alias("pdf_linked_xml"), F.count_if(is_("empty")).alias("empty_xml"), F.count_if(is_("malformed")).alias("malformed_xml"), F.count_if(is_("non_legislation")).alias("non_legislation_xml"),
    )
    others = (
        markdown_files.groupBy("legislation_type").agg(F.count(F.lit(1)).alias("markdown_files")), fetched.groupBy("legislation_type").agg(F.count_distinct("path").alias("fetched")),
        failures.groupBy("legislation_type").agg(F.count_if(F.col("stage") != "convert").alias("fetch_failures"), F.count_if(F.col("stage") == "convert").alias("convert_failures")),
    )
    for own in others:
        counted = counted.join(own, "legislation_type", "full_outer")
    sums = (*XML_COUNTERS, "markdown_files", "fetched", "fetch_failures", "convert_failures")
    rolled = counted.na.fill(0).rollup("legislation_type").agg(*[F.sum(c).alias(c) for c in sums], F.grouping("legislation_type").alias("g"))
    return rolled.select(F.when(F.col("g") == 1, "all").otherwise(F.col("legislation_type")).alias("legislation_type"), *sums)


def failures_of(reports: DataFrame) -> DataFrame:
    """One row per failure in fetch reports, with its category."""
    rows = reports.select(F.explode("failures").alias("f")).select("f.*")
    return rows.withColumn("category", error_category(F.coalesce("error", F.lit(""))))


def failure_counts(failures: DataFrame) -> DataFrame:
    """(stage, category, n), most frequent first where order matters."""
    return failures.groupBy("stage", "category").agg(F.count(F.lit(1)).alias("n"))


def prune_guard(sampled: DataFrame, kept: DataFrame, key: str, most: float = 0.02) -> DataFrame:
    """(sampled, missing, abort): whether more of the sampled keys are missing than pruning may risk."""
    gone = sampled.join(kept.select(key, F.lit(True).alias("_held")).distinct(), key, "left")
    return gone.agg(F.count(F.lit(1)).alias("sampled"), F.count_if(F.col("_held").isNull()).alias("missing")).withColumn("abort", F.col("missing") > F.col("sampled") * most)


def pdf_candidates(files: DataFrame, failures: DataFrame, strikes: int = 3) -> DataFrame:
    """For each version its first PDF that has no parsed text beside it and has not failed too often."""
    pdfs = files.where("file_kind = 'pdf'")
    parsed = files.where("file_kind = 'extracted_text'").select("version_id", "source_url").distinct()
    struck = failures.where(F.col("attempts") >= strikes).select("file_id").distinct()
    left = pdfs.join(parsed, ["version_id", "source_url"], "left_anti").join(struck, "file_id", "left_anti")
    first = Window.partitionBy("version_id").orderBy(F.col("is_canonical").desc(), "file_id")
    return left.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def document_pdf(files: DataFrame, versions: DataFrame, document_id: str, at: str | None = None) -> DataFrame:
    """The PDF to parse for one document, canonical ones first, then by id; ``at`` asks for a snapshot's."""
    own = versions.where(F.col("document_id") == document_id)
    own = own if at is None else own.where(F.col("snapshot_date") == F.lit(at).cast("date"))
    pdfs = files.where("file_kind = 'pdf' and source_url is not null").join(own.select("version_id"), "version_id", "left_semi")
    return pdfs.orderBy(F.col("is_canonical").desc(), "file_id").limit(1)


def _parse_order() -> list[Column]:
    return [F.col("is_metadata_only").desc(), F.col("calendar_year").asc_nulls_first(), F.col("document_id"), F.col("source_url"), F.col("file_id")]


def _in_scope(files: DataFrame, versions: DataFrame, documents: DataFrame, at: str | None, legislation_type: str | None) -> DataFrame:
    v = versions.select("version_id", "document_id", "is_metadata_only", "snapshot_date")
    d = documents.select(F.col("id").alias("document_id"), "calendar_year", "legislation_type")
    rows = files.drop("document_id").join(v, "version_id").join(d, "document_id")
    rows = rows if at is None else rows.where(F.col("snapshot_date") == F.lit(at).cast("date"))
    return rows if legislation_type is None else rows.where(F.col("legislation_type") == legislation_type)


def parse_queue(files: DataFrame, versions: DataFrame, documents: DataFrame, failures: DataFrame, *, at: str | None = None, legislation_type: str | None = None, only_metadata: bool = True, force: bool = False, limit: int | None = None, strikes: int = 3) -> DataFrame:
    """PDFs due for parsing, the most wanted first: texts that are missing, then by year and document.

    Files that failed ``strikes`` times are left out, and unless ``force`` those whose text is there already.
    """
    rows = files.where("file_kind = 'pdf' and source_url is not null").join(failures.where(F.col("attempts") >= strikes).select("file_id"), "file_id", "left_anti")
    if not force:
        rows = rows.join(files.where("file_kind = 'extracted_text'").select("version_id", "source_url"), ["version_id", "source_url"], "left_anti")
    rows = _in_scope(rows, versions, documents, at, legislation_type)
    rows = (rows.where("is_metadata_only") if only_metadata else rows).orderBy(*_parse_order())
    return rows if limit is None else rows.limit(limit)


#: Where reports of parsed PDFs and the Markdown made of them are kept.
REPORTS, RENDERED = "reports/liteparse/", "markdown/liteparse/"


def markdown_queue(files: DataFrame, versions: DataFrame, documents: DataFrame, *, at: str | None = None, legislation_type: str | None = None, force: bool = False, limit: int | None = None) -> DataFrame:
    """Reports of parsed PDFs that have no Markdown yet (or all, with ``force``), in the order of ``parse_queue``."""
    rows = files.where((F.col("file_kind") == "report") & F.col("object_key").startswith(REPORTS))
    if not force:
        done = files.where((F.col("file_kind") == "markdown") & F.col("object_key").startswith(RENDERED)).select("version_id", "source_url")
        rows = rows.join(done, ["version_id", "source_url"], "left_anti")
    rows = _in_scope(rows, versions, documents, at, legislation_type).orderBy(*_parse_order())
    return rows if limit is None else rows.limit(limit)


def empty_runs(years: DataFrame) -> DataFrame:
    """Runs of consecutive years (legislation_type, first_year, last_year, years) in which nothing was found."""
    w = Window.partitionBy("legislation_type").orderBy("year")
    empty = years.where("n = 0").withColumn("_island", F.col("year") - F.row_number().over(w))
    return empty.groupBy("legislation_type", "_island").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count(F.lit(1)).alias("years")).drop("_island")
