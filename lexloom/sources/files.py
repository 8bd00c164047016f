"""Landed files: Markdown trees, duties and enrichment files, reports, archives, and the object store."""

from __future__ import annotations

import csv
import gzip
import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.sources.clml import document_ref

#: Columns of the duties file.
DUTY_COLUMNS = (
    "dutyTempId", "duty_uri", "enactment", "enactmentTitle", "enactmentYear", "enactmentType", "enactmentNum", "section", "subsection", "actor", "actorIsBody",
    "actorIsAlias", "actorDefinition", "body_uri", "modality", "action", "condition", "inference", "priority",
)
ENRICHMENT = "id long, targets array<string>, is_direction_power boolean, instrument string"
REPORT = (
    "mode string, legislation_type string, start_year int, end_year int, at string, fetched array<string>, failures array<struct<stage:string,legislation_type:string,year:int,number:int,url:string,"
    "status_code:int,error:string,classification:string,probes:array<struct<label:string,url:string,status_code:int,error:string,pdf_alternatives:array<string>>>>>"
)
LAYOUT = "pages array<struct<page:int,text:string,text_items:array<struct<text:string,x:double,y:double,width:double,height:double,confidence:double>>>>"


def scan_markdown(spark: SparkSession, path: str, types: list[str] | None = None) -> DataFrame:
    """(path, markdown, ref) of every ``.md`` file below ``path``, of some document types only if asked."""
    rows = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("markdown"))
    rows = rows.withColumn("ref", document_ref(F.col("path")))
    return rows.where(F.col("ref.legislation_type").isin(*types)) if types else rows


def headers(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The first line of each file, in one job."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"), "value")
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "n").alias("line")).collect()  # a row for each file
    return {r["file"]: r["line"].lstrip("\ufeff").rstrip("\r") for r in first}


def read_duties(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[str]]:
    """(rows, failures): files whose header lacks a column are failures and give no rows; files of one header are read as one."""
    groups: dict[str, list[str]] = {}
    for path, line in sorted(headers(spark, paths).items()):
        groups.setdefault(line, []).append(path)
    out, failures = None, []
    for line, own in sorted(groups.items()):
        columns = next(csv.reader([line]))
        if missing := [c for c in DUTY_COLUMNS if c not in columns]:
            failures += [f"{path}: no column {', '.join(missing)}" for path in own]
            continue
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        raw = spark.read.schema(schema).csv(own, header=True, multiLine=True, escape='"', encoding="UTF-8", enforceSchema=True)
        rows = raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in DUTY_COLUMNS], F.col("_metadata.file_path").alias("source_file"))
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], ", ".join(f"{c} string" for c in (*DUTY_COLUMNS, "source_file"))), failures


def read_enrichment(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; what does not parse, and rows whose id is no whole number, are left out."""
    return spark.read.schema(ENRICHMENT + ", _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path).where("id is not null").drop("_corrupt")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT).json(path, multiLine=True)


def write_report(rows: DataFrame, path: str) -> None:
    """Reports (columns of REPORT) as files that ``read_report`` reads, one report a file."""
    rows.repartition(max(rows.count(), 1), F.monotonically_increasing_id()).write.mode("overwrite").option("maxRecordsPerFile", 1).json(path)


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LAYOUT).json(path, multiLine=True).withColumn("path", F.col("_metadata.file_path"))


def act_list(spark: SparkSession, path: str) -> DataFrame:
    """(document_path): one a line, what follows ``#`` is a comment."""
    return spark.read.text(path).select(F.trim(F.split_part("value", F.lit("#"), F.lit(1))).alias("document_path")).where("document_path <> ''")


def unzip(files: DataFrame) -> DataFrame:
    """(path, member, content, document_id, error) of the XML members of zip files (path, content).

    A file or member that can't be read has its error instead of content; the others are not affected.
    """

    def members(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                rows: list[tuple] = []
                try:
                    with zipfile.ZipFile(io.BytesIO(bytes(content or b""))) as z:
                        for n in sorted(x for x in z.namelist() if x.endswith(".xml")):
                            try:
                                rows.append((path, n, z.read(n), None))
                            except (zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError) as e:
                                rows.append((path, n, None, str(e)))
                except zipfile.BadZipFile as e:
                    rows.append((path, None, None, str(e)))
                yield pd.DataFrame(rows, columns=["path", "member", "content", "error"], dtype=object)

    rows = files.select("path", "content").mapInPandas(members, "path string, member string, content binary, error string")
    return rows.select("path", "member", "content", seed_ref(F.regexp_extract(F.decode("content", "UTF-8"), r'DocumentURI="([^"]*)"', 1)).alias("document_id"), "error")


def seed_ref(address: Column) -> Column:
    """The first type, year and number in a row in an address."""
    return F.nullif(F.regexp_extract(address, r"(?:^|/)([a-z]+/\d+/\d+)(?=/|$)", 1), F.lit(""))


# --- object store ---------------------------------------------------------------------------------


def safe_key(key: Column) -> Column:
    """Whether a key stays inside the store."""
    return ~key.startswith("/") & ~F.array_contains(F.split(key, "/"), "..") & (key != "")


@F.pandas_udf(T.BinaryType())
def gzipped(content: pd.Series) -> pd.Series:
    return content.map(lambda c: gzip.compress(bytes(c), mtime=0) if c is not None else None)


@F.pandas_udf(T.BinaryType())
def gunzipped(content: pd.Series) -> pd.Series:
    return content.map(lambda c: gzip.decompress(bytes(c)) if c is not None else None)


def put_objects(objects: DataFrame) -> DataFrame:
    """(key, stored, sha256, byte_size) of (key, content): compressible kinds as gzip without a time stamp, hashes of the raw bytes."""
    small = F.col("key").rlike(r"\.(xml|md|json|txt|html|csv)$")
    rows = objects.where(safe_key(F.col("key"))).withColumn("stored", F.when(small, gzipped(F.when(small, F.col("content")))).otherwise(F.col("content")))
    return rows.select(F.when(small, F.concat("key", F.lit(".gz"))).otherwise(F.col("key")).alias("key"), "stored", F.sha2("content", 256).alias("sha256"), F.length("stored").cast("long").alias("byte_size"))


def get_objects(stored: DataFrame) -> DataFrame:
    packed = F.col("key").endswith(".gz")
    return stored.select(F.when(packed, F.regexp_replace("key", r"\.gz$", "")).otherwise(F.col("key")).alias("key"), F.when(packed, gunzipped(F.when(packed, F.col("stored")))).otherwise(F.col("stored")).alias("content"))
