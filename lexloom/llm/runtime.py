"""Session helpers shared by the operators: tables in the shared folder, sampling."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.session import bounded_batches, shared_dir

__all__ = ["SHARES", "bounded_batches", "discard", "hash_share", "row_hash", "row_key", "session_of", "share_limit", "shared_dir", "staged", "staged_alone"]

#: Tables that ``staged`` wrote and nobody discarded yet: (session, path).
_tables: list[tuple[SparkSession, str]] = []


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here and any executor can go.

    The table lives until ``discard``, or until the driver's JVM ends.
    """
    spark = session_of(df)
    path = f"{shared_dir(spark)}/lexloom/{name}-{uuid.uuid4().hex}"
    system, place = _place(spark, path)
    df.write.parquet(path)
    system.deleteOnExit(place)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    _tables.append((spark, path))
    return out


def _delete(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)


def discard(*tables: DataFrame) -> None:
    """Delete what ``staged`` wrote for ``tables``, once nothing that will still run reads it."""
    for df in tables:
        _tables[:] = [t for t in _tables if t[1] != df._staged_path]
        _delete(session_of(df), df._staged_path)


def staged_alone(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``staged(make())``; what ``make`` staged on its way is deleted once the result is written."""
    mark = len(_tables)
    out = staged(make(), name)
    own = _tables.pop()
    for spark, path in _tables[mark:]:
        _delete(spark, path)
    _tables[mark:] = [own]
    return out


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row, so that equal texts of different rows are sampled one by one."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])


def row_key(df: DataFrame) -> Column:
    """128 bits that name a row by its values; equal rows have one key."""
    own = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind]
    return F.struct(F.xxhash64(*own).alias("a"), F.xxhash64(F.lit(len(own)), *reversed(own)).alias("b"))


#: Hashes are sampled by their remainder.
SHARES = 1 << 31


def share_limit(rows: int, bound: int) -> int:
    """Rows whose hash has a remainder below it are about ``bound`` of ``rows`` rows."""
    return SHARES if rows <= bound else int(bound / rows * SHARES)


def hash_share(rows: int, bound: int, hashed: Column) -> Column:
    """Deterministic sample predicate on ``hashed`` that keeps about ``bound`` of ``rows`` rows.

    Rows of one hash come together or not at all, so a sample is bounded only after
    ``dropDuplicates`` on the hash: then it has about ``bound`` rows whatever is repeated.
    """
    return F.pmod(hashed, F.lit(SHARES)) < F.lit(share_limit(rows, bound))
