"""State as tables: first row of a key, upsert, insert if absent, replacement of children, as-of pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_on(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``, which should be total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """``old`` with the rows of ``new`` put in by key; of several new rows of a key the first in ``order`` stays."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return distinct_on(both, keys, [F.col("_new").desc(), *(order or [])]).drop("_new")


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``old`` and those rows of ``new`` whose key it lacks; a null in a key equals an empty string."""
    own = [F.coalesce(new[k].cast("string"), F.lit("")) == F.coalesce(old[k].cast("string"), F.lit("")) for k in keys]
    fresh = new.join(old, own, "left_anti")
    w = Window.partitionBy(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]).orderBy(*order)
    return old.unionByName(fresh.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n"))


def replace_children(old: DataFrame, new: DataFrame, parent: list[str]) -> DataFrame:
    """All rows of the parents that occur in ``new`` give way to those of ``new``."""
    return old.join(new.select(*parent).distinct(), parent, "left_anti").select(old.columns).unionByName(new)


#: A table is broadcast up to SMALL bytes, and measured for that only where Spark expects MEASURED bytes at most.
SMALL, MEASURED = 8 << 20, 1 << 28


def small(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` marked for broadcast if its string ``columns`` are measured to have SMALL bytes at most in all, else as it is.

    For tables whose size Spark cannot tell beforehand, such as distinct values.  One job measures; tables
    that may be large are not measured and are joined by key.
    """
    expected = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(expected)) > MEASURED:
        return df
    held = df.agg(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(16))).alias("b")).first()["b"] or 0
    return F.broadcast(df) if held <= SMALL else df


#: Parts that ``numbered`` counts in.
PARTS = 1024


def numbered(df: DataFrame, keys: list[str], after: int = 0) -> DataFrame:
    """``df`` with ``_number``: whole numbers from ``after`` + 1 on without gaps, the same for the same ``keys``, which are unique.

    Rows are counted within PARTS parts by the hash of their keys; the parts' totals, PARTS rows, say where
    each part begins.  So no task sorts the whole table.
    """
    part = F.pmod(F.xxhash64(*keys), F.lit(PARTS)).cast("int")
    own = df.withColumn("_part", part)
    sums = own.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    total = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = sums.select("_part", total.alias("_begin"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return own.withColumn("_inside", inside).join(begins, "_part").withColumn("_number", F.lit(after) + F.col("_begin") + F.col("_inside")).drop("_part", "_inside", "_begin")


def delta(df: DataFrame, since: Column, *stamps: str) -> DataFrame:
    """Rows created or updated from ``since`` on."""
    return df.where(F.greatest(*[F.col(s) for s in stamps]) >= since if len(stamps) > 1 else F.col(stamps[0]) >= since)


def as_of_pair(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, value: str, left_id: str) -> DataFrame:
    """``left`` with ``before_id`` and ``after_id``: ``right``'s last value before the time, its first at or after it.

    Both sides go into one ordered sequence per key, so the cost does not follow the product of the
    two sides' lengths; ties in time go to the smallest value after and the largest before.
    """
    a = left.where(F.col(left_time).isNotNull()).select(F.col(key).alias("_k"), F.col(left_time).alias("_t"), F.lit(0).alias("_side"), F.col(left_id).alias("_id"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    b = right.where(F.col(right_time).isNotNull()).select(F.col(key).alias("_k"), F.col(right_time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(left.schema[left_id].dataType).alias("_id"), F.col(value).alias("_v"))
    # A row of the left stands before the right's rows of the same time: they count as after.
    forward = Window.partitionBy("_k").orderBy("_t", "_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    backward = Window.partitionBy("_k").orderBy("_t", "_side", "_v").rowsBetween(0, Window.unboundedFollowing)
    both = a.union(b).withColumn("before_id", F.last("_v", ignorenulls=True).over(forward)).withColumn("after_id", F.first("_v", ignorenulls=True).over(backward))
    pairs = both.where("_side = 0").select(F.col("_id").alias(left_id), "before_id", "after_id")
    return left.join(pairs.dropDuplicates([left_id]), left_id, "left")
