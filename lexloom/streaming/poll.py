"""Incremental ingestion: publication events as a stream, state as deltas of a table, replay without effect."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.operators.keyed import distinct_on

#: Deltas after which they and the snapshot before them become one snapshot.
COMPACT_EVERY = 16


@dataclass
class TableState:
    """A keyed table under ``path``: a snapshot and the deltas written since.

    A batch writes its own rows only, as delta ``d=<number>-<query>-<batch>``; the number is the state's
    own, so any number of queries and checkpoints may write one after the other.  A batch is known by the
    pair (query, batch): one that is replayed after a failure finds itself and writes nothing, and a new
    checkpoint is a new query, whose batches are new.  The state is, for each key, the first row in
    ``order`` of all that were written; among rows equal in ``order`` the ``latest`` written, or else the
    earliest.  Every COMPACT_EVERY deltas a snapshot ``s=<number>`` takes their place; what it replaces is
    deleted one snapshot later, so that readers of the state before may finish.
    """

    spark: SparkSession
    path: str
    keys: list[str]
    order: list[Column] = field(default_factory=list)
    latest: bool = False

    def _fs(self):
        place = self.spark._jvm.org.apache.hadoop.fs.Path
        return place(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _names(self) -> list[str]:
        fs, place = self._fs()
        return sorted(s.getPath().getName() for s in fs.listStatus(place(self.path))) if fs.exists(place(self.path)) else []

    def _complete(self, name: str) -> bool:
        fs, place = self._fs()
        return fs.exists(place(f"{self.path}/{name}/{'_applied.json' if name.startswith('s=') else '_SUCCESS'}"))

    def snapshots(self) -> list[int]:
        return [int(n[2:]) for n in self._names() if n.startswith("s=") and self._complete(n)]

    def deltas(self) -> list[tuple[int, str, int]]:
        """(number, query, batch) of the complete deltas since the newest snapshot, in order."""
        base = max(self.snapshots(), default=-1)
        parts = [n[2:].split("-") for n in self._names() if n.startswith("d=") and self._complete(n)]
        return sorted((int(p[0]), p[1], int(p[2])) for p in parts if int(p[0]) > base)

    def applied(self) -> dict[str, int]:
        """The last batch of each query that the state holds; a query can repeat only its last."""
        out: dict[str, int] = {}
        if base := self.snapshots():
            fs, place = self._fs()
            stream = fs.open(place(f"{self.path}/s={base[-1]:012d}/_applied.json"))
            try:
                out = json.loads(bytes(stream.readAllBytes()).decode())
            finally:
                stream.close()
        for _, query, batch in self.deltas():
            out[query] = max(batch, out.get(query, -1))
        return out

    def read(self) -> DataFrame | None:
        """The state; None where nothing was ever written."""
        base, deltas = self.snapshots(), self.deltas()
        parts = [(b, self.spark.read.parquet(f"{self.path}/s={b:012d}")) for b in base[-1:]]
        parts += [(n, self.spark.read.parquet(f"{self.path}/d={n:012d}-{query}-{batch}")) for n, query, batch in deltas]
        if len(parts) < 2:
            return parts[0][1] if parts else None
        both = None
        for number, df in parts:
            own = df.withColumn("_number", F.lit(number))
            both = own if both is None else both.unionByName(own)
        age = F.col("_number").desc() if self.latest else F.col("_number").asc()
        return distinct_on(both, self.keys, [*self.order, age]).drop("_number")

    def write(self, rows: DataFrame, query: str, batch: int) -> bool:
        """Adds ``rows`` as what (query, batch) brings; False, and nothing, if the state holds it already."""
        query = query.replace("-", "")
        if batch <= self.applied().get(query, -1):
            return False
        number = max([*self.snapshots(), *(d[0] for d in self.deltas())], default=-1) + 1
        # A row equal in order to one of its batch is no better than it: any stays.
        distinct_on(rows, self.keys, self.order or [F.col(k) for k in self.keys]).write.mode("overwrite").parquet(f"{self.path}/d={number:012d}-{query}-{batch}")
        if len(self.deltas()) >= COMPACT_EVERY:
            self.compact()
        return True

    def compact(self) -> None:
        """One snapshot for all that was written so far."""
        deltas = self.deltas()
        if not deltas:
            return
        number, before, applied = deltas[-1][0], max(self.snapshots(), default=-1), self.applied()
        fs, place = self._fs()
        self.read().write.mode("overwrite").parquet(f"{self.path}/s={number:012d}")
        out = fs.create(place(f"{self.path}/s={number:012d}/_applied.json"), True)
        try:
            out.write(json.dumps(applied).encode())
        finally:
            out.close()
        for name in self._names():
            own = int(name[2:].split("-")[0])
            if own < before or (own == before and name.startswith("d=")):
                fs.delete(place(f"{self.path}/{name}"), True)


def into(state: TableState):
    """A ``foreachBatch`` function that puts each batch's rows into ``state``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("a batch belongs to a streaming query")
        state.write(batch, query, batch_id)

    return run


def run_available(stream: DataFrame, each, checkpoint: str) -> None:
    """Everything that has landed, in batches, from where the checkpoint left off."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def poll(
    stream: DataFrame, state: TableState, checkpoint: str, *, since: str | None = None, until: str | None = None, updated: str = "updated", types: tuple[str, ...] | None = None, kind: str = "legislation_type",
) -> DataFrame | None:
    """The state after all publication events that have landed; what is not processed stays before the cursor.

    The cursor is the stream's checkpoint.  How much a batch takes is the source's setting (such as
    ``maxFilesPerTrigger``), so a cap never skips events, it only ends a batch.  Events before the day
    ``since`` or after the day ``until``, and those of other ``types``, are not taken.  A document that is
    published again comes up again: the state's order says which event stands for it.
    """
    day = F.substring(F.col(updated).cast("string"), 1, 10)
    if since is not None:
        stream = stream.where(day >= since)
    if until is not None:
        stream = stream.where(day <= until)
    if types is not None:
        stream = stream.where(F.col(kind).isin(*types))
    run_available(stream, into(state), checkpoint)
    return state.read()


def to_ingest(events: DataFrame, taken: DataFrame | None, key: str = "document_id", updated: str = "updated") -> DataFrame:
    """The first event of each document that is later than what was ``taken`` (key, updated) of it before.

    A document that was published again since then is due again, one without a later event is not.
    """
    if taken is not None:
        last = taken.groupBy(key).agg(F.max(updated).alias("_last"))
        events = events.join(last, key, "left").where(F.col("_last").isNull() | (F.col(updated) > F.col("_last"))).drop("_last")
    rest = [F.col(c) for c in events.columns if c not in (key, updated)]
    return distinct_on(events, [key], [F.col(updated), *rest])


def windowed_counts(stream: DataFrame, time: str, by: str, width: str, late: str) -> DataFrame:
    """Counts by tumbling window and ``by``; rows later than ``late`` behind the newest time are dropped."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))


def distinct_events(stream: DataFrame, time: str, key: str, late: str) -> DataFrame:
    """The stream without repeated keys, remembered for ``late``."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def work_dir(spark: SparkSession, root: str, name: str) -> str:
    """A folder of its own below ``root`` that is deleted when the driver's JVM ends."""
    path = f"{root.rstrip('/')}/lexloom-stream/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(place)
    system.deleteOnExit(place)
    return path
