"""What operators ask of a session: the shared folder and the size of Arrow batches."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Upper bound of one Arrow batch sent to a Python worker; a longer single text still travels whole.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 4096


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Where it is unset, a session in one process gets a temporary folder, recorded in the same setting;
    a session on a cluster gets an error, since no folder of one machine would do.
    """
    found = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lexloom-")
        spark.conf.set(CHECKPOINT_CONF, found)
    return found.rstrip("/")


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes and rows, so that a worker's memory does not follow text length; lower bounds stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
