"""Session-level helpers: durable intermediate results."""

from __future__ import annotations

import tempfile
import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session, setting one only where none is set.

    A cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    master may fall back to a temporary folder of the machine.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tunequorum-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


#: Scratch paths handed out by this driver and not yet deleted: when, and to which thread.
_handed_out: dict[str, tuple[int, int]] = {}


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path of its own in the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"
    _handed_out[path] = time.monotonic_ns(), threading.get_ident()
    return path


def scratch_mark() -> int:
    """A time; what is handed out later comes after it."""
    return time.monotonic_ns()


def scratch_since(mark: int) -> list[str]:
    """The scratch paths that this thread got after the mark."""
    return [path for path, (at, thread) in list(_handed_out.items()) if at >= mark and thread == threading.get_ident()]


def delete_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that no DataFrame in use reads any more; paths of others are refused."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        if path not in _handed_out:
            raise ValueError(f"not a scratch path of this driver: {path}")
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
        del _handed_out[path]  # what tasks get carries this table


#: Bytes of a batch of rows that goes to a Python worker. The JVM holds a batch several times outside its heap.
BATCH = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Let the session hand rows to Python workers in batches of BATCH bytes at most; a row may be larger than that.

    Rows that carry matrix blocks have megabytes each. With the default of 64 MB the copies of a batch in Arrow vectors and in
    the stream to the worker, for every task, are more than an executor has beside its heap.
    """
    if spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() > BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH))


def durable(df: DataFrame, partition_by: tuple[str, ...] = (), rows_per_file: int = 0) -> DataFrame:
    """Write a result that several branches read to a new table beside the checkpoints, and read it back.

    This cuts the lineage like a checkpoint, computes the result once, keeps it columnar and lets
    later reads prune columns, row groups and partitions. Rows of megabytes need ``rows_per_file``: a reader holds whole pages,
    and a writer only looks every hundred rows whether a page is full.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "tables")
    df.write.partitionBy(*partition_by).option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
