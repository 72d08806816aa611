"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null: empty) with the further columns asked for; all others are pruned from the scan."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def shared_dir(spark: SparkSession, kind: str) -> str:
    """A fresh path in the folder that all executors share (spark.checkpoint.dir)."""
    base = checkpointed(spark)
    return f"{base.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def checkpointed(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where it is unset, as in tests, a local session gets one of this machine; on a cluster
    that is an error, as executors wouldn't see each other's files."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "/tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(base)
    return base


def written(df: DataFrame, kind: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends there, so a lost executor costs only what it was running."""
    spark = df.sparkSession
    path = shared_dir(spark, kind)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that written() made, once nothing reads them any more; other tables are left alone."""
    for t in tables:
        if path := getattr(t, "_written_to", None):
            at = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def give_back() -> None:
    """Returns the memory that a worker has freed to the machine. Else a worker that waits for its next task holds the most that its last
    one took, while the others of its executor need it."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
        trim(0)


def from_system(fn: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """fn of the batches, which Arrow keeps in the system's memory: its own pool holds batches that are done, of which each is tens
    of MB, until the task ends."""
    pa.set_memory_pool(pa.system_memory_pool())
    return fn(batches)


def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task, after which its memory is given back."""
    yield from batches
    give_back()


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, rows: int = 1024) -> DataFrame:
    """mapInArrow with batches of `rows` rows at most, so that what a function makes of a batch stays small. Spark itself ends
    a batch at spark.sql.execution.arrow.maxBytesPerBatch; no setting of the session is touched."""

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, max(1, b.num_rows), rows):
                yield b.slice(at, rows)

    return df.mapInArrow(lambda batches: ended(from_system(fn, small(batches))), schema)
