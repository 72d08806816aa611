"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where it is unset, as in tests, a local session has one of this machine; on a cluster
    that is an error, as executors wouldn't see each other's files."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "/tmp/checkpoints"
    return base.rstrip("/")


def stored(df: DataFrame, kind: str) -> DataFrame:
    """df written to the checkpoint folder and read again: lineage ends there."""
    path = f"{checkpoint_dir(df.sparkSession)}/{kind}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def bucketed(df: DataFrame, kind: str, by: str, buckets: int) -> DataFrame:
    """stored() in buckets by the hash of a column, which df should be dealt by: joins on the column don't shuffle the table."""
    name = f"{kind}_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, by).saveAsTable(name, format="parquet")
    out = df.sparkSession.table(name)
    out._stored_at, out._stored_as = path, name
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that stored() and bucketed() made, once nothing reads them any more."""
    for t in tables:
        if path := getattr(t, "_stored_at", None):
            if name := getattr(t, "_stored_as", None):
                t.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
            at = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
