"""Incremental validation and windowed counts with Structured Streaming (extensions)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import content_hash
from ..operators import validate


def validated(stream: DataFrame, output: str = "output", domain: str = "domain") -> DataFrame:
    """A stream of records with their result; stateless, so that it fits any sink."""
    return validate.validated(stream, output, domain, "validation")


def first_seen(stream: DataFrame, text: str, time: str, delay: str = "1 hour") -> DataFrame:
    """Rows whose text wasn't seen within the watermark's delay."""
    return stream.withColumn("_h", content_hash(F.col(text))).withWatermark(time, delay).dropDuplicatesWithinWatermark(["_h"]).drop("_h")


def window_counts(stream: DataFrame, time: str = "ts", kind: str = "event_type", width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    rows = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return rows.groupBy(F.window(time, width), kind).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append"):
    """Handles what has arrived since the last run, and stops; the checkpoint resumes it."""
    return stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_parquet_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet files as they arrive in a folder; of a single file's path, that file."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        return reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
    return reader.parquet(path)
