"""Structured Streaming over folders where files land.  An extension: the batch jobs have no streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def landed(spark: SparkSession, folder: str, schema: StructType, form: str = "parquet", files_per_batch: int = 100) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return (reader.option("header", True) if form == "csv" else reader).format(form).load(folder)


def event_counts(events: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per kind and tumbling window; state older than the watermark is dropped."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), kind).agg(F.count("*").alias("n")).select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), kind, "n"
    )


def first_seen(files: DataFrame, time: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """One row per key within the watermark, so that a file that lands twice counts once."""
    return files.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def run_available(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what has landed, batch by batch, and stop; the checkpoint makes a later run go on from there."""
    q = df.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
