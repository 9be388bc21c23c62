"""Streaming variants: daily files as they arrive, and sessions by event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fathomline.schema import AIS_CSV, GAP_SECONDS


def report_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """Raw reports of new CSV files in a folder."""
    return spark.readStream.schema(AIS_CSV).option("header", True).option("maxFilesPerTrigger", files_per_trigger).csv(folder)


def load_stream(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand each micro-batch and its number to ``load``, such as ``load.take_reports``, which merges the files of a day."""
    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(events: DataFrame, key: str, ts: str, value: str, gap_seconds: int = GAP_SECONDS, late: str = "10 minutes") -> DataFrame:
    """Points of a key without a gap of ``gap_seconds`` between them: start, end, count, mean; works on streams and tables."""
    if events.isStreaming:
        events = events.withWatermark(ts, late)
    return (
        events.groupBy(F.session_window(ts, f"{gap_seconds} seconds").alias("s"), key)
        .agg(F.count("*").alias("points"), F.avg(value).alias("mean_value"), F.max(ts).alias("last"))
        .select(key, F.col("s.start").alias("session_start"), F.col("last").alias("session_last"), "points", "mean_value")
    )
