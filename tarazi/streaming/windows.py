"""Event-time windows, in batch and as a stream: an extension beyond the incremental batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly(events: DataFrame, width: str = "1 hour") -> DataFrame:
    """Count and sum of values by window and type; on a stream the windows close with the watermark."""
    by = events.groupBy(F.window(F.col("ts"), width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return by.select(F.col("w.start").cast("timestamp").alias("window_start"), "event_type", "n", "total")


def hourly_stream(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """``hourly`` of a stream that waits ``late`` for late events; later ones are dropped by the watermark."""
    return hourly(events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late), width)
