"""Profiling over a stream of alignment files: counts by micro-batch, totals on demand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def running_counts(alignments: DataFrame) -> DataFrame:
    """Running base and insert totals per feature of a streaming table (feature, insert_id, cov)."""
    return alignments.groupBy("feature").agg(F.sum("cov").alias("bases"), F.count("*").alias("rows"))


def windowed_events(events: DataFrame, *, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Count and sum by event type in tumbling windows with a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")


def append_profiles(stream: DataFrame, profile, path: str, checkpoint: str):
    """A query that profiles each micro-batch and appends it under its batch number, so a replay overwrites itself."""

    def write(batch: DataFrame, number: int) -> None:
        profile(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
