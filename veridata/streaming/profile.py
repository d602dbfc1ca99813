"""A running profile of an event stream: an extension, the batch aggregates over windows with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_profile(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Per window and event type: rows, missing values, mean; repeated event ids inside the watermark count once."""
    once = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    return once.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").isNull().cast("long")).alias("n_missing"), F.avg("value").alias("mean")).select(F.col("window.start").alias("start"), "event_type", "n", "n_missing", "mean")
