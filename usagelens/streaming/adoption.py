"""First uses kept up to date from a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_counts(events: DataFrame, time: str, by: str, late: str = "1 day") -> DataFrame:
    """Events by day and key, late ones within `late`."""
    return events.withWatermark(time, late).groupBy(F.window(time, "1 day").alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").cast("date").alias("day"), by, "n")


def first_uses(events: DataFrame, time: str, by: list[str]) -> DataFrame:
    """Earliest time for each key; for update or complete mode."""
    return events.groupBy(*by).agg(F.min(time).alias("first_at"))
