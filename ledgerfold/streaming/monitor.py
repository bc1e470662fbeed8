"""Ledger health: how many events arrive per window, system and type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def events_per_window(
    events: DataFrame, time: str = "ts", width: str = "1 day", late: str = "2 days"
) -> DataFrame:
    """Counts per window; on a stream a window closes once ``late`` has passed."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return (
        rows.groupBy(F.window(time, width).alias("w"), "source_system", "event_type")
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("w.start").alias("window_start"), "source_system", "event_type", "events")
    )
