"""Streams of visits and other events: windowed counts, and the last state of every key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, at: str, keys: list[str], width: str, late: str) -> DataFrame:
    """``(start, keys, n)`` by event time in windows of ``width``; events later than ``late`` behind the newest are dropped."""
    return (
        events.withWatermark(at, late).groupBy(F.window(at, width), *keys).agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("start"), *keys, "n")
    )


def distinct_events(events: DataFrame, key: str, at: str, late: str) -> DataFrame:
    """Events whose key has not been seen within the watermark; state is bounded by ``late``."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def last_state(events: DataFrame, key: str, at: str, tie: str, columns: list[str]) -> DataFrame:
    """The latest state per key, for an update- or complete-mode sink; the same rule as for tables, kept as aggregation state."""
    best = F.max(F.struct(at, tie, *columns)).alias("_r")
    return events.groupBy(key).agg(best).select(key, *[F.col("_r")[c].alias(c) for c in (at, *columns)])
