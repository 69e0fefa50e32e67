"""Last-write-wins selection of one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import identity


def latest_rows(df: DataFrame, keys: Sequence[str], version: str | Column, columns: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``version``; a null version ranks last.

    Rows that tie on the version are ordered by ``columns`` from left to right (null lowest), so the result depends on
    the rows alone. Partial maxima are taken before the shuffle, so a key that holds a large share of the rows sends one
    row per partition. Null keys form a group of their own. An empty input gives an empty result.
    """
    version = F.col(version) if isinstance(version, str) else version
    best = F.max(F.struct(version.alias("_version"), *[F.col(c) for c in columns])).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_row")[c].alias(c) for c in columns])


def current_places(place: DataFrame, *columns: str) -> DataFrame:
    """The row in force of every place: latest ``loaded_at`` per ``place_id``, places whose row says retired left out."""
    cols = list(dict.fromkeys(("status", *columns)))
    rows = latest_rows(
        place.select(identity.place_id("place_id").alias("place_id"), "loaded_at", *cols).where(F.col("place_id").isNotNull()),
        ["place_id"], "loaded_at", cols,
    )
    in_force = F.coalesce(F.lower(F.trim("status")) != "retired", F.lit(True))
    return rows.where(in_force).select("place_id", *columns)
