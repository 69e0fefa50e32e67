"""Differences between consecutive full snapshots of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .latest import latest_rows


def content_hash(columns: Sequence[str]) -> Column:
    """128 bits over the columns in which null differs from every value."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b"))


def snapshot_changes(rows: DataFrame, snapshot: str, key: str, version: str, compare: Sequence[str]) -> DataFrame:
    """``(snapshot, key, diff)`` with diff ``added``, ``removed`` or ``changed`` against the snapshot just before.

    Each key's snapshots are put in order by one window; a lagged hash shows a change, a gap in the snapshot index shows a
    removal and, at its other end, a later addition. One pass covers any number of snapshots.

    * Several rows of a key in one snapshot: the greatest ``version`` counts, ties by the compared values.
    * Rows without key or snapshot number are ignored; null compared values are values of their own.
    * "Just before" means the preceding snapshot that is present; nothing is reported for the first one.
    * An empty input gives an empty result; other columns of ``rows`` are not read.

    The reduction to one row per key and snapshot has a map-side part, so a key holding a third of all rows reaches the
    window as one row per snapshot. Only the list of snapshot numbers (one row per delivery) is broadcast.
    """
    slim = rows.select(F.col(snapshot).alias("_s"), F.col(key).alias("_k"), F.col(version).alias("_v"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(compare)])
    names = [f"_c{i}" for i in range(len(compare))]
    slim = slim.where(F.col("_k").isNotNull() & F.col("_s").isNotNull())
    state = latest_rows(slim, ["_k", "_s"], "_v", names).select("_k", "_s", content_hash(names).alias("_h"))
    listed = rows.select(F.col(snapshot).alias("_s")).where(F.col("_s").isNotNull()).distinct()
    order = listed.select("_s", F.row_number().over(Window.orderBy("_s")).alias("_i"), F.lead("_s").over(Window.orderBy("_s")).alias("_next"))
    by_key = Window.partitionBy("_k").orderBy("_i")
    seen = state.join(F.broadcast(order), "_s").select(
        "_k", "_s", "_i", "_next", "_h",
        F.lag("_i").over(by_key).alias("_pi"), F.lag("_h").over(by_key).alias("_ph"), F.lead("_i").over(by_key).alias("_ni"),
    )
    follows = F.coalesce(F.col("_pi") == F.col("_i") - 1, F.lit(False))
    here = F.when((F.col("_i") > 1) & ~follows, F.lit("added")).when(follows & (F.col("_h") != F.col("_ph")), F.lit("changed"))
    gone = F.col("_next").isNotNull() & ~F.coalesce(F.col("_ni") == F.col("_i") + 1, F.lit(False))
    events = F.filter(
        F.array(
            F.struct(F.col("_s").alias("s"), here.alias("d")),
            F.struct(F.col("_next").alias("s"), F.when(gone, F.lit("removed")).alias("d")),
        ),
        lambda e: e["d"].isNotNull(),
    )
    return seen.select("_k", F.explode(events).alias("_e")).select(F.col("_e.s").alias(snapshot), F.col("_k").alias(key), F.col("_e.d").alias("diff"))
