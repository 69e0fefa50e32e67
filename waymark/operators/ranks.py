"""Ranks within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import Stored, broadcast_if_small


def ranked_in_groups(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Adds ``rank`` (from 0, by ``order``) and ``size`` of the row's group.

    Rows are range-partitioned by group and order together and sorted within partitions, so a group that holds a third of
    all rows is spread over many tasks; a row's rank is its place in its partition plus the group's rows in the partitions
    before. End ``order`` on a unique column: rows equal in all of it share a partition and rank in no stated order. Null
    groups form one group. The sorted table is written once to the shared folder, so that ranks cannot shift on a retry.
    """
    keys = [f"_o{i}" for i in range(len(order))]
    tagged = df.withColumns({k: o for k, o in zip(keys, [_value(o) for o in order])})
    sort = [F.col(g).asc_nulls_last() for g in groups] + [_direction(o, k) for o, k in zip(order, keys)]
    placed = tagged.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_at", F.monotonically_increasing_id()).drop(*keys)
    placed = Stored(placed, "ranked").df
    # The upper bits of the position are the partition.
    part = F.shiftright(F.col("_at"), 33)
    counts = placed.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], part.alias("_p")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    names = [f"_g{i}" for i in range(len(groups))]
    by = Window.partitionBy(*names).orderBy("_p")
    counts = counts.withColumns({
        "_before": F.coalesce(F.sum("_n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "size": F.sum("_n").over(Window.partitionBy(*names)),
    })
    on = part == F.col("_p")
    for g, n in zip(groups, names):
        on = on & placed[g].eqNullSafe(F.col(n))
    joined = placed.join(broadcast_if_small(counts), on)
    return joined.withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_p", "_first", "_n", "_before", *names)


class Down:
    """A column in descending order, nulls last."""

    def __init__(self, column: str | Column):
        self.column = F.col(column) if isinstance(column, str) else column


def _value(o: Column | Down) -> Column:
    return o.column if isinstance(o, Down) else o


def _direction(o: Column | Down, key: str) -> Column:
    return F.col(key).desc_nulls_last() if isinstance(o, Down) else F.col(key).asc_nulls_last()
