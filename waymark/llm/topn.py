"""The N best rows of every group by lower bounds from partitions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..runtime import Stored, broadcast_if_small


def _starts(batch: pa.RecordBatch, before: pa.RecordBatch | None, names: list[str]) -> np.ndarray:
    """Which rows of a sorted batch open a new group; ``before`` is the last row read until now."""
    new = np.zeros(batch.num_rows, dtype=bool)
    new[0] = before is None
    for name in names:
        own = batch.column(name)
        last = own.slice(0, 1) if before is None else before.column(name)
        held = pa.concat_arrays([last, own.slice(0, batch.num_rows - 1)])
        differs = pc.fill_null(pc.not_equal(own, held), pc.xor(pc.is_null(own), pc.is_null(held)))
        new |= differs.to_numpy(zero_copy_only=False)
    return new


def partition_bounds(df: DataFrame, groups: list[str], order: list[Column], n: int) -> DataFrame:
    """Rows that stand ``n``-th, by ``order``, among the rows of their group in their partition; in partitions as they are.

    Spark sorts each partition by group and order, spilling if it must; one pass then counts within runs of a group, so the
    work does not depend on how many groups there are or how large they are.
    """

    def nth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            new = _starts(batch, before, groups)
            at = np.arange(batch.num_rows)
            # Rows since the run's start; the first run goes on from the batch before.
            first = np.maximum.accumulate(np.where(new, at, -seen))
            rank = at - first
            yield batch.filter(pa.array(rank == n - 1))
            before, seen = batch.slice(batch.num_rows - 1), int(rank[-1]) + 1

    return df.sortWithinPartitions(*groups, *order).mapInArrow(nth, df.schema)


def top_n_per_group(df: DataFrame, groups: Sequence[str], score: str, key: str, n: int, stored: bool = False) -> DataFrame:
    """Rows of ``df`` that are among the first ``n`` of their group by ``score`` descending, then ``key`` ascending; adds ``rank``.

    The local N-th best row of any partition is a lower bound for the group's N-th best. Each partition yields its bounds
    in one pass over its sorted rows, the tightest bound of a group is joined back, rows behind it are dropped, and only the
    survivors (at most N per partition and group, and fewer than N of a group that no partition fills) are shuffled and
    ranked. The bound holds score and key, so ties cannot inflate it; both are compared in their own types.

    * Rows with a null score or key are not ranked and do not come out; NaN scores neither. Null group values form a group.
    * Equal (score, key) rows of a group, as repeated rows are, rank side by side in no stated order; give a unique key
      for a unique answer. ``n`` below 1 and an empty input give an empty result. Scores are numbers.
    * The input is read twice; unless ``stored`` says that it is a table already, it is written to the shared folder once.
    """
    groups = list(groups)
    rows = df.where(F.col(score).isNotNull() & F.col(key).isNotNull())
    whole = isinstance(df.schema[score].dataType, IntegralType)
    if not whole:
        rows = rows.where(~F.isnan(F.col(score).cast("double")))
    if n < 1:
        return rows.where(F.lit(False)).withColumn("rank", F.lit(0))
    rows = rows if stored else Stored(rows, "topn").df
    names = [f"_g{i}" for i in range(len(groups))]
    slim = rows.select(*[F.col(g).alias(a) for g, a in zip(groups, names)], F.col(score).alias("_s"), F.col(key).alias("_k"))
    bounds = partition_bounds(slim, names, [F.col("_s").desc(), F.col("_k").asc()], n)
    # Of two bounds the tighter one is the better N-th row: higher score, then lower key. The complement of a whole number
    # turns its order round without overflow.
    falling = lambda c: F.bitwise_not(c) if whole else -F.col(c)
    bounds = Stored(bounds.groupBy(*names).agg(F.min(F.struct(falling("_s").alias("s"), F.col("_k").alias("k"))).alias("_bound")), "bounds").df
    same = F.lit(True)
    for g, a in zip(groups, names):
        same = same & rows[g].eqNullSafe(bounds[a])
    held = rows.join(broadcast_if_small(bounds), same, "left")
    held = held.where(F.col("_bound").isNull() | (F.struct(falling(score).alias("s"), F.col(key).alias("k")) <= F.col("_bound")))
    order = Window.partitionBy(*groups).orderBy(F.col(score).desc(), F.col(key).asc())
    ranked = held.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.select(*df.columns, "rank")
