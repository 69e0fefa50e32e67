"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import Stored


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(20,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, root)`` for every node that has an edge to another node; ``root`` is the least node of its component.

    Each round hangs every neighbour of a node on the least one it knows: first the greater neighbours, then the smaller
    ones. Stars are the fixed point, reached after about the logarithm of the number of nodes. Minima are combined before
    the shuffle and joined back, so a hub with a third of all edges is never gathered in one task. Every round is written
    to the shared folder, which cuts the lineage and survives lost executors.

    Null ends and loops are ignored, repeated edges count once, an empty input gives an empty result.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where(F.col("a") != F.col("b"))
    now = Stored(pairs.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(), "edges")
    before = _print(now.df)
    if before[0] == 0:
        return now.df.select(F.col("v").alias("node"), F.col("m").alias("root"))
    while True:
        both = now.df.union(now.df.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy(F.col("v").alias("u")).agg(F.min(F.least("v", "m")).alias("t"))
        # Large star: greater neighbours of u hang on the least node known to u.
        large = now.df.join(least, F.col("m") == F.col("u")).select(F.col("v"), F.col("t").alias("m")).distinct()
        # Small star: smaller neighbours of v hang on the least of them.
        low = large.groupBy(F.col("v").alias("u")).agg(F.min("m").alias("t"))
        hung = large.join(low, F.col("v") == F.col("u")).select(F.explode(F.array(F.struct("v", "t"), F.struct(F.col("m").alias("v"), "t"))).alias("e"))
        after = Stored(hung.select(F.col("e.v").alias("v"), F.col("e.t").alias("m")).where("v <> m").distinct(), "edges")
        now.drop()
        now, seen = after, _print(after.df)
        if seen == before:
            return now.df.select(F.col("v").alias("node"), F.col("m").alias("root"))
        before = seen
