"""Attention signals: how far an item's presence across sources departs from what its class and country lead one to expect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import Stored, broadcast_if_small
from .ranks import ranked_in_groups


def source_rates(profile: DataFrame, group: str | None = None) -> DataFrame:
    """``([group], source, rate)``: share of the items (of a group) that each source carries.

    ``profile``: distinct ``(item, source)`` rows, with the group if one is given. Rows without item or source do not count.
    """
    rows = profile.where("item is not null and source is not null").dropDuplicates(["item", "source"])
    keys = [group] if group else []
    hits = rows.groupBy(*keys, "source").agg(F.count("*").alias("_k"))
    size = rows.groupBy(*keys).agg(F.countDistinct("item").alias("_n"))
    joined = hits.join(size, keys) if keys else hits.join(F.broadcast(size), F.lit(True))
    return joined.select(*keys, "source", (F.col("_k") / F.col("_n")).alias("rate"))


def mass_classes(items: DataFrame, least: int) -> DataFrame:
    """``(country, class, members)`` of the classes with at least ``least`` distinct items in a country; ``items`` has one row per (item, country, class)."""
    return items.groupBy("country", "class").agg(F.countDistinct("item").alias("members")).where(F.col("members") >= least)


def main_class(items: DataFrame, mass: DataFrame) -> DataFrame:
    """``(item, country, class)``: the item's largest mass class in its country, greater name on ties; null where it has none."""
    own = items.join(mass, ["country", "class"], "left")
    best = F.max(F.when(F.col("members").isNotNull(), F.struct("members", "class")))["class"]
    return own.groupBy("item", "country").agg(best.alias("class"))


def frequent_classes(items: DataFrame, top: int) -> DataFrame:
    """The ``top`` classes by number of distinct items, ties by class."""
    return items.groupBy("class").agg(F.countDistinct("item").alias("items")).orderBy(F.desc("items"), "class").limit(top)


def with_mid_rank(df: DataFrame, value: str, groups: list[str], unique: str, into: str) -> DataFrame:
    """Adds 100 times (rows below + half the rows equal) over all rows of the group.

    Ranks come from a distributed sort that ends on ``unique``, so neither a group nor a value that a third of all rows share is
    one task's; a value's first rank and count are folded before the shuffle. Null groups are groups.
    """
    ranked = Stored(ranked_in_groups(df, groups, [F.col(value), F.col(unique)]), "ranks").df
    keys = [*groups, value]
    tied = ranked.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min("rank").alias("_below"), F.count("*").alias("_equal"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    pct = 100.0 * (2 * F.col("_below") + F.col("_equal")) / (2 * F.col("size"))
    return ranked.join(broadcast_if_small(tied), on).withColumn(into, pct).select(*df.columns, into)


def attention_scores(items: DataFrame, profile: DataFrame, least: int, ignored: list[str] = ()) -> DataFrame:
    """``(item, country, class, d, pct)``: discrimination score and its mid-rank percentile within (country, class).

    The score sums, over the item's sources, how rare the source is: against the items of the same class in all countries,
    or against all items where the item has no mass class; such items get no percentile. Items without a profile get no row.
    """
    one = main_class(items, mass_classes(items, least))
    rows = Stored(profile.where("item is not null and source is not null").dropDuplicates(["item", "source"]).join(one, "item"), "profile").df
    pooled = source_rates(rows).withColumnRenamed("rate", "_pooled")
    by_class = source_rates(rows.where("class is not null"), "class")
    rated = rows.join(broadcast_if_small(pooled), "source", "left").join(by_class, ["class", "source"], "left")
    rarity = 1.0 - F.when(F.col("class").isNull(), F.col("_pooled")).otherwise(F.col("rate"))
    counted = F.when(~F.col("source").cast("string").isin(list(ignored)), rarity).otherwise(0.0) if ignored else rarity
    scored = rated.groupBy("item", "country", "class").agg(F.round(F.sum(counted), 6).alias("d"))
    return with_mid_rank(scored, "d", ["country", "class"], "item", "pct").withColumn("pct", F.when(F.col("class").isNotNull(), F.col("pct")))


def top_share(pct, share: float):
    """True or false for items of a mass class, null for the others."""
    return pct >= 100.0 * (1.0 - share)
