"""Notability, country and global ranks, tiers and their calibration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import Stored, broadcast_if_small
from .candidates import whole_property
from .ranks import Down, ranked_in_groups


@dataclass(frozen=True)
class NotabilityRule:
    """Weights of the terms."""

    pageview_weight: float = 0.5
    pageview_divisor: float = 1000.0
    cap: float = 1.5
    whs: float = 1.0
    national: float = 0.2
    iucn: float = 0.4
    protected: float = 0.5
    size_cap: float = 0.15
    size_coefficient: float = 0.15
    size_from: int = 100_000


def notability(rule: NotabilityRule = NotabilityRule(), score: Column | None = None, pageviews: Column | None = None, strict: Column | None = None, protected: Column | None = None) -> Column:
    """log10(1 + sitelinks or score) + weighted log10 of pageviews + recognition + size. Null inputs count as absent."""
    sl = F.coalesce(score, F.col("sitelinks").cast("double")) if score is not None else F.col("sitelinks").cast("double")
    no = F.lit(False)
    strict, protected = (strict if strict is not None else no), (protected if protected is not None else no)
    r = F.when(whole_property(F.col("whs")), rule.whs).otherwise(0.0) + F.when(F.size("heritage") > 0, rule.national).otherwise(0.0)
    r = r + F.when(strict, rule.iucn).when(protected, rule.protected).otherwise(0.0)
    views = F.coalesce(pageviews, F.lit(0)).cast("double") if pageviews is not None else F.lit(0.0)
    pop = F.coalesce(F.col("population"), F.lit(0)).cast("double")
    size = F.when(pop >= rule.size_from, F.least(F.lit(rule.size_cap), rule.size_coefficient * F.log10(pop / rule.size_from))).otherwise(0.0)
    n = F.log10(1.0 + F.greatest(F.coalesce(sl, F.lit(0.0)), F.lit(0.0))) + rule.pageview_weight * F.log10(1.0 + views / rule.pageview_divisor) + F.least(r, F.lit(rule.cap)) + size
    return F.round(n, 6)


@dataclass(frozen=True)
class TierRule:
    """How many places of a country reach a tier, and the global percentiles."""

    icon_by_whs: tuple = ((9, 4), (30, 6), (None, 8))
    small_below: int = 10
    small_icons: int = 1
    major_percentile: float = 95.0
    major_next: int = 30
    small_next: int = 3
    notable_percentile: float = 75.0
    notable_share: float = 0.4


def icon_count(whs: Column, steps: tuple) -> Column:
    out = F.lit(steps[-1][1])
    for limit, top in reversed(steps):
        out = F.lit(top) if limit is None else F.when(whs <= limit, F.lit(top)).otherwise(out)
    return out


def global_percentile(df: DataFrame, value: str, into: str) -> DataFrame:
    """Adds 100 times the share of rows with a smaller value.

    Counts per distinct value are summed first, so the one ordered pass sees distinct rounded values and not rows; the pass
    runs over ranges of the value and their totals, not in one task.
    """
    counts = df.groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_band", F.floor(F.coalesce(F.col("_v").cast("double"), F.lit(-1e300)) * 100))
    inside = counts.withColumn("_in", F.coalesce(F.sum("_n").over(Window.partitionBy("_band").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    bands = counts.groupBy("_band").agg(F.sum("_n").alias("_bn"))
    # The list of bands is as long as the value's range in hundredths, whatever the number of rows.
    before = bands.withColumn("_before", F.coalesce(F.sum("_bn").over(Window.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("_all", F.sum("_bn").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    pct = inside.join(F.broadcast(before), "_band").select("_v", (100.0 * (F.col("_in") + F.col("_before")) / F.col("_all")).alias(into))
    return df.join(pct, df[value].eqNullSafe(pct["_v"]), "left").drop("_v")


def country_rank(df: DataFrame, country: str, value: str, *ties: str) -> DataFrame:
    """Adds ``rank`` (from 0, by falling value) and ``size`` per country, however large a country is."""
    return ranked_in_groups(df, [country], [Down(value), *[F.col(t) for t in ties]])


def assign_tiers(df: DataFrame, rule: TierRule = TierRule(), ties: tuple = ("name_en", "qid")) -> DataFrame:
    """Adds ``tier`` and ``tier_reason`` from the rank in the country and the global percentile of ``n``.

    Needs iso3, n, whs and the tie columns; ends the order on a unique one. Rows without a country are one group.
    """
    df = global_percentile(df, "n", "_pct")
    df = country_rank(df, "iso3", "n", *ties)
    return with_tier(with_held(df), rule).drop("_pct", "_held", "rank", "size")


def with_held(df: DataFrame) -> DataFrame:
    """Adds ``_held``, the number of whole World Heritage properties of the row's country."""
    held = df.groupBy(F.col("iso3").alias("_i")).agg(F.sum(whole_property(F.col("whs")).cast("int")).alias("_held"))
    # One row a country; written, so that its size is known.
    held = broadcast_if_small(Stored(held, "held").df)
    return df.join(held, df["iso3"].eqNullSafe(F.col("_i")), "left").drop("_i")


def with_tier(df: DataFrame, rule: TierRule) -> DataFrame:
    small = F.col("size") < rule.small_below
    icons = F.when(small, rule.small_icons).otherwise(icon_count(F.col("_held"), rule.icon_by_whs))
    following = F.when(small, rule.small_next).otherwise(rule.major_next)
    r, p = F.col("rank"), F.col("_pct")
    icon, major = r < icons, (p >= rule.major_percentile) | (r < icons + following)
    notable = (p >= rule.notable_percentile) | (r < F.lit(rule.notable_share) * F.col("size"))
    pick = lambda a, b, c, d: F.when(icon, a).when(major, b).when(notable, c).otherwise(d)
    return df.withColumns({
        "tier": pick("Icon", "Major", "Notable", "Local"),
        "tier_reason": pick("top of its country", "global p95 or next of its country", "global p75 or top 40 % of country", "the rest"),
    })


def tier_violations(rows: DataFrame, tier: str, least: str, most: str) -> DataFrame:
    """Adds ``violation``: below ``least``, above ``most``, or null; null bounds do not bind."""
    from ..functions.identity import tier_rank

    t = tier_rank(tier)
    return rows.withColumn("violation", F.when(t < tier_rank(least), F.lit("below")).when(t > tier_rank(most), F.lit("above")))
