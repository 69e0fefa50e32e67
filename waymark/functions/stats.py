"""Closed-form statistics as column expressions and small aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def wilson_lower(successes: Column, n: Column, z: float = 1.96) -> Column:
    """Lower bound of the Wilson score interval; 0 for no trials."""
    p = successes / n
    z2 = z * z
    centre = p + z2 / (2 * n)
    spread = z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))
    return F.when(n > 0, (centre - spread) / (1 + z2 / n)).otherwise(F.lit(0.0))


def noisy_or(strengths: Column, cap: float) -> Column:
    """1 minus the product of the complements of an array, taken in sorted order so the rounding is stable; at most ``cap``."""
    rest = F.aggregate(F.array_sort(strengths), F.lit(1.0), lambda acc, s: acc * (1.0 - s))
    return F.round(F.least(F.lit(cap), 1.0 - rest), 4)


def cohen_kappa(rated: DataFrame, a: str, b: str, *group: str) -> DataFrame:
    """``(group, n, kappa)`` of two raters' labels; null kappa where chance agreement is complete. Rows lacking either label do not count."""
    pairs = rated.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    table = pairs.groupBy(*group, F.col(a).alias("_a"), F.col(b).alias("_b")).agg(F.count("*").alias("_n"))
    part = Window.partitionBy(*group)
    table = table.withColumns({"_row": F.sum("_n").over(Window.partitionBy(*group, "_a")), "_col": F.sum("_n").over(Window.partitionBy(*group, "_b")), "_all": F.sum("_n").over(part)})
    rows = table.groupBy(*group, F.col("_a").alias("_l")).agg(F.max("_row").alias("_p"), F.max("_all").alias("_all"))
    cols = table.groupBy(*group, F.col("_b").alias("_l")).agg(F.max("_col").alias("_q"))
    chance = rows.join(cols, [*group, "_l"]).groupBy(*group).agg(F.sum(F.col("_p") * F.col("_q") / (F.col("_all") * F.col("_all"))).alias("_e"))
    seen = table.groupBy(*group).agg(F.sum(F.when(F.col("_a") == F.col("_b"), F.col("_n")).otherwise(0)).alias("_agree"), F.max("_all").alias("n"))
    both = seen.join(chance, list(group), "left") if group else seen.join(F.broadcast(chance), F.lit(True), "left")
    e = F.coalesce(F.col("_e"), F.lit(0.0))
    return both.select(*group, "n", F.when(e < 1, F.round((F.col("_agree") / F.col("n") - e) / (1 - e), 6)).alias("kappa"))


def kendall_tau(ranked: DataFrame, key: str, x: str, y: str, *group: str, digits: int = 6) -> DataFrame:
    """``(group, n, tau)``: Kendall's tau-a of two score columns, from discordance counts over binned ranks of ``y``.

    Within a group both columns are replaced by dense ranks; the number of pairs ordered alike and unlike is counted from the
    table of rank pairs, in which equal rows are one cell, so work follows distinct rank pairs. Groups are meant to be small
    lists (ranks of one country); their distinct rank pairs are joined with each other.
    """
    cells = ranked.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*group, F.col(x).alias("_x"), F.col(y).alias("_y")).agg(F.count(key).alias("_n"))
    other = cells.select(*group, F.col("_x").alias("_x2"), F.col("_y").alias("_y2"), F.col("_n").alias("_n2"))
    on = [F.col("_x") < F.col("_x2")]
    both = cells.alias("l").join(other.alias("r"), [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in group] + on)
    s = both.groupBy(*[F.col(f"l.{g}").alias(g) for g in group]).agg(F.sum(F.signum((F.col("_y2") - F.col("_y")).cast("double")) * F.col("_n") * F.col("_n2")).alias("_s"))
    size = cells.groupBy(*group).agg(F.sum("_n").alias("n"))
    joined = size.join(s, list(group), "left")
    n = F.col("n")
    return joined.select(*group, "n", F.round(F.coalesce(F.col("_s"), F.lit(0.0)) / (n * (n - 1) / 2), digits).alias("tau")).where(n > 1)
