"""Read models: print quotas and selection, missing kinds, calendars, keyed maxima."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import Down, ranked_in_groups


def months_filled(rows: DataFrame, key: str, day: str, value: Column, first: str, months: int = 12) -> DataFrame:
    """``(key, views, total)``: sums by month from ``first`` as an array without gaps; keys without any row in the span are absent."""
    at = (F.year(day) * 12 + F.month(day)) - (F.year(F.lit(first).cast("date")) * 12 + F.month(F.lit(first).cast("date")))
    counted = rows.select(key, at.cast("int").alias("_m"), value.alias("_v")).where(F.col("_m").between(0, months - 1)).groupBy(key, "_m").agg(F.sum("_v").alias("_v"))
    filled = counted.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_m", "_v"))).alias("_map"))
    views = F.transform(F.sequence(F.lit(0), F.lit(months - 1)), lambda m: F.coalesce(F.element_at("_map", m), F.lit(0).cast("bigint")))
    return filled.withColumn("views", views).select(key, "views", F.aggregate("views", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


def best_over_keys(rows: DataFrame, key: str, names: Column, values: DataFrame, name: str, value: str) -> DataFrame:
    """``(key, value)``: the greatest value of any of the row's names; null where no name has one."""
    exploded = rows.select(key, F.explode(F.array_distinct(names)).alias("_n"))
    best = exploded.join(values.select(F.col(name).alias("_n"), F.col(value).alias("_v")), "_n").groupBy(key).agg(F.max("_v").alias(value))
    return rows.select(key).distinct().join(best, key, "left")


def print_quota(countries: DataFrame, weight: Column, budget: int, kinds: Column, least: int = 1, most: int = 40, varied: int = 6) -> DataFrame:
    """Adds ``quota``: the budget shared by weight, rounded, between ``least`` and ``most``, and ``varied`` at least for countries of as many kinds."""
    total = countries.agg(F.sum(weight).alias("_total"))
    share = F.round(F.lit(budget) * weight / F.col("_total"), 0).cast("int")
    quota = F.greatest(F.lit(least), F.least(F.lit(most), share))
    # The total is one row.
    return countries.join(F.broadcast(total), F.lit(True)).withColumn("quota", F.when(kinds >= varied, F.greatest(quota, F.lit(varied))).otherwise(quota)).drop("_total")


def print_selection(places: DataFrame, quotas: DataFrame, country: str, key: str, order: Sequence[Column], kind: str, forced: Column, barred: Column) -> DataFrame:
    """Places for print: forced ones first, then by falling gain until the country's quota is full; barred ones never.

    ``order`` lists columns, greatest first. The gain of a place is its order, with the second and later places of one kind of a country put behind the first of every
    kind (rounds of kinds), which is the halving of novelty in rank form. Forced places count towards the quota but are not
    cut by it. Ranks come from distributed sorts, so a country of any size is spread over tasks.
    """
    free = places.where(~F.coalesce(barred, F.lit(False))).withColumn("_f", F.coalesce(forced, F.lit(False)).cast("int"))
    free = free.withColumns({f"_s{i}": o for i, o in enumerate(order)})
    falling = [Down("_f"), *[Down(f"_s{i}") for i in range(len(order))], F.col(key)]
    turns = ranked_in_groups(free, [country, kind], falling).withColumnRenamed("rank", "_turn").drop("size")
    placed = ranked_in_groups(turns, [country], [Down("_f"), F.col("_turn"), *falling[1:]])
    chosen = placed.withColumn("position", (F.col("rank") + 1).cast("int")).join(quotas.select(country, "quota"), country)
    return chosen.where((F.col("_f") == 1) | (F.col("position") <= F.col("quota"))).select(country, key, "position")


def missing_kinds(places: DataFrame, visited: DataFrame, scope: str, key: str, kind: str) -> DataFrame:
    """``(scope, kind)``: kinds that places of a scope have and visited places of it do not."""
    there = places.where(F.col(scope).isNotNull() & F.col(kind).isNotNull()).select(scope, kind).distinct()
    seen = places.join(visited.select(key), key, "left_semi").select(scope, kind).distinct()
    return there.join(seen, [scope, kind], "left_anti")


def gap_sentence(missing: DataFrame, scope: str, kind: str, order: Sequence[str]) -> DataFrame:
    """``(scope, sentence)``: one line a scope, kinds in vocabulary order."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(kind))
    names = F.transform(F.array_sort(F.collect_set(F.struct(rank.alias("r"), F.col(kind).alias("k")))), lambda x: x["k"])
    return missing.groupBy(scope).agg(F.concat(F.lit("Not yet: "), F.array_join(names, ", ")).alias("sentence"))


def last_write(rows: DataFrame, key: str, written: str, tie: str, columns: Sequence[str]) -> DataFrame:
    """The row of the latest ``written`` per key, ties by the greatest ``tie``."""
    best = F.max(F.struct(written, tie, *columns)).alias("_r")
    return rows.groupBy(key).agg(best).select(key, *[F.col("_r")[c].alias(c) for c in (written, *columns)])


def content_digest(rows: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """``(group, rows, digest)`` that does not depend on row order: the sum of 60-bit hashes of the rows, combined before the shuffle."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])
    part = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return rows.groupBy(group).agg(F.count("*").alias("rows"), F.sum(part).cast("string").alias("digest"))


def hash_sample(rows: DataFrame, stratum: str, key: str, n: int, seed: str) -> DataFrame:
    """The ``n`` rows of each stratum that come first by the seeded hash of their key, ties by key."""
    order = Window.partitionBy(stratum).orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), key)
    return rows.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).drop("_r")
