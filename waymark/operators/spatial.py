"""Joins of points with discs and regions on space-filling-curve codes.

Points become vectors on the unit sphere, so poles and the date line need no special case. A point's Z-order code has 21
bits per axis. A disc is covered by the cells that its bounding box meets, coarser for larger discs; within a cell the codes
of the box's two corners bound those of all its points, so every cell of a cover is one range of codes. Both sides are sorted
by cell and joined where the code lies in the range; the exact distance is tested on what remains. Where a cell holds many
points, it and the covers are cut into finer cells first, and a spot that no cell can divide is spread over several tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..runtime import Stored, broadcast_if_small

BITS = 21
#: Points of a cell beyond which it is cut into finer ones, how many levels finer at most, and points of one task's cell.
CROWDED, FINER, SPOT = 2_048, 4, 16_384
AXES = ("x", "y", "z")


def level_for(km: float, cell_per_radius: float = 4.0) -> int:
    """Finest level whose cell side is at least ``cell_per_radius`` times the chord of ``km``."""
    side = max(geo.chord(km) * max(cell_per_radius, 2.0), 2.0 / 2**BITS)
    return max(0, min(BITS, int(math.floor(math.log2(2.0 / side)))))


def _level(reach: Column) -> Column:
    """``level_for`` of a chord, in steps of two levels so that few levels occur."""
    found = F.floor(-F.log2(F.greatest(reach * 2.0, F.lit(2.0 / 2**BITS))) / 2).cast("int") * 2
    return F.greatest(F.lit(0), F.least(F.lit(BITS - 1), found))


def _fine(v: Column) -> Column:
    """Cell coordinate at the finest level of a value from -1 to 1."""
    return F.greatest(F.lit(0), F.least(F.lit(2**BITS - 1), F.floor((v + 1.0) * 2.0 ** (BITS - 1)))).cast("bigint")


def _shift(c: Column, by: Column) -> Column:
    return F.call_function("shiftright", c, by.cast("int"))


def _raise(c: Column, by: Column) -> Column:
    return F.call_function("shiftleft", c, by.cast("int"))


def _prefix(code: Column, level: Column) -> Column:
    return _shift(code, (F.lit(BITS) - level) * 3)


def with_code(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Adds the unit vector ``_x _y _z`` and its Z-order code ``_code``."""
    df = df.withColumns({f"_{a}": v for a, v in zip(AXES, geo.unit_vector(F.col(lat), F.col(lon)))})
    df = df.withColumns({f"_f{a}": _fine(F.col(f"_{a}")) for a in AXES})
    return geo.with_morton3(df, "_code", "_fx", "_fy", "_fz").drop("_fx", "_fy", "_fz")


def chord(km: Column) -> Column:
    """Chord of an arc, a little too long rather than too short."""
    return (F.lit(2.0) * F.sin(F.least(km / geo.EARTH_KM, F.lit(math.pi)) / 2)) * (1 + 1e-9) + 1e-12


def _cut(df: DataFrame, level: Column, near: Callable[[Callable[[str], Column], Column], Column] | None) -> DataFrame:
    """One row per cell of ``level`` that the row's box (``_lo*``, ``_hi*``) meets, with the box clipped to the cell.

    ``near``: a test of the cell, from its lower coordinates and side, that leaves out cells which the shape misses.
    """
    step = F.lit(BITS) - level
    for a in AXES:
        df = df.withColumn(f"_c{a}", F.explode(F.sequence(_shift(F.col(f"_lo{a}"), step), _shift(F.col(f"_hi{a}"), step))))
    side = F.lit(2.0) / F.pow(F.lit(2.0), level)
    if near is not None:
        df = df.where(near(lambda a: F.col(f"_c{a}") * side - 1.0, side))
    first = {f"_lo{a}": F.greatest(F.col(f"_lo{a}"), _raise(F.col(f"_c{a}"), step)) for a in AXES}
    last = {f"_hi{a}": F.least(F.col(f"_hi{a}"), _raise(F.col(f"_c{a}") + 1, step) - 1) for a in AXES}
    return df.withColumns({**first, **last}).drop("_cx", "_cy", "_cz")


def _range_join(shapes: DataFrame, points: DataFrame, levels: Sequence[int], same: Sequence[tuple[str, str]], on: Column, near) -> DataFrame:
    """``shapes`` with a box and ``_lv``, one of ``levels``, joined with ``points``, a stored table with ``_code``; helper columns
    are dropped.

    A pair meets once: a shape has one level, and at a level a point lies in one cell.
    """
    ls, rs = [a for a, _ in same], [b for _, b in same]
    right = points.withColumn("_rlv", F.explode(F.array(*[F.lit(v) for v in levels] or [F.lit(0)])))
    right = right.withColumn("_rcell", _prefix(F.col("_code"), F.col("_rlv")))
    count = right.groupBy(*rs, "_rlv", "_rcell").agg(F.count("*").alias("_n")).where(F.col("_n") > CROWDED)
    # A cell's points lie on a surface: a level finer divides them by about four.
    finer = F.least(F.lit(FINER), F.lit(BITS) - F.col("_rlv"), F.ceil(F.log2(F.col("_n") / CROWDED) / 2).cast("int"))
    crowded = Stored(count.withColumn("_finer", finer.cast("int")).drop("_n"), "crowded").df
    left = _cut(shapes, F.col("_lv"), near)
    if crowded.isEmpty():
        left, right = left.withColumns({"_finer": F.lit(0), "_part": F.lit(0)}), right.withColumns({"_rfiner": F.lit(0), "_rpart": F.lit(0)})
    else:
        known = broadcast_if_small(crowded.select(*[F.col(r).alias(f"_k{i}") for i, r in enumerate(rs)], F.col("_rlv").alias("_klv"), F.col("_rcell").alias("_kcell"), "_finer"))

        def refined(df: DataFrame, keys: list[str], lv: str, cell: Column, into: str) -> DataFrame:
            match = (F.col(lv) == F.col("_klv")) & (cell == F.col("_kcell"))
            for i, k in enumerate(keys):
                match = match & (F.col(k) == F.col(f"_k{i}"))
            out = df.join(known, match, "left").withColumn(into, F.coalesce("_finer", F.lit(0)))
            return out.drop("_klv", "_kcell", *[f"_k{i}" for i in range(len(keys))], *([] if into == "_finer" else ["_finer"]))

        left = geo.with_morton3(left, "_low", "_lox", "_loy", "_loz")
        left = refined(left, ls, "_lv", _prefix(F.col("_low"), F.col("_lv")), "_finer").drop("_low")
        left = _cut(left, F.col("_lv") + F.col("_finer"), near)
        right = refined(right, rs, "_rlv", F.col("_rcell"), "_rfiner")
        right = right.withColumn("_rcell", _prefix(F.col("_code"), F.col("_rlv") + F.col("_rfiner")))
        spots = right.where("_rfiner > 0").groupBy(*rs, "_rlv", "_rfiner", "_rcell").agg(F.count("*").alias("_n")).where(F.col("_n") > SPOT)
        spots = Stored(spots.withColumn("_parts", F.ceil(F.col("_n") / SPOT).cast("int")).drop("_n"), "spots").df
        if spots.isEmpty():
            left, right = left.withColumn("_part", F.lit(0)), right.withColumn("_rpart", F.lit(0))
        else:
            keys = [*rs, "_rlv", "_rfiner", "_rcell"]
            small = broadcast_if_small(spots.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)], "_parts"))
            left = geo.with_morton3(left, "_low", "_lox", "_loy", "_loz")
            mine = [*[F.col(c) for c in ls], F.col("_lv"), F.col("_finer"), _prefix(F.col("_low"), F.col("_lv") + F.col("_finer"))]
            pick = lambda cols: _all([c == F.col(f"_s{i}") for i, c in enumerate(cols)])
            left = left.join(small, pick(mine), "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
            left = left.drop("_low", "_parts", *[f"_s{i}" for i in range(len(keys))])
            # Every copy of a shape meets its own share of the spot's points.
            share = F.pmod(F.xxhash64(*[c for c in points.columns if c != "_code"]), F.coalesce("_parts", F.lit(1))).cast("int")
            right = right.join(small, pick([F.col(k) for k in keys]), "left").withColumn("_rpart", share).drop("_parts", *[f"_s{i}" for i in range(len(keys))])
    left = geo.with_morton3(left, "_low", "_lox", "_loy", "_loz")
    left = geo.with_morton3(left, "_high", "_hix", "_hiy", "_hiz")
    left = left.withColumn("_cell", _prefix(F.col("_low"), F.col("_lv") + F.col("_finer"))).drop(*[f"_{e}{a}" for e in ("lo", "hi") for a in AXES])
    equal = [F.col(a) == F.col(b) for a, b in [*same, ("_cell", "_rcell"), ("_lv", "_rlv"), ("_finer", "_rfiner"), ("_part", "_rpart")]]
    joined = left.join(right, _all([*equal, F.col("_code").between(F.col("_low"), F.col("_high")), on]))
    return joined.drop("_cell", "_lv", "_finer", "_part", "_low", "_high", "_rcell", "_rlv", "_rfiner", "_rpart", "_code", "_reach")


def _levels(shapes: DataFrame) -> list[int]:
    """The levels that occur, of which the curve has few."""
    return [r[0] for r in shapes.select("_lv").distinct().collect()]


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _discs(left: DataFrame, lat: str, lon: str, km: Column, level: Column | None) -> DataFrame:
    df = with_code(left, lat, lon).drop("_code").withColumn("_reach", chord(km))
    box = {f"_lo{a}": _fine(F.col(f"_{a}") - F.col("_reach")) for a in AXES} | {f"_hi{a}": _fine(F.col(f"_{a}") + F.col("_reach")) for a in AXES}
    return df.withColumns({**box, "_lv": _level(F.col("_reach")) if level is None else level})


def _disc_meets(low: Callable[[str], Column], side: Column) -> Column:
    gap = F.lit(0.0)
    for a in AXES:
        d = F.greatest(low(a) - F.col(f"_{a}"), F.col(f"_{a}") - (low(a) + side), F.lit(0.0))
        gap = gap + d * d
    return gap <= F.col("_reach") * F.col("_reach")


def coded(points: DataFrame, lat: str, lon: str, name: str = "coded") -> DataFrame:
    """The located rows of ``points`` with ``_code``, as a stored table that several joins can read."""
    return Stored(with_code(points.where(geo.located(F.col(lat), F.col(lon))), lat, lon).drop("_x", "_y", "_z"), name).df


def points_near_points(left: DataFrame, right: DataFrame, km: float | Column, left_pos: tuple[str, str], right_pos: tuple[str, str], extra: Column | None = None, same: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Rows of ``left`` joined with the rows of ``right`` at most ``km`` away; adds ``distance_km``.

    ``km`` is a number or a column of ``left``; discs of one join may have any radii. Column names of the two sides must
    differ and not begin with an underscore. Rows that are not located (null, NaN, out of range, 0/0) have no partners.
    ``same`` lists pairs of columns that must be equal and become join keys (null equals nothing); ``extra`` is a further
    condition. ``right`` may be a table made by ``coded``; otherwise it is written once.

    Cells are at least four radii wide. One that holds more than ``CROWDED`` points is cut up to ``FINER`` levels finer, down to
    a quarter of the radius, and what then still holds more than ``SPOT`` is spread over tasks with copies of the discs, so no
    task reads more points of one cell than that; the pairs that are tested keep to the neighbourhood of the disc.
    """
    radius = F.lit(float(km)) if isinstance(km, int | float) else km
    level = F.lit(level_for(km)) if isinstance(km, int | float) else None
    (alat, alon), (blat, blon) = left_pos, right_pos
    right = right if "_code" in right.columns else coded(right, blat, blon)
    shapes = left.where(geo.located(F.col(alat), F.col(alon)) & (radius >= 0))
    shapes = _discs(shapes if level is not None else Stored(shapes, "discs").df, alat, alon, radius, level)
    levels = [level_for(km)] if level is not None else _levels(shapes)
    # A latitude band and cheap tests come before the trigonometry.
    on = F.abs(F.col(alat) - F.col(blat)) <= radius * (180 / math.pi / geo.EARTH_KM) * (1 + 1e-9) + 1e-12
    on = on & extra if extra is not None else on
    d = geo.haversine_km(F.col(alat), F.col(alon), F.col(blat), F.col(blon))
    return _range_join(shapes, right, levels, same, on & (d <= radius), _disc_meets).withColumn("distance_km", d).drop("_x", "_y", "_z")


def near_pairs(points: DataFrame, key: str, lat: str, lon: str, km: float) -> DataFrame:
    """Unordered pairs of keys at most ``km`` apart: ``(key_a, key_b, distance_km)`` with ``key_a < key_b``.

    Keys that are null and rows that are not located take no part; a key must occur once (see ``latest_rows``).
    """
    slim = points.select(F.col(key).alias("kb"), F.col(lat).alias("lat_b"), F.col(lon).alias("lon_b")).where(F.col("kb").isNotNull())
    right = coded(slim, "lat_b", "lon_b")
    left = right.select(F.col("kb").alias("ka"), F.col("lat_b").alias("lat_a"), F.col("lon_b").alias("lon_a"))
    out = points_near_points(left, right, km, ("lat_a", "lon_a"), ("lat_b", "lon_b"), extra=F.col("ka") < F.col("kb"))
    return out.select(F.col("ka").alias(f"{key}_a"), F.col("kb").alias(f"{key}_b"), "distance_km")


def points_in_regions(points: DataFrame, regions: DataFrame, lat: str, lon: str, ring: str) -> DataFrame:
    """Rows of ``points`` joined with the rows of ``regions`` that contain them.

    ``ring`` is an array of (lat, lon) structs, the corners of a simple polygon in the plane of the coordinates, open or
    closed; a region across the date line is given as two. Column names of the two sides must differ and not begin with an
    underscore. A region's box is covered by ranges of codes, at most five cells a side, and crossing edges are counted on what
    remains; a point on an edge belongs to one side of it.

    Rows that are not located and regions with a null ring, null corners or fewer than three corners have no partners.
    """
    coordinate = {"x": lambda v: v / 180.0, "y": lambda v: v / 180.0}
    located = points.where(geo.located(F.col(lat), F.col(lon)))
    located = located.withColumns({"_fx": _fine(coordinate["x"](F.col(lon))), "_fy": _fine(coordinate["y"](F.col(lat))), "_fz": F.lit(0).cast("bigint")})
    located = Stored(geo.with_morton3(located, "_code", "_fx", "_fy", "_fz").drop("_fx", "_fy", "_fz"), "coded").df
    whole = regions.where((F.size(ring) >= 3) & ~F.exists(ring, lambda c: c["lat"].isNull() | c["lon"].isNull()))
    side = lambda pick, field: pick(F.transform(F.col(ring), lambda c: c[field]))
    box = {"_lox": _fine(side(F.array_min, "lon") / 180.0), "_hix": _fine(side(F.array_max, "lon") / 180.0), "_loy": _fine(side(F.array_min, "lat") / 180.0), "_hiy": _fine(side(F.array_max, "lat") / 180.0)}
    shapes = whole.withColumns({**box, "_loz": F.lit(0).cast("bigint"), "_hiz": F.lit(0).cast("bigint")})
    span = F.greatest(F.col("_hix") - F.col("_lox"), F.col("_hiy") - F.col("_loy"), F.lit(1))
    level = F.lit(BITS + 2) - F.ceil(F.log2(span.cast("double"))).cast("int")
    shapes = Stored(shapes.withColumn("_lv", F.greatest(F.lit(0), F.least(F.lit(BITS), level))), "regions").df
    after = F.concat(F.slice(F.col(ring), 2, F.size(ring)), F.slice(F.col(ring), 1, 1))
    edges = F.arrays_zip(F.col(ring).alias("a"), after.alias("b"))

    def crosses(e: Column) -> Column:
        a, b, y = e["a"], e["b"], F.col(lat)
        meets = (a["lat"] > y) != (b["lat"] > y)
        at = a["lon"] + (b["lon"] - a["lon"]) * (y - a["lat"]) / F.when(meets, b["lat"] - a["lat"])
        return F.coalesce(meets & (F.col(lon) < at), F.lit(False))

    inside = F.aggregate(edges, F.lit(False), lambda odd, e: odd != crosses(e))
    return _range_join(shapes, located, _levels(shapes), (), inside, None)


def nearest(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_pos: tuple[str, str], right_pos: tuple[str, str], start_km: float = 8.0, rounds: int = 2) -> DataFrame:
    """``(left_key, right_key, distance_km)``: the nearest row of ``right`` for every located row of ``left``, ties by key.

    Rows that find something within ``start_km``, or 8 times that in the next of ``rounds``, are settled by disc joins. The
    others, far from everything, go down the tree of cells: of each cell one point is known, the nearest of these bounds the
    answer, and only cells that begin within the bound are opened. No row ever meets all others. Keys must be unique; an empty
    side gives an empty result.
    """
    located = left.where(geo.located(F.col(left_pos[0]), F.col(left_pos[1]))).select(F.col(left_key), F.col(left_pos[0]), F.col(left_pos[1]))
    todo = Stored(located, "nearest").df
    places = coded(right.select(F.col(right_key), F.col(right_pos[0]), F.col(right_pos[1])), *right_pos)
    found, km = None, start_km
    for _ in range(rounds):
        hits = points_near_points(todo, places, km, left_pos, right_pos)
        best = Stored(_closest(hits, left_key, right_key), "nearest").df
        found = best if found is None else found.union(best)
        todo = Stored(todo.join(best.select(left_key), left_key, "left_anti"), "nearest").df
        if todo.isEmpty():
            return found
        km *= 8
    return found.union(_closest(_descend(todo, places, left_key, left_pos, right_pos), left_key, right_key))


def _closest(hits: DataFrame, left_key: str, right_key: str) -> DataFrame:
    best = hits.groupBy(left_key).agg(F.min(F.struct("distance_km", right_key)).alias("_b"))
    return best.select(left_key, F.col("_b")[right_key].alias(right_key), F.col("_b.distance_km").alias("distance_km"))


def _descend(rows: DataFrame, places: DataFrame, key: str, pos: tuple[str, str], place_pos: tuple[str, str], levels: Sequence[int] = (2, 4, 6, 8, 10)) -> DataFrame:
    """Candidate pairs with ``distance_km`` that hold the nearest place of every row: a search down the tree of cells."""
    state = with_code(rows, *pos).drop("_code").withColumns({"_cells": F.array(F.lit(0).cast("bigint")), "_bound": F.lit(8.0)})
    vector = dict(zip(AXES, geo.unit_vector(F.col(place_pos[0]), F.col(place_pos[1]))))
    above = 0
    for level in levels:
        known = places.select(F.lit(0).alias("_lv"), "_code", *[v.alias(f"_p{a}") for a, v in vector.items()])
        known = known.groupBy(_prefix(F.col("_code"), F.lit(level)).alias("_child")).agg(F.min(F.struct("_px", "_py", "_pz")).alias("_p"))
        children = known.groupBy(_shift(F.col("_child"), F.lit(3 * (level - above))).alias("_parent")).agg(F.collect_list(F.struct("_child", "_p")).alias("_children"))
        children = broadcast_if_small(Stored(children, "cells").df)
        opened = state.withColumn("_cell", F.explode("_cells")).join(children, F.col("_cell") == F.col("_parent")).withColumn("_c", F.explode("_children"))
        side, reach, gap = 2.0 / 2**level, F.lit(0.0), F.lit(0.0)
        for a in AXES:
            p, own = F.col("_c._p")[f"_p{a}"], F.col(f"_{a}")
            low = F.least(F.lit(2**level - 1), F.floor((p + 1.0) / side)) * side - 1.0
            out = F.greatest(low - own, own - (low + side), F.lit(0.0))
            reach, gap = reach + (p - own) * (p - own), gap + out * out
        opened = opened.select(key, F.col("_bound"), F.col("_c._child").alias("_child"), reach.alias("_d"), gap.alias("_gap"))
        bound = F.least(F.min("_d"), F.min("_bound")).alias("_bound")
        kept = opened.groupBy(key).agg(bound, F.collect_list(F.struct("_child", "_gap")).alias("_all"))
        kept = kept.withColumn("_cells", F.transform(F.filter("_all", lambda c: c["_gap"] <= F.col("_bound") * (1 + 1e-9) + 1e-15), lambda c: c["_child"])).drop("_all")
        state = Stored(state.drop("_cells", "_bound").join(kept, key), "descent").df
        above = level
    open_ = state.withColumn("_cell", F.explode("_cells"))
    d = geo.haversine_km(F.col(pos[0]), F.col(pos[1]), F.col(place_pos[0]), F.col(place_pos[1]))
    return open_.join(places.withColumn("_rcell", _prefix(F.col("_code"), F.lit(levels[-1]))), F.col("_cell") == F.col("_rcell")).withColumn("distance_km", d)
