import math
import random

from pyspark.sql import functions as F

from waymark.functions.geo import EARTH_KM, equal_earth_mm, haversine_km, tile_fraction
from waymark.operators import spatial
from waymark.operators.spatial import near_pairs, nearest, points_in_regions, points_near_points


def km(a, b):
    la, lo, lb, lob = map(math.radians, (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lob - lo) / 2) ** 2
    return 2 * EARTH_KM * math.asin(min(1, math.sqrt(h)))


def cloud(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        where = r.choice(["pole", "date", "zero", "any"])
        lat, lon = {"pole": (r.uniform(89.9, 90), r.uniform(-180, 180)), "date": (r.uniform(-0.1, 0.1), r.choice([-1, 1]) * r.uniform(179.95, 180)), "zero": (r.uniform(-0.05, 0.05), r.uniform(-0.05, 0.05)), "any": (r.uniform(-90, 90), r.uniform(-180, 180))}[where]
        out.append((f"p{i:03d}", lat, lon))
    return out + [("nan", math.nan, 1.0), ("null", None, 1.0), ("big", 91.0, 0.0), ("wide", 0.0, 181.0), ("filler", 0.0, 0.0), (None, 0.01, 0.01), ("twin1", 10.0, 10.0), ("twin2", 10.0, 10.0)]


def good(p):
    return p[0] and p[1] is not None and not math.isnan(p[1]) and abs(p[1]) <= 90 and abs(p[2]) <= 180 and (p[1], p[2]) != (0, 0)


def test_pairs_against_brute_force(spark):
    pts = cloud(160, 5)
    df = spark.createDataFrame([(*p, 7) for p in pts], "id string, lat double, lon double, _cell int")
    for limit in (2.0, 30.0, 900.0):
        want = {(a[0], b[0]) for a in pts for b in pts if good(a) and good(b) and a[0] < b[0] and km(a[1:], b[1:]) <= limit}
        got = {(r.id_a, r.id_b) for r in near_pairs(df, "id", "lat", "lon", limit).collect()}
        assert got == want
    assert near_pairs(df.where("false"), "id", "lat", "lon", 2.0).count() == 0


def test_radius_by_row_and_nearest(spark):
    a, b = cloud(60, 6), cloud(60, 7)
    left = spark.createDataFrame([(p[0], p[1], p[2], float(i % 5 * 20)) for i, p in enumerate(a) if p[0]], "a string, la double, lo double, r double")
    right = spark.createDataFrame([p for p in b if p[0]], "b string, lb double, lob double")
    got = {(r.a, r.b) for r in points_near_points(left, right, F.col("r"), ("la", "lo"), ("lb", "lob")).collect()}
    radius = {p[0]: float(i % 5 * 20) for i, p in enumerate(a) if p[0]}
    assert got == {(p[0], q[0]) for p in a for q in b if good(p) and good(q) and km(p[1:], q[1:]) <= radius[p[0]]}
    best = {r.a: round(r.distance_km, 6) for r in nearest(left.drop("r"), right, "a", "b", ("la", "lo"), ("lb", "lob")).collect()}
    assert best == {p[0]: round(min(km(p[1:], q[1:]) for q in b if good(q)), 6) for p in a if good(p)}


def test_crowded_cells_and_one_crowded_spot(spark, monkeypatch):
    """Half of all points on one spot and a dense town: cells are cut finer, the spot is spread, and no pair is lost or repeated."""
    monkeypatch.setattr(spatial, "CROWDED", 20)
    monkeypatch.setattr(spatial, "SPOT", 25)
    r = random.Random(9)
    pts = [(f"s{i:03d}", 45.0, 7.0) for i in range(120)] + [(f"t{i:03d}", 45.0 + r.uniform(-0.05, 0.05), 7.0 + r.uniform(-0.05, 0.05)) for i in range(80)] + [p for p in cloud(40, 3) if p[0]]
    df = spark.createDataFrame(pts, "id string, lat double, lon double")
    rows = near_pairs(df, "id", "lat", "lon", 2.0).collect()
    want = {(a[0], b[0]) for a in pts for b in pts if good(a) and good(b) and a[0] < b[0] and km(a[1:], b[1:]) <= 2.0}
    assert len(rows) == len(want) and {(x.id_a, x.id_b) for x in rows} == want
    left = df.select(F.col("id").alias("a"), F.col("lat").alias("la"), F.col("lon").alias("lo"), F.substring("id", 1, 1).alias("ka")).withColumn("r", F.when(F.col("a") < "s005", 12_000.0).otherwise(3.0))
    right = df.select(F.col("id").alias("b"), F.col("lat").alias("lb"), F.col("lon").alias("lob"), F.substring("id", 1, 1).alias("kb"))
    rows = points_near_points(left, right, F.col("r"), ("la", "lo"), ("lb", "lob"), same=[("ka", "kb")]).collect()
    want = {(a[0], b[0]) for a in pts for b in pts if good(a) and good(b) and a[0][0] == b[0][0] and km(a[1:], b[1:]) <= (12_000 if a[0] < "s005" else 3)}
    assert len(rows) == len(want) and {(x.a, x.b) for x in rows} == want


def test_regions_against_brute_force(spark):
    r = random.Random(4)
    pts = [(f"p{i}", r.uniform(-60, 60), r.uniform(-170, 170)) for i in range(300)] + [("null", None, 1.0), ("nan", math.nan, 0.0), ("zero", 0.0, 0.0)]
    rings = {}
    for i in range(30):
        la, lo, size = r.uniform(-50, 50), r.uniform(-150, 150), r.choice([0.5, 5.0, 30.0])
        turns = sorted(r.uniform(0, 2 * math.pi) for _ in range(r.randrange(3, 9)))
        rings[f"r{i}"] = [(la + size * r.uniform(0.2, 1) * math.sin(t), lo + size * r.uniform(0.2, 1) * math.cos(t)) for t in turns]
    rings |= {"two": [(0.0, 0.0), (1.0, 1.0)], "none": None, "hole": [(0.0, 0.0), (None, 1.0), (5.0, 5.0)]}

    def inside(p, ring):
        odd = False
        for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]):
            if (a > p[1]) != (c > p[1]) and p[2] < b + (d - b) * (p[1] - a) / (c - a):
                odd = not odd
        return odd

    points = spark.createDataFrame(pts, "id string, lat double, lon double")
    regions = spark.createDataFrame(list(rings.items()), "region string, ring array<struct<lat:double,lon:double>>")
    got = [(x.region, x.id) for x in points_in_regions(points, regions, "lat", "lon", "ring").collect()]
    want = {(k, p[0]) for k, ring in rings.items() if k[0] == "r" for p in pts if good(p) and inside(p, ring)}
    assert len(got) == len(want) and set(got) == want and len(want) > 30


def test_projections(spark):
    df = spark.createDataFrame([(0.0, 180.0), (90.0, 0.0), (0.0, 0.0)], "lat double, lon double")
    x, y = equal_earth_mm(F.col("lat"), F.col("lon"))
    tx, ty = tile_fraction(F.col("lat"), F.col("lon"), 1)
    rows = df.select(F.round(x, 3), F.round(y), tx, ty, haversine_km(F.col("lat"), F.col("lon"), F.lit(0.0), F.lit(0.0))).collect()
    assert rows[0][0] == 1500 and round(rows[1][1]) == 730 and rows[2][2:4] == (1.0, 1.0)
    assert abs(rows[0][4] - math.pi * EARTH_KM) < 1e-6
