from pyspark.sql import functions as F

from waymark.operators.gates import GATES, Context
from waymark.plans.build_queries import q54_gates


def test_places_are_compared_with_the_builds(spark, tmp_path):
    """Place 2 is in no build, place 1 has a key that no build knows, and build 4 has a place more."""
    ids = [f"pl_{i:010d}" for i in range(5)]
    p = spark.createDataFrame([(x, f"Q{i + 1 if i != 1 else 99}") for i, x in enumerate(ids[:3])], "place_id string, qid string")
    p.select(
        "place_id", "qid", F.lit("site").alias("type"), F.lit("Name").alias("name_en"), F.lit("XAA").alias("country_iso3"), F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon"),
        F.lit("Local").alias("tier"), F.lit("active").alias("status"), F.lit("2026-01-01").cast("timestamp").alias("loaded_at"),
    ).coalesce(1).write.parquet(f"{tmp_path}/place.parquet")
    b = spark.createDataFrame([(n, x, f"Q{i + 1}") for n in (3, 4) for i, x in enumerate(ids) if i != 2], "build_no int, place_id string, qid string")
    b.select("*", F.lit("XAA").alias("country_iso3"), F.lit("Name").alias("name_en"), F.lit("Local").alias("tier"), F.lit("active").alias("status"), F.lit("2026-01-01").cast("timestamp").alias("loaded_at")).coalesce(1).write.parquet(f"{tmp_path}/place_build.parquet")
    cols = ("golden_id", "row_kind", "expected_name", "iso3", "type", "lat", "lon", "tol_km", "min_tier", "max_tier", "relation", "target_id", "qid", "whs_id")
    spark.createDataFrame([("G1", "optional", "Name", "XAA", "site") + (None,) * 9], ", ".join(f"{c} string" for c in cols)).write.parquet(f"{tmp_path}/h1.parquet")
    got = {r.gate: r.passed for r in q54_gates(spark, str(tmp_path)).collect()}
    assert got == {"G-SCHEMA": True, "G-GOLDEN": True, "G-ID": False, "G-IDENT": True, "G-NAMES": True, "G-COUNT": False, "G-COVER": False, "G-CHURN": False}


def test_churn_without_former_positions(spark):
    now = spark.createDataFrame([("pl_a", "Local", "A", 1.0, 1.0)], "place_id string, tier string, name_en string, lat double, lon double")
    before = now.withColumns({"lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")})
    assert GATES["G-CHURN"](Context(now, previous=before)).passed
    assert not GATES["G-CHURN"](Context(before, previous=now)).passed
