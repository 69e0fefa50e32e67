"""Queries p2 (places near places) and p5 (snapshot changes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity
from ..functions.geo import located
from ..operators.latest import current_places
from ..operators.snapshots import snapshot_changes
from ..operators.spatial import near_pairs, points_in_regions
from ..runtime import table

NEAR_KM = 2.0


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of places in force at most 2 km apart."""
    places = current_places(table(spark, folder, "place"), "lat", "lon")
    return near_pairs(places, "place_id", "lat", "lon", NEAR_KM).select("place_id_a", "place_id_b")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Places added, removed or moved to another tier in builds 2 to 4."""
    rows = table(spark, folder, "place_build").select(
        "build_no", identity.place_id("place_id").alias("place_id"), identity.tier("tier").alias("tier"), "loaded_at"
    )
    return snapshot_changes(rows, "build_no", "place_id", "loaded_at", ["tier"])


def p2_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Places inside the lozenge of one degree north and south and a degree and a half east and west of every Icon."""
    places = current_places(table(spark, folder, "place"), "lat", "lon", "tier").withColumn("tier", identity.tier("tier"))
    corner = lambda la, lo: F.struct((F.col("lat") + la).alias("lat"), (F.col("lon") + lo).alias("lon"))
    icons = places.where((F.col("tier") == "Icon") & located(F.col("lat"), F.col("lon")))
    regions = icons.select(F.col("place_id").alias("region_id"), F.array(corner(1.0, 0.0), corner(0.0, 1.5), corner(-1.0, 0.0), corner(0.0, -1.5)).alias("ring"))
    return points_in_regions(places.select("place_id", "lat", "lon"), regions, "lat", "lon", "ring").select("region_id", "place_id")


QUERIES = {"p2_found": p2_found, "p2_regions": p2_regions, "p5_found": p5_found}

SQL = {
    "p2_found": """
        WITH c AS (
          SELECT lower(trim(place_id)) place_id, arg_max({'s': status, 'la': lat, 'lo': lon}, loaded_at) r
          FROM place GROUP BY 1),
        p AS (
          SELECT place_id, r.la lat, r.lo lon FROM c
          WHERE coalesce(lower(trim(r.s)) <> 'retired', true) AND r.la IS NOT NULL AND r.lo IS NOT NULL
            AND NOT isnan(r.la) AND NOT isnan(r.lo) AND abs(r.la) <= 90 AND abs(r.lo) <= 180 AND NOT (r.la = 0 AND r.lo = 0))
        SELECT a.place_id place_id_a, b.place_id place_id_b
        FROM p a JOIN p b ON a.place_id < b.place_id AND b.lat BETWEEN a.lat - 0.02 AND a.lat + 0.02
        WHERE 2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2)
              + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) <= 2.0""",
    "p2_regions": """
        WITH c AS (SELECT lower(trim(place_id)) place_id, arg_max({'s': status, 'la': lat, 'lo': lon, 't': tier}, loaded_at) r FROM place GROUP BY 1),
        p AS (
          SELECT place_id, r.la lat, r.lo lon, lower(trim(r.t)) tier FROM c
          WHERE coalesce(lower(trim(r.s)) <> 'retired', true) AND r.la IS NOT NULL AND r.lo IS NOT NULL
            AND NOT isnan(r.la) AND NOT isnan(r.lo) AND abs(r.la) <= 90 AND abs(r.lo) <= 180 AND NOT (r.la = 0 AND r.lo = 0))
        SELECT i.place_id region_id, p.place_id FROM p i JOIN p ON i.tier = 'icon' AND abs(p.lat - i.lat) + abs(p.lon - i.lon) / 1.5 < 1.0""",
    "p5_found": """
        WITH r AS (
          SELECT build_no, lower(trim(place_id)) place_id,
                 CASE lower(trim(tier)) WHEN 'icon' THEN 'Icon' WHEN 'major' THEN 'Major' WHEN 'notable' THEN 'Notable' WHEN 'local' THEN 'Local' END tier,
                 loaded_at
          FROM place_build WHERE trim(place_id) <> ''),
        s AS (SELECT build_no, place_id, arg_max({'t': tier}, (loaded_at, tier)).t tier FROM r GROUP BY ALL)
        SELECT coalesce(n.build_no, o.build_no + 1) build_no, coalesce(n.place_id, o.place_id) place_id,
               CASE WHEN o.place_id IS NULL THEN 'added' WHEN n.place_id IS NULL THEN 'removed' ELSE 'changed' END diff
        FROM s n FULL JOIN s o ON n.place_id = o.place_id AND n.build_no = o.build_no + 1
        WHERE coalesce(n.build_no, o.build_no + 1) BETWEEN 2 AND 4
          AND (o.place_id IS NULL OR n.place_id IS NULL OR n.tier IS DISTINCT FROM o.tier)""",
}
