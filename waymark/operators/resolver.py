"""Candidates of rows of an expectation list: by heritage number, by name and by distance, each with a status for the decision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_km, located
from .spatial import points_near_points

#: A candidate is near up to this many tolerances away.
SLACK = 1.5


def within_reach(positions: DataFrame, items: DataFrame, slack: float = SLACK) -> DataFrame:
    """``(golden_id, qid)`` at most ``slack`` tolerances apart."""
    where = positions.select("golden_id", "hla", "hlo", (F.col("tol") * slack).alias("reach"))
    return points_near_points(where, items.select("qid", "lat", "lon"), F.col("reach"), ("hla", "hlo"), ("lat", "lon")).select("golden_id", "qid")


def resolver_candidates(positions: DataFrame, names: DataFrame, numbers: DataFrame, items: DataFrame, item_names: DataFrame, item_numbers: DataFrame, strong: int, slack: float = SLACK) -> DataFrame:
    """``(golden_id, qid, km, sitelinks, found_by, name_match, status)``: all candidates of every row, one line each.

    ``positions``: golden_id, hla, hlo, tol, at least one line a row, with null coordinates where there are none; ``names``
    (golden_id, name) and ``numbers`` (golden_id, number) of the rows; ``items``: unique qid, lat, lon, sitelinks, label;
    ``item_names`` (qid, name) and ``item_numbers`` (qid, number). Names and labels are folded.

    * ``found_by`` is the first of whs, name and position that finds the item. ``km`` is null where a side has no position.
    * Near items with ``strong`` sitelinks are unique when they are the only ones of the row and ambiguous otherwise; other
      items within ``slack`` tolerances are near, all others far. ``name_match``: the item's label is a name of the row.
    * A row without any candidate has one line of status none. The result is as large as the true pairs: nothing bounds namesakes.
    """
    by_number = numbers.join(item_numbers, "number").select("golden_id", "qid", F.lit(0).alias("way"))
    by_name = names.join(item_names, "name").select("golden_id", "qid", F.lit(1).alias("way"))
    by_place = within_reach(positions, items, slack).select("golden_id", "qid", F.lit(2).alias("way"))
    found = by_number.union(by_name).union(by_place).groupBy("golden_id", "qid").agg(F.min("way").alias("way"))
    full = found.join(positions, "golden_id").join(items, "qid")
    both = located(F.col("hla"), F.col("hlo")) & located(F.col("lat"), F.col("lon"))
    full = full.withColumn("d", F.when(both, haversine_km(F.col("hla"), F.col("hlo"), F.col("lat"), F.col("lon"))))
    near = F.coalesce(F.col("d") <= F.col("tol") * slack, F.lit(False))
    one = full.groupBy("golden_id", "qid", "way", "sitelinks", "label").agg(F.min("d").alias("km"), F.bool_or(near).alias("near"))
    same = names.select("golden_id", F.col("name").alias("label"), F.lit(True).alias("same")).distinct()
    one = one.join(same, ["golden_id", "label"], "left").withColumn("cited", F.col("near") & (F.col("sitelinks") >= strong))
    k = one.where("cited").groupBy("golden_id").agg(F.count("*").alias("k"))
    status = F.when(~F.col("near"), "far").when(~F.col("cited"), "near").when(F.col("k") == 1, "unique").otherwise("ambiguous")
    out = one.join(k, "golden_id", "left").select(
        "golden_id", "qid", "km", "sitelinks", F.element_at(F.array(*map(F.lit, ("whs", "name", "position"))), F.col("way") + 1).alias("found_by"),
        F.coalesce("same", F.lit(False)).alias("name_match"), status.alias("status"),
    )
    rest = positions.select("golden_id").distinct().join(out.select("golden_id"), "golden_id", "left_anti")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in out.schema.fields[1:-1]]
    return out.union(rest.select("golden_id", *nulls, F.lit("none").alias("status")))
