"""Nested and duplicate records absorbed into the place that visitors know, by ordered rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import core_words, fold
from ..runtime import Stored
from .candidates import whole_property
from .resolution import chain_roots, first_by, greedy_assignment
from .spatial import points_near_points

# Distances in km, and the sitelinks below which a property's record is a stub.
COLOCATED_KM, SEAT_KM, RUINS_KM, STUB = 5.0, 10.0, 25.0, 15


def _side(df: DataFrame, tag: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{tag}_{c}") for c in ("qid", "iso3", "lat", "lon", "sitelinks", "place_type", "hint", "whs", "core", "admin")])


def _near(a: DataFrame, b: DataFrame, km: float, on: Column) -> DataFrame:
    other = F.col("p_qid") != F.col("a_qid")
    return points_near_points(_side(a, "p"), _side(b, "a"), km, ("p_lat", "p_lon"), ("a_lat", "a_lon"), other & on, [("p_iso3", "a_iso3")])


def _take_first(pairs: DataFrame, child: str, parent: str) -> DataFrame:
    """Parents, most cited first, each take the first free record in the same order; a record is taken once, a parent takes one."""
    cost = F.struct(-F.col("p_sitelinks"), F.col("p_qid"), -F.col("a_sitelinks"), F.col("a_qid"))
    return greedy_assignment(pairs.withColumn("_cost", cost), parent, child, "_cost").select(F.col(child).alias("qid"), F.col(parent).alias("parent"))


def _best(pairs: DataFrame) -> DataFrame:
    """The most cited parent of every child, ties by the greatest QID."""
    best = pairs.groupBy("p_qid").agg(F.max(F.struct("a_sitelinks", "a_qid"))["a_qid"].alias("parent"))
    return best.select(F.col("p_qid").alias("qid"), "parent")


def absorb(places: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """``(qid, parent, reason)`` of the absorbed places, with final parents.

    ``places``: unique qid; iso3, lat, lon, sitelinks, place_type, hint, whs, admin (boolean: an administrative record), parents
    (array of QIDs it lies in), name. ``overrides`` (loser, survivor, reason) come first. Then, each among the places still
    there: records of one whole property go to the most cited; serial components to the holder of their property; a thin
    record of a property to the famous item beside it; a historic centre's record to its city; a protected area to its
    mountain; lesser ruins to a World Heritage ruin within 25 km; administrative records to their seat; sites to the place
    they lie in (twice, since a place may gain a property by absorption). Chains are followed to their end.

    A place that takes over a property's record holds the property from then on: it takes no further one, and ruins and
    located places may come to it; but the three rules for thin, historic and protected records look at the records that held
    one before the first of them. Order within a rule is by sitelinks, then QID. Every step is written, so later ones read
    tables.
    """
    p = places.withColumn("core", core_words(fold("name"))).withColumn("admin", F.coalesce("admin", F.lit(False)))
    p = Stored(p, "places").df
    log: list[DataFrame] = []

    def gone() -> DataFrame:
        out = log[0].select("qid")
        for x in log[1:]:
            out = out.union(x.select("qid"))
        return out

    def left(df: DataFrame) -> DataFrame:
        return df.join(gone(), "qid", "left_anti") if log else df

    def note(found: DataFrame, reason: str | Column) -> DataFrame:
        reason = F.lit(reason) if isinstance(reason, str) else reason
        step = Stored(found.select("qid", "parent", reason.alias("reason")), "absorbed").df
        log.append(step)
        return step

    whole = whole_property(F.col("whs"))
    if overrides is not None:
        known = p.select("qid")
        ruled = overrides.join(known, F.col("loser") == F.col("qid"), "left_semi").join(known, F.col("survivor") == F.col("qid"), "left_semi").where("loser <> survivor")
        note(first_by(ruled, "loser", [F.col("survivor")]).select(F.col("loser").alias("qid"), F.col("survivor").alias("parent"), "reason"), F.concat(F.lit("owner ruling: "), F.col("reason")))
    winners = p.where(whole).groupBy("whs").agg(F.max(F.struct("sitelinks", "qid", "place_type"))["qid"].alias("winner"), F.max("sitelinks").alias("top"))
    # A record of the same property that an owner ruled away keeps its ruling.
    note(left(p.where(whole)).join(winners, "whs").where("qid <> winner").select("qid", F.col("winner").alias("parent"), "whs"), F.concat(F.lit("same World Heritage property "), F.col("whs")))
    serial = left(p).withColumn("_n", F.regexp_extract("whs", r"^([0-9]+)[-.]", 1)).where("_n <> ''").join(winners.select(F.col("whs").alias("_n"), "winner", "top"), "_n").where("qid <> winner")
    serial = serial.where(~(F.coalesce(F.col("place_type") == "settlement", F.lit(False)) & (F.col("top") * 3 < F.col("sitelinks"))))
    note(serial.select("qid", F.col("winner").alias("parent"), "_n"), F.concat(F.lit("serial component of property "), F.col("_n")))
    kind = lambda side, t: F.coalesce(F.col(f"{side}_place_type") == t, F.lit(False))
    shared = F.arrays_overlap("p_core", "a_core")

    # The records that hold a property before the first of the three rules; what a parent takes over is not taken on.
    holders = Stored(left(p.where(whole)), "holders").df

    def take(parents: DataFrame, km: float, on: Column, reason: str) -> None:
        nonlocal p
        step = note(_take_first(_near(parents, left(holders), km, on), "a_qid", "p_qid"), reason)
        # The parent holds the property from now on.
        got = step.join(p.select("qid", F.col("whs").alias("_w")), "qid").select(F.col("parent").alias("qid"), "_w")
        p = Stored(p.join(got, "qid", "left").withColumn("whs", F.coalesce("_w", "whs")).drop("_w"), "places").df

    thin = (F.col("a_sitelinks") < STUB) & (F.col("p_sitelinks") >= STUB) & ~kind("a", "settlement")
    take(left(p.where("whs is null and coalesce(place_type, '') <> 'settlement'")), COLOCATED_KM, thin, "property record beside it")
    take(left(p.where(~whole_property(F.col("whs")) & (F.col("place_type") == "settlement"))), SEAT_KM, shared & (F.col("a_sitelinks") * 3 < F.col("p_sitelinks")), "property record of its city")
    take(left(p.where("whs is null and place_type = 'area'")), COLOCATED_KM, shared & kind("a", "area") & (F.col("a_sitelinks") < F.col("p_sitelinks")), "protected area of its mountain")
    ruins = (F.col("place_type") == "site") & (F.col("hint") == "ruins")
    famous = left(p.where(whole_property(F.col("whs")) & ruins))
    note(_best(_near(left(p.where(ruins & F.col("whs").isNull())), famous, RUINS_KM, F.col("a_sitelinks") > F.col("p_sitelinks"))), "ruins within 25 km of a World Heritage ruin")
    seats = left(p.where("place_type = 'settlement' and not admin"))
    note(_best(_near(left(p.where("admin")), seats, SEAT_KM, F.lit(True))), "administrative record of its seat")
    for _ in range(2):
        # A place that has no property gets that of a record absorbed into it.
        gained = log[0]
        for x in log[1:]:
            gained = gained.union(x)
        gained = gained.join(p.select("qid", F.col("whs").alias("_w")), "qid").where("_w is not null").groupBy(F.col("parent").alias("qid")).agg(F.min("_w").alias("_w"))
        p = Stored(p.join(gained, "qid", "left").withColumn("whs", F.coalesce("whs", "_w")).drop("_w"), "places").df
        up = left(p.where("place_type = 'site'")).select("qid", "sitelinks", "whs", F.explode("parents").alias("up"))
        over = p.where("place_type in ('settlement', 'site')").select(F.col("qid").alias("up"), F.col("sitelinks").alias("us"), F.col("whs").alias("uw"))
        fit = up.join(over, "up").where((F.col("up") != F.col("qid")) & ((F.col("us") > F.col("sitelinks")) | (whole_property(F.col("uw")) & ~whole_property(F.col("whs")))))
        note(fit.groupBy("qid").agg(F.max(F.struct("us", "up"))["up"].alias("parent")), "located in or part of it")
    found = log[0]
    for x in log[1:]:
        found = found.union(x)
    found = Stored(found, "log").df
    pointers = p.select("qid").join(found.select("qid", "parent"), "qid", "left")
    ends = chain_roots(pointers, "qid", "parent").where("root is not null and root <> qid")
    return ends.select("qid", F.col("root").alias("parent")).join(found.select("qid", "reason"), "qid")
