"""Assembly of one candidate per identity from tagged extracts, and the admission rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import identity
from ..functions.text import squeeze_space
from ..runtime import broadcast_if_small

# Extract families in the order in which they are read, and admission thresholds.
FAMILIES = ["attention", "class", "popall", "institutional", "detail", "node"]
R2_SITELINKS, R3_POPULATION, R4_SITELINKS, R5_FLOOR = 40, 100_000, 15, 5


def whole_property(c: Column) -> Column:
    """The id stands for a whole World Heritage property, not for a serial component."""
    return F.coalesce(c.rlike(r"^[0-9]+(bis|ter|quater)?$"), F.lit(False))


def heritage_number(value: Column) -> Column:
    """The property number that an id has to be listed under: leading digits of a well-formed id, or the only number in free text."""
    v = F.regexp_replace(F.trim(value), "rev$", "")
    formed = F.regexp_extract(v, r"^([0-9]+)(?:bis|ter|quater|[-.][0-9]+)?$", 1)
    found = F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0))
    return F.coalesce(F.nullif(formed, F.lit("")), F.when(F.size(found) == 1, F.get(found, F.lit(0))))


def heritage_id(value: Column, listed: Column) -> Column:
    """The id in normal form when its number is ``listed`` (a boolean), else null: suffixes and components are kept, free text gives the number."""
    v = F.regexp_replace(F.trim(value), "rev$", "")
    formed = v.rlike(r"^[0-9]+(bis|ter|quater|[-.][0-9]+)?$")
    return F.when(listed, F.when(formed, v).otherwise(heritage_number(value)))


def assemble(extracts: DataFrame, properties: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """One row per QID from the rows of all families.

    Greatest sitelinks and population, unions of classes, heritage and countries, labels from the latest family that has one,
    coordinates from the family that measures best, the best heritage id (a whole property before a component, then arrival).
    ``overrides`` (qid, iso3) replace the country, which is otherwise the least of the item's countries. Rows without a QID
    are ignored. Everything is one aggregation with map-side parts; ``properties`` is joined before it.
    """
    order = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family"))
    # Coordinates: all-population rows over attention over class over institutional, the others last.
    place = F.array_position(F.array(*map(F.lit, ["popall", "attention", "class", "institutional"])), F.col("family"))
    place = F.when(place > 0, place).otherwise(9)
    listed = properties.select(F.trim("id_number").alias("_number")).distinct()
    rows = extracts.withColumn("qid", identity.qid("qid")).where(F.col("qid").isNotNull())
    rows = rows.withColumn("_w", heritage_number(F.col("whs"))).join(listed, F.col("_w") == F.col("_number"), "left")
    rows = rows.withColumn("whs_id", heritage_id(F.col("whs"), F.col("_number").isNotNull()))
    last = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col("admit_id").alias("i"), F.col(c).alias("x"))))["x"]
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    where = F.min(F.when(located, F.struct(place.alias("p"), F.col("admit_id").alias("i"), F.col("lat"), F.col("lon"))))
    best = F.min(F.when(F.col("whs_id").isNotNull(), F.struct((~whole_property(F.col("whs_id"))).alias("c"), order.alias("o"), F.col("admit_id").alias("i"), F.col("whs_id"))))
    out = rows.groupBy("qid").agg(
        F.min(identity.country("iso3")).alias("iso3"), F.array_sort(F.collect_set(identity.country("iso3"))).alias("isos"),
        F.coalesce(F.max(identity.count_or_null("sitelinks")), F.lit(0)).alias("sitelinks"), F.nullif(F.max("population"), F.lit(0).cast("bigint")).alias("population"),
        union("classes").alias("classes"), union("heritage").alias("heritage"), last("label_en").alias("label_en"), last("label_loc").alias("label_loc"),
        where["lat"].alias("lat"), where["lon"].alias("lon"), best["whs_id"].alias("whs"), F.max("wdpa").alias("wdpa"), F.coalesce(F.bool_or("voyage"), F.lit(False)).alias("voyage"),
    )
    if overrides is not None:
        named = overrides.select("qid", F.col("iso3").alias("_iso"))
        out = out.join(broadcast_if_small(named), "qid", "left").withColumn("iso3", F.coalesce("_iso", "iso3")).drop("_iso")
    return out


def classified(cands: DataFrame, types: DataFrame, living: list[str] = ()) -> DataFrame:
    """Adds ``place_type`` and ``kind_hint`` of the first row of ``types`` (class_qid, place_type, kind_hint, place_like, ord) that the classes hit.

    Where an item has a class of ``living`` and any settlement row, settlement rows alone count. Items without a hit get
    nulls. ``hints`` are up to three distinct kind hints in table order, from the counted rows and those that are not
    place-like. ``types`` is a rule table, bounded by its file, and is broadcast.
    """
    hits = cands.select("qid", F.explode("classes").alias("class_qid")).join(F.broadcast(types), "class_qid")
    lives = F.col("class_qid").isin(list(living)) if living else F.lit(False)
    town = F.col("place_like") & (F.col("place_type") == "settlement")
    row = F.struct("ord", "place_type", "kind_hint")
    hint = F.when(F.col("kind_hint").isNotNull(), F.struct("ord", "kind_hint"))
    # Both readings are folded in one aggregation; which one holds is known once all of an item's rows have been seen.
    found = hits.groupBy("qid").agg(
        (F.bool_or(lives) & F.bool_or(town)).alias("_alive"), F.min(F.when(F.col("place_like"), row)).alias("_any"), F.min(F.when(town, row)).alias("_town"),
        F.collect_set(hint).alias("_hints"), F.collect_set(F.when(town | ~F.col("place_like"), hint)).alias("_town_hints"),
    )
    alive = F.coalesce("_alive", F.lit(False))
    first, hints = F.when(alive, F.col("_town")).otherwise(F.col("_any")), F.when(alive, F.col("_town_hints")).otherwise(F.col("_hints"))
    named = F.slice(F.array_distinct(F.transform(F.array_sort(hints), lambda x: x["kind_hint"])), 1, 3)
    found = found.select("qid", first["place_type"].alias("place_type"), first["kind_hint"].alias("kind_hint"), named.alias("hints"))
    return cands.join(found, "qid", "left")


def admission_rules(strict: Column, admitted: Column, anchored: Column) -> Column:
    """All rules that fire, in order. ``admitted`` is null for items that no mass class judges; ``strict`` and ``anchored`` are booleans."""
    like = F.col("place_type").isNotNull()
    settlement = F.col("place_type") == "settlement"
    backed = (F.size("heritage") > 0) | F.col("wdpa").isNotNull() | (F.col("voyage") & ~settlement)
    r2 = F.when(admitted.isNull(), F.col("sitelinks") >= R2_SITELINKS).otherwise(admitted)
    tests = {
        "R1": strict | whole_property(F.col("whs")),
        "R2": like & r2,
        "R3": like & settlement & (F.coalesce("population", F.lit(0)) >= R3_POPULATION),
        "R4": like & (F.col("sitelinks") >= R4_SITELINKS) & backed,
        "R6": anchored,
    }
    return F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(k)) for k, t in tests.items()]))


def admit(cands: DataFrame, notability: Column, strict: Column | None = None, admitted: Column | None = None, anchored: Column | None = None, floor: int = R5_FLOOR) -> DataFrame:
    """Candidates with a position and a label that some rule admits; adds ``rules``.

    A country's floor (R5) takes the ``floor`` most notable of its place-like candidates that no other rule admits, ties by QID.
    """
    no = F.lit(False)
    rows = cands.where(F.col("lat").isNotNull() & F.coalesce(squeeze_space(F.col("label_en")), squeeze_space(F.col("label_loc"))).isNotNull())
    rows = rows.withColumns({"rules": admission_rules(strict if strict is not None else no, admitted if admitted is not None else F.lit(None).cast("boolean"), anchored if anchored is not None else no), "n": notability})
    waiting = rows.where((F.size("rules") == 0) & F.col("place_type").isNotNull())
    # A filter on the row number lets every task keep ``floor`` rows a country before the shuffle.
    place = F.row_number().over(Window.partitionBy("iso3").orderBy(F.desc("n"), "qid"))
    taken = waiting.withColumn("_r", place).where(F.col("_r") <= floor).drop("_r").withColumn("rules", F.array(F.lit("R5")))
    return rows.where(F.size("rules") > 0).unionByName(taken)


def context_reason(cfg: dict) -> Column:
    """Why an admitted candidate is context and no destination; empty when it is one. ``cfg`` holds the class lists and limits."""
    has = lambda name: F.arrays_overlap("classes", F.array(*map(F.lit, cfg[name])))
    plain = ~has("destination") & F.col("whs").isNull()
    area = F.coalesce(F.col("place_type") == "area", F.lit(False))
    return (
        F.when(has("context") & plain, F.lit("continent, sea, ocean, river or historical country"))
        .when(has("large") & (F.col("sitelinks") >= cfg["large_sitelinks"]) & plain, F.lit("a large feature known everywhere"))
        .when(area & (F.coalesce("population", F.lit(0)) >= cfg["population"]), F.concat(F.lit("region of "), F.col("population").cast("string"), F.lit(" inhabitants")))
        .when(area & (F.size("isos") >= cfg["countries"]) & (F.col("sitelinks") >= 100) & ~F.array_contains("rules", "R1"), F.concat(F.lit("found in "), F.size("isos").cast("string"), F.lit(" countries")))
        .otherwise("")
    )
