"""The rules that give places their kinds, as tests on facts; what is not known of a place fires nothing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kinds import KindRule, PairRule

# Rules with kind, source, strength, role and the kinds that they exclude; R04, R06, R08, R09 and R11 have no source yet.
RULES = [
    KindRule("R01", "capital", "wikidata", 0.90), KindRule("R02", "capital", "wikidata", 0.80), KindRule("R03", "seaside", "wikidata", 0.80), KindRule("R03b", "seaside", "coast", 0.65),
    KindRule("R05", "maritime", "wikidata", 0.85), KindRule("R05b", "maritime", "coast", 0.60), KindRule("R07", "ruins", "wikidata", 0.80), KindRule("R10", "sacred", "wikidata", 0.80),
    KindRule("R12", "wildlife", "iucn", 0.85, "core", ("rural",)), KindRule("R12b", "wildlife", "wikidata", 0.80, "core", ("rural",)), KindRule("R13", "desert", "landcover", 0.80),
    KindRule("R13b", "desert", "wikidata", 0.80), KindRule("R14", "mountain", "relief", 0.80), KindRule("R14b", "mountain", "wikidata", 0.75), KindRule("R15", "volcanic", "wikidata", 0.85),
    KindRule("R16", "metropolis", "pop", 0.85), KindRule("R17", "old_town", "unesco", 0.85), KindRule("R17b", "old_town", "wikidata", 0.75), KindRule("R18", "water", "wikidata", 0.80),
    KindRule("R18b", "water", "landcover", 0.60), KindRule("R19", "forest", "landcover", 0.80), KindRule("R20", "rural", "landcover", 0.65), KindRule("R21", "metropolis", "pop", 0.60, "fallback"),
]
#: Rules that a class of the place or of a thing merged into it fires.
CLASS_RULES = ["R03", "R05", "R07", "R10", "R12b", "R13b", "R14b", "R15", "R17b", "R18"]


@dataclass(frozen=True)
class KindLimits:
    """Limits of the tests, in metres, kilometres, inhabitants and shares."""

    relief: float = 1500
    summit: float = 2500
    bare: float = 0.75
    tree: float = 0.7
    open_land: float = 0.75
    maritime_km: float = 3
    maritime_city: int = 100_000
    seaside_km: float = 2
    metropolis: int = 1_000_000
    fallback: int = 100_000
    water: float = 0.15
    water_km: float = 5
    strict: tuple = ("Ia", "Ib", "II", "IV")
    old_town: str = r"historic (centre|center|town|city|quarter|district|areas?)|old (town|city|quarter)|medina|walled|ksar|historic city|city of|historic (monuments|sites) of"


def capital_state(statements: Column, sovereign: list[str], historical: list[str]) -> Column:
    """``now``, ``past`` or null from statements (classes, ended): of a sovereign state that lasts, or of one that has gone.

    A historical state is past whether or not the statement has an end; a lasting statement decides before any past one.
    """
    of = lambda s, classes: F.arrays_overlap(F.coalesce(s["classes"], F.array().cast("array<string>")), F.array(*map(F.lit, classes)))
    ended = lambda s: F.coalesce(s["ended"], F.lit(False))
    now = F.exists(statements, lambda s: ~ended(s) & of(s, sovereign) & ~of(s, historical))
    past = F.exists(statements, lambda s: of(s, historical) | (ended(s) & of(s, sovereign)))
    return F.when(now, F.lit("now")).when(past, F.lit("past"))


def member_rules(places: DataFrame, members: DataFrame, sets: DataFrame, key: str = "qid") -> DataFrame:
    """``(key, core, support)``: class rules hit by the place or an identity-merged thing, and those hit by nested things alone.

    ``places`` has key and classes; ``members`` (key, classes, nested) the things merged into a place; ``sets`` (rule_id, class_qid) is
    a rule table. Hits are folded before the shuffle.
    """
    all_ = places.select(key, "classes", F.lit(False).alias("nested")).unionByName(members.select(key, "classes", "nested"))
    hits = all_.select(key, "nested", F.explode("classes").alias("class_qid")).join(F.broadcast(sets), "class_qid")
    out = hits.groupBy(key).agg(F.collect_set(F.when(~F.col("nested"), F.col("rule_id"))).alias("core"), F.collect_set("rule_id").alias("_all"))
    return out.select(key, F.array_sort("core").alias("core"), F.array_sort(F.array_except("_all", "core")).alias("support"))


def kind_tests(limits: KindLimits = KindLimits()) -> dict[str, Column]:
    """Tests by rule on the columns capital (now, past), core and support (class rules), place_type, population, coast_km, iucn_cat,
    whs_title, bare, tree, crop, grass, water, wetland, relief, summit and big_city (a city near by); all may be null."""
    known = F.array_union(F.coalesce("core", F.array().cast("array<string>")), F.coalesce("support", F.array().cast("array<string>")))
    by_class = {r: F.array_contains(known, r) for r in CLASS_RULES}
    town, pop, coast = F.col("place_type") == "settlement", F.coalesce("population", F.lit(0)), F.col("coast_km")
    share = lambda *cs: sum((F.coalesce(F.col(c), F.lit(0.0)) for c in cs), F.lit(0.0))
    surveyed = F.coalesce("bare", "tree", "crop", "grass", "water", "wetland", "relief", "summit").isNotNull()
    return by_class | {
        "R01": F.col("capital") == "now", "R02": F.col("capital") == "past", "R03b": coast <= limits.seaside_km, "R05": by_class["R05"] & (coast <= limits.maritime_km),
        "R05b": town & (pop >= limits.maritime_city) & (coast <= limits.maritime_km), "R12": F.col("iucn_cat").isin(*limits.strict), "R12b": F.array_contains("core", "R12b"),
        "R13": F.col("bare") >= limits.bare, "R14": (F.col("relief") >= limits.relief) | (F.col("summit") >= limits.summit), "R16": pop >= limits.metropolis,
        "R17": town & F.lower("whs_title").rlike(limits.old_town), "R17b": by_class["R17b"] & town,
        "R18b": surveyed & (share("water", "wetland") >= limits.water) & F.coalesce(coast >= limits.water_km, F.lit(True)), "R19": F.col("tree") >= limits.tree,
        "R20": surveyed & (share("crop", "grass") >= limits.open_land) & ~F.coalesce("big_city", F.lit(False)), "R21": pop >= limits.fallback,
    }


def role_by_source(fired: Column) -> Column:
    """A class rule that only nested things hit supports its kind and is no core of it."""
    return F.transform(fired, lambda f: F.when(F.array_contains(F.coalesce("support", F.array().cast("array<string>")), f["rule"]) & (f["role"] == "core"), f.withField("role", F.lit("support"))).otherwise(f))


def pair_conditions() -> list[PairRule]:
    """Pairs of kinds, and when the first drops the second. Beaches and the salt of water are not known yet."""
    fired = lambda *rules: F.exists("fired", lambda f: f["rule"].isin(*rules))
    known = F.array_union(F.coalesce("core", F.array().cast("array<string>")), F.coalesce("support", F.array().cast("array<string>")))
    worship = F.array_contains(known, "R10") & ~F.array_contains(known, "R07")
    return [
        PairRule("sacred", "ruins", worship), PairRule("ruins", "sacred", ~worship), PairRule("maritime", "seaside", F.coalesce("population", F.lit(0)) >= 200_000), PairRule("seaside", "water", F.lit(False)),
        PairRule("wildlife", "rural", fired("R12", "R12b") & (F.coalesce("crop", F.lit(0.0)) < 0.3)), PairRule("forest", "rural", F.coalesce("tree", F.lit(0.0)) >= 0.5), PairRule("metropolis", "rural", F.lit(True)),
    ]
