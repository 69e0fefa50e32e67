"""Kinds of places from rules that cite evidence: firing, combination, selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import noisy_or

# Limits of the selection.
CAP, LEAST, BUCKET, MOST = 0.95, 0.50, 0.05, 3


@dataclass(frozen=True)
class KindRule:
    """A rule with its kind, the source of its evidence, its strength, and ``core``, ``support`` or ``fallback`` as role."""

    rule_id: str
    kind: str
    source: str
    strength: float
    role: str = "core"
    excludes: tuple[str, ...] = ()


@dataclass(frozen=True)
class PairRule:
    """Of two kinds of one place ``drop`` goes where the condition, a column, holds."""

    keep: str
    drop: str
    condition: Column


def fire(places: DataFrame, rules: Sequence[KindRule], tests: Mapping[str, Column], key: str = "qid") -> DataFrame:
    """Adds ``fired``: the rules whose test holds, as structs in order of rule id. Tests that are null do not hold."""
    entries = []
    for r in sorted(rules, key=lambda r: r.rule_id):
        if r.rule_id in tests:
            value = F.struct(F.lit(r.rule_id).alias("rule"), F.lit(r.kind).alias("kind"), F.lit(r.source).alias("source"), F.lit(r.strength).alias("strength"), F.lit(r.role).alias("role"), F.array(*map(F.lit, r.excludes)).cast("array<string>").alias("excludes"))
            entries.append(F.when(F.coalesce(tests[r.rule_id], F.lit(False)), value))
    return places.withColumn("fired", F.array_compact(F.array(*entries)))


def class_tests(places: DataFrame, sets: DataFrame, key: str = "qid") -> DataFrame:
    """Adds ``class_rules``: ids of the rules whose class set meets the place's classes. ``sets`` (rule_id, class_qid) is a rule table."""
    hits = places.select(key, F.explode("classes").alias("class_qid")).join(F.broadcast(sets), "class_qid")
    found = hits.groupBy(key).agg(F.array_sort(F.collect_set("rule_id")).alias("class_rules"))
    return places.join(found, key, "left").withColumn("class_rules", F.coalesce("class_rules", F.array().cast("array<string>")))


def bucket(strength: Column) -> Column:
    """Strength in steps of 0.05, halves to even."""
    return F.bround(strength / F.lit(BUCKET), 0).cast("int")


def _combined(fired: Column, kinds: Sequence[str]) -> Column:
    """Per kind: strength by noisy-or of the best rule of each source, number of sources, rule ids, whether a core rule is there."""

    def one(kind: Column) -> Column:
        mine = F.filter(fired, lambda f: f["kind"] == kind)
        sources = F.array_distinct(F.transform(mine, lambda f: f["source"]))
        best = F.transform(sources, lambda s: F.array_max(F.transform(F.filter(mine, lambda f: f["source"] == s), lambda f: f["strength"])))
        return F.struct(
            kind.alias("kind"), noisy_or(best, CAP).alias("strength"), F.size(sources).alias("sources"),
            F.transform(mine, lambda f: f["rule"]).alias("rules"), F.exists(mine, lambda f: f["role"] == "core").alias("core"),
        )

    named = F.array(*map(F.lit, kinds))
    return F.transform(F.filter(named, lambda k: F.exists(fired, lambda f: f["kind"] == k)), one)


def select_kinds(df: DataFrame, kinds: Sequence[str], pairs: Sequence[PairRule]) -> DataFrame:
    """Adds ``kept`` (structs, best first, three at most), ``cut`` (kind and reason) and ``crowded`` to rows with ``fired``.

    A kind needs a core rule and a strength of one half. Then rules exclude kinds in order of their ids, pair rules drop
    kinds in the order given, and the rest is ordered by strength in steps, number of sources, priority (order of ``kinds``).
    Fallback rules count where nothing is left. The fourth kind nearly as strong as the third makes a place crowded.
    """
    regular = F.filter("fired", lambda f: f["role"] != "fallback")
    df = df.withColumn("_c", _combined(regular, kinds))
    df = df.withColumn("_live", F.filter("_c", lambda c: c["core"] & (c["strength"] >= LEAST)))
    reason = lambda kind, text: F.struct(kind.alias("kind"), text.alias("reason"))
    weak = F.transform(F.filter("_c", lambda c: ~(c["core"] & (c["strength"] >= LEAST))), lambda c: reason(c["kind"], F.when(~c["core"], F.lit("no_core_rule")).otherwise(F.lit("below_threshold"))))
    df = df.withColumn("_cut", weak)
    # Exclusions run over the fired rules in order; each sees what the earlier ones left.
    excluding = F.filter(regular, lambda f: F.size(f["excludes"]) > 0)
    start = F.struct(F.transform("_live", lambda c: c["kind"]).alias("live"), F.transform(F.array(), lambda x: reason(F.lit(""), F.lit(""))).alias("cut"))

    def exclude(acc: Column, f: Column) -> Column:
        here = F.array_contains(acc["live"], f["kind"])
        out = F.when(here, F.filter(F.array_intersect(f["excludes"], acc["live"]), lambda k: k != f["kind"])).otherwise(F.array().cast("array<string>"))
        return F.struct(F.array_except(acc["live"], out).alias("live"), F.concat(acc["cut"], F.transform(out, lambda k: reason(k, F.concat(F.lit("excluded_by:"), f["rule"])))).alias("cut"))

    df = df.withColumn("_x", F.aggregate(excluding, start, exclude)).withColumns({"_names": F.col("_x.live"), "_cut": F.concat("_cut", F.col("_x.cut"))}).drop("_x")
    for p in pairs:
        goes = F.array_contains("_names", p.keep) & F.array_contains("_names", p.drop) & F.coalesce(p.condition, F.lit(False))
        df = df.withColumns({
            "_cut": F.when(goes, F.concat("_cut", F.array(reason(F.lit(p.drop), F.lit(f"pair:{p.keep}>{p.drop}"))))).otherwise(F.col("_cut")),
            "_names": F.when(goes, F.array_remove("_names", p.drop)).otherwise(F.col("_names")),
        })
    spare = F.filter(_combined(F.filter("fired", lambda f: f["role"] == "fallback"), kinds), lambda c: c["strength"] >= LEAST)
    live = F.filter("_live", lambda c: F.array_contains(F.col("_names"), c["kind"]))
    named = F.array(*map(F.lit, kinds))
    # Within a step of strength more sources count in the regular order; the fallback order looks at strength and priority.
    keyed = lambda cs, by_sources: F.transform(cs, lambda c: F.struct((-bucket(c["strength"])).alias("a"), (-c["sources"] if by_sources else F.lit(0)).alias("b"), F.array_position(named, c["kind"]).alias("p"), c.alias("c")))
    ranked = F.array_sort(F.when(F.size(live) > 0, keyed(live, True)).otherwise(keyed(spare, False)))
    df = df.withColumn("_ranked", F.transform(ranked, lambda x: x["c"]))
    over = F.transform(F.slice("_ranked", MOST + 1, len(kinds)), lambda c: reason(c["kind"], F.lit("cap")))
    third, fourth = F.get("_ranked", F.lit(MOST - 1)), F.get("_ranked", F.lit(MOST))
    crowded = F.coalesce(bucket(fourth["strength"]) >= bucket(third["strength"]) - 2, F.lit(False))
    df = df.withColumns({"kept": F.slice("_ranked", 1, MOST), "cut": F.concat("_cut", over), "crowded": crowded})
    return df.drop("_c", "_live", "_cut", "_names", "_ranked")


def kind_distribution(df: DataFrame, kinds: Sequence[str], kept: str = "kept") -> DataFrame:
    """``(kind, places, share)`` with zeros for kinds that no place has; kind null counts the places without any."""
    total = df.count()
    # A null stands for "no kind"; each place gives one row a kind, folded before the shuffle.
    names = F.when(F.size(kept) > 0, F.transform(kept, lambda c: c["kind"])).otherwise(F.array(F.lit(None).cast("string")))
    counts = df.select(F.explode(names).alias("kind")).groupBy("kind").agg(F.count("*").alias("places"))
    spark = df.sparkSession
    listed = spark.createDataFrame([(k,) for k in [*kinds, None]], "kind string")
    joined = listed.alias("v").join(counts.alias("c"), F.col("v.kind").eqNullSafe(F.col("c.kind")), "left")
    return joined.select(F.col("v.kind").alias("kind"), F.coalesce("places", F.lit(0)).alias("places"), F.round(F.coalesce("places", F.lit(0)) / F.lit(max(1, total)), 6).alias("share"))
