import math

import pandas as pd
from pyspark.sql import functions as F

from waymark.functions.stats import cohen_kappa, kendall_tau, noisy_or, wilson_lower
from waymark.functions.text import bad_name, base_name, core_words, fold, folded, short_name
from waymark.operators.candidates import admit, assemble, classified, heritage_id, heritage_number, whole_property
from waymark.operators.kinds import KindRule, PairRule, bucket, fire, kind_distribution, select_kinds
from waymark.operators.product import gap_sentence, hash_sample, missing_kinds, months_filled, print_quota, print_selection
from waymark.operators.ranking import assign_tiers, notability

KINDS = ["ruins", "sacred", "water", "rural", "mountain"]


def test_selection_rules(spark):
    rules = [
        KindRule("R1", "ruins", "wikidata", 0.8), KindRule("R2", "ruins", "osm", 0.7, "support"), KindRule("R3", "sacred", "wikidata", 0.8), KindRule("R4", "water", "coast", 0.45),
        KindRule("R5", "rural", "cover", 0.65), KindRule("R6", "mountain", "relief", 0.8, "core", ("rural",)), KindRule("R7", "water", "wikidata", 0.6, "support"), KindRule("R8", "rural", "pop", 0.6, "fallback"),
    ]
    cases = {"a": ["R1", "R2", "R3", "R5", "R6"], "b": ["R4"], "c": ["R7"], "d": ["R8"], "e": [], "f": ["R1", "R3", "R4", "R7", "R6", "R5"], "g": ["R4", "R8"]}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "qid string, on array<string>")
    df = fire(df, rules, {r.rule_id: F.array_contains("on", r.rule_id) for r in rules})
    out = {r.qid: r for r in select_kinds(df, KINDS, [PairRule("ruins", "sacred", F.lit(True))]).collect()}
    kinds = lambda k: [c["kind"] for c in out[k]["kept"]]
    cut = lambda k: {(c["kind"], c["reason"]) for c in out[k]["cut"]}
    assert kinds("a") == ["ruins", "mountain"] and cut("a") == {("rural", "excluded_by:R6"), ("sacred", "pair:ruins>sacred")}
    assert out["a"]["kept"][0]["strength"] == 0.94 and out["a"]["kept"][0]["sources"] == 2
    assert kinds("b") == [] and cut("b") == {("water", "below_threshold")} and cut("c") == {("water", "no_core_rule")}
    assert kinds("d") == ["rural"] and kinds("e") == [] and kinds("g") == ["rural"]
    assert kinds("f") == ["ruins", "mountain", "water"] or kinds("f") == ["water", "ruins", "mountain"]
    shares = {r.kind: r.places for r in kind_distribution(select_kinds(df, KINDS, []).select("kept"), KINDS).collect()}
    assert shares[None] == 3 and shares["rural"] == 2 and set(shares) == {*KINDS, None}


def test_statistics(spark):
    row = spark.range(1).select(wilson_lower(F.lit(9), F.lit(10)), wilson_lower(F.lit(0), F.lit(0)), noisy_or(F.array(F.lit(0.5), F.lit(0.5)), 0.95), noisy_or(F.array(F.lit(0.9), F.lit(0.9)), 0.95), bucket(F.lit(0.875))).first()
    p, z, n = 0.9, 1.96, 10
    assert abs(row[0] - (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)) < 1e-12 and row[1] == 0
    assert row[2] == 0.75 and row[3] == 0.95 and row[4] == 18
    two = spark.createDataFrame([("g", "a", "a"), ("g", "a", "b"), ("g", "b", "b"), ("g", "b", "b"), ("h", "a", "a"), ("h", None, "a")], "g string, x string, y string")
    k = {r.g: (r.n, r.kappa) for r in cohen_kappa(two, "x", "y", "g").collect()}
    assert k == {"g": (4, 0.5), "h": (1, None)}
    t = spark.createDataFrame([("g", i, i, x) for i, x in enumerate([1, 3, 2, 4, None])], "g string, k int, a int, b int")
    assert [(r.n, r.tau) for r in kendall_tau(t, "k", "a", "b", "g").collect()] == [(4, round(4 / 6, 6))]


def test_names(spark):
    assert folded(pd.Series(["  Straße İzmir ", None, "ABC", "ﬁn"])).tolist() == ["strasse izmir", None, "abc", "fin"]
    long = "A very long official title of a property that goes on and on: Part Two"
    data = [("Louvre,  The", None), (long, ["x" * 70, "Short one", "Longer alias"]), (long, None), ("y" * 70, None), ("word " * 20, []), (None, None)]
    rows = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "i int, name string, aliases array<string>")
    got = [r[0] for r in rows.orderBy("i").select(short_name("name", "aliases")).collect()]
    assert got[:4] == ["The Louvre", "Short one", long.split(": ")[0], "y" * 60] and len(got[4]) <= 60 and got[4].endswith("word") and got[5] is None
    f = spark.createDataFrame([("City of Valencia",), ("Madrid city",), ("The City",), ("Mount Kilimanjaro National Park",), (None,)], "n string").select(base_name(fold("n")), core_words(fold("n")), bad_name(F.col("n"))).collect()
    assert [r[0] for r in f] == ["valencia", "madrid", "the city", "mount kilimanjaro national park", None] and f[3][1] == ["kilimanjaro"]
    wrong = ["Q42", "P31", "L12", "<b>", "a&amp;b", "&x1;", "BogotÂ°", "a\x85b", "Ã©", "a\ufffd", "x" * 61, "a\nb"]
    fine = ["ok", "Q42 Tower", "R&D; x".replace(";", ""), "Ürümqi", "São Tomé", "[x]", "Q4x"]
    bad = spark.createDataFrame([(n,) for n in wrong + fine], "n string").select(bad_name(F.col("n"))).collect()
    assert [r[0] for r in bad] == [True] * len(wrong) + [False] * len(fine)


def extract(**kw):
    base = dict(admit_id=1, qid="Q1", alt_qids=None, iso3="aaa", family="attention", label_en=None, label_loc=None, lat=None, lon=None, sitelinks=None, population=None, classes=None, heritage=None, whs=None, wdpa=None, voyage=None)
    return {**base, **kw}


SCHEMA = "admit_id long, qid string, alt_qids array<string>, iso3 string, family string, label_en string, label_loc string, lat double, lon double, sitelinks int, population long, classes array<string>, heritage array<string>, whs string, wdpa string, voyage boolean"


def test_assembly_and_admission(spark):
    rows = [
        extract(admit_id=1, qid="wd:q1", label_en="First", lat=1.0, lon=1.0, sitelinks=3, classes=["K1"], whs="10-2"),
        extract(admit_id=2, qid=" Q1", family="popall", lat=2.0, lon=2.0, sitelinks=-5, population=200_000, classes=["K2"], iso3="bbb"),
        extract(admit_id=3, family="class", label_en="Second", sitelinks=7, whs="№10 in the list", voyage=True),
        extract(admit_id=4, qid="n/a"), extract(admit_id=5, qid=None), extract(admit_id=6, qid="Q2", classes=["K3"], label_loc="Loc", lat=1.0, lon=1.0, sitelinks=2), extract(admit_id=7, qid="Q3", sitelinks=90, classes=["K1"]),
    ]
    df = spark.createDataFrame(rows + rows[:1], SCHEMA)
    listed = spark.createDataFrame([("10",), ("11",)], "id_number string")
    over = spark.createDataFrame([("Q2", "ZZZ")], "qid string, iso3 string")
    got = {r.qid: r for r in assemble(df, listed, over).collect()}
    q = got["Q1"]
    assert (q.iso3, q.isos, q.sitelinks, q.population, q.classes, q.label_en, q.lat, q.whs, q.voyage) == ("AAA", ["AAA", "BBB"], 7, 200_000, ["K1", "K2"], "Second", 2.0, "10", True)
    assert set(got) == {"Q1", "Q2", "Q3"} and got["Q2"].iso3 == "ZZZ" and got["Q2"].classes == ["K3"]
    types = spark.createDataFrame([(0, "K1", "site", "ruins", True), (1, "K2", "settlement", None, True), (2, "K3", "area", "water", True), (3, "K4", "area", "rural", False)], "ord int, class_qid string, place_type string, kind_hint string, place_like boolean")
    c = classified(assemble(df, listed), types, ["K2"])
    assert {r.qid: r.place_type for r in c.collect()} == {"Q1": "settlement", "Q2": "area", "Q3": "site"}
    a = {r.qid: r.rules for r in admit(c, notability()).collect()}
    assert a == {"Q1": ["R1", "R3"], "Q2": ["R5"]}
    assert assemble(df.where("false"), listed).count() == 0


def test_heritage_forms(spark):
    v = ["173rev", "1133bis", "669-612", "874.594", "№395 in the list", "12 and 13", "", None, "99"]
    df = spark.createDataFrame([(x,) for x in v], "v string").withColumn("n", heritage_number(F.col("v")))
    listed = F.col("n").isin("173", "1133", "669", "874", "395")
    got = df.select(heritage_id(F.col("v"), F.coalesce(listed, F.lit(False))).alias("h")).withColumn("w", whole_property(F.col("h"))).collect()
    assert [r.h for r in got] == ["173", "1133bis", "669-612", "874.594", "395", None, None, None, None] and [r.w for r in got][:4] == [True, True, False, False]


def test_tiers_and_read_models(spark):
    rows = [(f"q{i:03d}", "A" if i < 50 else "B", float(i), None, f"n{i}") for i in range(55)]
    t = {r.qid: r.tier for r in assign_tiers(spark.createDataFrame(rows, "qid string, iso3 string, n double, whs string, name_en string")).collect()}
    assert [t[f"q{i:03d}"] for i in (54, 53, 51, 50, 49, 46, 45, 0)] == ["Icon", "Major", "Major", "Notable", "Icon", "Icon", "Major", "Local"]
    orders = spark.createDataFrame([("a", "2026-01-05"), ("a", "2026-01-09"), ("a", "2026-12-31"), ("b", "2025-12-31"), ("c", None)], "k string, d string").withColumn("d", F.to_date("d"))
    assert [(r.k, list(r.views), r.total) for r in months_filled(orders, "k", "d", F.lit(1).cast("bigint"), "2026-01-01").collect()] == [("a", [2] + [0] * 10 + [1], 3)]
    q = print_quota(spark.createDataFrame([("A", 9.0, 7), ("B", 0.1, 1)], "iso string, w double, k int"), F.col("w"), 10, F.col("k"))
    assert {r.iso: r.quota for r in q.collect()} == {"A": 10, "B": 1}
    p = spark.createDataFrame([("A", f"p{i}", i, "x" if i < 3 else "y", i == 0, i == 9) for i in range(10)], "iso string, id string, rank int, kind string, f boolean, b boolean")
    chosen = [r.id for r in print_selection(p, spark.createDataFrame([("A", 3)], "iso string, quota int"), "iso", "id", [F.col("rank")], "kind", F.col("f"), F.col("b")).orderBy("position").collect()]
    assert chosen == ["p0", "p8", "p7"] and "p9" not in chosen
    m = missing_kinds(p, spark.createDataFrame([("p1",)], "id string"), "iso", "id", "kind")
    assert [r.sentence for r in gap_sentence(m, "iso", "kind", ["x", "y"]).collect()] == ["Not yet: y"]
    assert hash_sample(p, "kind", "id", 2, "s").count() == 4
