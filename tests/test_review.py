import pytest
from pyspark.sql import functions as F

from waymark.functions import claims, raster
from waymark.operators import kindrules, review
from waymark.operators.kinds import fire

FACTS = "qid string, place_type string, population bigint, coast_km double, core array<string>, support array<string>, whs_title string, capital string, tree double, crop double, grass double, water double, wetland double, bare double, relief double, summit double, iucn_cat string, big_city boolean"


def test_kind_rules(spark):
    """Each fact alone and at its limit; what is not known fires nothing."""
    names = [f.split()[0] for f in FACTS.split(", ")]
    cases = {
        "nothing": ({}, set()), "capital": ({"capital": "now"}, {"R01"}), "former": ({"capital": "past"}, {"R02"}), "beach": ({"core": ["R03"]}, {"R03"}), "near": ({"coast_km": 2.0}, {"R03b"}),
        "port": ({"core": ["R05"], "coast_km": 3.0}, {"R05"}), "inland port": ({"core": ["R05"], "coast_km": 3.1}, set()), "port unknown": ({"core": ["R05"]}, set()),
        "coast city": ({"place_type": "settlement", "population": 100_000, "coast_km": 2.5}, {"R05b", "R21"}), "coast site": ({"place_type": "site", "population": 100_000, "coast_km": 2.5}, {"R21"}),
        "park": ({"iucn_cat": "IV"}, {"R12"}), "weak park": ({"iucn_cat": "V"}, set()), "own class": ({"core": ["R12b"]}, {"R12b"}), "member class": ({"support": ["R12b", "R07"]}, {"R07"}),
        "sand": ({"bare": 0.75}, {"R13"}), "relief": ({"relief": 1500.0}, {"R14"}), "summit": ({"relief": 0.0, "summit": 2500.0}, {"R14"}), "million": ({"population": 1_000_000}, {"R16", "R21"}),
        "old town": ({"place_type": "settlement", "whs_title": "Historic Centre of X"}, {"R17"}), "old site": ({"place_type": "site", "whs_title": "Historic Centre of X"}, set()), "old class": ({"place_type": "site", "core": ["R17b"]}, set()),
        "lake land": ({"water": 0.1, "wetland": 0.05}, {"R18b"}), "lagoon": ({"water": 0.5, "coast_km": 4.0}, set()), "trees": ({"tree": 0.7}, {"R19"}), "fields": ({"crop": 0.5, "grass": 0.25}, {"R20"}), "suburb": ({"crop": 0.9, "big_city": True}, set()),
    }
    df = spark.createDataFrame([tuple({"qid": k, **v[0]}.get(n) for n in names) for k, v in cases.items()], FACTS)
    out = {r.qid: {f["rule"]: f["role"] for f in r.fired} for r in fire(df, kindrules.RULES, kindrules.kind_tests()).withColumn("fired", kindrules.role_by_source(F.col("fired"))).collect()}
    assert {k: set(v) for k, v in out.items()} == {k: v[1] for k, v in cases.items()}
    assert out["member class"] == {"R07": "support"} and out["beach"] == {"R03": "core"}


def test_capitals_and_members(spark):
    s = spark.createDataFrame([("a", [(["S"], False)]), ("b", [(["S"], True)]), ("c", [(["S", "F"], False)]), ("d", [(["S"], True), (["S"], None)]), ("e", [(["X"], False), (None, None)]), ("f", [])], "k string, s array<struct<classes:array<string>,ended:boolean>>")
    got = {r.k: r.c for r in s.select("k", kindrules.capital_state(F.col("s"), ["S"], ["F"]).alias("c")).collect()}
    assert got == {"a": "now", "b": "past", "c": "past", "d": "now", "e": None, "f": None}
    p = spark.createDataFrame([("a", ["C1"]), ("b", None)], "qid string, classes array<string>")
    m = spark.createDataFrame([("a", ["C2"], True), ("b", ["C1"], False), ("a", ["C1"], True)], "qid string, classes array<string>, nested boolean")
    sets = spark.createDataFrame([("R07", "C1"), ("R10", "C2")], "rule_id string, class_qid string")
    assert {r.qid: (r.core, r.support) for r in kindrules.member_rules(p, m, sets).collect()} == {"a": (["R07"], ["R10"]), "b": (["R07"], [])}


def test_grids(spark):
    df = spark.createDataFrame([(list(map(float, range(25))),), ([],), (None,)], "g array<double>")
    rows = df.select(raster.in_circle(F.col("g"), 5, 2, 2, 1.0).alias("c"), raster.relief(F.col("g"), 5, 2.0, 2.0, 2.0, 1.0).alias("r"), raster.class_shares(F.col("g"), 5, 1.0, {"a": 12, "b": 0}).alias("s")).collect()
    assert rows[0].c == [7, 11, 12, 13, 17] and tuple(rows[0].r) == (20.0, 17.0, 12.0) and tuple(rows[0].s) == (0.2, 0.0)
    assert rows[1].c == [] and tuple(rows[1].s) == (None, None) and rows[2].c is None
    assert spark.range(1).select(raster.terrarium_metres(F.lit(128.0), F.lit(10.0), F.lit(128.0))).first()[0] == 10.5


PLACES = "place_id string, iso3 string, type string, lat double, lon double, keys array<string>, names array<string>"
ROWS = "golden_id string, iso3 string, type string, hla double, hlo double, tol double, qid string, names array<string>"


def test_expectations(spark):
    places = spark.createDataFrame([
        ("near", "A", "site", 10.0, 20.0, ["qid:Q1"], ["kolmar"]), ("twin", "A", "site", 10.02, 20.0, [], ["kolmar"]), ("other", "A", "area", 10.0, 20.0, ["qid:Q2"], ["alba"]),
        ("far", "A", "area", 11.0, 20.0, ["qid:Q3"], ["lake"]), ("abroad", "B", "site", 10.0, 20.0, ["qid:Q1"], ["kolmar"]), ("lost", "A", "site", None, None, ["qid:Q1"], ["kolmar"]),
    ], PLACES)
    rows = spark.createDataFrame([
        ("name", "A", "site", 10.0, 20.0, 5.0, None, ["kolmar", "x"]), ("id", "A", "settlement", 10.0, 20.0, 5.0, "Q2", ["y"]), ("anchor", "A", "area", 10.0, 20.0, 5.0, "Q3", ["y"]), ("strict", "A", "site", 10.0, 20.0, 5.0, "Q3", ["lake"]),
        ("nowhere", "A", "site", None, None, 5.0, None, ["kolmar"]), ("typed", "A", "area", 10.0, 20.0, 5.0, None, ["kolmar"]),
    ], ROWS)
    assert {(r.golden_id, r.place_id) for r in review.expectation_candidates(rows, places).collect()} == {("name", "near"), ("name", "twin"), ("id", "other"), ("anchor", "far")}
    state = {(r.golden_id, r.place_id): r.state for r in review.assign_expectations(rows, places).collect()}
    assert state == {("name", "near"): "matched", ("id", "other"): "matched", ("anchor", "far"): "matched", ("name", "twin"): "duplicate", ("strict", None): "missed", ("nowhere", None): "missed", ("typed", None): "missed"}
    assert review.assign_expectations(rows.where("false"), places).count() == 0


def test_recall_and_diagnosis(spark):
    e = spark.createDataFrame([("A", "Q1"), ("A", "Q2"), ("A", "Q2"), ("B", "Q3")], "iso3 string, qid string")
    x = spark.createDataFrame([("Q1", "class"), ("Q1", "node"), ("Q2", "class"), ("Q2", "class"), ("Q9", "class"), ("Q3", None)], "qid string, family string")
    assert {tuple(r) for r in review.recall_by(e, x, "iso3").collect()} == {("A", "class", 2, 2), ("A", "node", 2, 1), ("A", None, 2, 2), ("B", None, 1, 0)}
    missed = spark.createDataFrame([("g1", "Q1"), ("g2", "Q2"), ("g3", "Q3"), ("g4", "Q4")], "golden_id string, qid string")
    c = spark.createDataFrame([("Q1", "site", 3), ("Q2", None, 4), ("Q4", "site", 5)], "qid string, place_type string, sitelinks int")
    gone = spark.createDataFrame([("Q4", "Q1")], "qid string, parent string")
    assert {r.golden_id: r.cause for r in review.diagnose_misses(missed, c, gone).collect()} == {"g1": "below the floors", "g2": "no place-like class", "g3": "no candidate", "g4": "merged"}


def test_decisions_and_labels(spark):
    g = spark.createDataFrame([("g1", "positive", None, ""), ("g2", "positive", "Q7", "old"), ("n", "negative", None, "")], "golden_id string, row_kind string, qid string, qid_status string")
    d = lambda rows: spark.createDataFrame(rows, "golden_id string, qid string, decision string")
    fine = review.apply_decisions(g, d([("g1", "Q5", "accept"), ("n", "Q6", "reject")]), "2026-01-01").collect()
    assert {r.golden_id: (r.qid, r.qid_status) for r in fine} == {"g1": ("Q5", "resolved 2026-01-01"), "g2": ("Q7", "old"), "n": (None, "")}
    for bad in ([("n", "Q5", "accept")], [("g1", "x5", "accept")], [("g1", "Q7", "accept")], [("zz", "Q1", "accept")]):
        with pytest.raises(ValueError):
            review.apply_decisions(g, d(bad), "2026-01-01")
    e = spark.createDataFrame([("Q1", "castle"), ("Q2", "ruins"), ("Q3", "mill")], "class_qid string, expected string")
    f = spark.createDataFrame([("Q1", "castle"), ("Q2", "temple")], "class_qid string, label string")
    assert {tuple(r) for r in review.label_problems(e, f).collect()} == {("Q2", "is temple"), ("Q3", "not found")}


def test_read_models(spark):
    p = spark.createDataFrame([("pl_a", "Q1", "A", "Local", "site", ["ruins"], True, "kolmar"), ("pl_b", "Q2", "A", "Icon", "site", [], False, "alba")], "place_id string, qid string, iso3 string, tier string, type string, kinds array<string>, sample boolean, folded string")
    ids = lambda **kw: [r[0] for r in p.where(review.place_filter(**kw)).select("place_id").collect()]
    assert ids() == ["pl_a", "pl_b"] and ids(kind="none") == ["pl_b"] and ids(text="lba") == ["pl_b"] and ids(text="q1") == ["pl_a"] and ids(tab="sample", tier="Icon") == []
    log = spark.createDataFrame([("same property 7", "site", "ruins", "sacred"), ("same property 8", "area", None, "x"), ("located in Q1", "site", "a", "a")], "reason string, child_type string, child_hint string, parent_hint string")
    assert {tuple(r) for r in review.absorption_summary(log).collect()} == {("same property", 2, 1, 1), ("located in", 1, 1, 0)}
    moved = review.after_redirects(spark.createDataFrame([("Q1",), ("Q2",)], "qid string"), spark.createDataFrame([("Q1", "Q9"), ("Q3", None)], "qid string, target string"))
    assert {r.qid for r in moved.collect()} == {"Q9", "Q2"}


def test_answers(spark):
    a = spark.createDataFrame([('{"items": [{"timestamp": "2025020100", "views": 5}, {"timestamp": "2024120100", "views": 9}]}',), (None,)], "a string")
    assert [r[0] for r in a.select(claims.monthly_views(F.col("a"), "202501", 3)).collect()] == [[0, 5, 0], None]
    e = spark.createDataFrame([('{"id": "Q1", "sitelinks": {"enwiki": {"title": "x"}, "dewikiquote": {"title": "x"}, "arwiki": {"title": "x"}}}',), ('{"id": "Q2", "missing": ""}',)], "e string")
    assert [(r.missing, r.wikis) for r in e.select(*[c.alias(n) for n, c in claims.profile_columns(F.col("e")).items()]).collect()] == [(False, ["arwiki", "enwiki"]), (True, None)]
    assert spark.range(1).select(claims.title_path(F.lit("A b/ü*"))).first()[0] == "A_b%2F%C3%BC%2A"
