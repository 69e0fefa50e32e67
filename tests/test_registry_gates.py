import pytest
from pyspark.sql import functions as F

from waymark.operators import registry as R
from waymark.operators.gates import GATES, Context, frozen_digest, golden_problems, place_problems, run_gates

KINDS = ["ruins", "sacred"]
EV = [{"asset_id": "wd:Q1", "source": "wikidata", "url": None, "retrieved": "2026-01-01", "source_key": "qid:Q1"}]


def reg(spark, rows):
    return spark.createDataFrame([(i, k, s, "b1", "b1", None) for i, k, s in rows], R.SCHEMA)


def test_mint_reuse_and_errors(spark):
    r = reg(spark, [("pl_a", ["qid:Q1"], "active"), ("pl_b", ["qid:Q2", "wdpa:9"], "retired"), ("pl_c", ["qid:Q3"], "merged_into:pl_a"), ("pl_x", ["qid:Q8"], "merged_into:pl_y"), ("pl_y", ["qid:Q9"], "merged_into:pl_x")])
    c = lambda rows: spark.createDataFrame(rows, "candidate string, keys array<string>")
    after, ids = R.mint_or_reuse(r, c([("one", ["wdpa:7", "qid:Q3"]), ("two", ["qid:Q2"]), ("new", ["osm:5", "qid:Q77"])]), "b2")
    ids = {x.candidate: x.place_id for x in ids.collect()}
    rows = {x.place_id: x for x in after.collect()}
    assert ids["one"] == "pl_a" and rows["pl_a"]["keys"] == ["qid:Q1", "qid:Q3", "wdpa:7"] and rows["pl_a"].last_seen_build == "b2"
    assert ids["two"] == "pl_b" and rows["pl_b"].status == "active"
    assert len(ids["new"]) == 13 and rows[ids["new"]].minted_build == "b2"
    assert ids["new"] == r.limit(1).select(R.id_from(F.lit("qid:Q77"))).first()[0]
    for bad in ([("q", [])], [("q", ["qid:Q1", "qid:Q2"])], [("q", ["qid:Q8"])], [("q", ["k:1"]), ("p", ["k:1"])], [("q", ["qid:Q1"]), ("p", ["qid:Q3"])]):
        with pytest.raises(R.MintingError):
            R.mint_or_reuse(r, c(bad), "b2")


def test_retire_merge_split(spark):
    r = reg(spark, [("pl_a", ["qid:Q1"], "active"), ("pl_b", ["qid:Q2"], "active"), ("pl_c", ["qid:Q3"], "merged_into:pl_a")])
    assert {x.place_id for x in R.retire(r, ["pl_b"], "b2", "gone").where("status = 'retired'").collect()} == {"pl_b"}
    with pytest.raises(R.MintingError):
        R.retire(r, ["pl_c"], "b2", "gone")
    merged = R.merge(r, "pl_a", "pl_b", "b2")
    assert {x.place_id: x.current for x in R.resolved(merged).collect()} == {"pl_a": "pl_b", "pl_b": "pl_b", "pl_c": "pl_b"}
    for a, b in (("pl_a", "pl_a"), ("pl_a", "pl_z"), ("pl_a", "pl_c")):
        with pytest.raises(R.MintingError):
            R.merge(r, a, b, "b2")
    assert R.split(r, "pl_a", ["qid:Q5"], "b2").where("status = 'split_from:pl_a'").count() == 1
    with pytest.raises(R.MintingError):
        R.split(r, "pl_a", ["qid:Q2"], "b2")


def bundle(spark, n=120):
    rows = []
    for i in range(n):
        kind = {"kind": KINDS[i % 8 == 0], "rule": "R07", "strength": 0.8, "evidence": ["wd:Q1"]}
        kinds = [kind] if i % 5 == 0 else []
        rows.append((f"pl_{i:010d}", "site", f"Place {i}", [], "ABC" if i % 2 else "DEF", 10.0 + i / 100, 20.0, "Local", "active", f"Q{i + 1}", [f"qid:Q{i + 1}"], EV, kinds, None if kinds else "no rule fired"))
    schema = "place_id string, type string, name_en string, aliases array<string>, iso3 string, lat double, lon double, tier string, status string, qid string, keys array<string>, evidence array<struct<asset_id:string,source:string,url:string,retrieved:string,source_key:string>>, kinds array<struct<kind:string,rule:string,strength:double,evidence:array<string>>>, no_kind_reason string"
    return spark.createDataFrame(rows, schema)


def context(spark, places=None, base=None):
    base = bundle(spark) if base is None else base
    p = base if places is None else places
    golden = base.select(F.concat(F.lit("G"), F.substring("place_id", 4, 10)).alias("golden_id"), F.lit("positive").alias("row_kind"), F.col("name_en").alias("expected_name"), "iso3", "type", F.col("lat").cast("string").alias("lat"), F.col("lon").cast("string").alias("lon"), F.lit("5").alias("tol_km"), F.lit("Local").alias("min_tier"), F.lit("Icon").alias("max_tier"), F.lit(None).cast("string").alias("relation"), F.lit(None).cast("string").alias("target_id"), "qid", F.lit(None).cast("string").alias("whs_id"), F.lit("yes").alias("regression"))
    holdout = golden.withColumns({"golden_id": F.concat(F.lit("H"), "golden_id"), "expected_name": F.concat(F.lit("Held "), "expected_name"), "lat": (F.col("lat").cast("double") + 30).cast("string")})
    matches = p.select(F.concat(F.lit("G"), F.substring("place_id", 4, 10)).alias("golden_id"), "place_id").where("length(place_id) = 13")
    return Context(
        p, KINDS, golden, matches, base.select("place_id", "keys", F.lit("active").alias("status")), base, base.rollup("iso3").agg(F.count("*").alias("n")),
        spark.createDataFrame([("a", "x")], "file string, sha256 string"), spark.createDataFrame([("a", "x")], "file string, sha256 string"),
        spark.createDataFrame([("ABC", 5, False), ("DEF", 5, False)], "iso3 string, floor int, exempt boolean"),
        base.where("size(kinds) > 0").select("place_id", F.transform("kinds", lambda k: k["kind"]).alias("kinds")), base.limit(110).select("place_id", F.lit("right").alias("verdict")), strict=False,
        holdout=holdout, holdout_matches=matches.select(F.concat(F.lit("H"), "golden_id").alias("golden_id"), "place_id"), frozen=frozen_digest(holdout),
    )


def results(spark, ctx, names=None):
    return {r.gate: r.passed for r in run_gates(spark, ctx, names).collect()}


def test_gates_pass_on_a_sound_bundle(spark):
    got = results(spark, context(spark))
    # Four in five places have no kind, and two kinds cannot be labelled often enough, in so small a world.
    expected = {"G-KIND", "G-KIND-PRECISION", "G-DETERMINISM", "G-STRUCT", "G-PAIRS", "G-REGION", "G-DISPUTE", "G-PRINT"}
    assert {g for g, ok in got.items() if not ok} == expected and len(got) == len(GATES) + 6


def first():
    return F.col("place_id") == "pl_0000000000"


MUTATIONS = {
    "G-SCHEMA": lambda p: p.withColumn("lat", F.when(first(), 95.0).otherwise(F.col("lat"))),
    "G-LANDMARK": lambda p: p.where(~first()),
    "G-TIER": lambda p: p.withColumn("tier", F.when(first(), "None").otherwise(F.col("tier"))),
    "G-ID": lambda p: p.withColumn("keys", F.when(first(), F.array(F.lit("qid:Q999"))).otherwise(F.col("keys"))),
    "G-IDENT": lambda p: p.withColumn("qid", F.when(first(), "Q2").otherwise(F.col("qid"))),
    "G-NAMES": lambda p: p.withColumn("name_en", F.when(first(), "<b>x</b>").otherwise(F.col("name_en"))),
    "G-COUNT": lambda p: p.where(~first()),
    "G-COVER": lambda p: p.withColumn("iso3", F.when(first(), "XXX").otherwise(F.col("iso3"))),
    "G-EVIDENCE": lambda p: p.withColumn("evidence", F.when(first(), F.slice("evidence", 1, 0)).otherwise(F.col("evidence"))),
    "G-CHURN": lambda p: p.withColumn("lat", F.when(F.col("place_id") < "pl_0000000010", F.col("lat") + 1).otherwise(F.col("lat"))),
    "G-HOLDOUT": lambda p: p.where("place_id > 'pl_0000000030'"),
    "G-PRECISION": lambda p: p.where("place_id > 'pl_0000000030'"),
}


@pytest.mark.parametrize("name", MUTATIONS)
def test_each_gate_fails_on_its_defect(spark, name):
    base = bundle(spark)
    assert results(spark, context(spark, MUTATIONS[name](base), base), [name]) == {name: False}


def test_holdout_is_frozen_and_apart(spark):
    ctx = context(spark)
    ctx.frozen = "other"
    assert results(spark, ctx, ["G-HOLDOUT"]) == {"G-HOLDOUT": False}
    for change in ({"expected_name": F.lit("PLACE  7".replace("  ", " "))}, {"lat": (F.col("lat").cast("double") - 30).cast("string")}):
        ctx = context(spark)
        ctx.holdout = ctx.holdout.withColumns(change)
        ctx.frozen = frozen_digest(ctx.holdout)
        assert results(spark, ctx, ["G-HOLDOUT"]) == {"G-HOLDOUT": False}


def test_negative_rows_that_places_contradict(spark):
    row = lambda id_, name, iso, relation, target: (id_, "negative", name, iso, "site", "1", "1", "5", "Local", "Icon", relation, target, None, None, "no")
    for rows, ok in (([row("N1", "Not There", "ABC", "component_of", "G0000000000")], True), ([row("N1", "place 1", "ABC", "component_of", None)], False), ([row("N1", "Not There", "QQQ", "component_of", None)], False),
                     ([row("N1", "Place 1", "ABC", "not_credited", "G0000000003")], False), ([row("N1", "Not There", "ABC", "not_credited", "G9")], False)):
        ctx = context(spark)
        ctx.golden = ctx.golden.union(spark.createDataFrame(rows, ctx.golden.schema))
        assert results(spark, ctx, ["G-LANDMARK"]) == {"G-LANDMARK": ok}


def test_gates_fail_closed(spark):
    empty = context(spark, bundle(spark).where("false"))
    got = results(spark, empty)
    assert not any(ok for g, ok in got.items() if g not in ("G-GOLDEN", "G-INTEGRITY"))
    bare = results(spark, Context(bundle(spark)), ["G-GOLDEN", "G-LANDMARK", "G-COVER", "G-INTEGRITY", "G-PRECISION", "G-KIND-PRECISION"])
    assert not any(bare.values())


def test_problem_lists(spark):
    p = bundle(spark, 3).union(bundle(spark, 1))
    assert {r.problem for r in place_problems(p).collect()} == {"place_id repeated"}
    g = context(spark).golden.limit(3)
    bad = g.withColumns({"row_kind": F.lit("negative"), "relation": F.lit("not_above"), "target_id": F.lit("G9")}).limit(1)
    assert golden_problems(g).count() == 0
    assert "unknown target G9" in {r.problem for r in golden_problems(bad).collect()}
