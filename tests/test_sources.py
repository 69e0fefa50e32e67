import json

import pytest
from pyspark.sql import functions as F

from waymark.functions import claims as C
from waymark.sources import readers, remote, writers
from waymark.streaming.events import distinct_events, last_state, windowed_counts


def entity(**kw):
    stmt = lambda v, rank="normal", **q: {"rank": rank, "mainsnak": {"datavalue": {"value": v}}, "qualifiers": q}
    return json.dumps({
        "id": "Q5", "labels": {"en": {"value": "E"}, "fr": {"value": "F"}, "de": {"value": "D"}}, "aliases": {"en": [{"value": "e1"}], "de": [{"value": "d1"}, {"value": "d2"}]}, "descriptions": {"en": {"value": "desc"}},
        "claims": {"P31": [stmt({"id": "Q1"}), stmt({"id": "Q2"}, "deprecated"), stmt({"id": "Q3"}, "preferred")], "P571": [stmt({"time": "bad"}), stmt({"time": "-0753-04-21T00:00:00Z"})], "P1376": [stmt({"id": "Q9"}), stmt({"id": "Q8"}, P582=["x"])], "P856": [stmt("http://x")]},
        "sitelinks": {"enwiki": {"title": "T"}}, **kw,
    })


def test_claims(spark):
    df = spark.createDataFrame([("Q4", entity()), ("Q6", json.dumps({"id": "Q6", "missing": ""})), ("Q7", "no json")], "q string, e string")
    rows = {r.qid: r for r in df.select(*[c.alias(k) for k, c in C.entity_columns(F.col("e"), F.col("q"), ["fr", "de"]).items()]).collect()}
    a = rows["Q4"]
    assert (a.redirected_to, a.label_en, a.label_loc, a.instance_of, a.inception, a.dissolved, a.aliases_loc, a.official_url, a.wikipedia_en) == ("Q5", "E", "D", ["Q1", "Q3"], -753, None, ["d1", "d2"], "http://x", "T")
    assert [(x.qid, x.ended) for x in a.capital_of] == [("Q9", False), ("Q8", True)]
    assert rows["Q6"].missing and rows["Q6"].instance_of == [] and rows["Q7"].label_en is None
    b = {"item": "http://x/entity/Q1", "coord": "Point(2.5 -1e1)", "sl": "7.0", "insts": "http://x/Q2|http://x/Q3", "pop": "x", "country": "http://x/Q9"}
    r = spark.createDataFrame([(b,)], "b map<string,string>").select(*[c.alias(k) for k, c in C.binding_columns(F.col("b")).items()]).first()
    assert (r.qid, r.lat, r.lon, r.sitelinks, r.population, r.instance_of, r.country_qid, r.whs) == ("Q1", -10.0, 2.5, 7, None, ["Q2", "Q3"], "Q9", None)
    r = spark.createDataFrame([({"cap": "u/Q1", "state": "u/Q2", "classes": "u/Q3|", "ended": "1"},)], "b map<string,string>").select(*[c.alias(k) for k, c in C.capital_columns(F.col("b")).items()]).first()
    assert tuple(r) == ("Q1", "Q2", ["Q3"], True)


def test_readers(spark, tmp_path):
    t = str(tmp_path)
    assert readers.read_or_empty(spark, f"{t}/none", "a int, b string").count() == 0
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{t}/some")
    assert [tuple(r) for r in readers.read_or_empty(spark, f"{t}/some", "a int, b string").collect()] == [(1, None)]
    (tmp_path / "x.jsonl").write_text('{"_meta": {"complete": true}}\n{"qid": "Q1", "n": 3}\n{"n": 4}\nbroken\n')
    rows = readers.read_lines(spark, f"{t}/x.jsonl", "qid string, n int").collect()
    assert [(r.qid, r.n) for r in rows] == [("Q1", 3), (None, 4), (None, None)] and rows[2]["_corrupt_record"] == "broken"
    (tmp_path / "rules.csv").write_text('a,b\n1,"x, ""y"""\n2,z\n')
    assert [(r.a, r.b, r.ord) for r in readers.read_rules(spark, f"{t}/rules.csv", "a int, b string").collect()] == [(1, 'x, "y"', 0), (2, "z", 1)]
    (tmp_path / "old.csv").write_text("WDPAID,ISO3,STATUS,IUCN_CAT,GIS_AREA\n5,AAA;BBB,Designated,II,120\n6,CCC,Designated,Ia,1\n7,AAA,Proposed,Ia,1\n")
    (tmp_path / "new.csv").write_text("SITE_ID,PRNT_ISO3,STATUS,IUCN_CAT,REP_AREA\n5,BBB,designated,Ib,90\n10,AAA,Designated,V,x\n")
    wdpa = readers.reduce_protected(spark, [f"{t}/old.csv", f"{t}/new.csv"], ["AAA", "BBB"])
    assert [tuple(r) for r in wdpa.collect()] == [("5", "BBB", "Ib", 90.0), ("10", "AAA", "V", None)]
    assert [r[0] for r in wdpa.select(readers.strict_and_large(F.col("iucn_cat"), F.col("area_km2"), 50.0)).collect()] == [True, False]
    (tmp_path / "reg.csv").write_text("place_id,keys,status,minted_build,last_seen_build,tombstone_reason\npl_a,qid:Q1|wdpa:2, active ,b1,b1,\n")
    assert readers.read_registry(spark, f"{t}/reg.csv").first()["keys"] == ["qid:Q1", "wdpa:2"]
    (tmp_path / "doc/places").mkdir(parents=True)
    (tmp_path / "doc/places/AAA.json").write_text(json.dumps({"iso3": "AAA", "places": [{"place_id": "p", "aliases": ["x", {"alias": "y"}]}, {"place_id": "q", "iso3": "BBB"}]}))
    assert {(r.place_id, r.iso3, tuple(r.aliases or ())) for r in readers.read_bundle(spark, f"{t}/doc").collect()} == {("p", "AAA", ("x", "y")), ("q", "BBB", ())}


def test_bundle_round_trip(spark, tmp_path):
    t = str(tmp_path / "b")
    p = spark.createDataFrame([(f"pl_{i:03d}", "A" if i % 3 else "B", float(i), ["n"]) for i in range(30)], "place_id string, iso3 string, lat double, aliases array<string>")
    manifest = writers.write_bundle(p, t, "b1", {"note": 1})
    assert manifest["counts"] == {"places": 30, "per_country": {"A": 20, "B": 10}}
    back = readers.read_bundle(spark, t).select("place_id", "iso3", "lat", "aliases")
    assert {tuple(map(str, r)) for r in back.collect()} == {tuple(map(str, r)) for r in p.collect()}
    assert {r.file: r.sha256 for r in writers.file_hashes(spark, t).collect()} == json.loads((tmp_path / "b/manifest.json").read_text())["hashes"]
    with pytest.raises(FileExistsError):
        writers.write_bundle(p, t, "b2")
    assert json.loads(writers.geojson_lines(p.withColumn("lon", F.lit(1.0)), ["place_id"]).first().value)["geometry"]["type"] == "Point"


def test_guards_pins_and_reports(spark, tmp_path):
    registry = spark.createDataFrame([("b", ["k2", "k1"]), ("a", ["k"])], "place_id string, keys array<string>")
    golden = spark.createDataFrame([("g", "positive", "Q1")], "golden_id string, row_kind string, qid string")
    gates = lambda ok: spark.createDataFrame([("G-LANDMARK", ok)], "gate string, passed boolean")
    with pytest.raises(PermissionError):
        writers.commit_registry(registry, str(tmp_path / "r"), gates(False), golden)
    with pytest.raises(PermissionError):
        writers.commit_registry(registry, str(tmp_path / "r"), gates(True), golden.withColumn("qid", F.lit(" ")))
    writers.commit_registry(registry, str(tmp_path / "r"), gates(True), golden)
    assert spark.read.parquet(str(tmp_path / "r")).where("place_id = 'b'").first()["keys"] == ["k1", "k2"]
    m = writers.pin(writers.pin({}, "s", {"name": "n"}, [("b", b"1"), ("a", b"2")]), "s", {}, [("b", b"33")])
    assert [(f["path"], f["bytes"]) for f in m["sources"][0]["files"]] == [("a", 1), ("b", 2)]
    told = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("c", 1, "x"), ("d", 1, "x")], "path string, bytes long, sha256 string")
    seen = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", 1, "y"), ("e", 1, "z")], "path string, bytes long, sha256 string")
    assert {tuple(r) for r in writers.check_pins(told, seen, ["a", "z"]).collect()} == {("b", "size differs"), ("c", "hash differs"), ("d", "missing"), ("e", "not in the manifest"), ("z", "required but not pinned")}
    assert writers.markdown_table(spark.createDataFrame([("a|b", None)], "x string, y int")).splitlines()[2] == "| a\\|b |  |"
    with pytest.raises(ValueError):
        writers.markdown_table(spark.range(5), most=3)


def test_jobs_and_pages(spark):
    jobs = remote.plan_jobs(["A", "B"], [f"Q{i}" for i in range(24)])
    assert len(jobs) == 2 * 82 and len({j.name for j in jobs}) == len(jobs)
    waits = []
    calls = iter([remote.Throttled(7), remote.Throttled(), [{"qid": "Q1"}]])

    def flaky(*_):
        x = next(calls)
        if isinstance(x, Exception):
            raise x
        return x

    assert remote.call(flaky, pause=waits.append) == [{"qid": "Q1"}] and waits == [7, 2.0]
    with pytest.raises(remote.Throttled):
        remote.call(lambda: (_ for _ in ()).throw(remote.Throttled(0)), retries=1, pause=lambda s: None)

    def fetch(job, part, offset, page):
        if job.country == "B":
            raise OSError("down")
        return [{"qid": f"Q{part or 0}{k}"} for k in range(offset, min(offset + page, 5))] + ([{"qid": "Q00"}] if part == 1 and not offset else [])

    plan = [remote.Job("A", "x", (), (0, 1)), remote.Job("B", "x"), remote.Job("A", "done")]
    done = spark.createDataFrame([("A/done",)], "job string")
    rows = remote.read_remote(spark, "recorded", plan, fetch, done, page=2).collect()
    assert sorted(json.loads(r.row)["qid"] for r in rows if r.row) == [f"Q{p}{k}" for p in (0, 1) for k in range(5)] or {json.loads(r.row)["qid"] for r in rows if r.row} >= {"Q00", "Q04"}
    assert [(r.job, r.error) for r in rows if r.error] == [("B/x", "OSError: down")]
    assert [r.job for r in rows if not r.row and not r.error] == ["A/x"]
    e = spark.createDataFrame([("Q1", "X"), ("Q2", "Y")], "id string, expected string")
    assert [tuple(r) for r in remote.preflight(e, spark.createDataFrame([("Q1", "X")], "id string, label string")).collect()] == [("Q2", "Y", None)]
    got = remote.fetch_in_batches(spark.createDataFrame([(f"q{i}",) for i in range(7)], "qid string").coalesce(1), "qid", lambda ids: [{"qid": q, "n": len(ids)} for q in ids], "qid string, n int, error string", batch=3)
    assert sorted(r.n for r in got.collect()) == [1, 3, 3, 3, 3, 3, 3]


def test_streams(spark, tmp_path):
    rows = [("e1", "u", "2026-01-01 00:10:00", "a"), ("e2", "u", "2026-01-01 00:50:00", "b"), ("e1", "u", "2026-01-01 00:10:00", "a"), ("e3", "v", "2026-01-01 02:00:00", "c")]
    schema = "id string, user string, ts timestamp, state string"
    spark.createDataFrame(rows, "id string, user string, ts string, state string").withColumn("ts", F.to_timestamp("ts")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))

    def run(df, name, mode):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return [tuple(r) for r in spark.table(name).collect()]

    assert sorted((u, n) for _, u, n in run(windowed_counts(stream, "ts", ["user"], "1 hour", "1 day"), "w", "complete")) == [("u", 3), ("v", 1)]
    assert len(run(distinct_events(stream, "id", "ts", "1 day"), "d", "append")) == 3
    assert {(k, s) for k, _, s in run(last_state(stream, "user", "ts", "id", ["state"]), "l", "complete")} == {("u", "b"), ("v", "c")}
