import itertools
import random

from pyspark.sql import functions as F

from waymark.llm.representative import Bundle, Dependency, best_representative, branch_and_bound, tied_groups
from waymark.llm.sample import raised, sample_versions, threshold
from waymark.llm.topn import top_n_per_group


def test_branch_and_bound_is_exhaustive_search():
    r = random.Random(1)
    for _ in range(200):
        sizes = [r.randrange(0, 4) for _ in range(3)]
        weights = [r.choice([0.5, 1.0, 2.0]) for _ in sizes]
        bad = {(a, b, x, y) for a, b in ((0, 1), (1, 2), (0, 2)) for x in range(4) for y in range(4) if r.random() < 0.5}

        def allowed(choice, k):
            return not any((a, k, choice[a], choice[k]) in bad for a in range(k) if choice[a] < sizes[a] and choice[k] < sizes[k])

        def fine(c):
            return all(c[k] == sizes[k] or allowed(c, k) for k in range(3))

        best, value = branch_and_bound(sizes, weights, allowed)
        every = [(sum(w * p for w, p in zip(weights, c)), c) for c in itertools.product(*[range(s + 1) for s in sizes]) if fine(c)]
        assert (value, tuple(best)) == min(every)


def rows(spark):
    data = [
        (1, "g", 5, 3, "W1", "AA", 1.0), (2, "g", None, 9, "W2", "BB", 2.0), (3, "g", 5, None, None, "BB", 3.0), (4, "g", -1, 9, "W2", None, None),
        (5, "single", 1, 1, "W1", "AA", 1.0), (6, None, 1, 1, "W1", "AA", 1.0), (7, None, 1, 1, "W1", "AA", 1.0), (8, "h", None, None, None, None, None), (9, "h", None, None, None, None, None),
    ]
    return spark.createDataFrame(data, "id int, g string, links int, at int, whs string, iso string, lat double").withColumn("whs_iso", F.when(F.col("whs") == "W2", "BB").when(F.col("whs") == "W1", "AA"))


def test_best_representative(spark):
    links = F.when(F.col("links") >= 0, F.col("links"))
    survivor = Bundle("s", ["id"], [links, F.col("at"), -F.col("id")])
    heritage = Bundle("w", ["whs"], [F.col("at"), -F.col("id")], when=F.col("whs").isNotNull())
    got = {x.g: (x.first_id, x.n_rows, x.id, x.whs) for x in best_representative(rows(spark), "g", "id", [survivor, heritage]).collect()}
    assert got == {"g": (1, 4, 1, "W2"), "h": (8, 2, 8, None)}
    place = Bundle("p", ["iso", "lat"], [links, F.col("at"), -F.col("id")], when=F.col("iso").isNotNull(), weight=5.0)
    bound = best_representative(rows(spark), "g", "id", [survivor, heritage, place], [Dependency("w", "whs_iso", "p", "iso")])
    # The most trusted place is row 1 (AA), so the newest property (BB) gives way to the one of that country.
    assert {x.g: (x.id, x.whs, x.iso, x.lat) for x in bound.collect()} == {"g": (1, "W1", "AA", 1.0), "h": (8, None, None, None)}
    assert best_representative(rows(spark).where("false"), "g", "id", [survivor]).count() == 0


def test_search_goes_beyond_the_first_candidates(spark):
    # Forty countries of places, none of which fits the property except the least trusted one.
    data = [(i, "g", 100 - i, f"C{i:02d}", "W" if i == 0 else None, "C39") for i in range(40)]
    df = spark.createDataFrame(data, "id int, g string, n int, iso string, whs string, wiso string")
    p = Bundle("p", ["iso"], [F.col("n")], weight=0.1)
    w = Bundle("w", ["whs"], [F.col("n")], when=F.col("whs").isNotNull(), weight=50.0)
    got = best_representative(df, "g", "id", [p, w], [Dependency("w", "wiso", "p", "iso")]).collect()
    assert [(x.iso, x.whs) for x in got] == [("C39", "W")]


def test_tied_groups(spark):
    data = [(1, ["b", "a", None]), (2, ["a"]), (3, ["c", "b"]), (4, ["d"]), (5, [None]), (6, []), (7, None), (8, ["d", "d"])]
    df = spark.createDataFrame([(*d, "clash") for d in data], "id int, names array<string>, root string").drop("root")
    got = {x.id: x.group_id for x in tied_groups(df, "id", F.col("names")).collect()}
    assert got == {1: "a", 2: "a", 3: "a", 4: "d", 5: None, 6: None, 7: None, 8: "d"}


def test_top_n(spark):
    r = random.Random(2)
    data = [("hot" if i % 3 else r.choice(["a", "b", None]), r.choice([None, float("nan"), *map(float, range(6))]), f"k{i:04d}" if i % 50 else None) for i in range(600)]
    df = spark.createDataFrame([(*d, "x") for d in data], "g string, v double, k string, rank string").drop("rank").repartition(5)
    for n in (1, 7):
        got = {(x.g, x.k, x.rank) for x in top_n_per_group(df, ["g"], "v", "k", n).collect()}
        want = set()
        for g in {d[0] for d in data}:
            own = sorted((-d[1], d[2]) for d in data if d[0] == g and d[2] and d[1] is not None and d[1] == d[1])
            want |= {(g, k, i + 1) for i, (_, k) in enumerate(own[:n])}
        assert got == want
    # Whole numbers beyond the exact range of doubles, the least one included, and groups that span several Arrow batches.
    big = spark.createDataFrame([("g", 2**53, "a"), ("g", 2**53 + 1, "b"), ("h", -(2**63), "c"), ("h", -(2**63), "b"), ("h", -(2**63) + 1, "d")], "g string, v long, k string")
    assert {(x.g, x.k, x.rank) for x in top_n_per_group(big.coalesce(1), ["g"], "v", "k", 1).collect()} == {("g", "b", 1), ("h", "d", 1)}
    exact = big.withColumn("v", F.col("v").cast("decimal(30,0)") * 1_000_000_000)
    assert {(x.g, x.k) for x in top_n_per_group(exact.coalesce(1), ["g"], "v", "k", 2).collect()} == {("g", "a"), ("g", "b"), ("h", "b"), ("h", "d")}
    many = spark.range(60_000).select((F.col("id") % 20_000).alias("g"), (F.col("id") * 7919 % 1009).alias("v"), F.col("id").alias("k")).union(spark.range(30_000).select(F.lit(-1).cast("long"), F.col("id") % 13, -F.col("id")))
    got = {(x.g, x.k, x.rank) for x in top_n_per_group(many, ["g"], "v", "k", 2).collect()}
    own: dict = {}
    for x in many.collect():
        own.setdefault(x.g, []).append((-x.v, x.k))
    assert got == {(g, k, i + 1) for g, xs in own.items() for i, (_, k) in enumerate(sorted(xs)[:2])}
    assert top_n_per_group(df, ["g"], "v", "k", 0).count() == 0
    assert top_n_per_group(df.where("false"), ["g"], "v", "k", 3).count() == 0


def test_sample_is_stable(spark):
    data = [(b, f"p{i:04d}", "s" if (i + b) % 2 else "t", f"Q{i}" if b > 1 else None, 1) for b in (1, 2, 3) for i in range(200 * b)] + [(2, None, "s", None, 1), (None, "p0001", "s", None, 1), (3, "odd", None, None, 1)]
    df = spark.createDataFrame(data, "b int, k string, z string, q string, v int")
    plan = {1: {"s": 0.2, "t": 0.3}, 3: {"s": 0.4, "t": 0.1}}
    run = lambda d: {(x.b, x.k, x.z, x.q) for x in sample_versions(d, "k", "z", "b", "v", ["q"], plan, "salt").collect()}
    all_ = run(df)
    assert run(df.repartition(13).orderBy(F.rand(3))) == all_ and run(df.union(df)) == all_
    early = run(df.where("b < 3 or b is null"))
    assert {(b, k, z) for b, k, z, _ in early} == {(b, k, z) for b, k, z, _ in all_ if b < 3}
    by = {b: {k for v, k, _, _ in all_ if v == b} for b in (1, 2, 3)}
    assert by[1] < by[2] < by[3] and "odd" not in by[3]
    assert 0.1 < len(by[1]) / 200 < 0.4
    assert raised([{"a": 0.5}, {"a": 0.2, "b": 0.1}]) == [{"a": 0.5}, {"a": 0.5, "b": 0.1}]
    assert threshold(2.0) == 1 << 60 and threshold(-1.0) == 0
    assert run(df.where("false")) == set()
