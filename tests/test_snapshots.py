import random

from waymark.operators.latest import current_places, latest_rows
from waymark.operators.snapshots import snapshot_changes

SCHEMA = "s int, k string, v int, tier string, diff string, extra int"


def changes(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    return {tuple(r) for r in snapshot_changes(df, "s", "k", "v", ["tier"]).select("s", "k", "diff").collect()}


def brute(rows):
    state = {}
    for s, k, v, t in rows:
        if k is None or s is None:
            continue
        rank = (v is not None, v or 0, t is not None, t or "")
        if (s, k) not in state or state[s, k][0] < rank:
            state[s, k] = (rank, t)
    order = sorted({s for s, k, *_ in rows if s is not None})
    out = set()
    for a, b in zip(order, order[1:]):
        for k in {k for _, k in state}:
            x, y = state.get((a, k)), state.get((b, k))
            if x is None and y is not None:
                out.add((b, k, "added"))
            elif x is not None and y is None:
                out.add((b, k, "removed"))
            elif x and y and x[1] != y[1]:
                out.add((b, k, "changed"))
    return out


def test_against_brute_force(spark):
    r = random.Random(3)
    rows = [(r.choice([1, 2, 4, 7, None]), r.choice([None, *[f"k{i}" for i in range(25)]]), r.choice([None, 1, 2, 3]), r.choice([None, "A", "B"])) for _ in range(300)]
    rows += rows[:40]
    assert changes(spark, rows) == brute(rows)


def test_hot_key_and_edges(spark):
    rows = [(1, "hot", i, "A") for i in range(200)] + [(2, "hot", i, "A" if i < 199 else None) for i in range(200)] + [(1, "gone", 1, "A"), (3, "gone", 1, "A"), (3, "hot", 1, None), (2, "x", 1, "A")]
    assert changes(spark, rows) == brute(rows)
    assert changes(spark, []) == set()
    assert changes(spark, [(1, "a", 1, "A")]) == set()


def test_latest_ties_and_retired(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 2, "y"), ("a", None, "z"), (None, 1, "n"), (None, 2, "m")], "k string, v int, c string")
    assert {tuple(r) for r in latest_rows(df, ["k"], "v", ["c"]).collect()} == {("a", "y"), (None, "m")}
    p = spark.createDataFrame([("A ", 1, "active"), ("a", 2, "Retired"), ("b", 1, None), ("", 1, None), (None, 1, None)], "place_id string, loaded_at int, status string")
    assert [r.place_id for r in current_places(p).collect()] == ["b"]
