import random

import pytest
from pyspark.sql import functions as F

from waymark.operators.components import connected_components
from waymark.operators.ranks import Down, ranked_in_groups
from waymark.operators.resolution import ancestors, chain_roots, greedy_assignment, star_clusters, survivors


def test_components(spark):
    r = random.Random(1)
    edges = [(f"n{r.randrange(150):03d}", f"n{r.randrange(150):03d}") for _ in range(90)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(70)] + [("hub", f"h{i:03d}") for i in range(80)]
    edges += edges[:10] + [(None, "n001"), ("n002", None), ("x", "x")]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a and b and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {(q.node, q.root) for q in connected_components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()}
    assert {x for x in got if x[0] != x[1]} == {(n, find(n)) for n in parent if n != find(n)}
    assert connected_components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_greedy_assignment(spark):
    r = random.Random(2)
    pairs = [(f"l{r.randrange(12)}", f"r{r.randrange(12)}", r.randrange(6)) for _ in range(60)] + [(None, "r1", 1), ("l1", None, 1), ("l2", "r2", None)]
    best = {}
    for a, b, c in pairs:
        if a and b and c is not None:
            best[a, b] = min(c, best.get((a, b), 99))
    want, ls, rs = set(), set(), set()
    for c, a, b in sorted((c, a, b) for (a, b), c in best.items()):
        if a not in ls and b not in rs:
            want.add((a, b, c))
            ls.add(a)
            rs.add(b)
    df = spark.createDataFrame(pairs, "l string, r string, c int")
    assert {tuple(x) for x in greedy_assignment(df, "l", "r", "c").collect()} == want
    assert {tuple(x) for x in greedy_assignment(df, "l", "r", "c", local=0).collect()} == want
    # A chain of falling costs, whose pairs become first one after the other, beside the rest: more rounds than any fixed number.
    chain = [(f"c{(i + 1) // 2:02d}", f"d{i // 2:02d}", 100 - i) for i in range(24)]
    long = spark.createDataFrame(pairs + chain, "l string, r string, c int")
    assert {tuple(x) for x in greedy_assignment(long, "l", "r", "c", local=30).collect()} == want | set(chain[1::2])
    assert greedy_assignment(df.where("false"), "l", "r", "c").count() == 0


def test_star_clusters(spark):
    r = random.Random(4)
    nodes = [(f"n{i:02d}", r.randrange(5)) for i in range(40)]
    edges = [(f"n{r.randrange(40):02d}", f"n{r.randrange(42):02d}") for _ in range(70)]
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    center = {}
    for i, _ in sorted(nodes, key=lambda n: (n[1], n[0])):
        if i not in center:
            center[i] = i
            for j in near.get(i, ()):
                if j in dict(nodes) and j not in center:
                    center[j] = i
    got = {x.id: x.center for x in star_clusters(spark.createDataFrame(nodes, "id string, priority int"), spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == center
    # A path of falling priority settles one node a round; small parts are decided by tasks, the path by as many rounds as it needs.
    path = [(f"p{i:02d}", 100 - i) for i in range(9)] + nodes
    steps = [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(8)] + edges
    want = center | {f"p{i:02d}": f"p{i if i % 2 == 0 else i + 1:02d}" for i in range(9)}
    for local in (4, 100, 10_000):
        got = {x.id: x.center for x in star_clusters(spark.createDataFrame(path, "id string, priority int"), spark.createDataFrame(steps, "a string, b string"), local).collect()}
        assert got == want
    far = [(i, 1000 - i) for i in range(700)]
    got = {x.id: x.center for x in star_clusters(spark.createDataFrame(far, "id int, priority int"), spark.createDataFrame([(i, i + 1) for i in range(699)], "a int, b int")).collect()}
    assert all(got[i] == (i if (699 - i) % 2 == 0 else i + 1) for i in range(700))


@pytest.mark.parametrize("n", [0, 1, 30])
def test_chain_roots(spark, n):
    r = random.Random(n)
    rows = [(f"k{i}", r.choice([None, "lost", *[f"k{j}" for j in range(n)]])) for i in range(n)]
    rows += [(f"z{i}", f"z{i + 1}" if i < 20 else None) for i in range(21)] if n == 30 else []
    to = dict(rows)

    def end(k):
        seen = set()
        while True:
            if k not in to:
                return None, "dangling"
            if k in seen:
                return None, "cycle"
            seen.add(k)
            if to[k] is None:
                return k, "root"
            k = to[k]

    got = {x.k: (x.root, x.fate) for x in chain_roots(spark.createDataFrame(rows, "k string, t string"), "k", "t").collect()}
    assert got == {k: end(k) for k in to}


def test_ancestors_and_survivors(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("a", "c"), ("x", None)], "c string, p string")
    assert {tuple(r) for r in ancestors(links, "c", "p", 3).where("c = 'a'").collect()} == {("a", "b", 1), ("a", "c", 1), ("a", "d", 2), ("a", "e", 3)}
    rows = spark.createDataFrame([("g", "a", 5), ("g", "b", 5), ("g", "c", 1), ("h", "d", 1), (None, "e", 9)], "g string, k string, n int")
    assert {(r.k, r.survivor) for r in survivors(rows, "g", "k", ["n", "k"]).collect()} == {("a", "b"), ("b", "b"), ("c", "b")}


def test_ranks_of_a_hot_group(spark):
    r = random.Random(8)
    rows = [("hot" if i % 3 else r.choice(["a", "b", None]), r.choice([None, 1.0, 2.0, 3.0]), i) for i in range(400)]
    got = {x.i: (x.rank, x.size) for x in ranked_in_groups(spark.createDataFrame(rows, "g string, v double, i int").repartition(7), ["g"], [Down("v"), F.col("i")]).collect()}
    for g in {x[0] for x in rows}:
        own = sorted((x for x in rows if x[0] == g), key=lambda x: (x[1] is None, -(x[1] or 0), x[2]))
        assert [got[x[2]] for x in own] == [(k, len(own)) for k in range(len(own))]
