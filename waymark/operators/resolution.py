"""Greedy choices made in parallel, pointer chains, and absorption of nested records."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import Stored
from .components import connected_components

#: Bound on the pairs that one task decides in order, and parallel rounds between looks at the separate parts of the graph.
LOCAL_PAIRS, ROUNDS = 200_000, 6


def _parts(edges: DataFrame, left: str, right: str, local: int, two_sided: bool) -> tuple[DataFrame, DataFrame]:
    """``edges`` of the connected parts with at most ``local`` of them, with the part's ``_root``, and the other edges.

    With ``two_sided`` a value on the left is another node than the same value on the right.
    """
    node = lambda c, tag: F.concat(F.lit(tag if two_sided else ""), F.col(c).cast("string"))
    named = edges.withColumns({"_l": node(left, "l"), "_r": node(right, "r")})
    roots = connected_components(named, "_l", "_r")
    rooted = Stored(named.join(roots, F.col("_l") == F.col("node")).withColumnRenamed("root", "_root").drop("_l", "_r", "node"), "parts").df
    sized = rooted.join(rooted.groupBy("_root").agg(F.count("*").alias("_n")), "_root")
    return sized.where(F.col("_n") <= local).drop("_n"), sized.where(F.col("_n") > local).drop("_n", "_root")


def greedy_assignment(pairs: DataFrame, left: str, right: str, cost: str, local: int = LOCAL_PAIRS) -> DataFrame:
    """One-to-one pairs as taken cheapest first: ``(left, right, cost)``.

    Pairs are in one total order of cost, left, right. A pair that comes first among the open pairs of both its ends is taken
    by the sequential rule whatever else happens, so all such pairs are taken at once and their ends closed, until no pair is
    open. Work per round is two minima with map-side parts; a left or right with very many pairs is no single task.

    Null ends or costs are ignored, repeated pairs count once at their least cost, an empty input gives an empty result. Up to
    ``local`` open pairs are finished by one task that runs through them in order, and after every few rounds so are the
    separate parts of the graph that are no larger, each by a task of its own, since a long chain of falling costs would
    need as many rounds as it has links. The result is the same; only one connected part of more than ``local`` pairs can
    need many rounds, and it gets them.
    """
    slim = pairs.select(F.col(left).alias("l"), F.col(right).alias("r"), F.col(cost).alias("c")).where("l is not null and r is not null and c is not null")
    now = Stored(slim.groupBy("l", "r").agg(F.min("c").alias("c")), "pairs")
    taken = now.df.where(F.lit(False))
    rank = F.struct("c", "l", "r")
    done = 0
    while True:
        if now.df.count() <= local:
            taken = taken.union(_in_order(now.df.withColumn("_root", F.lit(0))))
            return taken.select(F.col("l").alias(left), F.col("r").alias(right), F.col("c").alias(cost))
        done += 1
        if done % ROUNDS == 0:
            small, rest = _parts(now.df, "l", "r", local, True)
            taken = taken.union(Stored(_in_order(small), "taken").df)
        else:
            by_left = now.df.groupBy("l").agg(F.min(rank).alias("b")).select("b.*")
            by_right = now.df.groupBy("r").agg(F.min(rank).alias("b")).select("b.*")
            best = Stored(by_left.join(by_right, ["l", "r", "c"]).select("l", "r", "c"), "taken").df
            taken = taken.union(best)
            rest = now.df.join(best.select("l"), "l", "left_anti").join(best.select("r"), "r", "left_anti")
        after = Stored(rest.select("l", "r", "c"), "pairs")
        now.drop()
        now = after


def _in_order(pairs: DataFrame) -> DataFrame:
    """The sequential rule within every ``_root``, whose pairs are of a bounded number; a root is one task's."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, left, right = None, set(), set()
        for batch in batches:
            keep = []
            for root, a, b in zip(batch["_root"], batch["l"], batch["r"]):
                if root != at:
                    at, left, right = root, set(), set()
                free = a not in left and b not in right
                keep.append(free)
                if free:
                    left.add(a)
                    right.add(b)
            yield batch[pd.Series(keep, index=batch.index, dtype=bool)][["l", "r"]]

    order = pairs.repartition("_root").sortWithinPartitions("_root", "c", "l", "r").select("_root", "l", "r")
    return order.mapInPandas(run, order.drop("_root").schema).join(pairs, ["l", "r"]).select("l", "r", "c")


def star_clusters(nodes: DataFrame, edges: DataFrame, local: int = LOCAL_PAIRS) -> DataFrame:
    """``(id, center)``: greedy star clustering in order of ``priority`` (smaller first, then id).

    Sequentially, the first free node becomes a centre and takes its free neighbours. In parallel: a free node is a centre as
    soon as no neighbour before it is free or a centre; a free node next to centres belongs to the first of them once all
    neighbours before that one are settled as members. The answer is that of the sequential rule, with no group gathered.

    ``nodes``: unique (id, priority); ``edges``: (a, b), any direction, repeats allowed; ends that are not nodes are ignored.
    Isolated nodes are their own centres. As with ``greedy_assignment``, up to ``local`` open edges are decided in order by one
    task, and so are separate parts of that size after every few rounds, since a path of falling priority settles a node a
    round; one connected part of more edges gets as many rounds as it needs.
    """
    n = nodes.select("id", "priority")
    e = edges.select("a", "b").where("a <> b")
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    # Only neighbours that come before a node decide about it.
    ranked = both.join(n.select(F.col("id").alias("a"), F.col("priority").alias("pa")), "a").join(n.select(F.col("id").alias("b"), F.col("priority").alias("pb")), "b")
    rank = lambda p, i: F.struct(F.col(p).alias("p"), F.col(i).alias("i"))
    before = Stored(ranked.where(rank("pb", "b") < rank("pa", "a")).select("a", "pa", "b", "pb"), "before").df
    # A node without a neighbour before it is a centre.
    first = n.join(before.select(F.col("a").alias("id")), "id", "left_anti").select("id", F.col("id").alias("center"))
    state = Stored(first.union(before.select("a").distinct().select("a", F.lit(None).cast(n.schema["id"].dataType))), "stars")
    done = 0
    while True:
        free = state.df.where("center is null").select(F.col("id").alias("a"))
        mine = before.join(free, "a", "left_semi").join(state.df.select(F.col("id").alias("b"), F.col("center").alias("bc")), "b")
        # Settled members before a node say nothing more.
        open_ = Stored(mine.where("bc is null or bc = b"), "open").df
        left = open_.count()
        if left == 0 and free.isEmpty():
            return state.df
        done += 1
        if left <= local:
            new = _stars_in_order(open_.withColumn("_root", F.lit(0)), free.withColumn("_root", F.lit(0)))
        elif done % ROUNDS == 0:
            small, _ = _parts(open_, "a", "b", local, False)
            new = _stars_in_order(small, small.select("a", "_root").distinct())
        else:
            is_center = F.col("bc") == F.col("b")
            seen = open_.groupBy("a").agg(F.min(F.when(is_center, rank("pb", "b"))).alias("c"), F.min(F.when(F.col("bc").isNull(), rank("pb", "b"))).alias("o"))
            found = F.when(F.col("c").isNull() & F.col("o").isNull(), F.col("a")).when(F.col("c").isNotNull() & (F.col("o").isNull() | (F.col("c") < F.col("o"))), F.col("c.i"))
            new = free.join(seen, "a", "left").select("a", found.alias("new"))
        after = Stored(state.df.join(new.select(F.col("a").alias("id"), "new"), "id", "left").select("id", F.coalesce("center", "new").alias("center")), "stars")
        state.drop()
        state = after


def _stars_in_order(open_: DataFrame, free: DataFrame) -> DataFrame:
    """``(a, new)``: the centres of free nodes by the sequential rule within every ``_root``; ``open_`` has their neighbours before them."""
    kind = open_.schema["a"].dataType.simpleString()
    lists = open_.groupBy("a", "_root").agg(F.first("pa").alias("pa"), F.array_sort(F.collect_list(F.struct("pb", "b", F.col("bc").isNotNull().alias("center")))).alias("near"))
    # A node with nothing open before it comes out as its own centre, whatever its place in the order.
    rows = free.join(lists, ["a", "_root"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, member = None, set()
        for batch in batches:
            new = []
            for root, a, near in zip(batch["_root"], batch["a"], batch["near"]):
                if root != at:
                    at, member = root, set()
                # The free ones before it have been decided by now: those that are no members are centres.
                center = next((x["b"] for x in near if x["center"] or x["b"] not in member), a) if near is not None else a
                if center != a:
                    member.add(a)
                new.append(center)
            yield pd.DataFrame({"a": batch["a"], "new": new})

    order = rows.repartition("_root").sortWithinPartitions("_root", "pa", "a").select("_root", "a", "near")
    return order.mapInPandas(run, f"a {kind}, new {kind}")


def chain_roots(pointers: DataFrame, key: str, target: str) -> DataFrame:
    """``(key, root, fate)``: the end of every row's chain of pointers; fate ``root``, ``dangling`` or ``cycle``.

    A row without a pointer is its own root. A chain that leaves the table is dangling and one that never ends is a cycle;
    both have a null root. Pointers are doubled, so a chain of n links takes log2(n) joins; a key must occur once.
    """
    rows = pointers.select(F.col(key).alias("k"), F.col(target).alias("t")).where("k is not null")
    known = rows.select(F.col("k").alias("kk"))
    start = rows.join(known, F.col("t") == F.col("kk"), "left")
    fate = F.when(F.col("t").isNull(), "root").when(F.col("kk").isNull(), "dangling")
    state = Stored(start.select("k", F.when(F.col("t").isNull(), F.col("k")).otherwise(F.col("t")).alias("t"), fate.alias("fate")), "chain")
    left, rounds = state.df.count(), 0
    while left and rounds <= 64:
        left = left // 2
        rounds += 1
        ahead = state.df.select(F.col("k").alias("k2"), F.col("t").alias("t2"), F.col("fate").alias("fate2"))
        moved = state.df.where("fate is null").join(ahead, F.col("t") == F.col("k2")).select("k", F.col("t2").alias("t"), F.col("fate2").alias("fate"))
        after = Stored(state.df.where("fate is not null").union(moved), "chain")
        state.drop()
        state = after
        if state.df.where("fate is null").isEmpty():
            break
    # What still moves after as many doublings as there are rows runs in a circle.
    out = state.df.withColumn("fate", F.coalesce("fate", F.lit("cycle")))
    return out.select(F.col("k").alias(key), F.when(F.col("fate") == "root", F.col("t")).alias("root"), "fate")


def ancestors(links: DataFrame, child: str, parent: str, hops: int = 3) -> DataFrame:
    """``(child, ancestor, hops)``: distinct ancestors within ``hops`` steps at their least distance."""
    one = links.select(F.col(child).alias("c"), F.col(parent).alias("a")).where("c is not null and a is not null").distinct()
    step = one.select(F.col("c").alias("a"), F.col("a").alias("up"))
    out = level = one.withColumn("n", F.lit(1))
    for n in range(2, hops + 1):
        level = level.join(step, "a").select("c", F.col("up").alias("a"), F.lit(n).alias("n")).distinct()
        out = out.union(level)
    return out.groupBy("c", "a").agg(F.min("n").alias("hops")).select(F.col("c").alias(child), F.col("a").alias("ancestor"), "hops")


def survivors(rows: DataFrame, group: str, key: str, order: Sequence[str | Column]) -> DataFrame:
    """Members of shared groups with the group's survivor: ``(group, key, survivor)``; groups of one are left out."""
    best = rows.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("_n"), F.max(F.struct(*order, F.col(key).alias("_key")))["_key"].alias("survivor")).where("_n > 1")
    return rows.select(group, key).join(best.drop("_n"), group)


def absorb_in_order(places: DataFrame, rules: Sequence, key: str = "qid") -> DataFrame:
    """``(key, parent, reason)`` from ordered absorption rules.

    A rule is a function of (all places, remaining places) giving ``(key, parent, reason)`` rows, one a key. A place absorbed by
    an earlier rule is out of the later ones' ``remaining``. Each rule's result is written, so that the next reads a table.
    """
    gone = None
    for rule in rules:
        rest = places if gone is None else places.join(gone.select(key), key, "left_anti")
        found = Stored(rule(places, rest).select(key, "parent", "reason"), "absorbed").df
        gone = found if gone is None else gone.union(found)
    return gone


def final_parents(places: DataFrame, gone: DataFrame, key: str = "qid") -> DataFrame:
    """``(key, parent, reason)`` with the end of each chain of absorptions; chains in a circle are dropped."""
    pointers = places.select(key).join(gone.select(key, "parent"), key, "left")
    ends = chain_roots(pointers, key, "parent").where(F.col("root").isNotNull() & (F.col("root") != F.col(key)))
    return ends.select(key, F.col("root").alias("parent")).join(gone.select(key, "reason"), key)


def first_by(rows: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row a key, the first by ``order``; tasks keep one row a key before the shuffle."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")
