"""One surviving record for each group of duplicates, from whole bundles of fields.

A bundle is a set of fields that must come from one row. Bundles are chosen by branch and bound: the total distance from
every bundle's most trusted candidate is made least, subject to functional dependencies between bundles. The bound of the
root node is the top candidate of every bundle; where these agree, and that is tested on columns, the search ends there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import connected_components
from ..runtime import Stored

FIRST_CANDIDATES = 16


@dataclass(frozen=True)
class Bundle:
    """``trust``: columns by which candidates are ordered, greatest first and null last; ``when``: rows that have one."""

    name: str
    fields: Sequence[str]
    trust: Sequence[Column]
    when: Column | None = None
    weight: float = 1.0


@dataclass(frozen=True)
class Dependency:
    """The chosen row of ``bundle`` expects ``expects`` (a column of its row); ``target``'s chosen row must have that value
    in ``value``. Null on either side agrees with everything."""

    bundle: str
    expects: str
    target: str
    value: str


@dataclass
class _Plan:
    bundles: Sequence[Bundle]
    dependencies: Sequence[Dependency] = field(default_factory=tuple)

    def constrained(self, b: Bundle) -> list[str]:
        """Fields of a bundle's row that dependencies look at."""
        names = [d.expects for d in self.dependencies if d.bundle == b.name] + [d.value for d in self.dependencies if d.target == b.name]
        return list(dict.fromkeys(names))

    def record(self, b: Bundle) -> Column:
        trust = [t.alias(f"t{i}") for i, t in enumerate(b.trust)]
        return F.struct(*trust, *[F.col(f).alias(f"f{i}") for i, f in enumerate(b.fields)], *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(self.constrained(b))])

    def agrees(self, chosen) -> Column:
        out = F.lit(True)
        for d in self.dependencies:
            a, b = (next(x for x in self.bundles if x.name == n) for n in (d.bundle, d.target))
            left = chosen(a)[f"c{self.constrained(a).index(d.expects)}"]
            right = chosen(b)[f"c{self.constrained(b).index(d.value)}"]
            out = out & F.coalesce(left == right, F.lit(True))
        return out


def branch_and_bound(sizes: Sequence[int], weights: Sequence[float], allowed) -> tuple[list[int], float]:
    """Positions, one per list (its size stands for "none"), of least weighted sum with ``allowed(choice, k)`` for every prefix.

    Ties are decided by the earlier lists' better positions. ``allowed`` sees the choice made for lists 0..k.
    """
    best: list[int] = list(sizes)
    value = sum(w * n for w, n in zip(weights, sizes))
    choice = [0] * len(sizes)

    def descend(k: int, cost: float) -> None:
        nonlocal best, value
        if k == len(sizes):
            if cost < value:
                best, value = choice.copy(), cost
            return
        for p in range(sizes[k] + 1):
            c = cost + weights[k] * p
            if c >= value:  # the rest costs nothing at best, and later positions only more
                return
            choice[k] = p
            if p == sizes[k] or allowed(choice, k):
                descend(k + 1, c)

    descend(0, 0.0)
    return best, value


def best_representative(rows: DataFrame, group: str, key: str, bundles: Sequence[Bundle], dependencies: Sequence[Dependency] = (), least: int = 2) -> DataFrame:
    """One row per group of at least ``least`` rows: ``group``, ``first_<key>``, ``n_rows``, and the fields of all bundles.

    * Candidates that tie on every trust column are ordered by their fields, greatest first, so the answer depends on the
      rows alone; end the trust columns with a unique one to rule such ties.
    * A bundle for which no row qualifies, or whose every candidate contradicts a better choice, gives nulls.
    * Rows with a null group are left out; fully repeated rows count as rows; an empty input gives an empty result.

    One aggregation with map-side maxima finds every bundle's top candidate. Groups whose top candidates contradict each
    other go on to the search with the best candidate of each distinct constrained value, first ``FIRST_CANDIDATES`` a
    bundle. A result is taken when no candidate beyond those could lower its cost; the other groups are searched again with
    eight times as many, so no group's search is cut short.
    """
    plan = _Plan(bundles, dependencies)
    rows = rows.where(F.col(group).isNotNull())
    top = _tops(rows, group, key, plan, least)
    at = {b.name: i for i, b in enumerate(bundles)}
    head = [group, f"first_{key}", "n_rows"]

    def finish(df: DataFrame) -> DataFrame:
        return df.select(*head, *[F.col(f"_b{i}")[f"f{j}"].alias(f) for i, b in enumerate(bundles) for j, f in enumerate(b.fields)])

    if not dependencies:
        return finish(top)
    top = Stored(top, "tops").df
    agrees = plan.agrees(lambda b: F.col(f"_b{at[b.name]}"))
    out = finish(top.where(agrees))
    open_groups, most = top.where(~agrees).select(*head), FIRST_CANDIDATES
    while not open_groups.isEmpty():
        searched = Stored(_search(rows, open_groups, group, head, plan, most), "search")
        out = out.unionByName(finish(searched.df.where("_proved")))
        open_groups, most = searched.df.where("not _proved").select(*head), most * 8
    return out


def _tops(rows: DataFrame, group: str, key: str, plan: _Plan, least: int) -> DataFrame:
    """Groups of at least ``least`` rows with the most trusted candidate of every bundle: the bound at the root of the search."""
    tops = [F.max(F.when(b.when if b.when is not None else F.lit(True), plan.record(b))).alias(f"_b{i}") for i, b in enumerate(plan.bundles)]
    return rows.groupBy(group).agg(F.min(key).alias(f"first_{key}"), F.count("*").alias("n_rows"), *tops).where(F.col("n_rows") >= least)


def search_extent(rows: DataFrame, group: str, key: str, bundles: Sequence[Bundle], dependencies: Sequence[Dependency], least: int = 2) -> DataFrame:
    """``(groups, searched)``: how many groups there are, and how many contradict themselves at the root and go on to the search."""
    plan = _Plan(bundles, dependencies)
    top = _tops(rows.where(F.col(group).isNotNull()), group, key, plan, least)
    at = {b.name: i for i, b in enumerate(bundles)}
    return top.agg(F.count("*").alias("groups"), F.count_if(~plan.agrees(lambda b: F.col(f"_b{at[b.name]}"))).alias("searched"))


def _search(rows: DataFrame, groups: DataFrame, group: str, head: list[str], plan: _Plan, most: int) -> DataFrame:
    mine = rows.join(groups.select(group), group, "left_semi")
    joined = groups
    for i, b in enumerate(plan.bundles):
        seen = [F.col(c).cast("string").alias(f"_k{j}") for j, c in enumerate(plan.constrained(b))]
        cand = mine.where(b.when) if b.when is not None else mine
        cand = cand.groupBy(group, *seen).agg(F.max(plan.record(b)).alias("_r"))
        order = Window.partitionBy(group).orderBy(F.col("_r").desc())
        cand = cand.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most + 1)
        lists = cand.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("_n", "_r"))).alias(f"_l{i}"))
        joined = joined.join(lists, group, "left")
    width = [len(plan.constrained(b)) for b in plan.bundles]
    values = [_seen_values(f"_l{i}", n) for i, n in enumerate(width)]
    joined = joined.withColumn("_values", F.array(*values))
    index = {b.name: i for i, b in enumerate(plan.bundles)}
    tests = [(index[d.bundle], plan.constrained(plan.bundles[index[d.bundle]]).index(d.expects), index[d.target], plan.constrained(plan.bundles[index[d.target]]).index(d.value)) for d in plan.dependencies]
    weights = [b.weight for b in plan.bundles]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            chosen, proved = [], []
            for lists in batch["_values"]:
                lists = [[] if x is None else list(x) for x in lists]
                sizes = [min(len(x), most) for x in lists]

                def allowed(choice: list[int], k: int, lists=lists, sizes=sizes) -> bool:
                    for a, i, b, j in tests:
                        if max(a, b) == k and choice[a] < sizes[a] and choice[b] < sizes[b]:
                            left, right = lists[a][choice[a]][i], lists[b][choice[b]][j]
                            if left is not None and right is not None and left != right:
                                return False
                    return True

                best, value = branch_and_bound(sizes, weights, allowed)
                chosen.append(best)
                # An unseen candidate stands at position ``most`` or later, and "none" behind all of them.
                beyond = [w * most for w, x in zip(weights, lists) if len(x) > most]
                proved.append(not beyond or value < min(beyond))
            yield batch.drop(columns=["_values"]).assign(_chosen=chosen, _proved=proved)

    slim = joined.select(group, "_values")
    schema = T.StructType([slim.schema[group], T.StructField("_chosen", T.ArrayType(T.IntegerType())), T.StructField("_proved", T.BooleanType())])
    answer = slim.mapInPandas(solve, schema)
    picked = [F.get(F.col(f"_l{i}"), F.col("_chosen")[i])["_r"].alias(f"_b{i}") for i in range(len(plan.bundles))]
    return joined.drop("_values").join(answer, group).select(*head, "_proved", *picked)


def _seen_values(lists: str, n: int) -> Column:
    """The constrained values of a list of candidates, as an array of arrays."""
    return F.transform(lists, lambda x: F.array(*[x["_r"][f"c{j}"] for j in range(n)]) if n else F.array(F.lit(None).cast("string")))


def tied_groups(rows: DataFrame, key: str, names: Column, group: str = "group_id") -> DataFrame:
    """``rows`` with ``group``: the least name of the component of rows tied by shared names, directly or through others.

    ``names`` is an array of normal names of the row; rows without a name get a null group.
    """
    named = rows.withColumn("_names", F.array_sort(F.array_distinct(F.array_compact(names))))
    first = F.get(F.col("_names"), F.lit(0))
    edges = named.where(F.size("_names") > 1).select(first.alias("_a"), F.explode(F.slice("_names", 2, 1 << 30)).alias("_b"))
    roots = connected_components(edges, "_a", "_b")
    joined = named.withColumn("_first", first).join(roots, F.col("_first") == F.col("node"), "left")
    return joined.withColumn(group, F.coalesce("root", "_first")).drop("_names", "_first", "node", "root")
