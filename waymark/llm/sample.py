"""Samples that stay the same across reruns, partitionings and growth."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.latest import latest_rows

SPACE = 1 << 60


def hash_position(key: Column, salt: str) -> Column:
    """A number below 2**60 that depends on salt and key alone: the first 15 hexadecimal digits of their MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt + "|"), key.cast("string"))), 1, 15), 16, 10).cast("bigint")


def raised(rates: Sequence[Mapping[str, float]]) -> list[dict[str, float]]:
    """Rates by version in which no stratum ever falls: the running maximum, strata kept once they have a rate."""
    out: list[dict[str, float]] = []
    for version in rates:
        last = out[-1] if out else {}
        out.append({s: max(last.get(s, 0.0), version.get(s, 0.0)) for s in {*last, *version}})
    return out


def threshold(rate: float) -> int:
    return int(min(1.0, max(0.0, rate)) * SPACE)


def sample_versions(rows: DataFrame, key: str, stratum: str, version: str, written: str, keep: Sequence[str], schedule: Mapping[int, Mapping[str, float]], salt: str, default: float = 0.0) -> DataFrame:
    """The sample as of every version: ``(version, key, stratum, *keep)``.

    ``schedule`` gives sampling rates by stratum from a version on. A key is in the sample of a version when it was first
    seen by then and its salted hash lies below the highest rate that its stratum has had so far. Other rows, their order,
    number and partitions have no influence; the rates only rise; and a key's stratum is that of its first version, so a
    key once selected stays, also when it moves to another stratum or leaves the table. ``keep`` columns hold the first
    known value by version.

    * Several rows of a key in one version: the latest ``written`` counts, ties by greatest values, nulls last.
    * Null keys and null versions are ignored; a null stratum or one without a rate gets ``default``.
    * An empty input gives an empty result; other columns are not read.

    All reductions have map-side parts; only the list of versions, one number a delivery, passes through the driver.
    """
    rows = rows.where(F.col(key).isNotNull() & F.col(version).isNotNull())
    firsts = [F.min(F.when(F.col(c).isNotNull(), F.struct(version, c)))[c].alias(c) for c in keep]
    state = latest_rows(rows, [key, version], written, [stratum, *keep])
    known = state.groupBy(key).agg(F.min(F.struct(version, stratum)).alias("_first"), *firsts)
    starts = sorted(schedule)
    limits = [(v, rates) for v, rates in zip(starts, raised([schedule[v] for v in starts]))]
    known = known.withColumn(stratum, F.col("_first")[stratum]).withColumn("_since", F.col("_first")[version])
    known = known.withColumn("_position", hash_position(F.col(key), salt))
    # Keys below their final threshold are the only ones that can appear in any version.
    known = known.where(F.col("_position") < _limit(F.col(stratum), limits[-1][1], default))
    versions = F.array(*[F.lit(r[0]) for r in rows.select(version).distinct().orderBy(version).collect()] or [F.lit(None).cast(rows.schema[version].dataType)])
    limit = F.lit(threshold(default))
    for v, rates in limits:
        limit = F.when(F.col("_v") >= v, _limit(F.col(stratum), rates, default)).otherwise(limit)
    later = F.filter(versions, lambda v: v >= F.col("_since"))
    out = known.withColumn("_v", F.explode(later)).where(F.col("_position") < limit)
    return out.select(F.col("_v").alias(version), key, stratum, *keep)


def _limit(stratum: Column, rates: Mapping[str, float], default: float) -> Column:
    limit = F.lit(threshold(default))
    for name, rate in sorted(rates.items()):
        limit = F.when(stratum == name, F.lit(threshold(rate))).otherwise(limit)
    return limit
