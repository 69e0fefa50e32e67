"""Permanent identifiers: resolution of merged ids, minting and reuse, retirement, merges and splits."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import Stored
from .resolution import chain_roots

# The id alphabet, and the order in which key schemes name a place.
ALPHABET = "0123456789abcdefghjkmnpqrstvwxyz"
SCHEMES = ["qid", "wdpa", "geonames", "osm"]
SCHEMA = "place_id string, keys array<string>, status string, minted_build string, last_seen_build string, tombstone_reason string"


class MintingError(Exception):
    """A rule of the registry would be broken."""


def place_keys(keys: Column, qid: Column, wdpa: Column) -> Column:
    """Identity keys of a place: listed keys, QID and protected area. A World Heritage number is no identity: properties span places."""
    own = F.array(F.concat(F.lit("qid:"), qid), F.concat(F.lit("wdpa:"), wdpa))
    return F.array_compact(F.array_union(F.coalesce(keys, F.array().cast("array<string>")), own))


def key_order(keys: Column) -> Column:
    """Keys by scheme priority, then name."""
    rank = lambda k: F.nullif(F.array_position(F.array(*map(F.lit, SCHEMES)), F.substring_index(k, ":", 1)), F.lit(0).cast("bigint"))
    return F.transform(F.array_sort(F.transform(F.array_distinct(keys), lambda k: F.struct(F.coalesce(rank(k), F.lit(99)).alias("r"), k.alias("k")))), lambda x: x["k"])


def resolved(registry: DataFrame) -> DataFrame:
    """``(place_id, current)``: where each id leads through merges; null for a broken or circular chain."""
    target = F.when(F.trim("status").startswith("merged_into:"), F.trim(F.substring_index("status", ":", -1)))
    return chain_roots(registry.select("place_id", target.alias("target")), "place_id", "target").select("place_id", F.col("root").alias("current"))


def key_conflicts(registry: DataFrame) -> DataFrame:
    """``(key, ids)`` of keys that several ids hold."""
    return registry.select("place_id", F.explode("keys").alias("key")).groupBy("key").agg(F.array_sort(F.collect_set("place_id")).alias("ids")).where(F.size("ids") > 1)


def lookup(registry: DataFrame, candidates: DataFrame) -> DataFrame:
    """``(candidate, current, problem)``: the id that a candidate's keys lead to; null for a new one; a problem where they lead to several or nowhere."""
    owners = registry.select("place_id", F.explode("keys").alias("key")).join(resolved(registry), "place_id")
    found = candidates.select("candidate", F.explode("keys").alias("key")).join(owners, "key").groupBy("candidate")
    found = found.agg(F.array_sort(F.collect_set("current")).alias("ids"), F.bool_or(F.col("current").isNull()).alias("broken"))
    problem = F.when(F.col("broken"), "a key resolves through a broken merge chain").when(F.size("ids") > 1, F.concat(F.lit("keys identify different places: "), F.array_join("ids", ", ")))
    listed = candidates.select("candidate", F.when(F.size("keys") == 0, "a place needs at least one identity key").alias("empty")).join(found, "candidate", "left")
    return listed.select("candidate", F.get(F.col("ids"), F.lit(0)).alias("current"), F.coalesce("empty", problem).alias("problem"))


def id_from(key: Column, turn: int = 0) -> Column:
    """``pl_`` and ten letters that depend on the key alone, five bits each from its SHA-256."""
    digest = F.conv(F.substring(F.sha2(F.concat(key, F.lit(f"#{turn}")), 256), 1, 13), 16, 10).cast("bigint")
    letters = [F.substring(F.lit(ALPHABET), (F.shiftright(digest, 5 * i).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)) for i in range(10)]
    return F.concat(F.lit("pl_"), *letters)


def mint_or_reuse(registry: DataFrame, candidates: DataFrame, build: str) -> tuple[DataFrame, DataFrame]:
    """``(registry after the build, (candidate, place_id))``.

    A candidate whose keys are known keeps its id, adds its new keys and is active again if it was retired; the others get an
    id derived from their first key, derived again on a collision. Raises ``MintingError`` when keys lead to several places,
    through a broken chain, or when two candidates share a key or an id. ``candidates``: unique candidate, keys.
    """
    cands = candidates.select("candidate", key_order("keys").alias("keys"))
    shared = cands.select("candidate", F.explode("keys").alias("key")).groupBy("key").agg(F.countDistinct("candidate").alias("n")).where("n > 1").limit(3).collect()
    if shared:
        raise MintingError(f"keys on several candidates: {[r['key'] for r in shared]}")
    found = lookup(registry, cands)
    bad = found.where("problem is not null").limit(3).collect()
    if bad:
        raise MintingError("; ".join(f"{r['candidate']}: {r['problem']}" for r in bad))
    joined = Stored(cands.join(found.select("candidate", "current"), "candidate"), "mint").df
    twice = joined.where("current is not null").groupBy("current").agg(F.count("*").alias("n")).where("n > 1").limit(3).collect()
    if twice:
        raise MintingError(f"several candidates lead to {[r['current'] for r in twice]}")
    taken = registry.select(F.col("place_id").alias("fresh"))
    todo, minted = joined.where("current is null").select("candidate", "keys"), None
    for turn in count():
        tried = todo.withColumn("fresh", id_from(F.get(F.col("keys"), F.lit(0)), turn))
        free = tried.join(taken, "fresh", "left_anti")
        first = free.groupBy("fresh").agg(F.min("candidate").alias("candidate"))
        won = free.join(first, ["fresh", "candidate"]).select("candidate", "keys", F.col("fresh").alias("place_id"))
        minted = won if minted is None else minted.unionByName(won)
        taken = taken.union(won.select(F.col("place_id").alias("fresh")))
        todo = todo.join(won.select("candidate"), "candidate", "left_anti")
        if todo.isEmpty():
            break
        todo = Stored(todo, "mint").df
    kept = joined.where("current is not null").select("candidate", F.col("current").alias("place_id"), F.col("keys").alias("_new"))
    old = registry.join(kept.select("place_id", "_new"), "place_id", "left")
    seen = F.col("_new").isNotNull()
    back = seen & (F.col("status") == "retired")
    old = old.select(
        "place_id", F.array_sort(F.array_union("keys", F.coalesce("_new", F.array().cast("array<string>")))).alias("keys"), F.when(back, "active").otherwise(F.col("status")).alias("status"),
        "minted_build", F.when(seen, build).otherwise(F.col("last_seen_build")).alias("last_seen_build"), F.when(back, F.lit(None)).otherwise(F.col("tombstone_reason")).alias("tombstone_reason"),
    )
    new = minted.select("place_id", F.array_sort("keys").alias("keys"), F.lit("active").alias("status"), F.lit(build).alias("minted_build"), F.lit(build).alias("last_seen_build"), F.lit(None).cast("string").alias("tombstone_reason"))
    return old.unionByName(new), kept.select("candidate", "place_id").unionByName(minted.select("candidate", "place_id"))


def retire(registry: DataFrame, ids: Sequence[str], build: str, reason: str) -> DataFrame:
    """Active ids become retired; any other id is an error."""
    wrong = registry.where(F.col("place_id").isin(list(ids)) & (F.col("status") == "active")).count()
    if wrong != len(set(ids)):
        raise MintingError("only active places can be retired")
    mine = F.col("place_id").isin(list(ids))
    return registry.withColumns({"status": F.when(mine, "retired").otherwise(F.col("status")), "last_seen_build": F.when(mine, build).otherwise(F.col("last_seen_build")), "tombstone_reason": F.when(mine, reason).otherwise(F.col("tombstone_reason"))})


def merge(registry: DataFrame, loser: str, survivor: str, build: str) -> DataFrame:
    """``loser`` points to ``survivor``; a merge into itself, with an unknown id or into a circle is an error."""
    if loser == survivor:
        raise MintingError("cannot merge a place into itself")
    if registry.where(F.col("place_id").isin(loser, survivor)).count() != 2:
        raise MintingError("unknown place")
    if resolved(registry).where((F.col("place_id") == survivor) & (F.col("current") == loser)).count():
        raise MintingError("merge would create a cycle")
    mine = F.col("place_id") == loser
    return registry.withColumns({"status": F.when(mine, f"merged_into:{survivor}").otherwise(F.col("status")), "last_seen_build": F.when(mine, build).otherwise(F.col("last_seen_build"))})


def split(registry: DataFrame, place_id: str, keys: Sequence[str], build: str) -> DataFrame:
    """A new id for ``keys`` that no place holds, marked as split from ``place_id``."""
    if not keys:
        raise MintingError("the new part needs its own keys")
    spark = registry.sparkSession
    if registry.where(F.arrays_overlap("keys", F.array(*map(F.lit, keys)))).count():
        raise MintingError("a split needs keys no place already holds")
    after, ids = mint_or_reuse(registry, spark.createDataFrame([("new", list(keys))], "candidate string, keys array<string>"), build)
    fresh = ids.first()["place_id"]
    return after.withColumn("status", F.when(F.col("place_id") == fresh, f"split_from:{place_id}").otherwise(F.col("status")))
