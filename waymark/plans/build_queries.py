"""q53 to q59: absorption, gates, problem lists, registry, claims and exported features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity
from ..operators import registry as reg
from ..operators.absorption import absorb
from ..operators.gates import Context, golden_problems, place_problems, run_gates
from ..operators.latest import current_places, latest_rows
from ..runtime import Stored, table
from ..sources.writers import geojson_lines
from .admission_queries import admitted, sql_qid, sql_tier
from .place_queries import PLACES, places


def q53_absorption(spark: SparkSession, d: str) -> DataFrame:
    """Admitted candidates absorbed into others; a candidate lies in what its place is near to."""
    near = places(spark, d).select("qid", "near").where("qid is not null and near is not null").join(places(spark, d).select(F.col("place_id").alias("near"), F.col("qid").alias("parent")), "near")
    parents = near.groupBy("qid").agg(F.array_sort(F.collect_set("parent")).alias("parents"))
    c = admitted(spark, d).select("qid", "iso3", "lat", "lon", "sitelinks", "place_type", F.col("kind_hint").alias("hint"), "whs", F.array_contains("classes", "Q6900000011").alias("admin"), F.coalesce("label_en", "label_loc").alias("name"))
    c = c.join(parents, "qid", "left").withColumn("parents", F.coalesce("parents", F.array().cast("array<string>")))
    return absorb(c)


def _build(spark: SparkSession, d: str, number: int) -> DataFrame:
    rows = table(spark, d, "place_build").where(F.col("build_no") == number).select(
        identity.place_id("place_id").alias("place_id"), identity.tier("tier").alias("tier"), "name_en", identity.country("country_iso3").alias("iso3"), F.lower(F.trim("status")).alias("status"), identity.qid("qid").alias("qid"), "loaded_at"
    )
    return latest_rows(rows.where("place_id is not null"), ["place_id"], "loaded_at", ["tier", "name_en", "iso3", "status", "qid"])


def _registered(spark: SparkSession, d: str) -> DataFrame:
    """Ids of all builds with every key they had and the status of their last row."""
    rows = table(spark, d, "place_build").select("build_no", identity.place_id("place_id").alias("place_id"), F.coalesce(F.lower(F.trim("status")), F.lit("active")).alias("status"), F.concat(F.lit("qid:"), identity.qid("qid")).alias("key"), "loaded_at")
    last = F.max(F.struct("build_no", "loaded_at", "status"))["status"]
    return rows.where("place_id is not null").groupBy("place_id").agg(F.array_sort(F.collect_set("key")).alias("keys"), last.alias("status"))


def q54_gates(spark: SparkSession, d: str) -> DataFrame:
    """Gates of the current places that the test data can feed: expectations, identity, names, counts, cover and churn against build 3.

    The registry is what the builds say of their ids, and the counts are those of build 4. Builds carry no coordinates, so that
    churn is of tiers, names and lost ids alone: movement cannot be tested here.
    """
    p = current_places(table(spark, d, "place"), "type", "name_en", "country_iso3", "lat", "lon", "tier", "qid")
    p = p.select("place_id", F.lower(F.trim("type")).alias("type"), "name_en", identity.country("country_iso3").alias("iso3"), "lat", "lon", identity.tier("tier").alias("tier"), identity.qid("qid").alias("qid"), F.lit("active").alias("status"))
    p = Stored(p.withColumn("keys", F.array_compact(F.array(F.concat(F.lit("qid:"), "qid")))), "gates").df
    registry = Stored(_registered(spark, d), "registry").df
    before = _build(spark, d, 3).withColumns({"lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")})
    scope = table(spark, d, "h1").select(identity.country("iso3").alias("iso3"), F.lit(5).alias("floor"), F.lit(False).alias("exempt")).where("iso3 is not null").distinct()
    counts = _build(spark, d, 4).where("coalesce(status, 'active') <> 'retired'").rollup("iso3").agg(F.count("*").alias("n"))
    ctx = Context(p, golden=table(spark, d, "h1").distinct(), registry=registry, previous=before, counts=counts, scope=scope, strict=False)
    return run_gates(spark, ctx, ["G-SCHEMA", "G-GOLDEN", "G-ID", "G-IDENT", "G-NAMES", "G-COUNT", "G-COVER", "G-CHURN"]).select("gate", "passed", "n")


def q55_place_problems(spark: SparkSession, d: str) -> DataFrame:
    p = current_places(table(spark, d, "place"), "type", "name_en", "country_iso3", "lat", "lon", "tier")
    p = p.select("place_id", F.lower(F.trim("type")).alias("type"), "name_en", F.col("country_iso3").alias("iso3"), "lat", "lon", "tier", F.lit("active").alias("status"))
    return place_problems(p)


def q56_golden_problems(spark: SparkSession, d: str) -> DataFrame:
    return golden_problems(table(spark, d, "h1").distinct(), table(spark, d, "whs_properties"))


def q57_minting(spark: SparkSession, d: str) -> DataFrame:
    """Ids of build 4's items when build 1 filled the registry: reused where the QID is known, new ones otherwise."""
    def keys(b: DataFrame) -> DataFrame:
        return b.where("qid is not null").groupBy("qid").agg(F.min("place_id").alias("place_id")).select("place_id", "qid", F.array(F.concat(F.lit("qid:"), "qid")).alias("keys"))

    first = keys(_build(spark, d, 1)).select("place_id", "keys", F.lit("active").alias("status"), F.lit("b1").alias("minted_build"), F.lit("b1").alias("last_seen_build"), F.lit(None).cast("string").alias("tombstone_reason"))
    now = keys(_build(spark, d, 4)).select(F.col("qid").alias("candidate"), "keys")
    _, ids = reg.mint_or_reuse(Stored(first, "registry").df, Stored(now, "candidates").df, "b4")
    return ids.select(F.col("candidate").alias("qid"), "place_id")


def q58_features(spark: SparkSession, d: str) -> DataFrame:
    """Number of exported features and their total length by country."""
    p = places(spark, d).where("iso3 is not null and lat is not null and not isnan(lat)").select("place_id", "name_en", "tier", "iso3", F.round("lat", 3).alias("lat"), F.round("lon", 3).alias("lon"))
    lines = geojson_lines(p, ["place_id", "iso3"])
    return lines.groupBy(F.get_json_object("value", "$.properties.iso3").alias("iso3")).agg(F.count("*").alias("n"), F.min(F.get_json_object("value", "$.properties.place_id")).alias("first_id"))


QUERIES = {f.__name__: f for f in (q53_absorption, q54_gates, q55_place_problems, q56_golden_problems, q57_minting, q58_features)}

def _golden_sql() -> str:
    """The tests of single rows, each with the condition under which it does not hold."""
    given = lambda c: f"(coalesce(trim({c}), '') <> '')"
    num = lambda c: f"try_cast({c} AS DOUBLE)"
    tiers = "('Local', 'Notable', 'Major', 'Icon')"
    rank = lambda c: f"list_position(['Local', 'Notable', 'Major', 'Icon'], {c})"
    holds = {
        "golden_id missing": given("golden_id"), "bad row_kind": "row_kind IN ('positive', 'negative', 'optional')", "expected_name missing": given("expected_name"), "bad iso3": "regexp_matches(iso3, '^[A-Z]{3}$')",
        "bad type": "row_kind = 'negative' OR type IN ('settlement', 'site', 'area', 'route')", "bad qid": f"NOT {given('qid')} OR regexp_matches(qid, '^Q[0-9]+$')",
        "bad coordinates": f"NOT ({given('lat')} OR {given('lon')}) OR (abs({num('lat')}) <= 90 AND abs({num('lon')}) <= 180)", "coordinates missing": f"row_kind <> 'positive' OR ({given('lat')} AND {given('lon')})",
        "bad tolerance": f"row_kind <> 'positive' OR ({num('tol_km')} > 0 AND {num('tol_km')} <= CASE WHEN type IN ('area', 'route') THEN 150 ELSE 50 END)", "bad min_tier": f"row_kind <> 'positive' OR min_tier IN {tiers}",
        "bad max_tier": f"NOT {given('max_tier')} OR max_tier IN {tiers}", "max_tier below min_tier": f"NOT ({given('max_tier')} AND {given('min_tier')}) OR coalesce({rank('max_tier')} >= {rank('min_tier')}, true)",
        "relation missing": "row_kind <> 'negative' OR relation IN ('component_of', 'not_above', 'not_credited', 'part_of')", "relation on a positive row": f"row_kind <> 'positive' OR NOT {given('relation')}",
        "target missing": f"NOT coalesce(row_kind = 'negative' AND relation IN ('not_above', 'not_credited'), false) OR {given('target_id')}",
    }
    rows = " UNION ALL ".join(f"SELECT golden_id, '{name}' problem FROM h WHERE NOT coalesce({test}, false)" for name, test in holds.items())
    return f"""
        WITH h AS (SELECT DISTINCT * FROM h1), t AS (SELECT golden_id, unnest(string_split(target_id, '|')) t FROM h WHERE {given("target_id")})
        {rows}
        UNION ALL SELECT golden_id, 'golden_id repeated' FROM h WHERE {given("golden_id")} GROUP BY 1 HAVING count(*) > 1
        UNION ALL SELECT golden_id, 'unknown target ' || t FROM t WHERE t <> '' AND t NOT IN (SELECT golden_id FROM h WHERE row_kind = 'positive')
        UNION ALL SELECT golden_id, 'whs_id not listed' FROM h WHERE {given("whs_id")} AND regexp_extract(whs_id, '^([0-9]+)', 1) NOT IN (SELECT id_number FROM whs_properties)"""


_ALPHABET = reg.ALPHABET
_DIGEST = "('0x' || substr(sha256('qid:' || qid || '#0'), 1, 13))::BIGINT"
_MINT = "'pl_' || " + " || ".join(f"substr('{_ALPHABET}', (({_DIGEST} >> {5 * i}) & 31)::INT + 1, 1)" for i in range(10))

SQL = {
    "q56_golden_problems": _golden_sql(),
    "q55_place_problems": f"""
        WITH c0 AS (SELECT lower(trim(place_id)) place_id, arg_max({{'s': status, 'ty': type, 'nm': name_en, 'c': country_iso3, 'la': lat, 'lo': lon, 't': tier}}, loaded_at) r FROM place GROUP BY 1),
        p AS (SELECT place_id, lower(trim(r.ty)) AS type, r.nm name_en, r.c iso3, r.la lat, r.lo lon, r.t tier FROM c0 WHERE coalesce(lower(trim(r.s)) <> 'retired', true))
        SELECT place_id, 'bad iso3' problem FROM p WHERE NOT coalesce(regexp_matches(iso3, '^[A-Z]{{3}}$'), false)
        UNION ALL SELECT place_id, 'bad coordinates' FROM p WHERE NOT coalesce(NOT isnan(lat) AND NOT isnan(lon) AND abs(lat) <= 90 AND abs(lon) <= 180, false)
        UNION ALL SELECT place_id, 'bad tier' FROM p WHERE NOT coalesce(tier IN ('Icon', 'Major', 'Notable', 'Local'), false)
        UNION ALL SELECT place_id, 'bad type' FROM p WHERE NOT coalesce(type IN ('settlement', 'site', 'area', 'route'), false)
        UNION ALL SELECT place_id, 'name_en missing' FROM p WHERE coalesce(name_en, '') = ''""",
    "q57_minting": f"""
        WITH br AS (SELECT build_no, lower(trim(place_id)) place_id, {sql_tier("tier")} tier, name_en, nullif(upper(trim(country_iso3)), '') iso3, lower(trim(status)) status, {sql_qid("qid")} qid, loaded_at
                    FROM place_build WHERE trim(place_id) <> ''),
        b AS (SELECT build_no, place_id, arg_max({{'q': qid}}, (loaded_at, tier, name_en, iso3, status, qid)).q qid FROM br WHERE build_no IN (1, 4) GROUP BY ALL),
        k AS (SELECT build_no, qid, min(place_id) place_id FROM b WHERE qid IS NOT NULL GROUP BY ALL)
        SELECT n.qid, coalesce(o.place_id, {_MINT.replace("qid:' || qid", "qid:' || n.qid")}) place_id FROM (FROM k WHERE build_no = 4) n LEFT JOIN (FROM k WHERE build_no = 1) o ON o.qid = n.qid""",
    "q58_features": f"WITH {PLACES} SELECT iso3, count(*) n, min(place_id) first_id FROM pl WHERE iso3 IS NOT NULL AND lat IS NOT NULL AND NOT isnan(lat) GROUP BY 1",
}
