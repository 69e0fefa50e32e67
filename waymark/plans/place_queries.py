"""q15 to q27 and q52: spatial joins, assignment, clustering, chains and kinds over places and candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, identity
from ..functions.stats import noisy_or, wilson_lower
from ..functions.text import GENERIC, base_name, fold
from ..operators.candidates import whole_property
from ..operators.kinds import KindRule, PairRule, class_tests, fire, kind_distribution, select_kinds
from ..operators.latest import current_places
from ..operators.resolution import ancestors, chain_roots, greedy_assignment, star_clusters, survivors
from ..operators.spatial import nearest, points_near_points
from ..runtime import Stored, table
from .admission_queries import ADMITTED, CANDIDATES, KINDS, TYPED, admitted, candidates, sql_qid, sql_tier


def places(spark: SparkSession, d: str) -> DataFrame:
    p = current_places(table(spark, d, "place"), "type", "name_en", "country_iso3", "lat", "lon", "tier", "qid", "near_place_id")
    return p.select(
        "place_id", F.lower(F.trim("type")).alias("type"), "name_en", identity.country("country_iso3").alias("iso3"), "lat", "lon",
        identity.tier("tier").alias("tier"), identity.qid("qid").alias("qid"), identity.place_id("near_place_id").alias("near"),
    )


def q15_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Same-type places of one country within 25 km of each other, both Notable or better."""
    p = places(spark, d).where("tier in ('Notable', 'Major', 'Icon') and iso3 is not null")
    return _pairs(p, 25.0, "type")


def _pairs(p: DataFrame, km: float, same: str) -> DataFrame:
    a = p.select(F.col("place_id").alias("place_id_a"), F.col("iso3").alias("ia"), F.col(same).alias("sa"), F.col("lat").alias("la"), F.col("lon").alias("oa"))
    b = p.select(F.col("place_id").alias("place_id_b"), F.col("iso3").alias("ib"), F.col(same).alias("sb"), F.col("lat").alias("lb"), F.col("lon").alias("ob"))
    on = F.col("place_id_a") < F.col("place_id_b")
    return points_near_points(a, b, km, ("la", "oa"), ("lb", "ob"), on, [("ia", "ib"), ("sa", "sb")]).select("place_id_a", "place_id_b", F.round("distance_km", 4).alias("km"))


def q16_band_join(spark: SparkSession, d: str) -> DataFrame:
    """Settlements and the sites within 5 km of them in the same country."""
    p = places(spark, d).where("iso3 is not null")
    a = p.where("type = 'settlement'").select(F.col("place_id").alias("settlement"), F.col("iso3").alias("ia"), F.col("lat").alias("la"), F.col("lon").alias("oa"))
    b = p.where("type = 'site'").select(F.col("place_id").alias("site"), F.col("iso3").alias("ib"), F.col("lat").alias("lb"), F.col("lon").alias("ob"))
    out = points_near_points(a, b, 5.0, ("la", "oa"), ("lb", "ob"), same=[("ia", "ib")])
    return out.select("settlement", "site", F.round("distance_km", 4).alias("km"))


def q17_big_neighbour(spark: SparkSession, d: str) -> DataFrame:
    """Candidates with another candidate of 50,000 inhabitants or more within 10 km."""
    c = candidates(spark, d).select("qid", "lat", "lon", "population")
    big = c.where("population >= 50000").select(F.col("qid").alias("big"), F.col("lat").alias("bl"), F.col("lon").alias("bo"))
    near = points_near_points(c.drop("population"), big, 10.0, ("lat", "lon"), ("bl", "bo"), extra=F.col("qid") != F.col("big"))
    return near.select("qid").distinct()


def q18_nearest_site(spark: SparkSession, d: str) -> DataFrame:
    """The nearest site of every settlement, in any country."""
    p = places(spark, d)
    a = p.where("type = 'settlement'").select(F.col("place_id").alias("settlement"), F.col("lat").alias("la"), F.col("lon").alias("oa"))
    b = p.where("type = 'site'").select(F.col("place_id").alias("site"), F.col("lat").alias("lb"), F.col("lon").alias("ob"))
    return nearest(a, b, "settlement", "site", ("la", "oa"), ("lb", "ob")).select("settlement", F.round("distance_km", 4).alias("km"))


def q19_greedy_assignment(spark: SparkSession, d: str) -> DataFrame:
    """Settlements and areas of one country within 60 km, paired one to one, nearest first."""
    p = places(spark, d).where("iso3 is not null")
    a = p.where("type = 'settlement'").select(F.col("place_id").alias("settlement"), F.col("iso3").alias("ia"), F.col("lat").alias("la"), F.col("lon").alias("oa"))
    b = p.where("type = 'area'").select(F.col("place_id").alias("area"), F.col("iso3").alias("ib"), F.col("lat").alias("lb"), F.col("lon").alias("ob"))
    pairs = points_near_points(a, b, 60.0, ("la", "oa"), ("lb", "ob"), same=[("ia", "ib")])
    return greedy_assignment(pairs.select("settlement", "area", F.round("distance_km", 6).alias("km")), "settlement", "area", "km")


def q20_same_property(spark: SparkSession, d: str) -> DataFrame:
    """Candidates that carry the same whole property, with the most cited of them."""
    c = candidates(spark, d).where(whole_property(F.col("whs")))
    return survivors(c.select("whs", "qid", "sitelinks"), "whs", "qid", ["sitelinks", "qid"])


def q21_star_merge(spark: SparkSession, d: str) -> DataFrame:
    """Admitted candidates of one country and base name within 5 km, merged into the most cited."""
    c = admitted(spark, d).select("qid", "iso3", "lat", "lon", "sitelinks", base_name(fold(F.coalesce("label_en", "label_loc"))).alias("base"))
    c = Stored(c, "named").df
    a = c.select(F.col("qid").alias("a"), F.col("iso3").alias("ia"), F.col("base").alias("na"), F.col("lat").alias("la"), F.col("lon").alias("oa"))
    b = c.select(F.col("qid").alias("b"), F.col("iso3").alias("ib"), F.col("base").alias("nb"), F.col("lat").alias("lb"), F.col("lon").alias("ob"))
    edges = points_near_points(a, b, 5.0, ("la", "oa"), ("lb", "ob"), F.col("a") < F.col("b"), [("ia", "ib"), ("na", "nb")]).select("a", "b")
    stars = star_clusters(c.select(F.col("qid").alias("id"), (-F.col("sitelinks")).alias("priority")), edges)
    return stars.where("id <> center").select(F.col("id").alias("qid"), F.col("center").alias("kept"))


def q22_ancestors(spark: SparkSession, d: str) -> DataFrame:
    """Places reached from a place by up to three steps along ``near_place_id``."""
    return ancestors(places(spark, d).select("place_id", "near"), "place_id", "near", 3)


def q23_chain_roots(spark: SparkSession, d: str) -> DataFrame:
    """The end of every place's chain of ``near_place_id``; null for chains that dangle or circle."""
    return chain_roots(places(spark, d).select("place_id", "near"), "place_id", "near")


def q52_cycles(spark: SparkSession, d: str) -> DataFrame:
    """Places whose chain of ``near_place_id`` never ends."""
    return q23_chain_roots(spark, d).where("fate = 'cycle'").select("place_id")


# The rule table of the test data: class rules come from kind hints, the others from figures.
RULES = [
    *[KindRule(f"R{i + 1:02d}", k, "wikidata", 0.6 + 0.02 * i, "support" if i % 5 == 4 else "core", ("rural",) if k == "wildlife" else ()) for i, k in enumerate(KINDS)],
    KindRule("R30", "metropolis", "pop", 0.85), KindRule("R31", "metropolis", "pop", 0.6, "fallback"), KindRule("R32", "wildlife", "iucn", 0.85, "core", ("rural", "water")),
    KindRule("R33", "sacred", "unesco", 0.7, "support"), KindRule("R34", "old_town", "unesco", 0.85), KindRule("R35", "seaside", "coast", 0.45), KindRule("R36", "maritime", "coast", 0.6),
    KindRule("R37", "mountain", "relief", 0.8), KindRule("R38", "forest", "landcover", 0.7), KindRule("R39", "rural", "landcover", 0.65),
]


def fired_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Admitted candidates with ``fired`` rules. Land figures that the test data lack are residues of the item's number."""
    c = admitted(spark, d).select("qid", "classes", "place_type", "population", "wdpa", "whs")
    number = F.regexp_extract("class_qid", "([0-9]{3})$", 1).cast("int")
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (number % 14) + 1)
    spark_sets = spark.range(4).select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.concat(F.lit("Q69"), F.lpad((F.col("id") * 100 + i).cast("string"), 8, "0")))).alias("class_qid"))
    by_kind = {k: f"R{i + 1:02d}" for i, k in enumerate(KINDS)}
    rule = F.create_map(*[F.lit(x) for kv in by_kind.items() for x in kv])[kind]
    c = class_tests(c, spark_sets.select(rule.alias("rule_id"), "class_qid"))
    n = F.substring("qid", 2, 30).cast("bigint")
    pop = F.coalesce("population", F.lit(0))
    tests = {r.rule_id: F.array_contains("class_rules", r.rule_id) for r in RULES if r.source == "wikidata"}
    tests |= {
        "R30": pop >= 1_000_000, "R31": pop >= 100_000, "R32": F.col("wdpa").isNotNull() & (n % 2 == 0), "R33": whole_property(F.col("whs")) & (n % 3 == 0),
        "R34": whole_property(F.col("whs")) & (F.col("place_type") == "settlement"), "R35": n % 7 == 0, "R36": (n % 11 == 0) & (pop >= 1000),
        "R37": n % 13 == 0, "R38": n % 17 == 0, "R39": n % 5 == 0,
    }
    return fire(c, RULES, tests)


def pair_rules() -> list[PairRule]:
    worship = F.exists("fired", lambda f: f["rule"] == "R05")
    pop = F.coalesce("population", F.lit(0))
    return [
        PairRule("sacred", "ruins", worship), PairRule("ruins", "sacred", ~worship), PairRule("maritime", "seaside", pop >= 200_000),
        PairRule("seaside", "water", F.lit(False)), PairRule("wildlife", "rural", F.lit(True)), PairRule("forest", "rural", F.lit(True)), PairRule("metropolis", "rural", F.lit(True)),
    ]


def q24_noisy_or(spark: SparkSession, d: str) -> DataFrame:
    """Strength of every kind of every candidate from its fired rules, before selection."""
    f = fired_candidates(spark, d).select("qid", F.explode("fired").alias("f")).select("qid", "f.*").where("role <> 'fallback'")
    best = f.groupBy("qid", "kind", "source").agg(F.max("strength").alias("s"))
    return best.groupBy("qid", "kind").agg(noisy_or(F.collect_list("s"), 0.95).alias("strength"), F.count("*").alias("sources"))


def q25_kind_select(spark: SparkSession, d: str) -> DataFrame:
    s = select_kinds(Stored(fired_candidates(spark, d), "fired").df, KINDS, pair_rules())
    return s.select("qid", F.array_join(F.transform("kept", lambda c: c["kind"]), "|").alias("kinds"), "crowded", F.array_join(F.array_sort(F.transform("cut", lambda c: F.concat(c["kind"], F.lit("="), c["reason"]))), "|").alias("cut"))


def q26_kind_distribution(spark: SparkSession, d: str) -> DataFrame:
    return kind_distribution(Stored(select_kinds(Stored(fired_candidates(spark, d), "fired").df, KINDS, pair_rules()).select("kept"), "kinds").df, KINDS)


def q27_wilson(spark: SparkSession, d: str) -> DataFrame:
    """Share of places with a position by type and country, with its lower bound."""
    p = table(spark, d, "place").select(F.lower(F.trim("type")).alias("type"), identity.country("country_iso3").alias("iso3"), geo.located(F.col("lat"), F.col("lon")).alias("ok"))
    g = p.groupBy("type", "iso3").agg(F.count("*").alias("n"), F.count_if("ok").alias("hits"))
    return g.select("type", "iso3", "n", "hits", F.round(wilson_lower(F.col("hits"), F.col("n")), 6).alias("lower"))


QUERIES = {f.__name__: f for f in (
    q15_neighbours, q16_band_join, q17_big_neighbour, q18_nearest_site, q19_greedy_assignment, q20_same_property, q21_star_merge, q22_ancestors, q23_chain_roots,
    q24_noisy_or, q25_kind_select, q26_kind_distribution, q27_wilson, q52_cycles,
)}

_KM = "2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))))"
_LOCATED = "lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon) AND abs(lat) <= 90 AND abs(lon) <= 180 AND NOT (lat = 0 AND lon = 0)"
PLACES = f"""
    c0 AS (SELECT lower(trim(place_id)) place_id, arg_max({{'s': status, 'ty': type, 'nm': name_en, 'c': country_iso3, 'la': lat, 'lo': lon, 't': tier, 'q': qid, 'nr': near_place_id}}, loaded_at) r FROM place GROUP BY 1),
    pl AS (SELECT place_id, lower(trim(r.ty)) AS type, r.nm name_en, nullif(upper(trim(r.c)), '') iso3, r.la lat, r.lo lon, {sql_tier("r.t")} tier, {sql_qid("r.q")} qid, nullif(lower(trim(r.nr)), '') near
           FROM c0 WHERE coalesce(lower(trim(r.s)) <> 'retired', true)),
    lp AS (SELECT * FROM pl WHERE {_LOCATED})"""
_CANDS = f"{CANDIDATES}, {TYPED}"
_FIRED_TESTS = {
    "R30": "pop >= 1000000", "R31": "pop >= 100000", "R32": "wdpa IS NOT NULL AND n % 2 = 0", "R33": "whole AND n % 3 = 0", "R34": "whole AND place_type = 'settlement'",
    "R35": "n % 7 = 0", "R36": "n % 11 = 0 AND pop >= 1000", "R37": "n % 13 = 0", "R38": "n % 17 = 0", "R39": "n % 5 = 0",
}
_RULE_ROWS = ", ".join(f"('{r.rule_id}', '{r.kind}', '{r.source}', {r.strength}::DOUBLE, '{r.role}')" for r in RULES)
_FIRED = f"""{_CANDS}, {ADMITTED},
    base AS (SELECT qid, classes, place_type, coalesce(population, 0) pop, wdpa, coalesce(regexp_matches(whs, '^[0-9]+(bis|ter|quater)?$'), false) whole, substr(qid, 2)::BIGINT n FROM adm),
    rule(rule, kind, source, strength, role) AS (VALUES {_RULE_ROWS}),
    hit AS (SELECT DISTINCT qid, 'R' || lpad((regexp_extract(k, '([0-9]{{3}})$', 1)::INT % 14 + 1)::VARCHAR, 2, '0') rule FROM (SELECT qid, unnest(classes) k FROM base)
            {" ".join(f"UNION ALL SELECT qid, '{k}' FROM base WHERE {v}" for k, v in _FIRED_TESTS.items())}),
    fired AS (SELECT hit.qid, rule.* FROM hit JOIN rule USING (rule))"""
_STRENGTH = """
    bs AS (SELECT qid, kind, source, max(strength) s FROM fired WHERE role <> 'fallback' GROUP BY ALL),
    comb AS (SELECT qid, kind, round(least(0.95::DOUBLE, 1 - list_reduce(list_prepend(1.0::DOUBLE, list_transform(list_sort(list(s)), lambda x: 1.0::DOUBLE - x)), lambda a, b: a * b)), 4) strength, count(*) sources FROM bs GROUP BY ALL)"""
_DROP = [("sacred", "ruins", "worship"), ("ruins", "sacred", "NOT worship"), ("maritime", "seaside", "pop >= 200000"), ("wildlife", "rural", "true"), ("forest", "rural", "true"), ("metropolis", "rural", "true")]


def _selection_sql() -> str:
    kinds = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    parts = [f"""
    core AS (SELECT qid, kind, bool_or(role = 'core') core FROM fired WHERE role <> 'fallback' GROUP BY ALL),
    live AS (SELECT c.*, core.core FROM comb c JOIN core USING (qid, kind)),
    s0 AS (SELECT b.qid, b.pop, coalesce(l.ks, []) live, coalesce(l.weak, []) cut,
                  coalesce(x.rs, []) rs, list_contains(coalesce(x.rs, []), 'R05') worship
           FROM base b LEFT JOIN (SELECT qid, coalesce(list(kind) FILTER (core AND strength >= 0.5), []) ks,
                                         coalesce(list(kind || '=' || CASE WHEN NOT core THEN 'no_core_rule' ELSE 'below_threshold' END) FILTER (NOT (core AND strength >= 0.5)), []) weak FROM live GROUP BY qid) l USING (qid)
           LEFT JOIN (SELECT qid, list(rule) rs FROM fired GROUP BY qid) x USING (qid))"""]
    step = 0
    for r in sorted((r for r in RULES if r.excludes), key=lambda r: r.rule_id):
        fires = f"list_contains(rs, '{r.rule_id}') AND list_contains(live, '{r.kind}')"
        for x in r.excludes:
            cond = f"{fires} AND list_contains(live, '{x}')"
            parts.append(f"s{step + 1} AS (SELECT * REPLACE (CASE WHEN {cond} THEN list_filter(live, lambda k: k <> '{x}') ELSE live END AS live, CASE WHEN {cond} THEN list_append(cut, '{x}=excluded_by:{r.rule_id}') ELSE cut END AS cut) FROM s{step})")
            step += 1
    for keep, drop, cond in _DROP:
        cond = f"list_contains(live, '{keep}') AND list_contains(live, '{drop}') AND {cond}"
        parts.append(f"s{step + 1} AS (SELECT * REPLACE (CASE WHEN {cond} THEN list_filter(live, lambda k: k <> '{drop}') ELSE live END AS live, CASE WHEN {cond} THEN list_append(cut, '{drop}=pair:{keep}>{drop}') ELSE cut END AS cut) FROM s{step})")
        step += 1
    parts.append(f"""
    ch AS (SELECT s.qid, u.kind, round_even(c.strength / 0.05::DOUBLE, 0)::INT bucket, c.sources FROM s{step} s, unnest(s.live) u(kind) JOIN comb c ON c.qid = s.qid AND c.kind = u.kind
           UNION ALL SELECT s.qid, f.kind, round_even(f.strength / 0.05::DOUBLE, 0)::INT, 0 FROM s{step} s JOIN fired f ON f.qid = s.qid AND f.role = 'fallback' WHERE len(s.live) = 0),
    rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY bucket DESC, sources DESC, list_position({kinds}, kind)) r FROM ch),
    sel AS (SELECT s.qid, coalesce(array_to_string(k.ks[1:3], '|'), '') kinds, coalesce(k.b[4] >= k.b[3] - 2, false) crowded,
                   array_to_string(list_sort(list_concat(s.cut, list_transform(coalesce(k.ks, [])[4:], lambda x: x || '=cap'))), '|') cut, coalesce(k.ks, [])[1:3] kept
            FROM s{step} s LEFT JOIN (SELECT qid, list(kind ORDER BY r) ks, list(bucket ORDER BY r) b FROM rk GROUP BY qid) k USING (qid))""")
    return ", ".join(parts)


_SELECT = _selection_sql()

SQL = {
    "q15_neighbours": f"""
        WITH {PLACES}, n AS (FROM lp WHERE tier IN ('Notable', 'Major', 'Icon') AND iso3 IS NOT NULL)
        SELECT a.place_id place_id_a, b.place_id place_id_b, round({_KM}, 4) km FROM n a JOIN n b ON a.iso3 = b.iso3 AND a.type = b.type AND a.place_id < b.place_id AND abs(a.lat - b.lat) <= 0.25 WHERE {_KM} <= 25""",
    "q16_band_join": f"""
        WITH {PLACES} SELECT a.place_id settlement, b.place_id site, round({_KM}, 4) km FROM lp a JOIN lp b ON a.iso3 = b.iso3 AND a.type = 'settlement' AND b.type = 'site' AND abs(a.lat - b.lat) <= 0.05 WHERE {_KM} <= 5""",
    "q17_big_neighbour": f"""
        WITH {_CANDS}, l AS (SELECT * FROM c2 WHERE {_LOCATED})
        SELECT DISTINCT a.qid FROM l a JOIN l b ON b.population >= 50000 AND a.qid <> b.qid AND abs(a.lat - b.lat) <= 0.1 WHERE {_KM} <= 10""",
    "q18_nearest_site": f"""
        WITH {PLACES} SELECT a.place_id settlement, round(min({_KM}), 4) km FROM lp a CROSS JOIN lp b WHERE a.type = 'settlement' AND b.type = 'site' GROUP BY 1""",
    # The sequential rules as they are stated, one pair or one candidate a step.
    "q19_greedy_assignment": f"""
        WITH RECURSIVE {PLACES}, pr AS (
            SELECT *, row_number() OVER (ORDER BY km, settlement, area) n FROM (
                SELECT a.place_id settlement, b.place_id area, round({_KM}, 6) km FROM lp a JOIN lp b ON a.iso3 = b.iso3 AND a.type = 'settlement' AND b.type = 'area' AND abs(a.lat - b.lat) <= 0.6 WHERE {_KM} <= 60)),
        r(n, ls, rs, took) AS (SELECT 0::BIGINT, []::VARCHAR[], []::VARCHAR[], false
            UNION ALL SELECT n, CASE WHEN free THEN list_append(ls, settlement) ELSE ls END, CASE WHEN free THEN list_append(rs, area) ELSE rs END, free
            FROM (SELECT pr.*, ls, rs, NOT list_contains(ls, settlement) AND NOT list_contains(rs, area) free FROM r JOIN pr ON pr.n = r.n + 1))
        SELECT settlement, area, km FROM r JOIN pr USING (n) WHERE took""",
    "q21_star_merge": rf"""
        WITH RECURSIVE {_CANDS}, {ADMITTED},
        named AS (SELECT qid, iso3, lat, lon, sitelinks, trim(replace(lower(strip_accents(coalesce(label_en, label_loc))), 'ß', 'ss')) nm FROM adm),
        nodes AS (SELECT *, coalesce(nullif(trim(regexp_replace(regexp_replace(nm, '{GENERIC}', ' ', 'g'), '\s+', ' ', 'g')), ''), nm) base, row_number() OVER (ORDER BY sitelinks DESC, qid) n FROM named),
        pos AS (SELECT * FROM nodes WHERE {_LOCATED}),
        nb AS (SELECT a.n, list(b.qid ORDER BY b.n) l FROM pos a JOIN pos b ON a.iso3 = b.iso3 AND a.base = b.base AND b.n < a.n WHERE {_KM} <= 5 GROUP BY 1),
        walk(n, cs, kept) AS (SELECT 0::BIGINT, []::VARCHAR[], NULL::VARCHAR
            UNION ALL SELECT n, CASE WHEN c IS NULL THEN list_append(cs, qid) ELSE cs END, coalesce(c, qid)
            FROM (SELECT nodes.n, qid, cs, list_filter(coalesce(l, []), lambda y: list_contains(cs, y))[1] c FROM walk JOIN nodes ON nodes.n = walk.n + 1 LEFT JOIN nb ON nb.n = nodes.n))
        SELECT qid, kept FROM walk JOIN nodes USING (n) WHERE kept <> qid""",
    "q20_same_property": f"""
        WITH {_CANDS}, w AS (SELECT *, count(*) OVER (PARTITION BY whs) n FROM c2 WHERE regexp_matches(whs, '^[0-9]+(bis|ter|quater)?$'))
        SELECT whs, qid, first_value(qid) OVER (PARTITION BY whs ORDER BY sitelinks DESC, qid DESC) survivor FROM w WHERE n > 1""",
    "q22_ancestors": f"""
        WITH RECURSIVE {PLACES}, up AS (SELECT DISTINCT place_id, near FROM pl WHERE near IS NOT NULL),
        r(place_id, a, n) AS (SELECT place_id, near, 1 FROM up UNION ALL SELECT r.place_id, up.near, n + 1 FROM r JOIN up ON up.place_id = r.a WHERE n < 3)
        SELECT place_id, a ancestor, min(n) hops FROM r GROUP BY ALL""",
    "q23_chain_roots": f"""
        WITH RECURSIVE {PLACES},
        r(place_id, pos, path) AS (SELECT place_id, place_id, [place_id] FROM pl
             UNION ALL SELECT r.place_id, p.near, list_append(r.path, p.near) FROM r JOIN pl p ON p.place_id = r.pos WHERE p.near IS NOT NULL AND NOT list_contains(r.path, p.near)),
        e AS (SELECT r.place_id, arg_max(r.pos, len(path)) last FROM r GROUP BY 1)
        SELECT e.place_id, CASE WHEN l.place_id IS NOT NULL AND l.near IS NULL THEN e.last END root, CASE WHEN l.place_id IS NULL THEN 'dangling' WHEN l.near IS NULL THEN 'root' ELSE 'cycle' END fate
        FROM e LEFT JOIN pl l ON l.place_id = e.last""",
    "q24_noisy_or": f"WITH {_FIRED}, {_STRENGTH} SELECT qid, kind, strength, sources FROM comb",
    "q25_kind_select": f"WITH {_FIRED}, {_STRENGTH}, {_SELECT} SELECT qid, kinds, crowded, cut FROM sel",
    "q26_kind_distribution": f"""
        WITH {_FIRED}, {_STRENGTH}, {_SELECT}, v(kind) AS (SELECT unnest([{", ".join(f"'{k}'" for k in KINDS)}, NULL])),
        u AS (SELECT unnest(CASE WHEN len(kept) > 0 THEN kept ELSE [NULL::VARCHAR] END) kind FROM sel), c AS (SELECT kind, count(*) n FROM u GROUP BY 1)
        SELECT v.kind, coalesce(c.n, 0) places, round(coalesce(c.n, 0)::DOUBLE / greatest(1, (SELECT count(*) FROM sel)), 6) share FROM v LEFT JOIN c ON v.kind IS NOT DISTINCT FROM c.kind""",
    "q27_wilson": f"""
        WITH g AS (SELECT lower(trim(type)) AS type, nullif(upper(trim(country_iso3)), '') iso3, count(*) n, count(*) FILTER ({_LOCATED}) hits FROM place GROUP BY 1, 2)
        SELECT type, iso3, n, hits, round((hits / n::DOUBLE + 3.8416::DOUBLE / (2 * n) - 1.96::DOUBLE * sqrt(hits / n::DOUBLE * (1 - hits / n::DOUBLE) / n + 3.8416::DOUBLE / (4 * n::DOUBLE * n))) / (1 + 3.8416::DOUBLE / n), 6) lower FROM g""",
    "q52_cycles": "",
}
SQL["q52_cycles"] = f"SELECT place_id FROM ({SQL['q23_chain_roots']}) WHERE fate = 'cycle'"
