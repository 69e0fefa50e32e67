"""Queries p1 (best representative), p4 (top N per group) and p6 (stable sample), with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity
from ..functions.geo import located
from ..operators.latest import current_places
from ..runtime import broadcast_if_small, table
from .linkage import link_records, records_of, whole_number
from .representative import Bundle, Dependency, best_representative, search_extent, tied_groups
from .sample import sample_versions
from .topn import top_n_per_group

TOP = 5
SALT = "place-review-1"
# Sampling rates by place type and the build from which they hold; a stratum's rate never falls.
RATES = {1: {"settlement": 0.05, "site": 0.05, "area": 0.10, "route": 0.20}, 3: {"site": 0.08}}


def admit_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Admission rows with ``group_id`` and ``whole_whs``, the listed property that ``whs`` names as a whole."""
    listed = table(spark, folder, "whs_properties").select(F.trim("id_number").alias("whole_whs"), identity.country("iso3").alias("whs_iso3")).dropDuplicates(["whole_whs"])
    admit = table(spark, folder, "admit").select("admit_id", "qid", "alt_qids", "whs", "sitelinks", "retrieved", "iso3", "lat", "lon", "label_en", "label_loc")
    numbers = F.regexp_extract_all("whs", F.lit("[0-9]+"), F.lit(0))
    admit = admit.withColumn("_number", F.when(F.size(numbers) == 1, F.get(numbers, F.lit(0))))
    admit = admit.join(broadcast_if_small(listed), F.col("_number") == F.col("whole_whs"), "left").drop("_number")
    names = F.concat(F.array(identity.qid("qid")), F.transform(F.coalesce("alt_qids", F.array().cast("array<string>")), identity.qid))
    return tied_groups(admit, "admit_id", names)


def _bundles() -> tuple[Bundle, Bundle]:
    newest, smallest = F.col("retrieved"), -F.col("admit_id")
    survivor = Bundle("survivor", ["admit_id"], [identity.count_or_null("sitelinks"), newest, smallest])
    heritage = Bundle("heritage", ["whole_whs"], [newest, smallest], when=F.col("whole_whs").isNotNull())
    return survivor, heritage


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Survivor and World Heritage property of every group of two or more tied admission rows."""
    found = best_representative(admit_groups(spark, folder), "group_id", "admit_id", _bundles())
    return found.select(F.col("first_admit_id").alias("first_id"), F.col("admit_id").alias("survivor_id"), F.coalesce("whole_whs", F.lit("")).alias("whs"))


def _consistent() -> tuple[list[Bundle], list[Dependency]]:
    """Bundles of a whole record, where the property's country must be that of the chosen location."""
    newest, smallest = F.col("retrieved"), -F.col("admit_id")
    location = Bundle("location", ["lat", "lon", "country"], [identity.count_or_null("sitelinks"), newest, smallest], when=located(F.col("lat"), F.col("lon")))
    labels = Bundle("labels", ["label_en", "label_loc"], [F.col("label_en").isNotNull(), F.col("label_loc").isNotNull(), newest, smallest], when=F.coalesce("label_en", "label_loc").isNotNull())
    return [*_bundles(), location, labels], [Dependency("heritage", "whs_iso3", "location", "country")]


def p1_records(spark: SparkSession, folder: str) -> DataFrame:
    """Whole surviving records by branch and bound under the dependency of the location on the property."""
    rows = admit_groups(spark, folder).withColumn("country", identity.country("iso3"))
    found = best_representative(rows, "group_id", "admit_id", *_consistent())
    return found.withColumnsRenamed({"first_admit_id": "first_id", "admit_id": "survivor_id", "whole_whs": "whs"}).drop("group_id")


def p1_search(spark: SparkSession, folder: str) -> DataFrame:
    """How many of the groups of ``p1_records`` are settled by search below the root."""
    rows = admit_groups(spark, folder).withColumn("country", identity.country("iso3"))
    return search_extent(rows, "group_id", "admit_id", *_consistent())


def p3_links(spark: SparkSession, folder: str) -> DataFrame:
    """Holdout rows and the places they mean, with a confidence."""
    places = current_places(table(spark, folder, "place"), "type", "name_en", "name_local", "aliases", "country_iso3", "lat", "lon", "whs_id").select(
        "place_id", identity.country("country_iso3").alias("iso"), F.lower(identity.squeeze("type")).alias("type"), "lat", "lon", whole_number("whs_id").alias("whs"),
        F.concat(F.array("name_en", "name_local"), F.coalesce("aliases", F.array().cast("array<string>"))).alias("names"),
    )
    titles = table(spark, folder, "whs_properties").select(F.trim("id_number").alias("whs"), F.col("site").alias("title")).where("whs <> ''")
    return link_records(records_of(table(spark, folder, "h1")), places, titles)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_links(spark, folder).select("golden_id", "place_id")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """First five places of every country and tier by sitelinks."""
    admit = table(spark, folder, "admit").select(identity.qid("qid").alias("qid"), "sitelinks").where("qid is not null and sitelinks >= 0")
    best = admit.groupBy("qid").agg(F.max("sitelinks").alias("sitelinks"))
    places = current_places(table(spark, folder, "place"), "country_iso3", "tier", "qid").select(
        "place_id", identity.country("country_iso3").alias("country_iso3"), identity.tier("tier").alias("tier"), identity.qid("qid").alias("qid")
    )
    ranked = places.where("country_iso3 is not null and tier is not null").join(best, "qid").select("country_iso3", "tier", "place_id", "sitelinks")
    return top_n_per_group(ranked, ["country_iso3", "tier"], "sitelinks", "place_id", TOP).select("country_iso3", "tier", "place_id")


def p6_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Review sample of every build; a chosen place keeps its place in the sample and the QID it was first known by."""
    rows = table(spark, folder, "place_build").select("build_no", identity.place_id("place_id").alias("place_id"), F.lower(F.trim("type")).alias("type"), identity.qid("qid").alias("qid"), "loaded_at")
    return sample_versions(rows, "place_id", "type", "build_no", "loaded_at", ["qid"], RATES, SALT)


QUERIES = {"p1_found": p1_found, "p1_records": p1_records, "p1_search": p1_search, "p3_found": p3_found, "p3_links": p3_links, "p4_found": p4_found, "p6_sample": p6_sample}

_QID = r"nullif(regexp_extract(upper({0}), '(?:^|[^A-Z0-9])(Q[0-9]+)\s*$', 1), '')"
_TIER = "CASE lower(trim({0})) WHEN 'icon' THEN 'Icon' WHEN 'major' THEN 'Major' WHEN 'notable' THEN 'Notable' WHEN 'local' THEN 'Local' END"

_GROUPS = f"""
    a AS (SELECT admit_id, sitelinks, retrieved, whs,
                 list_distinct(list_filter(list_concat([{_QID.format("qid")}], coalesce(list_transform(alt_qids, lambda x: {_QID.format("x")}), [])), lambda x: x IS NOT NULL)) qs
          FROM admit),
    m AS (SELECT DISTINCT admit_id, unnest(qs) q FROM a),
    e AS (SELECT DISTINCT x.q u, y.q v FROM m x JOIN m y USING (admit_id)),
    reach(u, v) AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM reach r JOIN e ON r.v = e.u),
    root AS (SELECT u, min(v) g FROM reach GROUP BY u),
    g AS (SELECT DISTINCT a.*, root.g FROM a JOIN m USING (admit_id) JOIN root ON root.u = m.q)"""

# One candidate a distinct constrained value, and "none" behind the last; the least sum of positions, earlier bundles first.
_RECORDS = f"""
        WITH RECURSIVE {_GROUPS},
        r AS (SELECT g.g, g.admit_id, g.retrieved, CASE WHEN g.sitelinks >= 0 THEN g.sitelinks END sl, nullif(upper(trim(x.iso3)), '') country, x.lat, x.lon, x.label_en, x.label_loc,
                     p.id_number whole, nullif(upper(trim(p.iso3)), '') wiso,
                     coalesce(NOT isnan(x.lat) AND NOT isnan(x.lon) AND abs(x.lat) <= 90 AND abs(x.lon) <= 180 AND NOT (x.lat = 0 AND x.lon = 0), false) placed
              FROM g JOIN admit x USING (admit_id) LEFT JOIN whs_properties p ON len(regexp_extract_all(g.whs, '[0-9]+')) = 1 AND regexp_extract(g.whs, '[0-9]+') = trim(p.id_number)),
        big AS (SELECT g, min(admit_id) first_id, count(*) n_rows, first(admit_id ORDER BY sl DESC NULLS LAST, retrieved DESC NULLS LAST, admit_id) survivor_id,
                       first({{'e': label_en, 'l': label_loc}} ORDER BY label_en IS NOT NULL DESC, label_loc IS NOT NULL DESC, retrieved DESC NULLS LAST, admit_id)
                         FILTER (coalesce(label_en, label_loc) IS NOT NULL) lab FROM r GROUP BY g HAVING count(*) > 1),
        h AS (SELECT g, wiso, trim(whole) whole, row_number() OVER (PARTITION BY g ORDER BY retrieved DESC NULLS LAST, admit_id) - 1 p
              FROM (SELECT * FROM r WHERE whole IS NOT NULL QUALIFY row_number() OVER (PARTITION BY g, wiso ORDER BY retrieved DESC NULLS LAST, admit_id) = 1)),
        l AS (SELECT g, country, lat, lon, row_number() OVER (PARTITION BY g ORDER BY sl DESC NULLS LAST, retrieved DESC NULLS LAST, admit_id) - 1 p
              FROM (SELECT * FROM r WHERE placed QUALIFY row_number() OVER (PARTITION BY g, country ORDER BY sl DESC NULLS LAST, retrieved DESC NULLS LAST, admit_id) = 1)),
        hn AS (SELECT g, p, wiso, whole FROM h UNION ALL SELECT big.g, count(h.g), NULL, NULL FROM big LEFT JOIN h USING (g) GROUP BY big.g),
        ln AS (SELECT g, p, country, lat, lon FROM l UNION ALL SELECT big.g, count(l.g), NULL, NULL, NULL FROM big LEFT JOIN l USING (g) GROUP BY big.g)"""

SQL = {
    "p1_records": f"""
        {_RECORDS}
        SELECT first_id, n_rows, survivor_id, whole whs, lat, lon, country, lab.e label_en, lab.l label_loc FROM big JOIN hn USING (g) JOIN ln USING (g)
        WHERE coalesce(wiso = country, true) QUALIFY row_number() OVER (PARTITION BY g ORDER BY hn.p + ln.p, hn.p, ln.p) = 1""",
    "p1_search": f"""
        {_RECORDS}
        SELECT count(*) groups, count(*) FILTER (NOT coalesce(hn.wiso = ln.country, true)) searched FROM big JOIN hn ON hn.g = big.g AND hn.p = 0 JOIN ln ON ln.g = big.g AND ln.p = 0""",
    "p1_found": f"""
        WITH RECURSIVE {_GROUPS},
        w AS (SELECT g.*, p.id_number whole FROM g LEFT JOIN whs_properties p
              ON len(regexp_extract_all(g.whs, '[0-9]+')) = 1 AND regexp_extract(g.whs, '[0-9]+') = trim(p.id_number))
        SELECT min(admit_id) first_id,
               first(admit_id ORDER BY CASE WHEN sitelinks >= 0 THEN sitelinks END DESC NULLS LAST, retrieved DESC NULLS LAST, admit_id) survivor_id,
               coalesce(first(whole ORDER BY retrieved DESC NULLS LAST, admit_id) FILTER (whole IS NOT NULL), '') whs
        FROM w GROUP BY g HAVING count(*) > 1""",
    "p4_found": f"""
        WITH c AS (SELECT lower(trim(place_id)) place_id, arg_max({{'s': status, 'c': country_iso3, 't': tier, 'q': qid}}, loaded_at) r FROM place GROUP BY 1),
        p AS (SELECT place_id, nullif(upper(trim(r.c)), '') country_iso3, {_TIER.format("r.t")} tier, {_QID.format("r.q")} qid
              FROM c WHERE coalesce(lower(trim(r.s)) <> 'retired', true)),
        s AS (SELECT {_QID.format("qid")} qid, max(sitelinks) n FROM admit WHERE sitelinks >= 0 GROUP BY 1)
        SELECT country_iso3, tier, place_id FROM p JOIN s USING (qid) WHERE country_iso3 IS NOT NULL AND tier IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY country_iso3, tier ORDER BY n DESC, place_id) <= {TOP}""",
    "p6_sample": f"""
        WITH r AS (SELECT build_no, lower(trim(place_id)) place_id, lower(trim(type)) type, {_QID.format("qid")} qid, loaded_at FROM place_build WHERE trim(place_id) <> ''),
        l AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY place_id, build_no ORDER BY loaded_at DESC NULLS LAST, type DESC NULLS LAST, qid DESC NULLS LAST) = 1),
        k AS (SELECT place_id, min(build_no) since, first(type ORDER BY build_no) type, first(qid ORDER BY build_no) FILTER (qid IS NOT NULL) qid FROM l GROUP BY place_id)
        SELECT b.build_no, place_id, type, qid
        FROM k JOIN (SELECT DISTINCT build_no FROM r) b ON b.build_no >= since
        WHERE ('0x' || substr(md5('{SALT}|' || place_id), 1, 15))::BIGINT <
              CASE type {" ".join(f"WHEN '{s}' THEN CASE WHEN b.build_no >= 3 THEN {int(max(x, RATES[3].get(s, 0)) * (1 << 60))} ELSE {int(x * (1 << 60))} END" for s, x in RATES[1].items())} ELSE 0 END""",
}
