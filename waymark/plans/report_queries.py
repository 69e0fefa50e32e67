"""q28 to q51: calendars, conflicts, differences, names, samples, projections, tiles, print, agreement, integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, identity
from ..functions.stats import cohen_kappa, kendall_tau
from ..functions.text import bad_name, fold, short_name
from ..functions.typed import decimal, tolerance_km
from ..operators.candidates import assemble, heritage_id
from ..operators.latest import latest_rows
from ..operators.product import best_over_keys, content_digest, gap_sentence, hash_sample, last_write, missing_kinds, months_filled, print_quota, print_selection
from ..operators.resolver import resolver_candidates
from ..operators.spatial import points_near_points
from ..operators.tiling import TileRule, gap_windows, tile_partition
from ..runtime import Stored, table
from .admission_queries import CANDIDATES, TYPED, candidates, sql_qid, sql_tier
from .place_queries import PLACES, places

SEED = "sample-1|"


def q28_monthly_views(spark: SparkSession, d: str) -> DataFrame:
    """Orders of every customer by month of 1995, gaps as zeros."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderdate").cast("date").alias("day"))
    m = months_filled(o, "custkey", "day", F.lit(1).cast("bigint"), "1995-01-01")
    return m.select("custkey", F.array_join(F.transform("views", lambda v: v.cast("string")), ",").alias("views"), "total")


def q29_best_over_keys(spark: SparkSession, d: str) -> DataFrame:
    """Most sitelinks under any QID of an admission row."""
    a = table(spark, d, "admit").select("admit_id", "alt_qids", identity.qid("qid").alias("qid"), "sitelinks")
    names = F.array_compact(F.concat(F.array("qid"), F.transform(F.coalesce("alt_qids", F.array().cast("array<string>")), identity.qid)))
    values = a.where("qid is not null and sitelinks >= 0").groupBy("qid").agg(F.max("sitelinks").alias("sitelinks"))
    return best_over_keys(a.drop("sitelinks"), "admit_id", names, values, "qid", "sitelinks")


def q30_key_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """QIDs and protected-area ids that several places carry."""
    p = table(spark, d, "place").select(identity.place_id("place_id").alias("place_id"), identity.qid("qid").alias("qid"), F.trim("wdpa_id").alias("wdpa"))
    keys = F.array_compact(F.array(F.concat(F.lit("qid:"), "qid"), F.concat(F.lit("wdpa:"), "wdpa")))
    k = p.where("place_id is not null").select("place_id", F.explode(keys).alias("key"))
    return k.groupBy("key").agg(F.countDistinct("place_id").alias("places")).where("places > 1")


def _builds(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    rows = table(spark, d, "place_build").select(
        "build_no", identity.place_id("place_id").alias("place_id"), identity.tier("tier").alias("tier"), "name_en", identity.country("country_iso3").alias("iso3"), identity.qid("qid").alias("qid"), "loaded_at"
    )
    return latest_rows(rows.where("place_id is not null"), ["place_id", "build_no"], "loaded_at", list(columns))


def q31_churn(spark: SparkSession, d: str) -> DataFrame:
    """Share of build 3's places, by country, that build 4 lost or gave another tier or name."""
    b = _builds(spark, d, "tier", "name_en", "iso3").where("build_no in (3, 4)")
    old = b.where("build_no = 3").select("place_id", "iso3", F.struct("tier", "name_en").alias("was"))
    new = b.where("build_no = 4").select("place_id", F.struct("tier", "name_en").alias("now"))
    j = old.join(new, "place_id", "left").withColumn("changed", ~F.col("was").eqNullSafe(F.col("now")))
    return j.groupBy("iso3").agg(F.count("*").alias("n"), F.count_if("changed").alias("changed"), F.round(F.avg(F.col("changed").cast("double")), 6).alias("share"))


def q32_count_gate(spark: SparkSession, d: str) -> DataFrame:
    """Counts in all and by country that differ between the places and build 4."""
    actual = places(spark, d).rollup("iso3").agg(F.grouping("iso3").cast("int").alias("total"), F.count("*").alias("n"))
    told = _builds(spark, d, "iso3").where("build_no = 4").rollup("iso3").agg(F.grouping("iso3").cast("int").alias("total"), F.count("*").alias("n"))
    return actual.exceptAll(told).withColumn("side", F.lit("places")).union(told.exceptAll(actual).withColumn("side", F.lit("build")))


def q33_coverage_floor(spark: SparkSession, d: str) -> DataFrame:
    """Countries of the holdout list with fewer than 30 places in force."""
    scope = table(spark, d, "h1").select(identity.country("iso3").alias("iso3")).where("iso3 is not null").distinct()
    n = places(spark, d).groupBy("iso3").agg(F.count("*").alias("n"))
    return scope.join(n, "iso3", "left").select("iso3", F.coalesce("n", F.lit(0)).alias("n")).where("n < 30")


def q34_lost_ids(spark: SparkSession, d: str) -> DataFrame:
    """Places of any build that the place table does not hold."""
    ids = table(spark, d, "place_build").select(identity.place_id("place_id").alias("place_id")).where("place_id is not null").distinct()
    now = table(spark, d, "place").select(identity.place_id("place_id").alias("place_id"))
    return ids.join(now, "place_id", "left_anti")


def q35_bad_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of all rows of places, English, local and every alias, that fail as names."""
    one = lambda c: F.struct(F.lit(c).alias("field"), F.col(c).alias("name"))
    aliases = F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: F.struct(F.lit("aliases").alias("field"), a.alias("name")))
    p = table(spark, d, "place").select(identity.place_id("place_id").alias("place_id"), F.explode(F.concat(F.array(one("name_en"), one("name_local")), aliases)).alias("n"))
    return p.select("place_id", "n.field", "n.name").where(bad_name(F.col("name"))).distinct()


def q36_fold_names(spark: SparkSession, d: str) -> DataFrame:
    return places(spark, d).where("name_en is not null").select("place_id", fold("name_en").alias("folded"))


def q37_short_name(spark: SparkSession, d: str) -> DataFrame:
    """Short forms of long titles made of name and note."""
    h = table(spark, d, "h1").select("golden_id", F.concat_ws(": ", "expected_name", "note").alias("name"), F.split("aliases", r"\|").alias("aliases")).distinct()
    return h.select("golden_id", "name", short_name("name", "aliases").alias("short"))


def q38_shared_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Places and candidates of one QID with the identity keys that they share."""
    keys = lambda q, w, h: F.array_compact(F.array(F.concat(F.lit("qid:"), q), F.concat(F.lit("wdpa:"), w), F.concat(F.lit("whs:"), h)))
    p = table(spark, d, "place").select(identity.place_id("place_id").alias("place_id"), identity.qid("qid").alias("qid"), "wdpa_id", "whs_id", "loaded_at")
    p = latest_rows(p.where("place_id is not null"), ["place_id"], "loaded_at", ["qid", "wdpa_id", "whs_id"]).select("place_id", "qid", keys(F.col("qid"), F.col("wdpa_id"), F.col("whs_id")).alias("a"))
    c = candidates(spark, d).select("qid", keys(F.col("qid"), F.col("wdpa"), F.col("whs")).alias("b"))
    shared = F.array_sort(F.array_intersect("a", F.filter("b", lambda k: k.rlike("^(whs|wdpa|qid):"))))
    return p.join(c, "qid").select("place_id", F.array_join(shared, "|").alias("shared"))


def q39_hash_sample(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.lower(F.trim("lang")).alias("lang"))
    return hash_sample(docs, "lang", "doc_id", 20, SEED)


def q40_resolver_status(spark: SparkSession, d: str) -> DataFrame:
    """Candidates near a holdout row: unique or ambiguous among the well cited, near for the others.

    As its SQL states: plainly typed numbers, one tolerance, no search by name or number. ``q40_resolver_candidates`` is the whole operator.
    """
    h = table(spark, d, "h1").select("golden_id", F.expr("try_cast(lat as double)").alias("hla"), F.expr("try_cast(lon as double)").alias("hlo"), F.coalesce(F.expr("try_cast(tol_km as double)"), F.lit(5.0)).alias("tol")).distinct()
    c = candidates(spark, d).select("qid", "sitelinks", "lat", "lon")
    near = points_near_points(h, c, F.col("tol"), ("hla", "hlo"), ("lat", "lon"))
    strong = near.groupBy("golden_id").agg(F.count_if(F.col("sitelinks") >= 15).alias("strong"))
    status = F.when(F.col("sitelinks") < 15, "near").when(F.col("strong") == 1, "unique").otherwise("ambiguous")
    return near.join(strong, "golden_id").select("golden_id", "qid", F.round("distance_km", 4).alias("km"), status.alias("status"))


def q40_resolver_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of every holdout row by World Heritage number, by any name or alias, and within 1.5 tolerances."""

    def folded(names: DataFrame) -> DataFrame:
        return names.where("trim(name) <> ''").withColumn("name", fold("name")).where("name <> ''").distinct()

    def numbered(df: DataFrame, key: str) -> DataFrame:
        """Suffixes of one property dropped; a component is no whole property."""
        number = F.regexp_replace(heritage_id(F.col("whs"), F.lit(True)), "(bis|ter|quater)$", "")
        return df.select(key, number.alias("number")).where("number is not null").distinct()

    h = table(spark, d, "h1").withColumn("golden_id", identity.squeeze("golden_id")).where("golden_id is not null")
    positions = h.select("golden_id", decimal("lat").alias("hla"), decimal("lon").alias("hlo"), tolerance_km("tol_km", 5.0).alias("tol")).distinct()
    typed = F.concat(F.array("expected_name"), F.split(F.coalesce("aliases", F.lit("")), r"\|"))
    names = folded(h.select("golden_id", F.explode(typed).alias("name")))
    a = table(spark, d, "admit").withColumn("qid", identity.qid("qid")).where("qid is not null")
    item_names = folded(a.select("qid", F.explode(F.array("label_en", "label_loc")).alias("name")))
    items = assemble(table(spark, d, "admit"), table(spark, d, "whs_properties")).select("qid", "lat", "lon", "sitelinks", fold(F.coalesce("label_en", "label_loc")).alias("label"))
    items = Stored(items, "items").df
    out = resolver_candidates(Stored(positions, "positions").df, Stored(names, "names").df, numbered(h.withColumnRenamed("whs_id", "whs"), "golden_id"), items, item_names, numbered(a, "qid"), 15)
    return out.withColumn("km", F.round("km", 4))


def q41_projections(spark: SparkSession, d: str) -> DataFrame:
    p = places(spark, d).where(geo.located(F.col("lat"), F.col("lon")) & (F.abs("lat") < 85))
    x, y = geo.equal_earth_mm(F.col("lat"), F.col("lon"))
    tx, ty = geo.tile_fraction(F.col("lat"), F.col("lon"), 12)
    return p.select("place_id", F.round(x, 5).alias("x_mm"), F.round(y, 5).alias("y_mm"), F.round(tx, 5).alias("tile_x"), F.round(ty, 5).alias("tile_y"), F.round(geo.metres_per_pixel(F.col("lat"), 12), 5).alias("mpp"))


def _plane(spark: SparkSession, d: str) -> DataFrame:
    p = places(spark, d).where(geo.located(F.col("lat"), F.col("lon")) & F.col("iso3").isNotNull())
    x, y = geo.equal_earth_mm(F.col("lat"), F.col("lon"))
    return p.select("iso3", F.col("place_id").alias("id"), F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


def q42_tile_partition(spark: SparkSession, d: str) -> DataFrame:
    return tile_partition(_plane(spark, d), "iso3", TileRule(most=40, least=5, extent=0.5, margin=0.01, slack=3))


def q43_widest_gap(spark: SparkSession, d: str) -> DataFrame:
    g = gap_windows(_plane(spark, d), "iso3", "x")
    return g.select("iso3", F.round("gap", 5).alias("gap"), F.round("position", 5).alias("position"))


def _quota(spark: SparkSession, d: str) -> DataFrame:
    p = places(spark, d).where("iso3 is not null")
    c = p.groupBy("iso3").agg(F.count("*").alias("n"), F.countDistinct("type", "tier").alias("kinds"), F.count_if(F.col("tier").isin("Icon", "Major")).alias("known"))
    weight = F.round(2.5 * F.log(1 + F.col("n") / 50.0) + 0.6 * F.col("kinds") + 1.2 * F.log(1.0 + F.col("known")), 9)
    return print_quota(c, weight, 500, F.col("kinds"))


def q44_print_quota(spark: SparkSession, d: str) -> DataFrame:
    return _quota(spark, d).select("iso3", "quota")


def q44_print_selection(spark: SparkSession, d: str) -> DataFrame:
    """Places for print: tier order within rounds of types, the first places of a build forced, local routes barred."""
    p = places(spark, d).where("iso3 is not null").withColumn("tier_rank", F.coalesce(identity.tier_rank("tier"), F.lit(-1)))
    forced = F.substring("place_id", 4, 2) == "00"
    barred = (F.col("type") == "route") & (F.col("tier") == "Local")
    return print_selection(p, _quota(spark, d), "iso3", "place_id", [F.col("tier_rank")], "type", forced, barred)


def q45_gap_sentence(spark: SparkSession, d: str) -> DataFrame:
    p = places(spark, d)
    missing = missing_kinds(p.withColumn("kind", F.concat_ws(" ", F.lower("tier"), "type")).where("tier is not null"), p.where("near is not null").select("place_id"), "iso3", "place_id", "kind")
    order = [f"{t} {k}" for t in ("icon", "major", "notable", "local") for k in ("settlement", "site", "area", "route")]
    return gap_sentence(missing, "iso3", "kind", order)


def q46_cohen_kappa(spark: SparkSession, d: str) -> DataFrame:
    """Agreement of the first and the last grade of documents graded more than once."""
    g = table(spark, d, "labels").where("grade is not null").groupBy("doc_id").agg(F.min(F.struct("labelled_at", "annotator", "grade")).alias("a"), F.max(F.struct("labelled_at", "annotator", "grade")).alias("b"), F.count("*").alias("k")).where("k > 1")
    return cohen_kappa(g.select(F.lit("all").alias("grp"), F.col("a.grade").alias("x"), F.col("b.grade").alias("y")), "x", "y", "grp")


def q47_kendall_tau(spark: SparkSession, d: str) -> DataFrame:
    """Agreement of two orders of the countries: by number of places and by Major places."""
    c = places(spark, d).where("iso3 is not null").groupBy("iso3").agg(F.count("*").alias("n"), F.count_if(F.col("tier").isin("Icon", "Major")).alias("known"))
    return kendall_tau(c.withColumn("grp", F.lit("countries")), "iso3", "n", "known", "grp")


def q48_json_props(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


def q49_grouped_names(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.groupBy("n_name").agg(F.array_join(F.array_sort(F.collect_set(F.col("s_suppkey").cast("string"))), "|").alias("suppliers"), F.count("*").alias("n"))


def q50_content_digest(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "place_build").select("build_no", "place_id", "qid", "tier", F.col("sitelinks").cast("string").alias("sitelinks"))
    return content_digest(b, "build_no", ["place_id", "qid", "tier", "sitelinks"])


def q51_last_write(spark: SparkSession, d: str) -> DataFrame:
    return last_write(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id", ["event_type"]).select("user_id", "event_type")


QUERIES = {f.__name__: f for f in (
    q28_monthly_views, q29_best_over_keys, q30_key_conflicts, q31_churn, q32_count_gate, q33_coverage_floor, q34_lost_ids, q35_bad_names, q36_fold_names, q37_short_name,
    q38_shared_evidence, q39_hash_sample, q40_resolver_status, q40_resolver_candidates, q41_projections, q42_tile_partition, q43_widest_gap, q44_print_quota, q44_print_selection, q45_gap_sentence,
    q46_cohen_kappa, q47_kendall_tau, q48_json_props, q49_grouped_names, q50_content_digest, q51_last_write,
)}

BUILDS = f"""
    br AS (SELECT build_no, lower(trim(place_id)) place_id, {sql_tier("tier")} tier, name_en, nullif(upper(trim(country_iso3)), '') iso3, loaded_at FROM place_build WHERE trim(place_id) <> '')"""
_EE = """
    ee AS (SELECT *, asin(sqrt(3) / 2 * sin(radians(lat))) t FROM lp),
    xy AS (SELECT *, radians(lon) * cos(t) / (sqrt(3) / 2 * (1.340264::DOUBLE + 3 * -0.081106::DOUBLE * t ** 2 + t ** 6 * (7 * 0.000893::DOUBLE + 9 * 0.003796::DOUBLE * t ** 2))) * (3000 * sqrt(3) / 2 * 1.340264::DOUBLE / (2 * pi())) x,
                  t * (1.340264::DOUBLE + -0.081106::DOUBLE * t ** 2 + t ** 6 * (0.000893::DOUBLE + 0.003796::DOUBLE * t ** 2)) * (3000 * sqrt(3) / 2 * 1.340264::DOUBLE / (2 * pi())) y FROM ee)"""
_QUOTA = f"""{PLACES},
    cq AS (SELECT iso3, count(*) n, count(DISTINCT CASE WHEN type IS NOT NULL AND tier IS NOT NULL THEN (type, tier) END) kinds, count(*) FILTER (tier IN ('Icon', 'Major')) known FROM pl WHERE iso3 IS NOT NULL GROUP BY 1),
    w AS (SELECT *, round(2.5::DOUBLE * ln(1 + n / 50.0::DOUBLE) + 0.6::DOUBLE * kinds + 1.2::DOUBLE * ln(1.0::DOUBLE + known), 9) w FROM cq),
    q0 AS (SELECT iso3, kinds, greatest(1, least(40, round(500 * w / sum(w) OVER (), 0)::INT)) q FROM w),
    quota AS (SELECT iso3, CASE WHEN kinds >= 6 THEN greatest(q, 6) ELSE q END quota FROM q0)"""

SQL = {
    "q28_monthly_views": """
        WITH m AS (SELECT o_custkey custkey, month(o_orderdate) m, count(*) v FROM orders WHERE year(o_orderdate) = 1995 GROUP BY ALL),
        f AS (SELECT c.custkey, t.m, coalesce(v, 0) v FROM (SELECT DISTINCT custkey FROM m) c CROSS JOIN range(1, 13) t(m) LEFT JOIN m ON m.custkey = c.custkey AND m.m = t.m)
        SELECT custkey, string_agg(v::VARCHAR, ',' ORDER BY m) views, sum(v)::BIGINT total FROM f GROUP BY 1""",
    "q29_best_over_keys": f"""
        WITH a AS (SELECT admit_id, {sql_qid("qid")} qid, alt_qids, sitelinks FROM admit),
        v AS (SELECT qid, max(sitelinks) s FROM a WHERE sitelinks >= 0 GROUP BY 1),
        e AS (SELECT admit_id, qid FROM a UNION SELECT admit_id, {sql_qid("u")} FROM (SELECT admit_id, unnest(alt_qids) u FROM a))
        SELECT admit_id, max(s) sitelinks FROM e LEFT JOIN v USING (qid) GROUP BY 1""",
    "q30_key_conflicts": f"""
        WITH p AS (SELECT lower(trim(place_id)) place_id, {sql_qid("qid")} qid, trim(wdpa_id) wdpa FROM place),
        k AS (SELECT place_id, 'qid:' || qid AS key FROM p WHERE qid IS NOT NULL UNION ALL SELECT place_id, 'wdpa:' || wdpa FROM p WHERE wdpa IS NOT NULL)
        SELECT key, count(DISTINCT place_id) places FROM k GROUP BY 1 HAVING places > 1""",
    "q31_churn": f"""
        WITH {BUILDS}, b AS (SELECT build_no, place_id, arg_max({{'t': tier, 'n': name_en, 'i': iso3}}, (loaded_at, tier, name_en, iso3)) r FROM br WHERE build_no IN (3, 4) GROUP BY ALL)
        SELECT o.r.i iso3, count(*) n, count(*) FILTER (c) changed, round(avg(c::INT), 6) share
        FROM (SELECT o.*, n.place_id IS NULL OR n.r.t IS DISTINCT FROM o.r.t OR n.r.n IS DISTINCT FROM o.r.n c FROM (FROM b WHERE build_no = 3) o LEFT JOIN (FROM b WHERE build_no = 4) n USING (place_id)) o GROUP BY 1""",
    "q32_count_gate": f"""
        WITH {PLACES}, {BUILDS}, b AS (SELECT place_id, arg_max({{'i': iso3}}, (loaded_at, iso3)).i iso3 FROM br WHERE build_no = 4 GROUP BY 1),
        a AS (SELECT iso3, grouping(iso3)::INT total, count(*) n FROM pl GROUP BY ROLLUP (iso3)), t AS (SELECT iso3, grouping(iso3)::INT total, count(*) n FROM b GROUP BY ROLLUP (iso3))
        SELECT *, 'places' side FROM (FROM a EXCEPT ALL FROM t) UNION ALL SELECT *, 'build' FROM (FROM t EXCEPT ALL FROM a)""",
    "q33_coverage_floor": f"""
        WITH {PLACES}, s AS (SELECT DISTINCT nullif(upper(trim(iso3)), '') iso3 FROM h1), n AS (SELECT iso3, count(*) n FROM pl GROUP BY 1)
        SELECT s.iso3, coalesce(n.n, 0) n FROM s LEFT JOIN n USING (iso3) WHERE s.iso3 IS NOT NULL AND coalesce(n.n, 0) < 30""",
    "q34_lost_ids": "SELECT DISTINCT lower(trim(place_id)) place_id FROM place_build WHERE trim(place_id) <> '' AND lower(trim(place_id)) NOT IN (SELECT lower(trim(place_id)) FROM place)",
    "q35_bad_names": r"""
        WITH n AS (SELECT lower(trim(place_id)) place_id, 'name_en' field, name_en AS name FROM place UNION ALL SELECT lower(trim(place_id)), 'name_local', name_local FROM place
                   UNION ALL SELECT lower(trim(place_id)), 'aliases', unnest(aliases) FROM place)
        SELECT DISTINCT place_id, field, name FROM n
        WHERE regexp_matches(name, '^[QPL]\p{Nd}+$|<|>|&#?[\p{L}\p{N}_]+;|[\x00-\x1f\x7f-\x{9f}\x{FFFD}]|Ã.|Â.', 's') OR length(name) > 60""",
    "q36_fold_names": f"WITH {PLACES} SELECT place_id, trim(replace(lower(strip_accents(name_en)), 'ß', 'ss')) folded FROM pl WHERE name_en IS NOT NULL",
    "q37_short_name": r"""
        WITH h AS (SELECT DISTINCT golden_id, concat_ws(': ', expected_name, note) name, string_split(aliases, '|') aliases FROM h1),
        c AS (SELECT *, regexp_replace(trim(regexp_replace(name, '\s+', ' ', 'g')), '^(.*), (The|A|An)$', '\2 \1') clean,
                     list_filter(list_transform(coalesce(aliases, []), lambda a: trim(regexp_replace(a, '\s+', ' ', 'g'))), lambda a: length(a) BETWEEN 3 AND 60) fit FROM h),
        s AS (SELECT *, list_filter([split_part(clean, ': ', 1), split_part(clean, ' – ', 1), split_part(clean, ' - ', 1), split_part(clean, ', ', 1)], lambda x: length(x) BETWEEN 3 AND 60) heads,
                     list_filter(fit, lambda a: length(a) = list_min(list_transform(fit, lambda b: length(b)))) shortest FROM c)
        SELECT golden_id, name, CASE WHEN length(clean) <= 60 THEN clean ELSE coalesce(shortest[1], heads[1], nullif(regexp_extract(left(clean, 60), '^(.*) [^ ]*$', 1), ''), left(clean, 60)) END short FROM s""",
    "q38_shared_evidence": f"""
        WITH {CANDIDATES}, {TYPED},
        p0 AS (SELECT lower(trim(place_id)) place_id, arg_max({{'q': qid, 'w': wdpa_id, 'h': whs_id}}, loaded_at) r FROM place GROUP BY 1),
        p AS (SELECT place_id, {sql_qid("r.q")} qid, r.w w, r.h h FROM p0)
        SELECT place_id, concat_ws('|', 'qid:' || p.qid, CASE WHEN p.w = c.wdpa THEN 'wdpa:' || p.w END, CASE WHEN p.h = c.whs THEN 'whs:' || p.h END) shared FROM p JOIN cand c USING (qid)""",
    "q39_hash_sample": f"""
        SELECT doc_id, lang FROM (SELECT doc_id, lower(trim(lang)) lang FROM documents) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5('{SEED}' || doc_id), doc_id) <= 20""",
    "q40_resolver_status": f"""
        WITH {CANDIDATES}, {TYPED}, h AS (SELECT DISTINCT golden_id, try_cast(lat AS DOUBLE) lat, try_cast(lon AS DOUBLE) lon, coalesce(try_cast(tol_km AS DOUBLE), 5.0) tol FROM h1),
        n AS (SELECT a.golden_id, b.qid, b.sitelinks, 2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) km, a.tol
              FROM h a JOIN cand b ON abs(a.lat - b.lat) <= 2 WHERE abs(a.lat) <= 90 AND abs(a.lon) <= 180 AND abs(b.lat) <= 90 AND abs(b.lon) <= 180 AND NOT isnan(b.lat) AND NOT isnan(b.lon) AND NOT (b.lat = 0 AND b.lon = 0) AND NOT (a.lat = 0 AND a.lon = 0)),
        k AS (SELECT *, count(*) FILTER (sitelinks >= 15) OVER (PARTITION BY golden_id) strong FROM n WHERE km <= tol)
        SELECT golden_id, qid, round(km, 4) km, CASE WHEN sitelinks < 15 THEN 'near' WHEN strong = 1 THEN 'unique' ELSE 'ambiguous' END status FROM k""",
    "q41_projections": f"""
        WITH {PLACES}, {_EE} SELECT place_id, round(x, 5) x_mm, round(y, 5) y_mm, round((lon + 180) / 360 * 4096, 5) tile_x,
               round((1 - asinh(tan(radians(lat))) / pi()) / 2 * 4096, 5) tile_y, round(156543.03392::DOUBLE * cos(radians(lat)) / 4096, 5) mpp FROM xy WHERE abs(lat) < 85""",
    "q43_widest_gap": f"""
        WITH {PLACES}, {_EE}, s AS (SELECT iso3, round(x, 6) a, lead(round(x, 6)) OVER (PARTITION BY iso3 ORDER BY round(x, 6), place_id) b FROM xy WHERE iso3 IS NOT NULL)
        SELECT iso3, round(max(b - a), 5) gap, round(arg_max((a + b) / 2, (b - a, -a)), 5) AS position FROM s WHERE b IS NOT NULL GROUP BY 1""",
    "q44_print_quota": f"WITH {_QUOTA} SELECT iso3, quota FROM quota",
    "q44_print_selection": f"""
        WITH {_QUOTA}, f AS (SELECT pl.*, substr(place_id, 4, 2) = '00' f, coalesce(list_position(['Local', 'Notable', 'Major', 'Icon'], tier), 0) rk FROM pl
                             WHERE iso3 IS NOT NULL AND NOT coalesce(type = 'route' AND tier = 'Local', false)),
        t AS (SELECT *, row_number() OVER (PARTITION BY iso3, type ORDER BY f DESC, rk DESC, place_id) turn FROM f),
        p AS (SELECT *, row_number() OVER (PARTITION BY iso3 ORDER BY f DESC, turn, rk DESC, place_id) AS position FROM t)
        SELECT iso3, place_id, position::INT AS position FROM p JOIN quota USING (iso3) WHERE f OR position <= quota""",
    "q45_gap_sentence": f"""
        WITH {PLACES}, k AS (SELECT DISTINCT iso3, lower(tier) || ' ' || type kind FROM pl WHERE tier IS NOT NULL AND iso3 IS NOT NULL),
        v AS (SELECT DISTINCT iso3, lower(tier) || ' ' || type kind FROM pl WHERE tier IS NOT NULL AND near IS NOT NULL),
        m AS (FROM k ANTI JOIN v ON k.iso3 = v.iso3 AND k.kind = v.kind)
        SELECT iso3, 'Not yet: ' || string_agg(kind, ', ' ORDER BY list_position(['icon', 'major', 'notable', 'local'], split_part(kind, ' ', 1)), list_position(['settlement', 'site', 'area', 'route'], split_part(kind, ' ', 2))) sentence FROM m GROUP BY 1""",
    "q46_cohen_kappa": """
        WITH g AS (SELECT doc_id, arg_min(grade, (labelled_at, annotator, grade)) x, arg_max(grade, (labelled_at, annotator, grade)) y FROM labels WHERE grade IS NOT NULL GROUP BY 1 HAVING count(*) > 1),
        n AS (SELECT count(*) n, avg((x = y)::INT) po FROM g),
        e AS (SELECT sum(p * q) e FROM (SELECT x l, count(*)::DOUBLE / (SELECT n FROM n) p FROM g GROUP BY 1) JOIN (SELECT y l, count(*)::DOUBLE / (SELECT n FROM n) q FROM g GROUP BY 1) USING (l))
        SELECT 'all' grp, n, CASE WHEN coalesce(e, 0) < 1 THEN round((po - coalesce(e, 0)) / (1 - coalesce(e, 0)), 6) END kappa FROM n, e WHERE n > 0""",
    "q47_kendall_tau": f"""
        WITH {PLACES}, c AS (SELECT iso3, count(*) n, count(*) FILTER (tier IN ('Icon', 'Major')) k FROM pl WHERE iso3 IS NOT NULL GROUP BY 1)
        SELECT 'countries' grp, (SELECT count(*) FROM c) n, round(sum(sign(b.k - a.k))::DOUBLE / ((SELECT count(*) FROM c) * ((SELECT count(*) FROM c) - 1) / 2), 6) tau FROM c a JOIN c b ON a.n < b.n""",
    "q48_json_props": "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) k FROM events",
    "q49_grouped_names": "SELECT n_name, string_agg(DISTINCT s_suppkey::VARCHAR, '|' ORDER BY s_suppkey::VARCHAR) suppliers, count(*) n FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1",
    "q50_content_digest": r"""
        SELECT build_no, count(*) AS rows, sum(('0x' || substr(sha256(concat_ws(chr(31), coalesce(place_id, chr(0)), coalesce(qid, chr(0)), coalesce(tier, chr(0)), coalesce(sitelinks::VARCHAR, chr(0)))), 1, 15))::BIGINT::HUGEINT)::VARCHAR digest
        FROM place_build GROUP BY 1""",
    "q51_last_write": "SELECT user_id, arg_max(event_type, (ts, event_id)) event_type FROM events GROUP BY 1",
}
