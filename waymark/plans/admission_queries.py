"""q05 to q14: selection, assembly, classification, admission, notability and tiers over ``admit``."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity
from ..operators.candidates import admit, assemble, classified, context_reason
from ..operators.latest import latest_rows
from ..operators.ranking import assign_tiers, country_rank, global_percentile, icon_count, notability, tier_violations, with_held
from ..runtime import Stored, table

TYPES = ["settlement", "site", "area", "route"]
# The vocabulary of kinds in priority order.
KINDS = ["capital", "metropolis", "old_town", "ruins", "sacred", "maritime", "seaside", "volcanic", "mountain", "desert", "wildlife", "forest", "water", "rural"]
LIVING = ["Q6900000000", "Q6900000001"]
PROTECTED = ["Q6900000205", "Q6900000206"]
CONTEXT = {"context": ["Q6900000203", "Q6900000310"], "destination": ["Q6900000200"], "large": ["Q6900000204"], "large_sitelinks": 60, "population": 2_000_000, "countries": 2}
ANCHORS = 997


def class_types(spark: SparkSession) -> DataFrame:
    """The rule table of the test data: 48 classes, twelve a type, numbered by hundreds; sites first, like the specific rows of a types table."""
    return spark.range(48).select(
        F.col("id").cast("int").alias("ord"),
        F.concat(F.lit("Q69"), F.lpad((F.element_at(F.array(F.lit(100), F.lit(200), F.lit(300), F.lit(0)), (F.col("id") / 12).cast("int") + 1) + F.col("id") % 12).cast("string"), 8, "0")).alias("class_qid"),
        F.element_at(F.array(*[F.lit(TYPES[i]) for i in (1, 2, 3, 0)]), (F.col("id") / 12).cast("int") + 1).alias("place_type"),
        F.when(F.col("id") % 3 != 0, F.element_at(F.array(*map(F.lit, KINDS)), (F.col("id") % 14).cast("int") + 1)).alias("kind_hint"),
        (F.col("id") % 12 != 11).alias("place_like"),
    )


def candidates(spark: SparkSession, d: str) -> DataFrame:
    cands = assemble(table(spark, d, "admit"), table(spark, d, "whs_properties"))
    return classified(cands, class_types(spark), LIVING)


def _notability() -> Column:
    return notability(protected=F.arrays_overlap("classes", F.array(*map(F.lit, PROTECTED))))


def _anchored() -> Column:
    return F.substring("qid", 2, 30).cast("bigint") % ANCHORS == 0


def admitted(spark: SparkSession, d: str) -> DataFrame:
    return admit(candidates(spark, d), _notability(), anchored=_anchored())


def q05_select_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Items worth a detail request, with every reason: sitelinks, population, heritage, protection, nodes, holdout parents."""
    rows = table(spark, d, "admit").select(identity.qid("qid").alias("qid"), "sitelinks", "population", "whs", "wdpa", "family").where("qid is not null")
    tests = {"sitelinks": F.col("sitelinks") >= 15, "population": F.col("population") >= 100_000, "whs": F.col("whs").isNotNull(), "wdpa": F.col("wdpa").isNotNull(), "node": F.col("family") == "node"}
    flagged = rows.groupBy("qid").agg(*[F.bool_or(F.coalesce(t, F.lit(False))).alias(k) for k, t in tests.items()])
    why = F.array_compact(F.array(*[F.when(F.col(k), F.lit(k)) for k in sorted(tests)]))
    return flagged.select("qid", F.array_join(why, "|").alias("why")).where("why <> ''")


def q06_semi_join(spark: SparkSession, d: str) -> DataFrame:
    """Extract rows of items that some well-cited row mentions."""
    cited = table(spark, d, "admit").where("sitelinks >= 40").select(identity.qid("qid").alias("qid"))
    return table(spark, d, "admit").select("admit_id", identity.qid("qid").alias("qid")).join(cited, "qid", "left_semi")


def q07_candidate_assembly(spark: SparkSession, d: str) -> DataFrame:
    c = assemble(table(spark, d, "admit"), table(spark, d, "whs_properties"))
    return c.select("qid", "iso3", F.array_join("isos", "|").alias("isos"), "sitelinks", "population", F.array_join("classes", "|").alias("classes"), F.array_join("heritage", "|").alias("heritage"), "label_en", "label_loc", "lat", "lon", "whs", "wdpa", "voyage")


def q08_first_class_hit(spark: SparkSession, d: str) -> DataFrame:
    return candidates(spark, d).select("qid", "place_type", "kind_hint", F.array_join("hints", "|").alias("hints"))


def q09_admission_rules(spark: SparkSession, d: str) -> DataFrame:
    return admitted(spark, d).select("qid", "iso3", F.array_join("rules", "|").alias("rules"))


def q10_context_reason(spark: SparkSession, d: str) -> DataFrame:
    return admitted(spark, d).select("qid", context_reason(CONTEXT).alias("why")).where("why <> ''")


def q11_notability(spark: SparkSession, d: str) -> DataFrame:
    return candidates(spark, d).select("qid", F.round(_notability(), 4).alias("n"))


def _ranked_input(spark: SparkSession, d: str) -> DataFrame:
    """What the ranks need, written once, since they read it several times."""
    return Stored(admitted(spark, d).select("qid", "iso3", "whs", F.round("n", 4).alias("n"), F.coalesce("label_en", "label_loc").alias("name_en")), "admitted").df


def q12_tiers(spark: SparkSession, d: str) -> DataFrame:
    return assign_tiers(_ranked_input(spark, d), ties=("qid",)).select("qid", "tier", "tier_reason")


def tier_grid() -> list[dict]:
    """All 108 settings of the calibration."""
    names = ("icon", "major_next", "major_pct", "notable_pct", "share")
    return [dict(zip(names, v)) for v in product((2, 4, 6), (20, 30), (93.0, 95.0, 97.0), (70.0, 75.0, 80.0), (0.3, 0.4))]


def q13_tier_grid(spark: SparkSession, d: str) -> DataFrame:
    """Shares of the tiers, and rows outside their expected bounds, at every setting of the grid.

    Ranks and percentiles do not depend on the settings, so they are computed once; a settings array is exploded on the rows
    and folded before the shuffle.
    """
    base = country_rank(with_held(global_percentile(_ranked_input(spark, d), "n", "_pct")), "iso3", "n", "qid")
    grid = F.array(*[F.struct(F.lit(i).alias("grid"), *[F.lit(v).alias(k) for k, v in g.items()]) for i, g in enumerate(tier_grid())])
    rows = base.select("qid", "rank", "size", "_pct", "_held", F.explode(grid).alias("g")).select("qid", "rank", "size", "_pct", "_held", "g.*")
    icons = F.col("icon") + icon_count(F.col("_held"), ((9, 0), (30, 2), (None, 4)))
    tier = (
        F.when(F.col("rank") < icons, "Icon")
        .when((F.col("_pct") >= F.col("major_pct")) | (F.col("rank") < icons + F.col("major_next")), "Major")
        .when((F.col("_pct") >= F.col("notable_pct")) | (F.col("rank") < F.col("share") * F.col("size")), "Notable")
        .otherwise("Local")
    )
    bounds = rows.withColumns({"tier": tier, "least": F.when(F.col("_pct") >= 90, "Notable"), "most": F.when(F.col("_pct") < 50, "Major")})
    judged = tier_violations(bounds, "tier", "least", "most")
    share = lambda t: F.round(F.avg((F.col("tier") == t).cast("double")), 6)
    return judged.groupBy("grid").agg(share("Icon").alias("icon_share"), share("Major").alias("major_share"), share("Notable").alias("notable_share"), F.count("violation").alias("violations"))


def q14_tier_diff(spark: SparkSession, d: str) -> DataFrame:
    """Places of builds 3 and 4 by whether and how their tier moved."""
    rows = table(spark, d, "place_build").where("build_no in (3, 4)").select("build_no", identity.place_id("place_id").alias("place_id"), identity.tier("tier").alias("tier"), "loaded_at").where("place_id is not null")
    one = latest_rows(rows, ["place_id", "build_no"], "loaded_at", ["tier"])
    both = one.groupBy("place_id").agg(F.count_if(F.col("build_no") == 3).alias("b"), F.count_if(F.col("build_no") == 4).alias("a"), F.max(F.when(F.col("build_no") == 3, F.col("tier"))).alias("before"), F.max(F.when(F.col("build_no") == 4, F.col("tier"))).alias("after"))
    rank = lambda c: F.coalesce(identity.tier_rank(c), F.lit(-1))
    move = F.when(F.col("b") == 0, "new").when(F.col("a") == 0, "gone").when(rank("after") > rank("before"), "up").when(rank("after") < rank("before"), "down").otherwise("same")
    return both.select("place_id", "before", "after", move.alias("move")).where("move <> 'same'")


QUERIES = {f.__name__: f for f in (q05_select_reasons, q06_semi_join, q07_candidate_assembly, q08_first_class_hit, q09_admission_rules, q10_context_reason, q11_notability, q12_tiers, q13_tier_grid, q14_tier_diff)}


def sql_qid(c: str) -> str:
    return rf"nullif(regexp_extract(upper({c}), '(?:^|[^A-Z0-9])(Q[0-9]+)\s*$', 1), '')"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def sql_tier(c: str) -> str:
    return f"CASE lower(trim({c})) WHEN 'icon' THEN 'Icon' WHEN 'major' THEN 'Major' WHEN 'notable' THEN 'Notable' WHEN 'local' THEN 'Local' END"


CANDIDATES = f"""
    x AS (SELECT *, {sql_qid("qid")} q, list_position(['attention', 'class', 'popall', 'institutional', 'detail', 'node'], family) fo,
                 coalesce(nullif(list_position(['popall', 'attention', 'class', 'institutional'], family), 0), 9) po,
                 regexp_replace(trim(whs), 'rev$', '') v FROM admit),
    x2 AS (SELECT *, coalesce(nullif(regexp_extract(v, '^([0-9]+)(?:bis|ter|quater|[-.][0-9]+)?$', 1), ''),
                              CASE WHEN len(regexp_extract_all(v, '[0-9]+')) = 1 THEN regexp_extract(v, '[0-9]+') END) num FROM x WHERE q IS NOT NULL),
    x3 AS (SELECT x2.*, CASE WHEN p.num IS NULL THEN NULL WHEN regexp_matches(v, '^[0-9]+(bis|ter|quater|[-.][0-9]+)?$') THEN v ELSE x2.num END wid
           FROM x2 LEFT JOIN (SELECT DISTINCT trim(id_number) num FROM whs_properties) p ON p.num = x2.num),
    cand AS (SELECT q qid, min(nullif(upper(trim(iso3)), '')) iso3, list_sort(list(DISTINCT nullif(upper(trim(iso3)), '')) FILTER (nullif(upper(trim(iso3)), '') IS NOT NULL)) isos,
                    coalesce(max(sitelinks) FILTER (sitelinks >= 0), 0)::INT sitelinks, nullif(max(population), 0) population,
                    coalesce(list_sort(list_distinct(flatten(list(classes) FILTER (classes IS NOT NULL)))), []) classes,
                    coalesce(list_sort(list_distinct(flatten(list(heritage) FILTER (heritage IS NOT NULL)))), []) heritage,
                    arg_max(label_en, (fo, admit_id)) FILTER (label_en IS NOT NULL) label_en, arg_max(label_loc, (fo, admit_id)) FILTER (label_loc IS NOT NULL) label_loc,
                    arg_min(lat, (po, admit_id)) FILTER (lat IS NOT NULL AND lon IS NOT NULL) lat, arg_min(lon, (po, admit_id)) FILTER (lat IS NOT NULL AND lon IS NOT NULL) lon,
                    arg_min(wid, (NOT regexp_matches(wid, '^[0-9]+(bis|ter|quater)?$'), fo, admit_id)) FILTER (wid IS NOT NULL) whs,
                    max(wdpa) wdpa, coalesce(bool_or(voyage), false) voyage
             FROM x3 GROUP BY q)"""

TYPED = f"""
    types AS (SELECT i ord, 'Q69' || lpad((([100, 200, 300, 0])[i // 12 + 1] + i % 12)::VARCHAR, 8, '0') class_qid, (['site', 'area', 'route', 'settlement'])[i // 12 + 1] place_type,
                     CASE WHEN i % 3 <> 0 THEN ({sql_list(KINDS)})[i % 14 + 1] END kind_hint, i % 12 <> 11 place_like FROM range(48) t(i)),
    hits AS (SELECT c.qid, t.*, bool_or(class_qid IN ({", ".join(f"'{x}'" for x in LIVING)})) OVER w AND bool_or(place_like AND place_type = 'settlement') OVER w alive
             FROM (SELECT qid, unnest(classes) k FROM cand) c JOIN types t ON t.class_qid = c.k WINDOW w AS (PARTITION BY c.qid)),
    counted AS (SELECT *, place_like AND (NOT alive OR place_type = 'settlement') ok FROM hits),
    typed AS (SELECT qid, arg_min(place_type, ord) FILTER (ok) place_type, min(ord) FILTER (ok) first_ord,
                     list(kind_hint ORDER BY ord) FILTER ((ok OR NOT place_like) AND kind_hint IS NOT NULL) hs FROM counted GROUP BY qid),
    c2 AS (SELECT cand.*, typed.place_type, types.kind_hint, typed.hs FROM cand LEFT JOIN typed USING (qid) LEFT JOIN types ON types.ord = typed.first_ord)"""

_WHOLE = "coalesce(regexp_matches(whs, '^[0-9]+(bis|ter|quater)?$'), false)"
_N = f"""round(log10(1.0::DOUBLE + greatest(sitelinks, 0)) + 0.0
         + least(CASE WHEN {_WHOLE} THEN 1.0::DOUBLE ELSE 0.0 END + CASE WHEN len(heritage) > 0 THEN 0.2::DOUBLE ELSE 0.0 END
                 + CASE WHEN list_has_any(classes, {sql_list(PROTECTED)}) THEN 0.5::DOUBLE ELSE 0.0 END, 1.5)
         + CASE WHEN coalesce(population, 0) >= 100000 THEN least(0.15::DOUBLE, 0.15::DOUBLE * log10(population / 100000.0::DOUBLE)) ELSE 0.0 END, 6)"""

ADMITTED = f"""
    n AS (SELECT *, {_N} n FROM c2 WHERE lat IS NOT NULL AND coalesce(label_en, label_loc) IS NOT NULL),
    r AS (SELECT *, list_filter([CASE WHEN {_WHOLE} THEN 'R1' END,
                 CASE WHEN place_type IS NOT NULL AND sitelinks >= 40 THEN 'R2' END,
                 CASE WHEN place_type = 'settlement' AND population >= 100000 THEN 'R3' END,
                 CASE WHEN place_type IS NOT NULL AND sitelinks >= 15 AND (len(heritage) > 0 OR wdpa IS NOT NULL OR (voyage AND place_type <> 'settlement')) THEN 'R4' END,
                 CASE WHEN substr(qid, 2)::BIGINT % {ANCHORS} = 0 THEN 'R6' END], lambda e: e IS NOT NULL) rules FROM n),
    f AS (SELECT *, row_number() OVER (PARTITION BY iso3, len(rules) = 0 AND place_type IS NOT NULL ORDER BY n DESC, qid) rn FROM r),
    adm AS (SELECT * EXCLUDE (rules, rn), CASE WHEN len(rules) = 0 THEN ['R5'] ELSE rules END rules FROM f
            WHERE len(rules) > 0 OR (place_type IS NOT NULL AND rn <= 5))"""

_WITH = f"WITH {CANDIDATES}, {TYPED}"
_RANKED = f"""{_WITH}, {ADMITTED},
    b AS (SELECT qid, iso3, whs, round(n, 4) n FROM adm),
    k AS (SELECT *, row_number() OVER (PARTITION BY iso3 ORDER BY n DESC, qid) - 1 rank, count(*) OVER (PARTITION BY iso3) size,
                 sum({_WHOLE}::INT) OVER (PARTITION BY iso3) held, 100.0::DOUBLE * (rank() OVER (ORDER BY n) - 1) / count(*) OVER () pct FROM b)"""

SQL = {
    "q05_select_reasons": f"""
        WITH a AS (SELECT {sql_qid("qid")} qid, bool_or(coalesce(sitelinks >= 15, false)) s, bool_or(coalesce(population >= 100000, false)) p,
                          bool_or(whs IS NOT NULL) h, bool_or(wdpa IS NOT NULL) w, bool_or(family = 'node') n FROM admit GROUP BY 1)
        SELECT qid, concat_ws('|', CASE WHEN n THEN 'node' END, CASE WHEN p THEN 'population' END, CASE WHEN s THEN 'sitelinks' END, CASE WHEN w THEN 'wdpa' END, CASE WHEN h THEN 'whs' END) why
        FROM a WHERE qid IS NOT NULL AND (s OR p OR h OR w OR n)""",
    "q06_semi_join": f"SELECT admit_id, {sql_qid('qid')} qid FROM admit WHERE {sql_qid('qid')} IN (SELECT {sql_qid('qid')} FROM admit WHERE sitelinks >= 40)",
    "q07_candidate_assembly": f"""
        WITH {CANDIDATES} SELECT qid, iso3, array_to_string(coalesce(isos, []), '|') isos, sitelinks, population, array_to_string(classes, '|') classes, array_to_string(heritage, '|') heritage,
                                 label_en, label_loc, lat, lon, whs, wdpa, voyage FROM cand""",
    "q08_first_class_hit": f"""
        {_WITH} SELECT qid, place_type, kind_hint,
        CASE WHEN qid IN (SELECT qid FROM typed) THEN array_to_string(list_filter(coalesce(hs, []), lambda h, i: list_position(hs, h) = i)[1:3], '|') END hints FROM c2""",
    "q09_admission_rules": f"{_WITH}, {ADMITTED} SELECT qid, iso3, array_to_string(rules, '|') rules FROM adm",
    "q10_context_reason": f"""
        {_WITH}, {ADMITTED}, why AS (SELECT qid, CASE
            WHEN list_has_any(classes, {sql_list(CONTEXT["context"])}) AND NOT list_has_any(classes, {sql_list(CONTEXT["destination"])}) AND whs IS NULL THEN 'continent, sea, ocean, river or historical country'
            WHEN list_has_any(classes, {sql_list(CONTEXT["large"])}) AND sitelinks >= 60 AND NOT list_has_any(classes, {sql_list(CONTEXT["destination"])}) AND whs IS NULL THEN 'a large feature known everywhere'
            WHEN place_type = 'area' AND population >= 2000000 THEN 'region of ' || population || ' inhabitants'
            WHEN place_type = 'area' AND len(isos) >= 2 AND sitelinks >= 100 AND NOT list_contains(rules, 'R1') THEN 'found in ' || len(isos) || ' countries' ELSE '' END why FROM adm)
        SELECT * FROM why WHERE why <> ''""",
    "q11_notability": f"{_WITH} SELECT qid, round({_N}, 4) n FROM c2",
    "q12_tiers": f"""
        {_RANKED}, t AS (SELECT qid, rank, size, pct, CASE WHEN size < 10 THEN 1 WHEN held <= 9 THEN 4 WHEN held <= 30 THEN 6 ELSE 8 END icons, CASE WHEN size < 10 THEN 3 ELSE 30 END nxt FROM k)
        SELECT qid, CASE WHEN rank < icons THEN 'Icon' WHEN pct >= 95 OR rank < icons + nxt THEN 'Major' WHEN pct >= 75 OR rank < 0.4::DOUBLE * size THEN 'Notable' ELSE 'Local' END tier,
               CASE WHEN rank < icons THEN 'top of its country' WHEN pct >= 95 OR rank < icons + nxt THEN 'global p95 or next of its country'
                    WHEN pct >= 75 OR rank < 0.4::DOUBLE * size THEN 'global p75 or top 40 % of country' ELSE 'the rest' END tier_reason FROM t""",
    "q13_tier_grid": f"""
        {_RANKED}, grid AS (SELECT * FROM (VALUES {", ".join(f"({i}, {g['icon']}, {g['major_next']}, {g['major_pct']}::DOUBLE, {g['notable_pct']}::DOUBLE, {g['share']}::DOUBLE)" for i, g in enumerate(tier_grid()))}) v(grid, icon, nxt, mp, np, share)),
        t AS (SELECT grid, pct, CASE WHEN rank < icon + extra THEN 3 WHEN pct >= mp OR rank < icon + extra + nxt THEN 2 WHEN pct >= np OR rank < share * size THEN 1 ELSE 0 END tr
              FROM (SELECT *, CASE WHEN held <= 9 THEN 0 WHEN held <= 30 THEN 2 ELSE 4 END extra FROM k) CROSS JOIN grid)
        SELECT grid, round(avg((tr = 3)::INT), 6) icon_share, round(avg((tr = 2)::INT), 6) major_share, round(avg((tr = 1)::INT), 6) notable_share,
               count(*) FILTER ((pct >= 90 AND tr < 1) OR (pct < 50 AND tr > 2)) violations FROM t GROUP BY grid""",
    "q14_tier_diff": f"""
        WITH r AS (SELECT build_no, lower(trim(place_id)) place_id, {sql_tier("tier")} tier, loaded_at FROM place_build WHERE trim(place_id) <> '' AND build_no IN (3, 4)),
        s AS (SELECT build_no, place_id, arg_max({{'t': tier}}, (loaded_at, tier)).t tier FROM r GROUP BY ALL),
        j AS (SELECT coalesce(o.place_id, n.place_id) place_id, o.tier "before", n.tier "after", o.place_id IS NULL isnew, n.place_id IS NULL gone,
                     coalesce(list_position(['Local', 'Notable', 'Major', 'Icon'], o.tier), 0) x, coalesce(list_position(['Local', 'Notable', 'Major', 'Icon'], n.tier), 0) y
              FROM (FROM s WHERE build_no = 3) o FULL JOIN (FROM s WHERE build_no = 4) n USING (place_id)),
        m AS (SELECT place_id, "before", "after", CASE WHEN isnew THEN 'new' WHEN gone THEN 'gone' WHEN y > x THEN 'up' WHEN y < x THEN 'down' ELSE 'same' END move FROM j)
        SELECT * FROM m WHERE move <> 'same'""",
}
