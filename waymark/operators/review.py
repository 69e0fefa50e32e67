"""Expectations against places and extracts, decisions on them, and read models for reviewers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import identity
from ..functions.text import fold
from ..functions.typed import decimal, tolerance_km
from .resolution import greedy_assignment
from .spatial import points_near_points

#: A place known by its QID may lie so far from an area's or a route's anchor, in km.
ANCHOR_KM = 150.0


def with_names(df: DataFrame, key: str, names: Column) -> DataFrame:
    """``df`` with ``names``, the distinct folded forms of an array of names that are no blanks; folding runs on exploded names."""
    one = df.select(key, F.explode(names).alias("_n")).where("trim(_n) <> ''").withColumn("_n", fold("_n")).where("_n <> ''")
    return df.drop("names").join(one.groupBy(key).agg(F.collect_set("_n").alias("names")), key, "left").withColumn("names", F.coalesce("names", F.array().cast("array<string>")))


def as_expectations(rows: DataFrame) -> DataFrame:
    """Rows of an expectation list as typed, one an id, in the columns that ``expectation_candidates`` reads, and row_kind,
    relation and targets where there are such."""
    one = rows.withColumn("golden_id", identity.squeeze("golden_id")).where("golden_id is not null").dropDuplicates(["golden_id"])
    has = set(rows.columns)
    typed = F.concat(F.array("expected_name"), F.split(F.coalesce("aliases", F.lit("")), r"\|")) if "aliases" in has else F.array("expected_name")
    out = one.select(
        "golden_id", *[c for c in ("row_kind", "relation") if c in has], identity.country("iso3").alias("iso3"), F.lower(identity.squeeze("type")).alias("type"), decimal("lat").alias("hla"), decimal("lon").alias("hlo"),
        tolerance_km("tol_km", 5.0).alias("tol"), identity.qid("qid").alias("qid"), *([F.filter(F.split("target_id", r"\|"), lambda t: t != "").alias("targets")] if "target_id" in has else []), typed.alias("_typed"),
    )
    return with_names(out, "golden_id", F.col("_typed")).drop("_typed")


def evidence_keys(places: DataFrame) -> Column:
    """Identity and heritage keys of a place and of the sources of its evidence."""
    none = F.array().cast("array<string>")
    has = set(places.columns)
    parts = [F.coalesce("keys", none)] + ([F.transform(F.coalesce("evidence", F.array()), lambda e: e["source_key"])] if "evidence" in has else [])
    whs = [F.array(F.concat(F.lit("whs:"), F.col("whs_id")))] if "whs_id" in has else []
    return F.filter(F.array_distinct(F.concat(*parts, *whs)), lambda k: F.coalesce(k.rlike("^(whs|wdpa|qid|ramsar):"), F.lit(False)))


def relational_problems(golden: DataFrame, matches: DataFrame, places: DataFrame) -> DataFrame:
    """``(golden_id, problem)`` of negative rows: a country without places, a component that is a place of its own, a target that no
    place stands for, and a place that carries the evidence of the target it must not be credited with.

    ``matches``: golden_id, place_id; ``places``: place_id, iso3, name_en, keys, and, where there are such, name_local, aliases,
    evidence, whs_id.
    """
    rows = as_expectations(golden).where("row_kind = 'negative'")
    has = set(places.columns)
    names = F.concat(F.array("name_en", *[c for c in ("name_local",) if c in has]), *([F.coalesce("aliases", F.array().cast("array<string>"))] if "aliases" in has else []))
    named = with_names(places.select("place_id", "iso3", evidence_keys(places).alias("keys"), names.alias("_typed")), "place_id", F.col("_typed")).drop("_typed")
    blank = rows.join(named.select("iso3").distinct(), "iso3", "left_anti").select("golden_id", F.lit("no place of its country").alias("problem"))
    known = rows.join(named.select("iso3").distinct(), "iso3", "left_semi")
    found = same_name_in_country(known, named)
    own = known.where("relation = 'component_of'").join(found, "golden_id").select("golden_id", F.concat(F.lit("is a place: "), "place_id").alias("problem"))
    credited = known.where("relation = 'not_credited'").select("golden_id", F.get("targets", F.lit(0)).alias("t"))
    at = credited.join(matches.select(F.col("golden_id").alias("t"), F.col("place_id").alias("target")), "t", "left")
    open_ = at.where("target is null").select("golden_id", F.lit("target without a place").alias("problem"))
    keys = named.select("place_id", "keys")
    both = at.join(found, "golden_id").join(keys, "place_id").join(keys.toDF("target", "tkeys"), "target").where(F.arrays_overlap("keys", "tkeys"))
    return blank.union(own).union(open_).union(both.select("golden_id", F.concat(F.lit("shares evidence: "), F.array_join(F.array_sort(F.array_intersect("keys", "tkeys")), " ")).alias("problem")))


def expectation_candidates(rows: DataFrame, places: DataFrame, loose: bool = False) -> DataFrame:
    """``(golden_id, place_id, km)``: the places that a row can mean.

    ``rows``: golden_id, iso3, type, hla, hlo, tol, qid, names (folded); ``places``: place_id, iso3, type, lat, lon, keys (``qid:`` and
    others), names. A row with a QID means the place of the country that has it among its keys: within the tolerance, or
    ``ANCHOR_KM`` for an area or a route, whatever the type. A row without one means places of its country and type within
    the tolerance that share a name. ``loose`` takes the latter for rows with a QID too, to find second ones. Rows without
    position or tolerance mean nothing.
    """
    r = rows.select("golden_id", F.col("iso3").alias("riso"), F.col("type").alias("rtype"), "hla", "hlo", F.col("tol"), F.col("qid").alias("rqid"), F.col("names").alias("rnames"))
    reach = F.when(F.col("rqid").isNotNull() & F.col("rtype").isin("area", "route"), F.greatest(F.col("tol"), F.lit(ANCHOR_KM))).otherwise(F.col("tol"))
    p = places.select("place_id", F.col("iso3").alias("piso"), F.col("type").alias("ptype"), "lat", "lon", "keys", F.col("names").alias("pnames"))
    near = points_near_points(r.withColumn("reach", reach), p, F.col("reach"), ("hla", "hlo"), ("lat", "lon"), same=[("riso", "piso")])
    known = F.col("rqid").isNotNull() & F.array_contains(F.coalesce("keys", F.array().cast("array<string>")), F.concat(F.lit("qid:"), F.coalesce("rqid", F.lit(""))))
    alike = (F.col("rtype") == F.col("ptype")) & (F.col("distance_km") <= F.col("tol")) & F.arrays_overlap("rnames", "pnames")
    fits = known | (alike if loose else alike & F.col("rqid").isNull())
    return near.where(fits).select("golden_id", "place_id", F.col("distance_km").alias("km"))


def assign_expectations(rows: DataFrame, places: DataFrame) -> DataFrame:
    """``(golden_id, place_id, state)``: ``matched`` one to one, nearest first; ``duplicate`` for further places of a matched row that
    no row has (an area spans several, so it has none); ``missed`` with a null place."""
    found = expectation_candidates(rows, places)
    matched = greedy_assignment(found, "golden_id", "place_id", "km").select("golden_id", "place_id")
    second = expectation_candidates(rows.where("coalesce(type, '') <> 'area'"), places, loose=True).select("golden_id", "place_id")
    second = second.join(matched.select("golden_id"), "golden_id", "left_semi").join(matched.select("place_id"), "place_id", "left_anti").select("golden_id", "place_id").distinct()
    missed = rows.select("golden_id").distinct().join(matched, "golden_id", "left_anti").select("golden_id", F.lit(None).cast("string").alias("place_id"))
    tagged = lambda df, state: df.withColumn("state", F.lit(state))
    return tagged(matched, "matched").union(tagged(second, "duplicate")).union(tagged(missed, "missed"))


def same_name_in_country(rows: DataFrame, places: DataFrame) -> DataFrame:
    """``(golden_id, place_id)`` of one country that share a folded name, wherever they lie. Both have iso3 and names."""
    named = lambda df, key: df.select(key, "iso3", F.explode(F.array_distinct("names")).alias("name")).where("name <> ''")
    return named(rows, "golden_id").join(named(places, "place_id"), ["iso3", "name"]).select("golden_id", "place_id").distinct()


def overlapping_expectations(left: DataFrame, right: DataFrame, km: float = 1.0) -> DataFrame:
    """``(left_id, right_id)``: rows of two lists that are about one thing: of one country, with a common name or, of one type, within ``km``.

    Both have golden_id, iso3, type, hla, hlo, names.
    """
    a = left.select(F.col("golden_id").alias("left_id"), F.col("iso3").alias("liso"), F.col("type").alias("ltype"), F.col("hla").alias("la"), F.col("hlo").alias("lo"))
    b = right.select(F.col("golden_id").alias("right_id"), F.col("iso3").alias("riso"), F.col("type").alias("rtype"), F.col("hla").alias("ra"), F.col("hlo").alias("ro"))
    near = points_near_points(a, b, km, ("la", "lo"), ("ra", "ro"), same=[("liso", "riso"), ("ltype", "rtype")])
    named = same_name_in_country(left, right.withColumnRenamed("golden_id", "place_id"))
    return near.where(F.col("distance_km") < km).select("left_id", "right_id").union(named.toDF("left_id", "right_id")).distinct()


def recall_by(expected: DataFrame, extracts: DataFrame, group: str) -> DataFrame:
    """``(group, family, expected, found)``: how many expected QIDs of a group the extracts of each family, and any (null), hold.

    ``expected``: qid and the group; ``extracts``: qid, family. Groups without any hit have their row of the null family.
    """
    total = expected.groupBy(group).agg(F.countDistinct("qid").alias("expected"))
    held = expected.select(group, "qid").distinct().join(extracts.select("qid", "family").where("family is not null").distinct(), "qid")
    per = held.groupBy(group, "family").agg(F.countDistinct("qid").alias("found"))
    any_ = held.groupBy(group).agg(F.countDistinct("qid").alias("found")).select(group, F.lit(None).cast("string").alias("family"), "found")
    blank = total.join(any_.select(group), group, "left_anti").select(group, F.lit(None).cast("string").alias("family"), F.lit(0).cast("bigint").alias("found"))
    return per.union(any_).union(blank).join(total, group).select(group, "family", "expected", "found")


def diagnose_misses(missed: DataFrame, candidates: DataFrame, merged: DataFrame) -> DataFrame:
    """``(golden_id, cause, detail)`` of expected QIDs without a place: merged into another place, no candidate, no place-like
    class, or below the floors. ``candidates``: qid, place_type, sitelinks; ``merged``: qid, parent."""
    j = missed.join(merged.select("qid", "parent"), "qid", "left").join(candidates.select("qid", F.lit(True).alias("_c"), "place_type", "sitelinks"), "qid", "left")
    cause = F.when(F.col("parent").isNotNull(), "merged").when(F.col("_c").isNull(), "no candidate").when(F.col("place_type").isNull(), "no place-like class").otherwise("below the floors")
    detail = F.when(F.col("parent").isNotNull(), F.col("parent")).when(F.col("_c"), F.concat(F.lit("sitelinks "), F.col("sitelinks").cast("string")))
    return j.select("golden_id", cause.alias("cause"), detail.alias("detail"))


def decision_problems(golden: DataFrame, decisions: DataFrame) -> DataFrame:
    """``(golden_id, qid, problem)`` of accepted decisions: on no positive row, no QID, or a QID that another row has or is given."""
    accepted = decisions.where("decision = 'accept'").select("golden_id", "qid").distinct()
    positive = golden.where("row_kind = 'positive'").select("golden_id", F.lit(True).alias("_p")).distinct()
    uses = golden.where("coalesce(qid, '') <> ''").select("qid", "golden_id").union(accepted.select("qid", "golden_id")).distinct()
    shared = uses.groupBy("qid").agg(F.count("*").alias("_n")).where("_n > 1")
    j = accepted.join(positive, "golden_id", "left").join(shared, "qid", "left")
    problem = F.when(F.col("_p").isNull(), "not a positive row").when(~F.coalesce(F.col("qid").rlike("^Q[0-9]+$"), F.lit(False)), "no QID").when(F.col("_n").isNotNull(), "QID of several rows")
    return j.select("golden_id", "qid", problem.alias("problem")).where("problem is not null")


def apply_decisions(golden: DataFrame, decisions: DataFrame, day: str) -> DataFrame:
    """``golden`` with the QIDs of accepted decisions and the day in ``qid_status``; any problem of a decision is an error."""
    bad = decision_problems(golden, decisions).limit(3).collect()
    if bad:
        raise ValueError("; ".join(f"{r['golden_id']}: {r['problem']}" for r in bad))
    accepted = decisions.where("decision = 'accept'").groupBy("golden_id").agg(F.max("qid").alias("_q"))
    j = golden.join(accepted, "golden_id", "left")
    return j.withColumns({"qid": F.coalesce("_q", "qid"), "qid_status": F.when(F.col("_q").isNotNull(), F.lit(f"resolved {day}")).otherwise(F.col("qid_status"))}).drop("_q")


def label_problems(expected: DataFrame, found: DataFrame) -> DataFrame:
    """``(class_qid, problem)`` where a class has no label or another one than expected; labels are folded by the caller."""
    j = expected.select("class_qid", "expected").join(found.select("class_qid", "label"), "class_qid", "left")
    problem = F.when(F.col("label").isNull(), "not found").when(F.col("label") != F.col("expected"), F.concat(F.lit("is "), "label"))
    return j.select("class_qid", problem.alias("problem")).where("problem is not null")


def shuffle_key(qid: Column) -> Column:
    """A number below 2**24 from the SHA-1 of the QID, by which viewers shuffle alike."""
    return F.conv(F.substring(F.sha1(qid), 1, 6), 16, 10).cast("int")


def place_filter(tab: str | None = None, country: str | None = None, tier: str | None = None, kind: str | None = None, type_: str | None = None, text: str | None = None) -> Column:
    """The viewer's filter on a table of kinds (array), sample, iso3, tier, type, folded name, place_id and qid; kind ``none``: without kinds."""
    out = F.lit(True)
    if tab == "sample":
        out = out & F.col("sample")
    for c, v in (("iso3", country), ("tier", tier), ("type", type_)):
        out = out if v is None else out & (F.col(c) == v)
    if kind is not None:
        out = out & (F.size("kinds") == 0 if kind == "none" else F.array_contains("kinds", kind))
    if text:
        out = out & (F.contains(F.col("folded"), F.lit(text)) | (F.col("place_id") == text) | (F.lower("qid") == text.lower()))
    return F.coalesce(out, F.lit(False))


def absorption_summary(log: DataFrame) -> DataFrame:
    """``(rule, absorbed, sites, differ)`` by the first two words of the reason: all, those that are sites, those of another kind hint.

    ``log``: reason, child_type, child_hint, parent_hint.
    """
    rule = F.array_join(F.slice(F.split("reason", " "), 1, 2), " ")
    differ = (F.coalesce("child_hint", F.lit("")) != "") & (F.coalesce("parent_hint", F.lit("")) != "") & (F.col("child_hint") != F.col("parent_hint"))
    return log.groupBy(rule.alias("rule")).agg(F.count("*").alias("absorbed"), F.count_if(F.col("child_type") == "site").alias("sites"), F.count_if(differ).alias("differ"))


def tile_summary(tiles: DataFrame, group: str, bound: int) -> DataFrame:
    """``(group, tiles, least, median, under)``: number of tiles, their least and median number of places, and tiles below a bound. ``tiles``: group, tile."""
    size = tiles.groupBy(group, "tile").agg(F.count("*").alias("n"))
    return size.groupBy(group).agg(F.count("*").alias("tiles"), F.min("n").alias("least"), F.median("n").alias("median"), F.count_if(F.col("n") < bound).alias("under"))


def bias_audit(rows: DataFrame, groups: list[str], judged: Column) -> DataFrame:
    """Per group: number, share judged true, and its difference from the share of all. Nulls of ``judged`` count as false."""
    hit = F.coalesce(judged, F.lit(False)).cast("double")
    total = rows.agg(F.avg(hit).alias("_all"))
    per = rows.groupBy(*groups).agg(F.count("*").alias("n"), F.avg(hit).alias("share"))
    # The total is one row.
    return per.join(F.broadcast(total), F.lit(True)).select(*groups, "n", F.round("share", 6).alias("share"), F.round(F.col("share") - F.col("_all"), 6).alias("gap"))


def after_redirects(rows: DataFrame, redirects: DataFrame, key: str = "qid") -> DataFrame:
    """``rows`` with ``key`` replaced by where it redirects to, at most one step, before anything is matched. ``redirects``: key, target."""
    known = redirects.where("target is not null").groupBy(F.col(key).alias("_k")).agg(F.min("target").alias("_t"))
    return rows.join(known, F.col(key) == F.col("_k"), "left").withColumn(key, F.coalesce("_t", key)).drop("_k", "_t")
