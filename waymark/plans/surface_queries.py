"""q59 to q84: expectations, decisions, read models, grids, statements of items, and round trips through readers and writers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import claims, identity, raster
from ..functions.geo import located, tile_fraction
from ..functions.text import fold
from ..operators import kindrules, review
from ..operators.candidates import whole_property
from ..operators.kinds import fire, select_kinds
from ..operators.latest import current_places
from ..operators.resolution import survivors
from ..operators.spatial import nearest
from ..runtime import Stored, scratch_root, table
from ..sources import readers, remote, writers
from .admission_queries import ADMITTED, CANDIDATES, KINDS, LIVING, PROTECTED, TYPED, admitted, candidates, sql_list, sql_qid, sql_tier
from .place_queries import PLACES, places




def _expected(spark: SparkSession, d: str) -> DataFrame:
    """Holdout rows as expectations; a row takes the QID of the place that holds its heritage number."""
    h1 = table(spark, d, "h1")
    h = review.as_expectations(h1).drop("qid").join(h1.select(identity.squeeze("golden_id").alias("golden_id"), F.regexp_extract("whs_id", "^([0-9]+)", 1).alias("w")).dropDuplicates(["golden_id"]), "golden_id")
    numbers = current_places(table(spark, d, "place"), "whs_id", "qid").select(F.trim("whs_id").alias("w"), identity.qid("qid").alias("qid")).where("w <> '' and qid is not null").groupBy("w").agg(F.min("qid").alias("qid"))
    return h.join(numbers, "w", "left").drop("w")


def _named_places(spark: SparkSession, d: str) -> DataFrame:
    p = current_places(table(spark, d, "place"), "type", "name_en", "name_local", "aliases", "country_iso3", "lat", "lon", "qid").select(
        "place_id", F.lower(F.trim("type")).alias("type"), identity.country("country_iso3").alias("iso3"), "lat", "lon", identity.qid("qid").alias("qid"),
        F.concat(F.array("name_en", "name_local"), F.coalesce("aliases", F.array().cast("array<string>"))).alias("typed"),
    )
    p = p.withColumn("keys", F.array_compact(F.array(F.concat(F.lit("qid:"), "qid"))))
    return Stored(review.with_names(p, "place_id", F.col("typed")).drop("typed"), "named").df


def q59_capital_states(spark: SparkSession, d: str) -> DataFrame:
    """Items by whether some record of theirs makes them the capital of a lasting or a past state (classes stand for states')."""
    a = table(spark, d, "admit").select(identity.qid("qid").alias("qid"), "classes", F.col("voyage").alias("ended")).where("qid is not null")
    s = a.groupBy("qid").agg(F.collect_list(F.struct("classes", "ended")).alias("s"))
    return s.select("qid", kindrules.capital_state(F.col("s"), LIVING, PROTECTED).alias("capital")).where("capital is not null")


def _facts(spark: SparkSession, d: str) -> DataFrame:
    """Admitted candidates with the facts of the kind rules. The test data have no survey of the land: the coast is the nearest
    route, categories follow from heritage statements, and cover and relief come from the grid of vectors."""
    c = Stored(admitted(spark, d).select("qid", "lat", "lon", "classes", "heritage", "place_type", "population", "wdpa", "whs"), "admitted").df
    routes = places(spark, d).where("type = 'route'").select(F.col("place_id").alias("route"), F.col("lat").alias("bl"), F.col("lon").alias("bo"))
    coast = nearest(c.select("qid", "lat", "lon"), routes, "qid", "route", ("lat", "lon"), ("bl", "bo"), 60.0).select("qid", F.round("distance_km", 4).alias("coast_km"))
    sets = _class_sets(spark)
    members = table(spark, d, "admit").select(F.explode(F.transform("alt_qids", identity.qid)).alias("qid"), "classes", F.coalesce("voyage", F.lit(False)).alias("nested")).where("qid is not null and classes is not null")
    hit = kindrules.member_rules(c, members.join(c.select("qid"), "qid", "left_semi"), sets)
    titles = table(spark, d, "whs_properties").select(F.trim("id_number").alias("whs"), F.col("site").alias("whs_title")).where("site is not null").groupBy("whs").agg(F.min("whs_title").alias("whs_title"))
    n = table(spark, d, "embeddings").count()
    grid = table(spark, d, "embeddings").select("vec_id", raster.class_shares(_codes(), 8, 3.0, {"tree": 4, "crop": 5, "grass": 6, "water": 3, "wetland": 7, "bare": 2}).alias("s"), raster.relief(_metres(), 8, 4.0, 4.0, 3.0, 1.5).alias("r"))
    cell = F.pmod(F.substring("qid", 2, 30).cast("bigint"), F.lit(n))
    full = c.withColumn("vec_id", cell).join(grid, "vec_id", "left").join(coast, "qid", "left").join(hit, "qid", "left").join(titles, "whs", "left")
    capital = F.when(F.arrays_overlap("classes", F.array(*map(F.lit, LIVING))) & ~F.arrays_overlap("classes", F.array(*map(F.lit, PROTECTED))), "now").when(F.arrays_overlap("classes", F.array(*map(F.lit, PROTECTED))), "past")
    return full.select(
        "qid", "place_type", "population", "coast_km", "core", "support", "whs_title", capital.alias("capital"), "s.*", F.round("r.relief", 2).alias("relief"), F.round("r.top", 2).alias("summit"),
        F.when(F.col("wdpa").isNotNull(), F.element_at(F.array(*map(F.lit, ("Ia", "II", "V", "VI"))), F.least(F.size("heritage") + 1, F.lit(4)))).alias("iucn_cat"), F.lit(False).alias("big_city"),
    )


def _class_sets(spark: SparkSession) -> DataFrame:
    """The class table of the test data: the k-th class of a hundred fires the k-th class rule."""
    rules = F.array(*map(F.lit, kindrules.CLASS_RULES))
    return spark.range(40).select(F.element_at(rules, (F.col("id") % 10 + 1).cast("int")).alias("rule_id"), F.concat(F.lit("Q69"), F.lpad((F.floor(F.col("id") / 10) * 100 + F.col("id") % 10).cast("string"), 8, "0")).alias("class_qid"))


def _codes():
    return F.transform("embedding", lambda v: F.greatest(F.lit(0), F.floor(v.cast("double") * 10) + 5).cast("int"))


def _metres():
    return F.transform("embedding", lambda v: v.cast("double") * 3000 + 1000)


def q60_kind_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rules that fire on every candidate, with the role that the hit has."""
    fired = fire(_facts(spark, d), kindrules.RULES, kindrules.kind_tests()).withColumn("fired", kindrules.role_by_source(F.col("fired")))
    return fired.select("qid", F.explode("fired").alias("f")).select("qid", "f.rule", "f.kind", "f.role")


def q61_rule_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Kinds chosen from the fired rules, with what was cut and why."""
    fired = fire(_facts(spark, d), kindrules.RULES, kindrules.kind_tests()).withColumn("fired", kindrules.role_by_source(F.col("fired")))
    s = select_kinds(Stored(fired, "fired").df, KINDS, kindrules.pair_conditions())
    return s.select("qid", F.array_join(F.transform("kept", lambda c: c["kind"]), "|").alias("kinds"), "crowded", F.array_join(F.array_sort(F.transform("cut", lambda c: F.concat(c["kind"], F.lit("="), c["reason"]))), "|").alias("cut"))


def q62_expected_places(spark: SparkSession, d: str) -> DataFrame:
    found = review.expectation_candidates(_expected(spark, d).where("row_kind = 'positive'"), _named_places(spark, d))
    return found.select("golden_id", "place_id", F.round("km", 4).alias("km"))


def q62_expectation_states(spark: SparkSession, d: str) -> DataFrame:
    rows = Stored(_expected(spark, d).where("row_kind = 'positive'"), "rows").df
    return review.assign_expectations(rows, _named_places(spark, d))


def q63_same_name(spark: SparkSession, d: str) -> DataFrame:
    return review.same_name_in_country(_expected(spark, d), _named_places(spark, d))


def q63_relational_problems(spark: SparkSession, d: str) -> DataFrame:
    """Every row with a name taken as a component that must not be a place of its own."""
    golden = table(spark, d, "h1").withColumns({"row_kind": F.lit("negative"), "relation": F.lit("component_of")})
    p = _named_places(spark, d).select("place_id", "iso3", "keys").join(places(spark, d).select("place_id", "name_en"), "place_id")
    return review.relational_problems(golden, spark.createDataFrame([], "golden_id string, place_id string"), p)


def q64_overlapping_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = Stored(_expected(spark, d), "rows").df
    return review.overlapping_expectations(rows, rows).where("left_id < right_id")


def q65_recall(spark: SparkSession, d: str) -> DataFrame:
    """Of the places in force, by country, how many QIDs each family of extracts holds."""
    extracts = table(spark, d, "admit").select(identity.qid("qid").alias("qid"), "family").where("qid is not null")
    return review.recall_by(places(spark, d).where("qid is not null and iso3 is not null").select("iso3", "qid"), extracts, "iso3")


def q66_diagnosis(spark: SparkSession, d: str) -> DataFrame:
    """Why places of the list have no admitted candidate."""
    c = Stored(candidates(spark, d).select("qid", "whs", "place_type", "sitelinks"), "candidates").df
    merged = survivors(c.where(whole_property(F.col("whs"))), "whs", "qid", ["sitelinks", "qid"]).where("qid <> survivor").select("qid", F.col("survivor").alias("parent"))
    missed = places(spark, d).where("qid is not null").select(F.col("place_id").alias("golden_id"), "qid").join(admitted(spark, d).select("qid").join(merged.select("qid"), "qid", "left_anti"), "qid", "left_anti")
    return review.diagnose_misses(missed, c, merged)


def q67_decision_problems(spark: SparkSession, d: str) -> DataFrame:
    """Decisions that take for a row any candidate of its country with its heritage number or name."""
    golden = table(spark, d, "h1").select(identity.squeeze("golden_id").alias("golden_id"), "row_kind", "qid").distinct()
    e = _expected(spark, d)
    decisions = e.where("qid is not null").select("golden_id", "qid", F.lit("accept").alias("decision"))
    other = e.where("row_kind <> 'positive'").select("golden_id", F.col("iso3").alias("qid"), F.lit("accept").alias("decision"))
    return review.decision_problems(golden, decisions.union(other))


def q68_compact(spark: SparkSession, d: str) -> DataFrame:
    """The viewer's rows: position in display order, shuffle key, and whether a filter shows them."""
    p = places(spark, d).where("qid is not null and tier is not null and name_en is not null")
    p = p.withColumns({"kinds": F.array(F.concat_ws(" ", F.lower("tier"), "type")), "sample": F.substring("place_id", 4, 1) == "a", "folded": fold("name_en")})
    shown = review.place_filter(tab="sample", tier="Notable", type_="site", kind="notable site", text="a")
    return p.select("place_id", review.shuffle_key(F.col("qid")).alias("turn"), shown.alias("shown"))


def q69_absorption_summary(spark: SparkSession, d: str) -> DataFrame:
    """Summary of the merges of one property, with the hints of both sides."""
    c = Stored(candidates(spark, d).select("qid", "whs", "place_type", "kind_hint", "sitelinks"), "candidates").df
    pairs = survivors(c.where(whole_property(F.col("whs"))), "whs", "qid", ["sitelinks", "qid"]).where("qid <> survivor")
    log = pairs.join(c.select("qid", F.col("place_type").alias("child_type"), F.col("kind_hint").alias("child_hint")), "qid").join(c.select(F.col("qid").alias("survivor"), F.col("kind_hint").alias("parent_hint")), "survivor")
    reason = F.concat(F.when(F.col("child_type") == "site", "same property ").otherwise("shared property "), F.col("whs"))
    return review.absorption_summary(log.withColumn("reason", reason))


def q70_tile_summary(spark: SparkSession, d: str) -> DataFrame:
    p = places(spark, d).where(located(F.col("lat"), F.col("lon")) & (F.abs("lat") < 85) & F.col("iso3").isNotNull())
    x, y = tile_fraction(F.col("lat"), F.col("lon"), 6)
    t = p.select("iso3", F.concat_ws("/", F.floor(x), F.floor(y)).alias("tile"))
    return review.tile_summary(t, "iso3", 5)


def q71_bias_audit(spark: SparkSession, d: str) -> DataFrame:
    """Share of places with a position by country and type against the share of all."""
    return review.bias_audit(places(spark, d).withColumn("ok", located(F.col("lat"), F.col("lon"))), ["iso3", "type"], F.col("ok"))


def q72_redirects(spark: SparkSession, d: str) -> DataFrame:
    """Records of every item after an item with other names has been redirected to the least of them."""
    a = table(spark, d, "admit").select("admit_id", identity.qid("qid").alias("qid"), F.array_min(F.transform("alt_qids", identity.qid)).alias("target")).where("qid is not null")
    moved = review.after_redirects(a.select("admit_id", "qid"), a.where("target <> qid").select("qid", "target"))
    return moved.groupBy("qid").agg(F.count("*").alias("n"), F.min("admit_id").alias("first_id"))


def q73_grid_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Relief, summit and class shares within circles of the grids that the vectors are."""
    e = table(spark, d, "embeddings").select("vec_id", raster.relief(_metres(), 8, 4.0, 4.0, 3.0, 1.5).alias("r"), raster.class_shares(_codes(), 8, 3.0, {"tree": 4, "water": 3}).alias("s"), raster.terrarium_metres(F.lit(128.0), F.floor(F.element_at("embedding", 1) * 100) + 100.0, F.lit(64.0)).alias("metres"))
    return e.select("vec_id", F.round("r.relief", 3).alias("relief"), F.round("r.top", 3).alias("top"), F.round("r.centre", 3).alias("centre"), "s.tree", "s.water", "metres")


def _entities(spark: SparkSession, d: str) -> DataFrame:
    """Admission rows as the items' JSON texts; the last class of a row is a deprecated statement."""
    a = table(spark, d, "admit").select("admit_id", identity.qid("qid").alias("qid"), "label_en", "label_loc", "classes", "voyage", "sitelinks").where("qid is not null")
    item = lambda q: F.struct(F.struct(F.struct(q.alias("id")).alias("value")).alias("datavalue"))
    n = F.size("classes")
    p31 = F.transform("classes", lambda c, i: F.struct(F.when(i == n - 1, "deprecated").otherwise("normal").alias("rank"), item(c)["datavalue"].alias("x"), F.struct(item(c)["datavalue"].alias("datavalue")).alias("mainsnak")).dropFields("x"))
    when = F.array(F.struct(F.lit("normal").alias("rank"), F.struct(F.struct(F.struct(F.concat(F.lit("-0"), F.lpad(F.least(F.greatest(F.coalesce("sitelinks", F.lit(0)), F.lit(0)), F.lit(999)).cast("string"), 3, "0"), F.lit("-04-21T00:00:00Z")).alias("time")).alias("value")).alias("datavalue")).alias("mainsnak")))
    end = F.when(F.col("voyage"), F.create_map(F.lit("P582"), F.lit("x")))
    capital = F.transform(F.slice("classes", 1, 1), lambda c: F.struct(F.lit("normal").alias("rank"), F.struct(item(c)["datavalue"].alias("datavalue")).alias("mainsnak"), end.alias("qualifiers")))
    text = lambda c: F.struct(c.alias("value"))
    body = F.struct(
        F.col("qid").alias("id"), F.struct(text(F.col("label_en")).alias("en"), text(F.col("label_loc")).alias("xx")).alias("labels"), F.struct(F.struct(F.col("label_en").alias("title")).alias("enwiki"), F.struct(F.col("label_en").alias("title")).alias("xxwiki"), F.struct(F.col("label_en").alias("title")).alias("enquote")).alias("sitelinks"),
        F.struct(p31.alias("P31"), p31.alias("P279"), when.alias("P571"), capital.alias("P1376")).alias("claims"),
    )
    return a.select("admit_id", "qid", F.to_json(body).alias("entity"))


def q74_entities(spark: SparkSession, d: str) -> DataFrame:
    e = _entities(spark, d)
    c = claims.entity_columns(F.col("entity"), F.col("qid"), ["xx"])
    capital = F.transform(c["capital_of"], lambda x: F.concat(x["qid"], F.when(x["ended"], "-").otherwise("+")))
    return e.select("admit_id", c["label_en"].alias("label_en"), c["label_loc"].alias("label_loc"), F.array_join(c["instance_of"], "|").alias("classes"), c["inception"].alias("inception"), F.array_join(capital, "|").alias("capital_of"), c["missing"].alias("missing"))


def q75_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Wikis of every item, and the label and parents that it has as a class."""
    e = _entities(spark, d)
    p, c = claims.profile_columns(F.col("entity")), claims.class_columns(F.col("entity"))
    return e.select("admit_id", F.array_join(p["wikis"], "|").alias("wikis"), c["label"].alias("label"), F.array_join(c["parents"], "|").alias("parents"))


def q76_bindings(spark: SparkSession, d: str) -> DataFrame:
    """Extract rows from query bindings: items as addresses, positions as text."""
    a = table(spark, d, "admit").where("qid is not null and lat is not null and not isnan(lat) and not isnan(lon)")
    uri = lambda c: F.concat(F.lit("http://example.org/entity/"), c)
    b = F.create_map(
        F.lit("item"), uri(identity.qid("qid")), F.lit("coord"), F.concat(F.lit("Point("), F.col("lon").cast("string"), F.lit(" "), F.col("lat").cast("string"), F.lit(")")), F.lit("sl"), F.col("sitelinks").cast("string"),
        F.lit("pop"), F.col("population").cast("string"), F.lit("insts"), F.array_join(F.transform("classes", uri), "|"), F.lit("label_en"), F.col("label_en"),
    )
    c = claims.binding_columns(b)
    return a.select("admit_id", c["qid"].alias("qid"), c["lat"].alias("lat"), c["lon"].alias("lon"), c["sitelinks"].alias("sitelinks"), c["population"].alias("population"), F.array_join(c["instance_of"], "|").alias("classes"), c["label_en"].alias("label_en"))


def q77_capital_bindings(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "admit").where("qid is not null and classes is not null")
    b = F.create_map(F.lit("cap"), F.concat(F.lit("x/"), identity.qid("qid")), F.lit("state"), F.concat(F.lit("x/"), F.get("classes", F.lit(0))), F.lit("classes"), F.array_join("classes", "|"), F.lit("ended"), F.when(F.col("voyage"), "true").otherwise("0"))
    c = claims.capital_columns(b)
    return a.select("admit_id", c["cap"].alias("cap"), c["state"].alias("state"), F.array_join(c["classes"], "|").alias("classes"), c["ended"].alias("ended"))


def q78_view_answers(spark: SparkSession, d: str) -> DataFrame:
    """Monthly orders of every customer, from page-view answers made of the orders; and the customer's name as a path."""
    o = table(spark, d, "orders").where("year(o_orderdate) = 1995").groupBy(F.col("o_custkey").alias("custkey"), F.date_format("o_orderdate", "yyyyMM").alias("m")).agg(F.count("*").alias("n"))
    answer = o.groupBy("custkey").agg(F.to_json(F.struct(F.collect_list(F.struct(F.concat("m", F.lit("0100")).alias("timestamp"), F.col("n").alias("views"))).alias("items"))).alias("a"))
    j = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), F.concat("c_name", F.lit(" / é*")).alias("name")).join(answer, "custkey", "left")
    views = claims.monthly_views(F.col("a"), "199501")
    return j.select("custkey", F.array_join(F.transform(views, lambda v: v.cast("string")), ",").alias("views"), claims.title_path(F.col("name")).alias("path"))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:10]}"


def q79_line_files(spark: SparkSession, d: str) -> DataFrame:
    """Admission rows through JSON lines behind a header object, read by an explicit schema."""
    where = _scratch(spark, "lines")
    rows = table(spark, d, "admit").select("admit_id", "qid", "lat", "classes", "voyage")
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).union(spark.createDataFrame([('{"_meta": {"complete": true}}',)], "value string")).write.text(where)
    back = readers.read_lines(spark, where, "admit_id bigint, qid string, lat double, classes array<string>, voyage boolean, absent string")
    return back.select("admit_id", "qid", "lat", F.array_join("classes", "|").alias("classes"), "voyage", "absent")


def q80_sorted_files(spark: SparkSession, d: str) -> DataFrame:
    """Places through sorted Parquet and CSV; a column that the file lacks comes back null, a file that is not there empty."""
    p = places(spark, d).select("place_id", "iso3", "tier", "name_en")
    parquet, csv = _scratch(spark, "sorted"), _scratch(spark, "csv")
    writers.write_sorted(p.drop("tier"), parquet, ["iso3", "place_id"])
    writers.write_csv(p, csv, ["place_id"])
    a = readers.read_or_empty(spark, parquet, "place_id string, iso3 string, tier string, name_en string").unionByName(readers.read_or_empty(spark, parquet + "-none", "place_id string, iso3 string, tier string, name_en string"))
    b = readers.read_rules(spark, csv, "place_id string, iso3 string, tier string, name_en string").drop("ord")
    return a.withColumn("file", F.lit("parquet")).unionByName(b.withColumn("file", F.lit("csv")))


def q81_bundle(spark: SparkSession, d: str) -> DataFrame:
    """Places through a bundle of country files, counted against its manifest and hashes."""
    where = _scratch(spark, "bundle")
    p = places(spark, d).where("iso3 is not null and qid is not null").select("place_id", "type", "name_en", "iso3", "lat", "lon", "tier", "qid", F.array(F.concat(F.lit("qid:"), "qid")).alias("keys"), F.lit("active").alias("status"))
    manifest = writers.write_bundle(p, where, "b1")
    told = spark.createDataFrame(list(manifest["counts"]["per_country"].items()), "iso3 string, told long")
    files = writers.file_hashes(spark, where)
    same = files.join(spark.createDataFrame(list(manifest["hashes"].items()), "file string, sha256 string"), ["file", "sha256"], "left_anti").isEmpty()
    back = readers.read_bundle(spark, where).groupBy("iso3").agg(F.count("*").alias("n"), F.min("place_id").alias("first_id"), F.max("qid").alias("last_qid"))
    return back.join(told, "iso3", "full").select("iso3", "n", "told", "first_id", "last_qid", F.lit(same).alias("intact"))


def q82_protected(spark: SparkSession, d: str) -> DataFrame:
    """Protected areas from two files with columns of two generations; the last row of an id counts, strict and large ones are told."""
    a = table(spark, d, "admit").where("wdpa is not null").groupBy("wdpa").agg(F.min("admit_id").alias("first_id"), F.max("admit_id").alias("last_id"), F.min(identity.country("iso3")).alias("iso3"))
    form = lambda id_, cats: a.select("wdpa", F.concat_ws(";", F.lit("ZZZ"), "iso3").alias("iso"), F.lit("Designated").alias("st"), F.element_at(F.array(*map(F.lit, cats)), (F.col(id_) % 3 + 1).cast("int")).alias("cat"), (F.col(id_) % 250).cast("string").alias("area"))
    one, two = _scratch(spark, "wdpa"), _scratch(spark, "wdpa")
    writers.write_csv(form("first_id", ("Ia", "V", "VI")).toDF("WDPAID", "ISO3", "STATUS", "IUCN_CAT", "REP_AREA"), one, ["WDPAID"])
    writers.write_csv(form("last_id", ("II", "Ib", "V")).where("st is not null and cast(area as int) % 2 = 0").toDF("SITE_ID", "PRNT_ISO3", "STATUS", "IUCN_CAT", "GIS_AREA"), two, ["SITE_ID"])
    scope = [r[0] for r in a.select("iso3").where("iso3 is not null").distinct().collect()]  # countries of the rules, bounded
    out = readers.reduce_protected(spark, [one, two], scope)
    return out.select("wdpa", "iso3", "iucn_cat", "area_km2", readers.strict_and_large(F.col("iucn_cat"), F.col("area_km2")).alias("strict"))


def q83_jobs(spark: SparkSession, d: str) -> DataFrame:
    """The plan of jobs for every nation and three classes, one band of one nation read in slices."""
    names = [r[0] for r in table(spark, d, "nation").select("n_name").orderBy("n_name").collect()]
    jobs = remote.plan_jobs(names, ["Q1", "Q2", "Q3"], {(names[0], "attention", (25, 40)): ((25, 30), (30, 40))})
    return spark.createDataFrame([(j.country, j.family, j.name, len(j.slices)) for j in jobs], "country string, family string, job string, slices int")


def q84_remote_rows(spark: SparkSession, d: str) -> DataFrame:
    """Customers of every nation through the remote source, in pages; jobs that are done are not read again."""

    def fetch(job, part, offset, page):
        import pyarrow.parquet as pq

        rows = pq.read_table(f"{d}/customer.parquet", columns=["c_custkey", "c_name"], filters=[("c_nationkey", "=", int(job.country))])
        rows = rows.sort_by("c_custkey").slice(offset, page)
        return [{"qid": f"Q{k}", "name": n} for k, n in zip(rows["c_custkey"].to_pylist(), rows["c_name"].to_pylist())]

    jobs = [remote.Job(str(r[0]), "popall") for r in table(spark, d, "nation").select("n_nationkey").collect()]
    done = spark.createDataFrame([("3/popall",)], "job string")
    rows = remote.read_remote(spark, f"customers_{uuid.uuid4().hex[:8]}", jobs, fetch, done, page=50)
    return rows.where("row is not null").select("job", F.get_json_object("row", "$.qid").alias("qid"), F.get_json_object("row", "$.name").alias("name"))


def q85_preflight(spark: SparkSession, d: str) -> DataFrame:
    """Nations whose label is not what was expected, those of one region being called otherwise."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("label"), "n_regionkey")
    told = n.select("id", F.when(F.col("n_regionkey") == 2, F.lower("label")).otherwise(F.col("label")).alias("expected"))
    return remote.preflight(told, n.select("id", "label"))


def q86_registry(spark: SparkSession, d: str) -> DataFrame:
    """Ids of all builds through the registry's files, where each leads, and keys that several hold."""
    from .build_queries import _registered

    where = _scratch(spark, "registry")
    r = _registered(spark, d).where("size(keys) > 0")
    flat = r.select("place_id", F.array_join("keys", "|").alias("keys"), F.concat(F.lit(" "), "status").alias("status"), F.lit("b1").alias("minted_build"), F.lit("b1").alias("last_seen_build"), F.lit(None).cast("string").alias("tombstone_reason"))
    writers.write_csv(flat, where + ".csv", ["place_id"])
    back = readers.read_registry(spark, where + ".csv")
    return back.select("place_id", F.array_join("keys", "|").alias("keys"), "status")


QUERIES = {f.__name__: f for f in (
    q59_capital_states, q60_kind_rules, q61_rule_kinds, q62_expected_places, q62_expectation_states, q63_same_name, q63_relational_problems, q64_overlapping_rows, q65_recall, q66_diagnosis, q67_decision_problems, q68_compact,
    q69_absorption_summary, q70_tile_summary, q71_bias_audit, q72_redirects, q73_grid_statistics, q74_entities, q75_profiles, q76_bindings, q77_capital_bindings, q78_view_answers, q79_line_files,
    q80_sorted_files, q81_bundle, q82_protected, q83_jobs, q84_remote_rows, q85_preflight, q86_registry,
)}

_FOLD = "trim(replace(lower(strip_accents({0})), 'ß', 'ss'))"
_NUMBER = "try_cast(replace(regexp_replace({0}, '[^0-9.,+\\-eE]', '', 'g'), ',', '.') AS DOUBLE)"
_KM = "2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin(radians(b.lat - a.hla) / 2), 2) + cos(radians(a.hla)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.hlo) / 2), 2))))"
_EXPECTED = rf"""{PLACES},
    np AS (SELECT lower(trim(place_id)) place_id, arg_max({{'w': whs_id, 'q': qid, 's': status, 'nl': name_local, 'al': aliases}}, loaded_at) r FROM place GROUP BY 1),
    wq AS (SELECT trim(r.w) w, min({sql_qid("r.q")}) qid FROM np WHERE coalesce(lower(trim(r.s)) <> 'retired', true) AND trim(r.w) <> '' AND {sql_qid("r.q")} IS NOT NULL GROUP BY 1),
    h0 AS (SELECT DISTINCT ON (golden_id) trim(golden_id) golden_id, row_kind, nullif(upper(trim(iso3)), '') iso3, lower(trim(type)) AS type, {_NUMBER.format("lat")} hla, {_NUMBER.format("lon")} hlo,
                  coalesce(nullif(try_cast(replace(regexp_extract(tol_km, '([0-9]+(?:[.,][0-9]+)?)', 1), ',', '.') AS DOUBLE), 0), 5.0) tol, regexp_extract(whs_id, '^([0-9]+)', 1) w,
                  list_concat([expected_name], string_split(coalesce(aliases, ''), '|')) typed FROM h1),
    h AS (SELECT h0.*, wq.qid, list_filter(list_transform(list_filter(typed, lambda x: trim(x) <> ''), lambda x: {_FOLD.format("x")}), lambda x: x <> '') names FROM h0 LEFT JOIN wq USING (w)),
    e AS (SELECT pl.*, list_filter(list_transform(list_filter(list_concat([name_en, r.nl], coalesce(r.al, [])), lambda x: trim(x) <> ''), lambda x: {_FOLD.format("x")}), lambda x: x <> '') names
          FROM pl JOIN np USING (place_id))"""
_AT_H = "hla IS NOT NULL AND hlo IS NOT NULL AND abs(hla) <= 90 AND abs(hlo) <= 180 AND NOT (hla = 0 AND hlo = 0)"
_AT = "lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon) AND abs(lat) <= 90 AND abs(lon) <= 180 AND NOT (lat = 0 AND lon = 0)"
_MERGED = """mg AS (SELECT whs, qid, first_value(qid) OVER (PARTITION BY whs ORDER BY sitelinks DESC, qid DESC) survivor FROM c2 WHERE regexp_matches(whs, '^[0-9]+(bis|ter|quater)?$')),
    gone AS (SELECT * FROM mg WHERE qid <> survivor)"""
_ROWS = f"SELECT admit_id, {sql_qid('qid')} q, * EXCLUDE (admit_id) FROM admit WHERE {sql_qid('qid')} IS NOT NULL"

SQL = {
    "q59_capital_states": f"""
        WITH a AS (SELECT {sql_qid("qid")} qid, coalesce(list_has_any(classes, {sql_list(LIVING)}), false) sv, coalesce(list_has_any(classes, {sql_list(PROTECTED)}), false) hs, coalesce(voyage, false) en FROM admit),
        g AS (SELECT qid, bool_or(NOT en AND sv AND NOT hs) n, bool_or(hs OR (en AND sv)) p FROM a WHERE qid IS NOT NULL GROUP BY 1)
        SELECT qid, CASE WHEN n THEN 'now' ELSE 'past' END capital FROM g WHERE n OR p""",
    "q62_expected_places": f"""
        WITH {_EXPECTED}, j AS (SELECT a.golden_id, b.place_id, {_KM} km, a.tol, a.type ht, b.type pt, a.qid hq, b.qid pq, list_has_any(a.names, b.names) alike
              FROM h a JOIN e b ON a.iso3 = b.iso3 WHERE a.row_kind = 'positive' AND {_AT_H} AND {_AT})
        SELECT golden_id, place_id, round(km, 4) km FROM j
        WHERE (hq = pq AND km <= CASE WHEN ht IN ('area', 'route') THEN greatest(tol, 150.0) ELSE tol END) OR (hq IS NULL AND ht = pt AND km <= tol AND alike)""",
    "q63_same_name": f"""
        WITH {_EXPECTED}, n AS (SELECT DISTINCT golden_id, iso3, unnest(names) nm FROM h), m AS (SELECT DISTINCT place_id, iso3, unnest(names) nm FROM e)
        SELECT DISTINCT golden_id, place_id FROM n JOIN m USING (iso3, nm)""",
    "q63_relational_problems": f"""
        WITH {_EXPECTED}, n AS (SELECT DISTINCT golden_id, iso3, unnest(names) nm FROM h), m AS (SELECT place_id, iso3, {_FOLD.format("name_en")} nm FROM pl WHERE trim(name_en) <> '')
        SELECT DISTINCT golden_id, 'is a place: ' || place_id problem FROM n JOIN m USING (iso3, nm)
        UNION ALL SELECT golden_id, 'no place of its country' FROM h WHERE iso3 NOT IN (SELECT iso3 FROM pl WHERE iso3 IS NOT NULL) OR iso3 IS NULL""",
    "q64_overlapping_rows": f"""
        WITH {_EXPECTED}, b AS (SELECT golden_id, iso3, type, hla lat, hlo lon, names FROM h)
        SELECT DISTINCT a.golden_id left_id, b.golden_id right_id FROM h a JOIN b ON a.iso3 = b.iso3
        WHERE a.golden_id < b.golden_id AND (list_has_any(a.names, b.names) OR (a.type = b.type AND {_AT_H} AND abs(b.lat) <= 90 AND abs(b.lon) <= 180 AND NOT (b.lat = 0 AND b.lon = 0) AND {_KM} < 1.0))""",
    "q65_recall": f"""
        WITH {PLACES}, x AS (SELECT DISTINCT iso3, qid FROM pl WHERE qid IS NOT NULL AND iso3 IS NOT NULL), f AS (SELECT DISTINCT {sql_qid("qid")} qid, family FROM admit WHERE family IS NOT NULL),
        t AS (SELECT iso3, count(*) expected FROM x GROUP BY 1), k AS (SELECT iso3, family, count(DISTINCT qid) found FROM x JOIN f USING (qid) GROUP BY ALL),
        y AS (SELECT iso3, NULL::VARCHAR family, count(DISTINCT qid) FILTER (f.family IS NOT NULL) found FROM x LEFT JOIN f USING (qid) GROUP BY 1)
        SELECT iso3, family, expected, found FROM (FROM k UNION ALL FROM y) JOIN t USING (iso3)""",
    "q66_diagnosis": f"""
        WITH {CANDIDATES}, {TYPED}, {ADMITTED}, {PLACES}, {_MERGED},
        m AS (SELECT place_id golden_id, qid FROM pl WHERE qid IS NOT NULL AND qid NOT IN (SELECT qid FROM adm WHERE qid NOT IN (SELECT qid FROM gone)))
        SELECT golden_id, CASE WHEN g.survivor IS NOT NULL THEN 'merged' WHEN c.qid IS NULL THEN 'no candidate' WHEN c.place_type IS NULL THEN 'no place-like class' ELSE 'below the floors' END cause,
               CASE WHEN g.survivor IS NOT NULL THEN g.survivor WHEN c.qid IS NOT NULL THEN 'sitelinks ' || c.sitelinks END detail FROM m LEFT JOIN gone g USING (qid) LEFT JOIN c2 c ON c.qid = m.qid""",
    "q67_decision_problems": f"""
        WITH {_EXPECTED}, dc AS (SELECT DISTINCT golden_id, qid FROM h WHERE qid IS NOT NULL UNION SELECT golden_id, iso3 FROM h WHERE row_kind <> 'positive'),
        s AS (SELECT qid FROM dc GROUP BY 1 HAVING count(DISTINCT golden_id) > 1),
        x AS (SELECT golden_id, qid, CASE WHEN NOT EXISTS (FROM h WHERE h.golden_id = dc.golden_id AND row_kind = 'positive') THEN 'not a positive row'
                     WHEN NOT coalesce(regexp_matches(qid, '^Q[0-9]+$'), false) THEN 'no QID' WHEN qid IN (FROM s) THEN 'QID of several rows' END problem FROM dc)
        SELECT * FROM x WHERE problem IS NOT NULL""",
    "q68_compact": f"""
        WITH {PLACES} SELECT place_id, ('0x' || substr(sha1(qid), 1, 6))::INT turn,
               coalesce(substr(place_id, 4, 1) = 'a' AND tier = 'Notable' AND type = 'site' AND (contains({_FOLD.format("name_en")}, 'a')), false) shown
        FROM pl WHERE qid IS NOT NULL AND tier IS NOT NULL AND name_en IS NOT NULL""",
    "q69_absorption_summary": f"""
        WITH {CANDIDATES}, {TYPED}, {_MERGED}
        SELECT CASE WHEN a.place_type = 'site' THEN 'same property' ELSE 'shared property' END AS rule, count(*) absorbed, count(*) FILTER (a.place_type = 'site') sites, count(*) FILTER (a.kind_hint <> b.kind_hint) differ
        FROM gone JOIN c2 a ON a.qid = gone.qid JOIN c2 b ON b.qid = gone.survivor GROUP BY 1""",
    "q70_tile_summary": f"""
        WITH {PLACES}, t AS (SELECT iso3, floor((lon + 180) / 360 * 64) x, floor((1 - asinh(tan(radians(lat))) / pi()) / 2 * 64) y, count(*) n FROM lp WHERE abs(lat) < 85 AND iso3 IS NOT NULL GROUP BY ALL)
        SELECT iso3, count(*) tiles, min(n) least, median(n)::DOUBLE AS median, count(*) FILTER (n < 5) AS under FROM t GROUP BY 1""",
    "q71_bias_audit": f"""
        WITH {PLACES}, o AS (SELECT iso3, type, coalesce({_AT}, false)::INT ok FROM pl)
        SELECT iso3, type, count(*) n, round(avg(ok), 6) share, round(avg(ok) - (SELECT avg(ok) FROM o), 6) gap FROM o GROUP BY ALL""",
    "q72_redirects": f"""
        WITH a AS (SELECT admit_id, {sql_qid("qid")} qid, list_min(list_filter(list_transform(alt_qids, lambda x: {sql_qid("x")}), lambda x: x IS NOT NULL)) t FROM admit),
        k AS (SELECT qid, min(t) t FROM a WHERE t <> qid GROUP BY 1)
        SELECT coalesce(k.t, a.qid) qid, count(*) n, min(admit_id) first_id FROM a LEFT JOIN k USING (qid) WHERE a.qid IS NOT NULL GROUP BY 1""",
    "q73_grid_statistics": """
        WITH c AS (SELECT vec_id, unnest(embedding)::DOUBLE v, generate_subscripts(embedding, 1) - 1 i FROM embeddings),
        g AS (SELECT *, v * 3000 + 1000 m, greatest(0, floor(v * 10) + 5)::INT k, pow(i // 8 - 4, 2) + pow(i % 8 - 4, 2) d, pow(i // 8 - 3.5, 2) + pow(i % 8 - 3.5, 2) md FROM c)
        SELECT vec_id, round(max(m) FILTER (d <= 9) - min(m) FILTER (d <= 9), 3) relief, round(max(m) FILTER (d <= 2.25), 3) top, round(max(m) FILTER (i = 36), 3) centre,
               round(count(*) FILTER (md <= 9 AND k = 4) / nullif(count(*) FILTER (md <= 9 AND k > 0), 0)::DOUBLE, 4) tree, round(count(*) FILTER (md <= 9 AND k = 3) / nullif(count(*) FILTER (md <= 9 AND k > 0), 0)::DOUBLE, 4) water,
               128.0::DOUBLE * 256 + max(floor((v::FLOAT * 100)::DOUBLE)) FILTER (i = 0) + 100 + 64.0::DOUBLE / 256 - 32768 metres FROM g GROUP BY 1""",
    "q74_entities": f"""
        SELECT admit_id, label_en, label_loc, array_to_string(coalesce(classes[1:len(classes) - 1], []), '|') classes, -least(greatest(coalesce(sitelinks, 0), 0), 999)::INT inception,
               CASE WHEN classes IS NOT NULL THEN coalesce(classes[1] || CASE WHEN voyage THEN '-' ELSE '+' END, '') END capital_of, false missing FROM ({_ROWS})""",
    "q75_profiles": f"SELECT admit_id, 'enwiki|xxwiki' wikis, label_en AS label, array_to_string(coalesce(classes[1:len(classes) - 1], []), '|') parents FROM ({_ROWS})",
    "q76_bindings": f"""
        SELECT admit_id, {sql_qid("qid")} qid, lat, lon, sitelinks, population, array_to_string(list_filter(classes, lambda x: x <> ''), '|') classes, label_en FROM admit
        WHERE qid IS NOT NULL AND lat IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)""",
    "q77_capital_bindings": f"SELECT admit_id, {sql_qid('qid')} cap, classes[1] state, array_to_string(classes, '|') classes, coalesce(voyage, false) ended FROM admit WHERE qid IS NOT NULL AND classes IS NOT NULL",
    "q78_view_answers": """
        WITH m AS (SELECT o_custkey k, month(o_orderdate) m, count(*) v FROM orders WHERE year(o_orderdate) = 1995 GROUP BY ALL),
        f AS (SELECT c.k, t.m, coalesce(v, 0) v FROM (SELECT DISTINCT k FROM m) c CROSS JOIN range(1, 13) t(m) LEFT JOIN m ON m.k = c.k AND m.m = t.m),
        a AS (SELECT k, string_agg(v::VARCHAR, ',' ORDER BY m) views FROM f GROUP BY 1)
        SELECT c_custkey custkey, views, replace(replace(c_name, '#', '%23'), ' ', '_') || '_%2F_%C3%A9%2A' AS path FROM customer LEFT JOIN a ON k = c_custkey""",
    "q79_line_files": "SELECT admit_id, qid, lat, array_to_string(classes, '|') classes, voyage, NULL::VARCHAR absent FROM admit",
    "q80_sorted_files": f"WITH {PLACES} SELECT place_id, iso3, NULL::VARCHAR tier, name_en, 'parquet' file FROM pl UNION ALL SELECT place_id, iso3, tier, name_en, 'csv' FROM pl",
    "q81_bundle": f"WITH {PLACES} SELECT iso3, count(*) n, count(*) told, min(place_id) first_id, max(qid) last_qid, true intact FROM pl WHERE iso3 IS NOT NULL AND qid IS NOT NULL GROUP BY 1",
    "q82_protected": """
        WITH a AS (SELECT wdpa, min(admit_id) f, max(admit_id) l, min(nullif(upper(trim(iso3)), '')) iso3 FROM admit WHERE wdpa IS NOT NULL GROUP BY 1),
        x AS (SELECT wdpa, iso3, CASE WHEN (l % 250) % 2 = 0 THEN (['II', 'Ib', 'V'])[l % 3 + 1] ELSE (['Ia', 'V', 'VI'])[f % 3 + 1] END iucn_cat, CASE WHEN (l % 250) % 2 = 0 THEN l % 250 ELSE f % 250 END::DOUBLE area_km2 FROM a)
        SELECT *, iucn_cat IN ('Ia', 'Ib', 'II') AND area_km2 >= 100 strict FROM x WHERE iso3 IS NOT NULL""",
    "q83_jobs": """
        WITH b AS (SELECT n_name c FROM nation), first AS (SELECT min(c) c FROM b),
        band(f, lo, hi) AS (VALUES ('class', 0, '4'), ('class', 4, '15'), ('class', 15, 'None'), ('attention', 15, '25'), ('attention', 25, '40'), ('attention', 40, '70'), ('attention', 70, '120'), ('attention', 120, 'None'))
        SELECT c country, f AS family, c || '/class/class=' || k || '/low=' || lo || '/high=' || hi job, 0 slices FROM b, band, (VALUES ('Q1'), ('Q2'), ('Q3')) v(k) WHERE f = 'class'
        UNION ALL SELECT c, f, c || '/attention/low=' || lo || '/high=' || hi, CASE WHEN lo = 25 AND c = (FROM first) THEN 2 ELSE 0 END FROM b, band WHERE f = 'attention'
        UNION ALL SELECT c, f, c || '/' || f, 0 FROM b, (VALUES ('popall'), ('institutional')) v(f) UNION ALL SELECT c, 'node', c || '/node/kind=' || k, 0 FROM b, (VALUES ('airport'), ('station'), ('port')) v(k)""",
    "q84_remote_rows": "SELECT c_nationkey || '/popall' job, 'Q' || c_custkey qid, c_name AS name FROM customer WHERE c_nationkey <> 3 AND c_nationkey IN (SELECT n_nationkey FROM nation)",
    "q85_preflight": "SELECT n_nationkey id, lower(n_name) expected, n_name AS label FROM nation WHERE n_regionkey = 2 AND lower(n_name) <> n_name",
    "q86_registry": f"""
        WITH r AS (SELECT build_no, lower(trim(place_id)) place_id, coalesce(lower(trim(status)), 'active') status, {sql_qid("qid")} q, loaded_at FROM place_build WHERE trim(place_id) <> '')
        SELECT place_id, string_agg(DISTINCT 'qid:' || q, '|' ORDER BY 'qid:' || q) AS keys, arg_max(status, (build_no, loaded_at, status)) status FROM r GROUP BY 1 HAVING count(q) > 0""",
}
