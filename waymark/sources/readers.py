"""Readers: tables that may lack columns or files, line files with a header object, rule files, bundles, registries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType, _parse_datatype_string


def _schema(spark: SparkSession, schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else _parse_datatype_string(schema)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def read_or_empty(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A Parquet table in the given schema: absent columns are null, an absent file is an empty table, others are not read."""
    s = _schema(spark, schema)
    return spark.read.schema(s).parquet(path) if exists(spark, path) else spark.createDataFrame([], s)


def read_lines(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """JSON lines without the leading ``_meta`` object. Lines that are no JSON come out as ``_corrupt_record``."""
    s = StructType([*_schema(spark, schema).fields])
    s = s.add("_meta", "string").add("_corrupt_record", "string")
    rows = spark.read.schema(s).option("mode", "PERMISSIVE").json(path)
    return rows.where(F.col("_meta").isNull()).drop("_meta")


def read_rules(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A rule table from CSV with a header; ``ord`` numbers the rows as they stand, since the first hit wins.

    A rule file is read by one task, which is what keeps its order.
    """
    s = _schema(spark, schema)
    rows = spark.read.schema(s).csv(path, header=True, quote='"', escape='"', multiLine=True)
    return rows.coalesce(1).withColumn("ord", F.monotonically_increasing_id().cast("int"))


PLACE = "place_id string, type string, name_en string, name_local string, aliases array<string>, iso3 string, lat double, lon double, tier string, tier_reason string, qid string, keys array<string>, status string, evidence array<struct<asset_id:string,source:string,url:string,retrieved:string,source_key:string>>, kinds array<struct<kind:string,rule:string,strength:double,evidence:array<string>>>, rules array<string>, sitelinks int, whs_id string, wdpa_id string, population bigint, no_kind_reason string, crowded boolean"


def read_bundle(spark: SparkSession, folder: str) -> DataFrame:
    """Places of a bundle: country documents (``{"iso3": …, "places": […]}``) or lines under ``iso3=…`` folders.

    A place without a country takes its document's; aliases may be texts or objects with ``alias``.
    """
    place = _parse_datatype_string(PLACE)
    root = f"{folder}/places"
    if any(f.getPath().getName().startswith("iso3=") for f in _list(spark, root)):
        return spark.read.schema(place).json(root)
    loose = StructType([f for f in place.fields if f.name != "aliases"]).add("aliases", ArrayType(StringType()))
    doc = StructType().add("iso3", "string").add("places", ArrayType(loose))
    rows = spark.read.schema(doc).json(root, multiLine=True).select(F.col("iso3").alias("_doc"), F.explode("places").alias("p")).select("_doc", "p.*")
    alias = F.transform("aliases", lambda a: F.coalesce(F.when(a.startswith("{"), F.get_json_object(a, "$.alias")), a))
    return rows.withColumns({"iso3": F.coalesce("iso3", "_doc"), "aliases": alias}).select(*[f.name for f in place.fields])


def _list(spark: SparkSession, path: str) -> list:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return list(p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p))


REGISTRY = "place_id string, keys array<string>, status string, minted_build string, last_seen_build string, tombstone_reason string"


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry from Parquet, or from CSV with bars between keys."""
    if not path.endswith(".csv"):
        return read_or_empty(spark, path, REGISTRY)
    rows = spark.read.schema(REGISTRY.replace("array<string>", "string")).csv(path, header=True)
    keys = F.filter(F.split(F.coalesce("keys", F.lit("")), r"\|"), lambda k: k != "")
    return rows.withColumns({"keys": keys, "status": F.trim("status")})


def reduce_protected(spark: SparkSession, paths: Sequence[str], countries: Sequence[str]) -> DataFrame:
    """``(wdpa, iso3, iucn_cat, area_km2)`` of designated areas in scope from files of two column generations.

    Countries may be lists with semicolons. Of several rows of an id the last counts, by file in the order given and then by row.
    """
    parts = []
    for i, path in enumerate(paths):
        rows = spark.read.csv(path, header=True, quote='"', escape='"')
        have = {c.upper(): c for c in rows.columns}
        pick = lambda *names, have=have: F.coalesce(*[F.col(f"`{have[n]}`") for n in names if n in have], F.lit(None).cast("string"))
        parts.append(rows.select(
            pick("WDPAID", "SITE_ID").alias("wdpa"), pick("ISO3", "PRNT_ISO3", "PARENT_ISO3").alias("iso"), pick("STATUS").alias("status"), pick("IUCN_CAT").alias("iucn_cat"),
            pick("GIS_AREA", "REP_AREA").try_cast("double").alias("area_km2"), F.lit(i).alias("_file"), F.monotonically_increasing_id().alias("_row"),
        ))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    scope = F.array(*map(F.lit, countries))
    isos = F.transform(F.split("iso", ";"), F.trim)
    kept = rows.where((F.lower(F.trim("status")) == "designated") & F.arrays_overlap(isos, scope)).withColumn("iso3", F.get(F.array_intersect(isos, scope), F.lit(0)))
    last = kept.groupBy("wdpa").agg(F.max(F.struct("_file", "_row", "iso3", "iucn_cat", "area_km2")).alias("r"))
    return last.select("wdpa", "r.iso3", "r.iucn_cat", "r.area_km2").orderBy(F.col("wdpa").cast("bigint"))


def strict_and_large(category: Column, area: Column, least: float = 100.0) -> Column:
    """A strictly protected area (Ia, Ib or II) of at least ``least`` square kilometres. Never null."""
    return F.coalesce(category.isin("Ia", "Ib", "II") & (area >= least), F.lit(False))


def read_expectations(spark: SparkSession, path: str) -> DataFrame:
    """An expectation list from CSV, all columns as typed, with ``names`` (folded by the caller), ``kinds`` and ``targets`` split at bars."""
    rows = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)
    parts = lambda c: F.filter(F.split(F.coalesce(F.col(c), F.lit("")), r"\|"), lambda x: F.trim(x) != "")
    return rows.withColumns({"names": F.concat(F.array("expected_name"), parts("aliases")), "kinds": parts("kinds_expected"), "targets": parts("target_id")})
