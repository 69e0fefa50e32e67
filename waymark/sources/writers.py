"""Writers: sorted tables, bundles with a manifest, guarded registries, reports."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written beside its place and moved there, so a reader never sees half of it."""
    fs, p = _fs(spark, path)
    _, tmp = _fs(spark, path + ".part")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    fs.delete(p, False)
    fs.rename(tmp, p)


def write_sorted(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Parquet in total order; files are ranges of the order, so equal content gives equal tables whatever the partitions."""
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, by: Sequence[str]) -> None:
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def file_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, sha256, bytes)`` of every file below ``folder``, the manifest left out; files are hashed by the executors."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    _, p = _fs(spark, folder)
    name = F.regexp_replace("path", "^.*/" + p.getName() + "/", "")
    return rows.select(name.alias("file"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes")).where(~F.col("file").rlike(r"(^|/)(manifest\.json|_SUCCESS|\..*)$"))


def write_bundle(places: DataFrame, folder: str, build_id: str, notes: dict | None = None) -> dict:
    """Places as JSON lines by country, in order of id, with a manifest of counts and file hashes; returns the manifest.

    The folder must be new, so no file of an earlier build can stay. A large country is cut into several files by ranges of
    its ids. The manifest has one entry a file and one a country.
    """
    spark = places.sparkSession
    fs, p = _fs(spark, folder)
    if fs.exists(p):
        raise FileExistsError(folder)
    order = ["iso3", "place_id"]
    # Ranges keep a country's files few and its ids in order.
    places.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("iso3").option("ignoreNullFields", "true").json(f"{folder}/places")
    per = {r["iso3"]: r["count"] for r in places.groupBy("iso3").count().orderBy("iso3").collect()}
    hashes = {r["file"]: r["sha256"] for r in file_hashes(spark, folder).orderBy("file").collect()}
    manifest = {"build_id": build_id, "hashes": hashes, "counts": {"places": sum(per.values()), "per_country": {str(k): v for k, v in per.items()}}, **(notes or {})}
    write_text(spark, f"{folder}/manifest.json", json.dumps(manifest, ensure_ascii=False, indent=2, sort_keys=True))
    return manifest


def geojson_lines(places: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``value``: one GeoJSON feature a place."""
    shape = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    return places.select(F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*keep).alias("properties"))).alias("value"))


def commit_registry(registry: DataFrame, path: str, gates: DataFrame, golden: DataFrame) -> None:
    """Writes the registry in order of id; ids are permanent, so the landmark gate must have passed and every positive row have a QID."""
    if not gates.where("gate = 'G-LANDMARK' and passed").count():
        raise PermissionError("the landmark gate has not passed")
    blank = golden.where("row_kind = 'positive' and coalesce(trim(qid), '') = ''").count()
    if blank:
        raise PermissionError(f"{blank} expected rows have no QID")
    write_sorted(registry.withColumn("keys", F.array_sort("keys")), path, ["place_id"])


def pin(manifest: dict, source: str, entry: dict, files: Sequence[tuple[str, bytes]]) -> dict:
    """The input manifest with ``source``'s files (path, content) recorded by size and hash; an equal path is replaced."""
    out = {**manifest, "sources": [dict(s) for s in manifest.get("sources", [])]}
    own = next((s for s in out["sources"] if s["source_id"] == source), None)
    if own is None:
        own = {"source_id": source, **entry, "files": []}
        out["sources"].append(own)
    new = {path: {"path": path, "bytes": len(b), "sha256": hashlib.sha256(b).hexdigest()} for path, b in files}
    own["files"] = sorted([*[f for f in own["files"] if f["path"] not in new], *new.values()], key=lambda f: f["path"])
    return out


def check_pins(pinned: DataFrame, found: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """``(path, problem)``: pinned files that are missing or differ in size or hash, required ones not pinned, unknown ones.

    ``pinned`` and ``found`` have (path, bytes, sha256)."""
    told = pinned.select("path", F.col("bytes").alias("b1"), F.col("sha256").alias("h1"), F.lit(True).alias("told"))
    seen = found.select("path", F.col("bytes").alias("b2"), F.col("sha256").alias("h2"), F.lit(True).alias("seen"))
    j = told.join(seen, "path", "full")
    problem = F.when(F.col("told").isNull(), "not in the manifest").when(F.col("seen").isNull(), "missing").when(F.col("b1") != F.col("b2"), "size differs").when(F.col("h1") != F.col("h2"), "hash differs")
    out = j.select("path", problem.alias("problem")).where("problem is not null")
    if required:
        need = pinned.sparkSession.createDataFrame([(r,) for r in required], "path string")
        out = out.union(need.join(pinned, "path", "left_anti").select("path", F.lit("required but not pinned").alias("problem")))
    return out


def markdown_table(df: DataFrame, most: int = 1000) -> str:
    """A report table; reports are aggregates, and a table of more than ``most`` rows is refused instead of cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows")
    cell = lambda v: "" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v).replace("|", "\\|")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(v) for v in r) + " |" for r in rows]) + "\n"
