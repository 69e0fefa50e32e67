"""Statements of knowledge-base items and query bindings, as expressions on JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

#: One statement; values stay JSON text, since their shape depends on the property.
CLAIM = "array<struct<rank:string, mainsnak:struct<datavalue:struct<value:string>>, qualifiers:map<string,string>>>"
ENTITY = StructType([
    StructField("id", StringType()), StructField("missing", StringType()),
    StructField("labels", MapType(StringType(), StructType([StructField("value", StringType())]))),
    StructField("descriptions", MapType(StringType(), StructType([StructField("value", StringType())]))),
    StructField("aliases", MapType(StringType(), ArrayType(StructType([StructField("value", StringType())])))),
    StructField("claims", MapType(StringType(), StringType())),
    StructField("sitelinks", MapType(StringType(), StructType([StructField("title", StringType())]))),
])
# Properties that are read from an item.
ITEM_LISTS = {"instance_of": "P31", "located_in": "P131", "part_of": "P361", "heritage": "P1435"}
YEARS = {"inception": "P571", "dissolved": "P576"}


def statements(json: Column) -> Column:
    """Statements of one property, deprecated ones left out; null for none."""
    return F.filter(F.from_json(json, CLAIM), lambda c: ~c["rank"].eqNullSafe("deprecated"))


def item_ids(json: Column) -> Column:
    """Ids of the items that statements name, in order; values that are no items are skipped."""
    ids = F.transform(statements(json), lambda c: F.get_json_object(c["mainsnak"]["datavalue"]["value"], "$.id"))
    return F.coalesce(F.array_compact(ids), F.array().cast("array<string>"))


def year(json: Column) -> Column:
    """First signed year that can be read from time statements (``-0753-04-21`` is -753)."""
    years = F.transform(statements(json), lambda c: F.regexp_extract(F.get_json_object(c["mainsnak"]["datavalue"]["value"], "$.time"), r"^([+-]?\d+)-", 1).try_cast("int"))
    return F.get(F.array_compact(years), F.lit(0))


def capital_of(json: Column) -> Column:
    """``(qid, ended)`` of capital-of statements; an end-time qualifier makes them ended."""
    all_ = F.transform(statements(json), lambda c: F.struct(F.get_json_object(c["mainsnak"]["datavalue"]["value"], "$.id").alias("qid"), F.coalesce(F.map_contains_key(c["qualifiers"], "P582"), F.lit(False)).alias("ended")))
    return F.filter(all_, lambda x: x["qid"].isNotNull())


def entity_columns(entity: Column, requested: Column, languages: list[str]) -> dict[str, Column]:
    """Columns of a detail row from an entity's JSON text.

    Later languages take precedence for the local label; an item found under another id than requested is a redirect; an
    item that the source marks missing has nulls and ``missing`` true.
    """
    e = F.from_json(entity, ENTITY)
    label = lambda lang: e["labels"][lang]["value"]
    aliases = lambda lang: F.transform(e["aliases"][lang], lambda a: a["value"])
    none = F.array().cast("array<string>")
    local = F.concat(*[F.coalesce(aliases(x), none) for x in languages]) if languages else none
    out = {
        "qid": requested, "missing": e["missing"].isNotNull(), "redirected_to": F.when(e["id"] != requested, e["id"]),
        "label_en": label("en"), "label_loc": F.coalesce(*[label(x) for x in reversed(languages)]) if languages else F.lit(None).cast("string"),
        "description": e["descriptions"]["en"]["value"], "aliases_en": F.coalesce(aliases("en"), none), "aliases_loc": local,
        "capital_of": capital_of(e["claims"]["P1376"]), "official_url": F.get(F.array_compact(F.transform(statements(e["claims"]["P856"]), lambda c: c["mainsnak"]["datavalue"]["value"])), F.lit(0)),
        "wikipedia_en": e["sitelinks"]["enwiki"]["title"],
    }
    out |= {name: item_ids(e["claims"][p]) for name, p in ITEM_LISTS.items()}
    return out | {name: year(e["claims"][p]) for name, p in YEARS.items()}


def id_of(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def point(wkt: Column) -> tuple[Column, Column]:
    """(lat, lon) of ``Point(lon lat)``; nulls for anything else."""
    form = r"(?i)^point\(\s*([-+0-9.eE]+)\s+([-+0-9.eE]+)\s*\)$"
    return F.regexp_extract(wkt, form, 2).try_cast("double"), F.regexp_extract(wkt, form, 1).try_cast("double")


def binding_columns(b: Column, disputed: bool = False) -> dict[str, Column]:
    """Columns of an extract row from a binding, a map of names to values."""
    lat, lon = point(b["coord"])
    whole = lambda c: c.try_cast("double").cast("bigint")
    out = {"qid": id_of(b["item"]), "lat": lat, "lon": lon, "sitelinks": whole(b["sl"]).cast("int"), "population": whole(b["pop"])}
    out["instance_of"] = F.filter(F.transform(F.split(b["insts"], r"\|"), id_of), lambda q: q != "")
    out |= {c: b[c] for c in ("whs", "wdpa", "iata", "icao", "code", "label_en", "label_loc")}
    return out | {"country_qid": id_of(b["country"]), "disputed": F.lit(disputed)}


def capital_columns(b: Column) -> dict[str, Column]:
    ended = F.coalesce(F.lower(b["ended"]).isin("true", "1"), F.lit(False))
    classes = F.filter(F.transform(F.split(b["classes"], r"\|"), id_of), lambda q: q != "")
    return {"cap": id_of(b["cap"]), "state": id_of(b["state"]), "classes": F.coalesce(classes, F.array().cast("array<string>")), "ended": ended}


def profile_columns(entity: Column) -> dict[str, Column]:
    """Which wikis carry the item: names of its site links that end in ``wiki``, in order; null for a missing item."""
    e = F.from_json(entity, ENTITY)
    names = F.array_sort(F.filter(F.map_keys(e["sitelinks"]), lambda k: k.endswith("wiki")))
    return {"missing": e["missing"].isNotNull(), "wikis": F.when(e["missing"].isNull(), F.coalesce(names, F.array().cast("array<string>")))}


def class_columns(entity: Column) -> dict[str, Column]:
    """A class's English label and the classes that it is a kind of."""
    e = F.from_json(entity, ENTITY)
    return {"label": e["labels"]["en"]["value"], "parents": item_ids(e["claims"]["P279"])}


def monthly_views(answer: Column, first: str, months: int = 12) -> Column:
    """Views by month from ``first`` (``YYYYMM``) of a page-view answer, gaps as 0; null where the answer is (a missing article)."""
    items = F.from_json(answer, "items array<struct<timestamp:string, views:bigint>>")["items"]
    start = int(first[:4]) * 12 + int(first[4:]) - 1
    at = lambda t: F.substring(t, 1, 4).cast("int") * 12 + F.substring(t, 5, 2).cast("int") - 1 - start
    of = lambda m: F.aggregate(F.filter(items, lambda x: at(x["timestamp"]) == m), F.lit(0).cast("bigint"), lambda a, x: a + x["views"])
    return F.when(answer.isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(months - 1)), of))


def title_path(title: Column) -> Column:
    """An article's title as a segment of a path: blanks as underscores, everything else escaped."""
    return F.regexp_replace(F.url_encode(F.replace(title, F.lit(" "), F.lit("_"))), r"\*", "%2A")
