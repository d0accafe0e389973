"""Scans of nested JSON: dictionaries, guides, record lists, SDMX, GeoJSON. Each file is one document; what has no column of its own stays as JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MAP, _LIST = "map<string,string>", "array<string>"


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, doc): whole files as text, a byte order mark taken off."""
    files = spark.read.option("wholetext", True).text(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^﻿", "").alias("doc"))


def _kind(json: Column) -> Column:
    return F.substring(F.ltrim(json), 1, 1)


def _named(json: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(*(F.get_json_object(json, f"$['{n}']") for n in names))


def dictionary(docs: DataFrame) -> DataFrame:
    """(path, key, fields, value_json) of {key: object}: a row for each key, its object's fields as texts; null fields where the value is no object."""
    rows = docs.select("path", F.explode(F.from_json("doc", _MAP)).alias("key", "value_json"))
    return rows.select("path", "key", F.when(_kind(F.col("value_json")) == "{", F.from_json("value_json", _MAP)).alias("fields"), "value_json")


def guide(docs: DataFrame, child_lists: tuple[str, ...] = ("ilceler", "ilçeler", "districts", "counties"), names: tuple[str, ...] = ("il", "ad", "name")) -> DataFrame:
    """(path, key, name, child, place, value_json) of {key: {name, children}} or {key: children}: a row for each child, from 1 on; one without a child where there
    are none."""
    rows = docs.select("path", F.explode(F.from_json("doc", _MAP)).alias("key", "value_json"))
    v = F.col("value_json")
    held = F.when(_kind(v) == "[", v).when(_kind(v) == "{", F.coalesce(*(F.when(_kind(F.get_json_object(v, f"$['{c}']")) == "[", F.get_json_object(v, f"$['{c}']")) for c in child_lists)))
    listed = rows.select("path", "key", F.when(_kind(v) == "{", _named(v, names)).alias("name"), F.from_json(held, _LIST).alias("children"), "value_json")
    return listed.select("path", "key", "name", F.posexplode_outer("children").alias("at", "child"), "value_json").select("path", "key", "name", "child", (F.col("at") + 1).alias("place"), "value_json")


def records(docs: DataFrame) -> DataFrame:
    """(path, under, place, fields, value_json): the records of a list of objects, or of the longest such list among an object's values, the first of equals."""
    doc = F.col("doc")
    lists = F.filter(F.map_entries(F.from_json(doc, _MAP)), lambda e: F.substring(F.regexp_replace(e["value"], r"\s", ""), 1, 2) == "[{")
    parsed = F.transform(lists, lambda e, i: F.struct((-F.json_array_length(e["value"])).alias("n"), i.alias("i"), e["key"].alias("k"), e["value"].alias("v")))
    longest = F.when(_kind(doc) == "{", F.try_element_at(F.array_sort(parsed), F.lit(1)))
    chosen = docs.select("path", "doc", longest.alias("l")).select("path", "doc", F.col("l.k").alias("under"), F.from_json(F.when(_kind(doc) == "[", doc).otherwise(F.col("l.v")), _LIST).alias("rows"))
    rows = chosen.select("path", "under", F.posexplode_outer("rows").alias("at", "row"), "doc").withColumn("row", F.coalesce("row", "doc"))
    return rows.select("path", "under", (F.col("at") + 1).alias("place"), F.when(F.col("at").isNotNull() & (_kind(F.col("row")) == "{"), F.from_json("row", _MAP)).alias("fields"), F.col("row").alias("value_json"))


def _features(features: DataFrame) -> DataFrame:
    get = lambda name: F.get_json_object("feature", f"$.{name}")
    rows = features.select("path", "place", get("id").alias("id"), F.from_json(get("properties"), _MAP).alias("properties"), get("geometry").alias("geometry_json"))
    # Numbers of the coordinates in turn: x, y, and a height only where each point has three
    return rows.withColumn("kind", F.get_json_object("geometry_json", "$.type"))


def geojson(docs: DataFrame) -> DataFrame:
    """(path, place, id, properties, geometry_json, kind) of the features of FeatureCollections."""
    listed = docs.select("path", F.posexplode(F.from_json(F.get_json_object("doc", "$.features"), _LIST)).alias("at", "feature"))
    return _features(listed.select("path", (F.col("at") + 1).alias("place"), "feature"))


def geojson_sequence(spark: SparkSession, path: str) -> DataFrame:
    """The same of files with a feature on each line, record separators taken off."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.trim(F.regexp_replace("value", "\x1e", "")).alias("feature")).where("feature <> ''")
    return _features(lines.withColumn("place", F.lit(None).cast("int")))


def boxed(features: DataFrame) -> DataFrame:
    """features with the box of their coordinates (west, south, east, north) and its middle (lon, lat); without a geometry they go. Coordinates are pairs."""
    numbers = F.transform(F.regexp_extract_all(F.get_json_object("geometry_json", "$.coordinates"), F.lit(r"(-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)"), F.lit(1)), lambda x: x.cast("double"))
    turn = lambda odd: F.filter("numbers_", lambda x, i: i % 2 == odd)
    held = features.where(F.col("geometry_json").isNotNull()).withColumn("numbers_", numbers)
    edges = {"west": F.array_min(turn(0)), "south": F.array_min(turn(1)), "east": F.array_max(turn(0)), "north": F.array_max(turn(1))}
    return held.withColumns(edges).withColumns({"lon": (F.col("west") + F.col("east")) / 2, "lat": (F.col("south") + F.col("north")) / 2}).drop("numbers_")


def sdmx(docs: DataFrame) -> DataFrame:
    """(path, series, dims, period, value, text, attributes) of SDMX-JSON: each observation with its series' codes by dimension, its period's code, its value as
    number and text, and its attributes' codes."""
    get = lambda name: F.get_json_object("doc", name)
    axis = "array<struct<id:string,values:array<struct<id:string,name:string>>>>"
    head = docs.select(
        "path",
        F.from_json(get("$.data.structure.dimensions.series"), axis).alias("series_dims"),
        F.from_json(get("$.data.structure.dimensions.observation"), axis).alias("obs_dims"),
        F.from_json(get("$.data.structure.attributes.observation"), axis).alias("attrs"),
        F.explode(F.from_json(get("$.data.dataSets"), f"array<struct<series:map<string,struct<observations:map<string,{_LIST}>>>>>")).alias("set"),
    )
    per = head.select("path", "series_dims", "obs_dims", "attrs", F.explode("set.series").alias("series", "s"))
    codes = F.transform(F.split("series", ":"), lambda x: x.try_cast("int"))
    code = lambda values, i: F.when(i >= 0, F.try_element_at(values, i + 1))["id"]
    dims = F.map_from_entries(F.transform("series_dims", lambda d, i: F.struct(d["id"].alias("k"), code(d["values"], F.get(codes, i)).alias("v"))))
    obs = per.select("path", "series", dims.alias("dims"), "obs_dims", "attrs", F.explode("s.observations").alias("at", "o"))
    at, text = F.split_part("at", F.lit(":"), F.lit(1)).try_cast("int"), F.get("o", F.lit(0))
    found = F.filter(F.transform("attrs", lambda a, i: F.struct(a["id"].alias("k"), code(a["values"], F.get("o", i + 1).try_cast("int")).alias("v"))), lambda e: e["v"].isNotNull())
    return obs.select("path", "series", "dims", code(F.get("obs_dims", F.lit(0))["values"], at).alias("period"), F.regexp_replace(text, ",", ".").try_cast("double").alias("value"), text.alias("text"), F.map_from_entries(F.coalesce(found, F.array())).alias("attributes"))


def timetable(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with facts (name: value), departures (day type, seconds, note) and stops (place, number, name) of timetable pages, read by their tables' classes."""
    plain = lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, "<[^>]+>", " "), "&nbsp;", " "), r"\s+", " "))
    block = lambda mark: F.regexp_extract(html, rf'(?s){mark}(.*?)</table>', 1)
    rows = lambda mark: F.regexp_extract_all(block(mark), F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = lambda row: F.filter(F.transform(F.regexp_extract_all(row, F.lit(r"(?s)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), plain), lambda c: ~c.isin("", ":"))
    facts = F.filter(F.transform(rows('class="hs-kv"'), cells), lambda c: F.size(c) >= 2)
    heads = F.transform(F.regexp_extract_all(block('class="hs-table"'), F.lit(r"(?s)<th[^>]*>(.*?)</th>"), F.lit(1)), plain)
    columns = F.regexp_extract_all(block('class="hs-table"'), F.lit(r'(?s)<td class="hs-times"[^>]*>(.*?)</td>'), F.lit(1))

    def times(head: Column, column: Column) -> Column:
        texts = F.filter(F.transform(F.split(column, r"<br\s*/?>"), plain), lambda t: t.rlike(r"^\d{1,2}:\d{2}"))
        part = lambda t, i: F.regexp_extract(t, r"^(\d{1,2}):(\d{2})\s*(.*)$", i)
        return F.transform(texts, lambda t: F.struct(head.alias("day"), (part(t, 1).cast("int") * 3600 + part(t, 2).cast("int") * 60).alias("seconds"), F.nullif(F.nullif(part(t, 3), F.lit("")), F.lit("-")).alias("note")))

    pairs = F.arrays_zip(F.slice(heads, 1, F.least(F.size(heads), F.size(columns))).alias("h"), F.slice(columns, 1, F.least(F.size(heads), F.size(columns))).alias("c"))
    stops = F.filter(F.transform(rows("route-table"), cells), lambda c: (F.size(c) >= 3) & F.get(c, F.lit(0)).rlike(r"^\d+$"))
    return pages.withColumns({
        "facts": F.map_from_entries(F.transform(facts, lambda c: F.struct(F.get(c, F.lit(0)), F.get(c, F.lit(1))))),
        "departures": F.flatten(F.transform(pairs, lambda p: times(p["h"], p["c"]))),
        "stops": F.transform(stops, lambda c: F.struct(F.get(c, F.lit(0)).cast("int").alias("place"), F.get(c, F.lit(1)).alias("number"), F.get(c, F.lit(2)).alias("name"))),
    })


def widened(rows: DataFrame, fields: str = "fields") -> DataFrame:
    """rows with a text column for each key that occurs in their fields. The distinct keys, a schema's worth, reach the driver."""
    keys = sorted(r[0] for r in rows.select(F.explode(F.map_keys(fields))).distinct().collect())
    return reduce(lambda df, k: df.withColumn(k, F.try_element_at(fields, F.lit(k))), keys, rows).drop(fields)


def unread(sources: DataFrame, done: DataFrame, path: str = "path") -> DataFrame:
    """The sources that a target table holds nothing of yet."""
    return sources.join(done.select(path).where(F.col(path).isNotNull()).distinct(), path, "left_anti")
