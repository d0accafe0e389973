"""Scalar functions as Spark columns, and those that need Python as vectorised ones; queries that show them over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fold(text: Column) -> Column:
    """Lower case by Turkish rules, without diacritics; runs of anything but a-z and 0-9 become one space."""
    lower = F.translate(F.lower(F.translate(text, "İI", "iı")), "çğıöşüâîû", "cgiosuaiu")
    return F.trim(F.regexp_replace(lower, "[^a-z0-9]+", " "))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6371008.8) -> Column:
    """Metres, or whatever unit radius has, between two points in degrees."""
    half = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(half))


def period_index(period: Column) -> Column:
    """Months since year 0 of 'yyyy-MM'; null for anything else."""
    ok = period.rlike("^[0-9]{4}-[0-9]{2}$")
    return F.when(ok, F.substring(period, 1, 4).cast("int") * 12 + F.substring(period, 6, 2).cast("int") - 1)


def token_jaccard(a: Column, b: Column) -> Column:
    """Shared words over all words of two folded texts; null where neither has any."""
    x, y = F.array_distinct(F.split(fold(a), " ")), F.array_distinct(F.split(fold(b), " "))
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def gtfs_seconds(time: Column) -> Column:
    """Seconds of 'HH:MM:SS', whose hours may pass 24; null for anything else."""
    part = [F.split_part(time, F.lit(":"), F.lit(i)).try_cast("int") for i in (1, 2, 3)]
    return part[0] * 3600 + part[1] * 60 + part[2]


def _jaro_winkler(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free, common = [True] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                common.append(c)
                break
    if not common:
        return 0.0
    other = [c for c, f in zip(b, free, strict=True) if not f]
    swaps = sum(x != y for x, y in zip(common, other, strict=True)) // 2
    m = len(common)
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return jaro + prefix * 0.1 * (1 - jaro) if jaro >= 0.7 else jaro


def remembered(one: Callable[[str | None, str | None], float | None]) -> Callable[[Column, Column], Column]:
    """A function of two texts as one of columns; a worker keeps its results for the pairs that it met last."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        known = _KEPT.setdefault(one.__name__, lru_cache(maxsize=1 << 16)(one))
        return pd.Series([known(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    return F.pandas_udf(run, "double")


#: What remembered keeps, by the function's name.
_KEPT: dict[str, Callable] = {}


def jaro_winkler(a: Column, b: Column) -> Column:
    """Similarity of two texts, 0 to 1; null where one is null."""
    return remembered(_jaro_winkler)(a, b)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _alike_parts(parts: DataFrame, text: str, score: Callable[[Column, Column], Column], least: float) -> DataFrame:
    """(a_id, b_id, score): parts (p_partkey, p_brand, p_size and a text) of one brand and size whose texts reach a score, a_id < b_id. Parts of one block
    and text are one row until then."""
    from ..operators import relational

    block = ["p_brand", "p_size"]
    a, b = (relational.spread(relational.classed(parts.withColumnsRenamed({"p_partkey": i, text: t}), i, [*block, t], f"{i}s"), *block) for i, t in (("a_id", "x"), ("b_id", "y")))
    pairs = a.hint("merge").join(b, block).withColumn("score", F.round(score(F.col("x"), F.col("y")), 9)).where(F.col("score") >= least)
    return relational.expanded(pairs.select("a_ids", "b_ids", "score"), a_ids="a_id", b_ids="b_id").where("a_id < b_id").select("a_id", "b_id", "score")


def jaro_winkler_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of one brand and size whose names are alike: blocked by an equality join."""
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", F.lower("p_name").alias("name"))
    return _alike_parts(p, "name", jaro_winkler, 0.8)


def token_jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", fold(F.col("p_type")).alias("kind"))
    return _alike_parts(p, "kind", token_jaccard, 0.5)


def gtfs_time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events").select("event_id", F.date_format("ts", "HH:mm:ss").alias("t"))
    return e.select("event_id", gtfs_seconds(F.col("t")).cast("long").alias("secs"))


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.array_join(F.array_sort(F.json_object_keys("props")), ",").alias("names"))


ROW_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "jaro_winkler_match": (jaro_winkler_match, "select a.p_partkey a_id, b.p_partkey b_id, round(jaro_winkler_similarity(lower(a.p_name), lower(b.p_name)), 9) score from part a join part b on a.p_brand = b.p_brand and a.p_size = b.p_size and a.p_partkey < b.p_partkey where round(jaro_winkler_similarity(lower(a.p_name), lower(b.p_name)), 9) >= 0.8"),
    "token_jaccard_pairs": (token_jaccard_pairs, "with t as (select p_partkey, p_brand, p_size, list_distinct(string_split(trim(regexp_replace(lower(p_type), '[^a-z0-9]+', ' ', 'g')), ' ')) w from part) select * from (select a.p_partkey a_id, b.p_partkey b_id, round(len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))), 9) score from t a join t b on a.p_brand = b.p_brand and a.p_size = b.p_size and a.p_partkey < b.p_partkey) where score >= 0.5"),
    "gtfs_time_parse": (gtfs_time_parse, "select event_id, (extract(hour from ts) * 3600 + extract(minute from ts) * 60 + extract(second from ts))::bigint secs from events"),
    "json_props": (json_props, "select event_id, cast(json_extract_string(props, '$.k') as bigint) k, array_to_string(list_sort(json_keys(props)), ',') as names from events"),
}
