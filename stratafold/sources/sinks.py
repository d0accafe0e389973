"""Sinks: published as a whole or not at all, balanced, kept apart by unit, and logged."""

from __future__ import annotations

import json
import uuid
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F



def _files(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, so that any store that Spark writes to will do."""
    jvm = spark.sparkContext._jvm
    held = jvm.org.apache.hadoop.fs.Path(path)
    return held.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), held


def publish(df: DataFrame, path: str, version: str, partition: list[str] | None = None) -> int:
    """Writes zstd Parquet beside the path, reads it back, and only then moves it to the path. Where the path already holds this version, it is
    reused. Returns its rows; raises where rows don't balance, and leaves an older version in place until the new one is whole.

    What is written counts its rows as they pass, so the input is computed once."""
    spark = df.sparkSession
    fs, target = _files(spark, path)
    jvm = spark.sparkContext._jvm
    said = lambda where: spark.read.json(f"{where}/_version").first()
    if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/_version")) and (held := said(path))["version"] == version:
        return held["n_rows"]
    beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").option("compression", "zstd")
    (writer.partitionBy(*partition) if partition else writer).parquet(beside)
    wanted, written = seen.get["n"], spark.read.parquet(beside).count()
    if written != wanted:
        fs.delete(jvm.org.apache.hadoop.fs.Path(beside), True)
        raise RuntimeError(f"{written} rows were written of {wanted}")
    spark.createDataFrame([(version, written)], "version string, n_rows long").coalesce(1).write.json(f"{beside}/_version")
    if fs.exists(target):
        old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
        fs.rename(target, old)
        fs.rename(jvm.org.apache.hadoop.fs.Path(beside), target)
        fs.delete(old, True)
    else:
        fs.rename(jvm.org.apache.hadoop.fs.Path(beside), target)
    return written


def unit_path(domain: str, entity: str, source: str, table: str) -> str:
    """Where a unit of a source lies: domain/entity/hash-table."""
    return f"{domain}/{entity}/{sha256(f'{source}|{table}'.encode()).hexdigest()[:16]}-{table}"


def write_semicolons(df: DataFrame, path: str) -> None:
    """Delimited text for spreadsheets: semicolons, a byte order mark ahead of each file's header, quotes where needed, decimal commas."""
    kinds = dict(df.dtypes)
    quoted = lambda c: F.when(c.rlike('[;"\n\r]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    cell = lambda n: F.coalesce(quoted(F.replace(F.col(n).cast("string"), F.lit("."), F.lit(",")) if kinds[n] in ("double", "float") else F.col(n).cast("string")), F.lit(""))
    head = "﻿" + ";".join(df.columns)

    lines = df.select(F.concat_ws(";", *map(cell, df.columns)).alias("value")).withColumn("part", F.spark_partition_id())
    lines = lines.sortWithinPartitions("part")  # one header a file: rows stay with their partition
    from collections.abc import Iterator

    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for b in batches:
            values = b.column("value").to_pylist()
            yield pa.RecordBatch.from_pydict({"value": pa.array(([head] if first else []) + values, pa.string())})
            first = False

    lines.select("value").mapInArrow(run, "value string").write.text(path)


def beyond(df: DataFrame, state: dict[str, int], key: str, row_id: str = "id") -> tuple[DataFrame, dict[str, int]]:
    """(rows, state): rows whose id lies beyond what state says of their key, and the state with what they reach. The state holds a number for each key
    of tables that are followed: a few."""
    mark = F.create_map(*(F.lit(x) for pair in state.items() for x in pair)) if state else F.create_map().cast("map<string,bigint>")
    new = df.where(F.col(row_id) > F.coalesce(F.try_element_at(mark, F.col(key)), F.lit(-1)))
    reached = {r[0]: r[1] for r in new.groupBy(key).agg(F.max(row_id)).collect()}
    return new, {**state, **reached}


def serving(df: DataFrame, hide: list[str], flags: list[str], order: Column | str, parts: int) -> DataFrame:
    """What may be shown, stored by place: without hidden columns and rows that any flag marks, sorted within ranges of the order."""
    shown = df
    for flag in flags:
        shown = shown.where(~F.coalesce(F.col(flag), F.lit(False)))
    by = F.col(order) if isinstance(order, str) else order
    return shown.drop(*hide, *flags).repartitionByRange(parts, by).sortWithinPartitions(by)


def checked(df: DataFrame, key: str, parent: DataFrame | None = None, parent_key: str | None = None, box: tuple[float, float, float, float] | None = None) -> dict[str, int]:
    """How many keys are null or repeat, how many rows have no parent, and how many lie outside a box (south, west, north, east)."""
    found = df.agg(F.count(F.when(F.col(key).isNull(), 1)).alias("null_keys"), (F.count(key) - F.count_distinct(key)).alias("repeated_keys")).first().asDict()
    if parent is not None:
        found["orphans"] = df.where(F.col(parent_key).isNotNull()).join(parent, parent_key, "left_anti").count()
    if box:
        found["outside"] = df.where(~(F.col("lat").between(box[0], box[2]) & F.col("lon").between(box[1], box[3]))).count()
    return found


def logged(spark: SparkSession, path: str, **event: object) -> None:
    """Appends an event to a log of JSON lines."""
    spark.createDataFrame([(json.dumps(event, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("append").text(path)


def indexed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """A lookup table: Parquet by buckets of the key, sorted by it, so that a key's rows are a few pages of one file."""
    df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).repartition(buckets, "bucket").sortWithinPartitions("bucket", key).write.partitionBy("bucket").option("compression", "zstd").parquet(path)


def looked_up(spark: SparkSession, path: str, key: str, value: object, buckets: int) -> DataFrame:
    """The rows of one key, from its bucket alone."""
    (found,) = spark.range(1).select(F.pmod(F.xxhash64(F.lit(value)), F.lit(buckets)).cast("int")).first()
    return spark.read.parquet(path).where((F.col("bucket") == found) & (F.col(key) == value)).drop("bucket")


