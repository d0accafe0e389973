"""Scans of files that come as they are: delimited text with rejects, JSON lines, archives, truncated archives, SQLite; and sinks that balance rows."""

from __future__ import annotations

import io
import sqlite3
import tempfile
import zipfile
import zlib
from collections.abc import Callable, Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELIMITERS = ",;\t|"


def sniff(line: str) -> str:
    """The delimiter that the header line has most often; the first of equals."""
    return max(DELIMITERS, key=line.count)


def head_of(spark: SparkSession, path: str, size: int = 1 << 16) -> bytes:
    """The first bytes of a file, or of the first file of a folder or pattern."""
    jvm = spark.sparkContext._jvm
    held = jvm.org.apache.hadoop.fs.Path(path)
    fs = held.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted(str(x.getPath()) for x in fs.globStatus(held) or ())
    while found and fs.getFileStatus(jvm.org.apache.hadoop.fs.Path(found[0])).isDirectory():
        found = sorted(str(x.getPath()) for x in fs.listStatus(jvm.org.apache.hadoop.fs.Path(found[0])) if not x.getPath().getName().startswith(("_", ".")))
    if not found:
        raise FileNotFoundError(path)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(found[0]))
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


def encoding_of(data: bytes) -> str:
    """UTF-8 where the bytes are that, but for a character that the end may cut; else the Turkish code page."""
    for cut in range(4):
        try:
            data[: len(data) - cut].decode("utf-8")
            return "UTF-8"
        except UnicodeDecodeError:
            continue
    return "windows-1254"


def read_delimited(spark: SparkSession, path: str, sep: str | None = None, breaks: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): every column as text, ragged rows filled with nulls; lines that have more fields than the header go to rejects as they are. The
    first line of each file is its header and goes, whatever else equals it stays. breaks: quoted values may hold line breaks; a file is then one task's
    work. Raises ValueError where one column was read though the header has another delimiter twice."""
    data = head_of(spark, path)
    encoding = encoding_of(data)
    line = data.decode(encoding, "replace").removeprefix("\ufeff").split("\n")[0].rstrip("\r")
    if not line:
        empty = spark.createDataFrame([], "line string")
        return empty, empty
    sep = sep or sniff(line)
    names = [x.strip().strip('"') for x in line.split(sep)]
    if len(names) == 1 and any(line.count(d) >= 2 for d in DELIMITERS if d != sep):
        raise ValueError("the delimiter is suspect")
    names = [n or f"c{i}" for i, n in enumerate(names)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_line"]])  # the text of lines with more or fewer fields
    options = {"sep": sep, "quote": '"', "escape": '"', "header": True, "enforceSchema": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line", "encoding": "UTF-8" if encoding == "UTF-8" else "ISO-8859-1", "multiLine": breaks, "columnPruning": False}
    parsed = spark.read.schema(schema).options(**options).csv(path)
    if encoding != "UTF-8":  # the code page has Latin 1's bytes but for six letters
        parsed = parsed.select(*(F.translate(c, "ÐÝÞðýþ", "ĞİŞğış").alias(c) for c in parsed.columns))
    wider = ", ".join(f"`{n}` string" for n in [*names, "_more"])
    more = F.from_csv("_line", wider, {"sep": sep, "quote": '"', "escape": '"', "multiLine": breaks})["_more"].isNotNull()
    beside = F.left(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), F.lit(0))  # nothing; but the reader refuses to be asked for odd lines alone
    return parsed.where(F.col("_line").isNull() | ~more).select(*(F.col(f"`{n}`") for n in names)), parsed.where((F.concat("_line", beside) != "") & more).select(F.concat("_line", beside).alias("line"))


def positional(lines: DataFrame, expected: int, sep: str = ",") -> DataFrame:
    """(values_json, status) of lines (value): the fields in order as a JSON array, and valid, or malformed_column_count where there aren't as many as expected."""
    import csv
    import json

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [next(csv.reader([x], delimiter=sep), []) for x in f["value"]]
            yield pd.DataFrame({"values_json": [json.dumps(r, ensure_ascii=False) for r in rows], "status": ["valid" if len(r) == expected else "malformed_column_count" for r in rows]})

    return lines.select("value").mapInPandas(run, "values_json string, status string")


def read_json_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): records with the union of their fields; lines that aren't JSON objects as they are."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    good = F.try_parse_json("value").isNotNull() & F.startswith(F.ltrim("value"), F.lit("{"))
    schema = spark.read.json(path).drop("_corrupt_record").schema
    return lines.where(good).select(F.from_json("value", schema).alias("r")).select("r.*"), lines.where(~good).select(F.col("value").alias("line"))


def read_evolved(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files whose schemas differ, as one table with all columns."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


#: Columns of a transit feed's files that a feed may lack.
FEED = {
    "stops": "stop_id stop_name stop_lat stop_lon parent_station",
    "routes": "route_id agency_id route_short_name route_long_name route_type",
    "trips": "trip_id route_id service_id trip_headsign direction_id shape_id",
    "stop_times": "trip_id stop_sequence stop_id arrival_time departure_time",
    "calendar": "service_id monday tuesday wednesday thursday friday saturday sunday start_date end_date",
    "frequencies": "trip_id start_time end_time headway_secs",
}


def read_feed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of a transit feed, all columns as text: those that it lacks are null, a file that it lacks is an empty table."""
    out = {}
    for name, columns in FEED.items():
        wanted = columns.split()
        try:
            rows, _ = read_delimited(spark, f"{folder}/{name}.txt")
        except FileNotFoundError:
            rows = spark.createDataFrame([], ", ".join(f"{c} string" for c in wanted))
        out[name] = rows.select(*(F.trim(F.col(f"`{c}`")).alias(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in wanted))
    return out


def _members(name: str, data: bytes, depth: int) -> Iterator[tuple[str, bytes]]:
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for info in z.infolist():
                if not info.is_dir():
                    inner = z.read(info)
                    if depth > 1 and zipfile.is_zipfile(io.BytesIO(inner)):
                        yield from _members(f"{name}!{info.filename}", inner, depth - 1)
                    else:
                        yield f"{name}!{info.filename}", inner
    except zipfile.BadZipFile:
        yield f"{name}!bad", b""


def read_archives(spark: SparkSession, path: str, depth: int = 3) -> DataFrame:
    """(member, size, sha256, content) of the members of ZIP files, and of ZIP files in them, to a depth."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, data in zip(f["path"], f["content"], strict=True):
                for member, content in _members(name.rsplit("/", 1)[-1], data, depth):
                    yield pd.DataFrame({"member": [member], "size": [len(content)], "sha256": [sha256(content).hexdigest()], "content": [content]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "member string, size long, sha256 string, content binary")


def repaired_lines(data: bytes) -> list[str]:
    """The whole lines that a gzip file, which may be cut off, still holds."""
    inflate = zlib.decompressobj(31)
    out = bytearray()
    try:
        for at in range(0, len(data), 1 << 16):
            out += inflate.decompress(data[at : at + (1 << 16)])
    except zlib.error:
        pass
    whole = bytes(out) if inflate.eof else bytes(out[: out.rfind(b"\n") + 1])
    return whole.decode("utf-8", "replace").splitlines()


def read_cut_archives(spark: SparkSession, path: str) -> DataFrame:
    """(line) of gzip files whose ends may be missing."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for data in f["content"]:
                yield pd.DataFrame({"line": repaired_lines(data)})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "line string")


def read_sqlite(spark: SparkSession, path: str, table: str, columns: list[str]) -> DataFrame:
    """Columns of a table, as text, of SQLite files. Each file is one task's work."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ", ".join('"' + c.replace('"', '""') + '"' for c in columns)
        for f in frames:
            for data in f["content"]:
                with tempfile.NamedTemporaryFile(suffix=".db") as held:
                    held.write(data)
                    held.flush()
                    with sqlite3.connect(f"file:{held.name}?immutable=1", uri=True) as db:
                        cursor = db.execute(f'select {names} from "{table}"')
                        while rows := cursor.fetchmany(50_000):
                            yield pd.DataFrame([[None if x is None else str(x) for x in r] for r in rows], columns=columns)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, ", ".join(f"`{c}` string" for c in columns))


def write_balanced(df: DataFrame, path: str, partition: list[str] | None = None) -> int:
    """Writes zstd Parquet to a new path and reads it back; raises where the rows that came don't balance. Rows are counted as they pass."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").option("compression", "zstd")
    (writer.partitionBy(*partition) if partition else writer).parquet(path)
    written = df.sparkSession.read.parquet(path).count()
    if written != seen.get["n"]:
        raise RuntimeError(f"{written} rows were written of {seen.get['n']}")
    return written


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows with all columns; what a frame lacks is null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def file_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name, size and content hash of all Parquet files of a folder, those in folders below it too, with the rows that they hold."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(sf_dir)
    return files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "length", F.sha2("content", 256).alias("sha256"))


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("customer_balance"))
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("supplier_balance"))
    return union_by_name([c, s]).groupBy("nation").agg(F.round(F.sum("customer_balance"), 4).alias("customers"), F.round(F.sum("supplier_balance"), 4).alias("suppliers"))


SOURCE_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "file_catalogue": (file_catalogue, ""),
    "schema_evolution": (schema_evolution, "select nation, round(sum(a), 4) customers, round(sum(b), 4) suppliers from (select c_nationkey nation, c_acctbal a, null::double b from customer union all select s_nationkey, null, s_acctbal from supplier) group by nation"),
}
