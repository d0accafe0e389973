"""Event streams with Structured Streaming: windows with watermarks, exact duplicates, changes between snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import haversine
from ..operators import relational
from ..operators.lineage import shared
from ..plans.model import expand


def stream(spark: SparkSession, sf_dir: str, name: str = "events") -> DataFrame:
    """A table as a stream of its files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need instants; the session's zone is UTC


def tumbling_counts(events: DataFrame, width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts and sums by type and window; events later than the watermark no longer count."""
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("window.start").cast("timestamp_ntz").alias("begins"), "event_type", "n", F.round("total", 6).alias("total"))


def deduplicated(events: DataFrame, late: str = "1 day") -> DataFrame:
    """The first row of each event_id within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def finished(df: DataFrame, mode: str) -> DataFrame:
    """Runs a stream over all that is there, and returns what it has put out: Parquet in the folder that all executors share. A batch that is done
    anew writes over its own folder."""
    spark = df.sparkSession
    folder = f"{shared(spark)}/stream-{uuid.uuid4().hex}"
    done: list[int] = []

    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/out/batch={batch}")
        done.append(batch)

    df.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    if not done:
        return spark.createDataFrame([], df.schema)
    if mode == "complete":
        return spark.read.parquet(f"{folder}/out/batch={max(done)}")
    return spark.read.parquet(f"{folder}/out").drop("batch")


def upserting(rows: DataFrame, table: str, keys: list[str], order: str, volatile: tuple[str, ...] = ()):
    """Starts a stream that keeps the last row of each key in a table of Parquet versions, table/version=N, and what changed rows were before in
    table-history/batch=N. Corrections that arrive late count by their order; a batch that is done anew gives the same version."""

    def put(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        new = relational.keep_latest(batch, keys, [F.col(order).desc(), F.xxhash64(*batch.columns)])
        old = version(spark, table, n - 1)
        if old is None:
            new.write.mode("overwrite").parquet(f"{table}/version={n}")
            return
        fresh = new.join(old.select(*keys, F.col(order).alias("order_")), keys, "left").where(F.col("order_").isNull() | (F.col(order) >= F.col("order_"))).drop("order_")
        relational.history(old, fresh, keys, (order, *volatile)).write.mode("overwrite").parquet(f"{table}-history/batch={n}")
        relational.upsert(old, fresh, keys).write.mode("overwrite").parquet(f"{table}/version={n}")

    return rows.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", f"{table}-checkpoint").trigger(availableNow=True).start()


def version(spark: SparkSession, table: str, most: int | None = None) -> DataFrame | None:
    """The newest version of a table that upserting has written, up to `most`."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(table)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    names = [x.getPath().getName() for x in fs.listStatus(path)]
    found = [int(x.removeprefix("version=")) for x in names if x.startswith("version=")]
    found = [x for x in found if most is None or x <= most]
    return spark.read.parquet(f"{table}/version={max(found)}") if found else None


def snapshot_events(before: DataFrame | None, after: DataFrame, keys: list[str], date: str, moved_metres: float = 150.0) -> DataFrame:
    """(keys, event, date) of what appeared, went, or moved by more than a distance (lat, lon) since the last snapshot. The first snapshot is the baseline and
    makes no events; the same date and snapshots give the same events."""
    if before is None:
        return after.limit(0).select(*keys, F.lit("").alias("event"), F.lit(date).alias("date"))
    a, b = before.select(*keys, F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"), F.lit(True).alias("was")), after.select(*keys, "lat", "lon", F.lit(True).alias("is_"))
    far = haversine(F.col("a_lat"), F.col("a_lon"), F.col("lat"), F.col("lon")) > moved_metres
    event = F.when(F.col("was").isNull(), "added").when(F.col("is_").isNull(), "removed").when(far, "moved")
    return a.join(b, keys, "full_outer").select(*keys, event.alias("event"), F.lit(date).alias("date")).where("event is not null")


def session_counts(events: DataFrame, gap: str = "1 hour") -> DataFrame:
    """Sessions of each user: runs of events with no pause of the gap or more."""
    found = events.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return found.select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("begins"), "n", F.round("total", 6).alias("total"))


def stream_tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(tumbling_counts(stream(spark, sf_dir)), "complete")


def stream_dedup_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    twice = stream(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(1) + F.col("event_id") % 3)))  # up to three of each
    return finished(deduplicated(twice).select("event_id", "user_id", "event_type"), "append")


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_counts(spark.read.parquet(f"{sf_dir}/events.parquet"))


def recent_events_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the last days before the end of the table, by type and by the place's category; places lie where their ids say."""
    from ..operators import spatial
    from ..plans.model import given

    e = given(spark, sf_dir, "select event_id, event_type, ts, user_id % 2000 id from events")
    last = e.agg(F.max("ts").alias("last"))
    near = spatial.near(given(spark, sf_dir, "select id, category, cast(lat as double) lat, cast(lon as double) lon from poi"), 39.0, 35.0, 150_000)
    recent = e.crossJoin(F.broadcast(last)).where(F.col("ts") > F.col("last") - F.expr("interval 10 days"))
    return recent.join(near, "id").groupBy("event_type", "category").agg(F.count("*").alias("n"))


STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"stream_tumbling_counts": stream_tumbling_counts, "stream_dedup_watermark": stream_dedup_watermark, "session_windows": stream_sessions, "recent_events_near": recent_events_near}
STREAM_SQL = {
    "stream_tumbling_counts": "select date_trunc('day', ts)::timestamp begins, event_type, count(*) n, round(sum(value), 6) total from events group by 1, 2",
    "stream_dedup_watermark": "select event_id, user_id, event_type from events",
    "session_windows": "with g as (select *, case when ts - lag(ts) over (partition by user_id order by ts) < interval 1 hour then 0 else 1 end b from events), s as (select *, sum(b) over (partition by user_id order by ts rows unbounded preceding) k from g) select user_id, min(ts) begins, count(*) n, round(sum(value), 6) total from s group by user_id, k",
    "recent_events_near": expand("select event_type, category, count(*) n from events join poi on id = user_id % 2000 where ts > (select max(ts) from events) - interval 10 days and 2 * 6371008.8 * asin(sqrt(power(sin(radians(lat - 39.0) / 2), 2) + cos(radians(39.0)) * cos(radians(lat)) * power(sin(radians(lon - 35.0) / 2), 2))) <= 150000 group by 1, 2", duck=True),
}
