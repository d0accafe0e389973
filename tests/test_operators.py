"""Relational and spatial operators on small cases with ties and nulls."""

import math
import random

import pytest
from pyspark.sql import functions as F

from stratafold.operators import relational as R
from stratafold.operators import spatial as S


def test_latest_and_dedup(spark):
    df = spark.createDataFrame([("a", 1.0, "2", "x"), ("a", 2.0, "2", "y"), ("a", 9.0, None, "z"), ("b", 5.0, None, "x"), ("b", 5.0, None, "x")], "k string, v double, upd string, src string")
    assert {(r.k, r.v) for r in R.keep_latest(df, ["k"], [F.col("upd").desc_nulls_last(), F.col("src").desc()]).collect()} == {("a", 2.0), ("b", 5.0)}
    assert {tuple(r) for r in R.dedup_observations(df, ["k"], "v", ["upd", "src"]).collect()} == {("a", 9.0, 3, True), ("b", 5.0, 2, False)}  # ranks are compared as joined texts, where an empty part sorts last


def test_upserts_and_differences(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, None, 3)], "k int, v string, t int")
    new = spark.createDataFrame([(2, "c", 9), (3, None, 9), (4, "d", 9)], "k int, v string, t int")
    rows = lambda df: {tuple(r) for r in df.collect()}
    assert rows(R.upsert(old, new, ["k"])) == {(1, "a", 1), (2, "c", 9), (3, None, 9), (4, "d", 9)}
    assert rows(R.upsert(old, new, ["k"], "first")) == {(1, "a", 1), (2, "b", 2), (3, None, 3), (4, "d", 9)}
    assert rows(R.upsert(old, new.withColumn("v", F.lit(None).cast("string")), ["k"], "coalesce")) == {(1, "a", 1), (2, "b", 9), (3, None, 9), (4, None, 9)}
    assert rows(R.history(old, new, ["k"], ("t",))) == {(2, "b", 2)}
    assert rows(R.snapshot_diff(old, new, ["k"])) == {(1, "removed"), (2, "changed"), (3, "changed"), (4, "added")}
    with pytest.raises(ValueError):
        R.upsert(old, new, ["k"], "other")


def test_ranks(spark):
    df = spark.createDataFrame([("a", 1, 1), ("b", 2, 1), ("c", 2, 5), ("d", 7, 1)], "k string, v int, w int")
    got = {r.k: (r.i, r.p) for r in df.select("k", R.average_rank("v").alias("i"), F.round(R.percent_position("v"), 3).alias("p")).collect()}
    assert got == {"a": (1.0, 0.0), "b": (2.5, 50.0), "c": (2.5, 50.0), "d": (4.0, 100.0)}
    assert R.weighted_median(df.withColumn("g", F.lit(1)), ["g"], "v", "w").first().weighted_median == 2
    assert [r.k for r in R.top(df, [F.col("v").desc(), F.col("k")], 2).orderBy("place").collect()] == ["d", "b"]
    assert {tuple(r) for r in R.zero_filled(df.select("k"), df.where("v > 1").select("k", "v"), "k", "v").collect()} == {("a", 0), ("b", 2), ("c", 2), ("d", 7)}


def test_sessions(spark):
    df = spark.sql("select * from values ('u', timestamp '2024-01-01 00:00:00'), ('u', timestamp '2024-01-01 00:30:00'), ('u', timestamp '2024-01-01 03:00:00') t(k, t)")
    assert [r.session for r in R.sessions(df, "k", "t", 3600).orderBy("t").collect()] == [1, 1, 2]


def test_one_to_one(spark):
    rng = random.Random(7)
    pairs = list({(rng.randint(0, 20), rng.randint(0, 20)): 0 for _ in range(120)})
    scored = [(a, b, rng.randint(0, 9) / 10) for a, b in pairs]
    used_a, used_b, want = set(), set(), set()
    for a, b, s in sorted(scored, key=lambda x: (-x[2], x[0], x[1])):
        if a not in used_a and b not in used_b:
            want.add((a, b, s))
            used_a.add(a)
            used_b.add(b)
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    assert {tuple(r) for r in R.one_to_one(spark.createDataFrame(scored, "a int, b int, score double")).collect()} == want


def test_spatial(spark):
    rng = random.Random(8)
    rows = [(i, 39 + rng.random(), 30 + rng.random()) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, lat double, lon double")
    found = {(r.a_id, r.b_id) for r in S.distance_join(df, df, 3000).collect()}
    every = df.alias("a").crossJoin(df.alias("b")).select(F.col("a.id").alias("x"), F.col("b.id").alias("y"), S.haversine(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")).alias("m"))
    assert found == {(r.x, r.y) for r in every.where("m <= 3000").collect()}
    center = S.near(df, 39.5, 30.5, 20_000)
    assert center.count() == df.where(S.haversine(F.lit(39.5), F.lit(30.5), F.col("lat"), F.col("lon")) <= 20_000).count()
    shape = "area_id int, ring array<struct<x:double,y:double>>"
    areas = spark.createDataFrame([(1, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]), (2, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)])], shape)
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 2.0, 3.0), (3, 5.0, 5.0)], "id int, x double, y double")
    assert {tuple(r) for r in S.containing_area(points, areas).collect()} == {(1, 1), (2, 2)}
    assert areas.where("area_id = 2").select(S.ring_area(F.col("ring")).alias("a")).first().a == 16.0
    text = spark.range(1).select(S.polygon_text(S.circle(F.lit(40.0), F.lit(30.0), 100)).alias("t")).first().t
    points = [tuple(map(float, p.split())) for p in text[len("POLYGON((") : -2].split(", ")]
    assert len(points) == 73 and points[0] == points[-1]
    assert all(abs(math.hypot((x - 30) * 111_320 * math.cos(math.radians(40)), (y - 40) * 111_320) - 100) < 0.1 for x, y in points)


def test_one_to_one_settles_long_chains(spark):
    chain = [(i, j, 1000.0 - i - j) for i in range(12) for j in (i, i + 1)]
    found = {(r.a, r.b) for r in R.one_to_one(spark.createDataFrame(chain, "a int, b int, score double")).collect()}
    assert found == {(i, i) for i in range(12)}


def test_nearest_widens_its_search(spark):
    a = spark.createDataFrame([(1, 40.0, 30.0), (2, 10.0, 50.0)], "k int, lat double, lon double")
    b = spark.createDataFrame([(7, 40.0, 30.001), (8, 40.0, 31.0), (6, 40.0, 29.999)], "id int, lat double, lon double")
    assert sorted((r.k, r.id) for r in S.nearest(a, "k", b, "id", 0.01).collect()) == [(1, 6), (2, 8)]
    assert S.nearest(a, "k", b.limit(0), "id", 0.01).count() == 0


def test_running_and_ranks(spark):
    df = spark.createDataFrame([(i, (i * 7) % 10) for i in range(200)], "id int, v int").repartition(7)
    found = {r.id: r for r in R.ranked(df, "v").collect()}
    assert all(found[i].least_rank == 1 + 20 * ((i * 7) % 10) and found[i].average_rank == 10.5 + 20 * ((i * 7) % 10) and found[i].n == 200 for i in found)
    assert [r.id for r in R.numbered(df, ["v", "id"]).orderBy("place").collect()] == sorted(range(200), key=lambda i: ((i * 7) % 10, i))
    assert R.numbered(df.limit(0), ["id"]).count() == 0 and R.ranked(df.limit(0), "v").count() == 0
