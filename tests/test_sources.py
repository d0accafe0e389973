"""Nested sources, sinks and streams on small cases."""

import json

import pytest
from pyspark.sql import functions as F

from stratafold.sources import files, nested, sinks
from stratafold.streaming import events


def docs(spark, *texts):
    return spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "path string, doc string")


def test_delimited_keeps_rows_like_the_header_and_quoted_breaks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text('k;v\n1;"x\ny"\nk;v\n2;z\n', encoding="utf-8")
    (tmp_path / "in/b.csv").write_text("k;v\n3;w\n", encoding="utf-8")
    rows, rejects = files.read_delimited(spark, str(tmp_path / "in"), breaks=True)
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "x\ny"), ("2", "z"), ("3", "w"), ("k", "v")] and rejects.count() == 0
    (tmp_path / "c.csv").write_bytes("ad;n\nİĞŞ;1\n".encode("cp1254"))
    assert files.read_delimited(spark, str(tmp_path / "c.csv"))[0].first().ad == "İĞŞ"
    assert files.encoding_of("çığ".encode()[:-1]) == "UTF-8"


def test_json_lines_and_positional_records(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\nnot json\n{"b": "x"}\n[1]\n', encoding="utf-8")
    rows, rejects = files.read_json_lines(spark, str(tmp_path / "a.jsonl"))
    assert sorted((r.a or 0, r.b or "") for r in rows.collect()) == [(0, "x"), (1, "")] and sorted(r.line for r in rejects.collect()) == ["[1]", "not json"]
    got = files.positional(spark.createDataFrame([('a,"b,c",d',), ("x",)], "value string"), 3).collect()
    assert [(json.loads(r.values_json), r.status) for r in got] == [(["a", "b,c", "d"], "valid"), (["x"], "malformed_column_count")]


def test_feed(spark, tmp_path):
    (tmp_path / "stops.txt").write_text("stop_id,stop_name\ns1,One\n", encoding="utf-8")
    feed = files.read_feed(spark, str(tmp_path))
    assert tuple(feed["stops"].first()) == ("s1", "One", None, None, None) and feed["trips"].count() == 0 and "headway_secs" in feed["frequencies"].columns


def test_dictionary_and_guide(spark):
    d = docs(spark, '{"a": {"x": 1, "y": [2]}, "b": 5, "c": {"z": "t"}}')
    rows = {r.key: (r.fields, r.value_json) for r in nested.dictionary(d).collect()}
    assert rows["a"][0] == {"x": "1", "y": "[2]"} and rows["b"] == (None, "5") and rows["c"][0] == {"z": "t"}
    wide = nested.widened(nested.dictionary(d)).orderBy("key").collect()
    assert [(r.x, r.y, r.z) for r in wide] == [("1", "[2]", None), (None, None, None), (None, None, "t")]
    g = docs(spark, '{"1": {"il": "A", "ilceler": ["p", {"ad": "q"}]}, "2": ["r"], "3": {"ad": "C"}, "4": 7}')
    got = sorted(((r.key, r.name, r.child, r.place) for r in nested.guide(g).collect()), key=str)
    assert got == sorted([("1", "A", "p", 1), ("1", "A", '{"ad":"q"}', 2), ("2", None, "r", 1), ("3", "C", None, None), ("4", None, None, None)], key=str)


def test_records(spark):
    d = docs(spark, '{"m": 1, "short": [{"a": 1}], "long": [{"a": 2}, {"b": 3}], "flat": [1, 2, 3]}', '[{"a": 9}, 4]', '{"none": 1}')
    got = sorted(((r.path, r.under, r.place, r.fields) for r in nested.records(d).collect()), key=str)
    assert got == sorted([("f0", "long", 1, {"a": "2"}), ("f0", "long", 2, {"b": "3"}), ("f1", None, 1, {"a": "9"}), ("f1", None, 2, None), ("f2", None, None, None)], key=str)


def test_geojson(spark, tmp_path):
    feature = lambda i, g: {"type": "Feature", "id": i, "properties": {"n": i}, "geometry": g}
    ring = {"type": "Polygon", "coordinates": [[[30.0, 40.0], [31.5, 40.0], [31.5, 41.0], [30.0, 40.0]]]}
    d = docs(spark, json.dumps({"type": "FeatureCollection", "features": [feature(1, ring), feature(2, None)]}))
    rows = nested.geojson(d).orderBy("place").collect()
    assert [(r.id, r.properties, r.kind) for r in rows] == [("1", {"n": "1"}, "Polygon"), ("2", {"n": "2"}, None)]
    box = nested.boxed(nested.geojson(d)).collect()
    assert [(r.west, r.south, r.east, r.north, r.lon, r.lat) for r in box] == [(30.0, 40.0, 31.5, 41.0, 30.75, 40.5)]
    (tmp_path / "a.seq").write_text("\x1e" + json.dumps(feature(7, ring)) + "\n\n\x1e" + json.dumps(feature(8, None)) + "\n", encoding="utf-8")
    assert sorted(r.id for r in nested.geojson_sequence(spark, str(tmp_path / "a.seq")).collect()) == ["7", "8"]


def test_sdmx(spark):
    doc = {
        "data": {
            "structure": {
                "dimensions": {
                    "series": [{"id": "AREA", "values": [{"id": "TR1", "name": "x"}, {"id": "TR2", "name": "y"}]}, {"id": "SEX", "values": [{"id": "F", "name": "f"}]}],
                    "observation": [{"id": "TIME", "values": [{"id": "2020", "name": "2020"}, {"id": "2021", "name": "2021"}]}],
                },
                "attributes": {"observation": [{"id": "STATUS", "values": [{"id": "A", "name": "a"}, {"id": "E", "name": "e"}]}]},
            },
            "dataSets": [{"series": {"1:0": {"observations": {"0": [3.5, 1], "1": ["4,25", None]}}, "0:0": {"observations": {"1": [None]}}}}],
        }
    }
    got = sorted(((r.series, r.dims, r.period, r.value, r.attributes) for r in nested.sdmx(docs(spark, json.dumps(doc))).collect()), key=str)
    assert got == sorted([("1:0", {"AREA": "TR2", "SEX": "F"}, "2020", 3.5, {"STATUS": "E"}), ("1:0", {"AREA": "TR2", "SEX": "F"}, "2021", 4.25, {}), ("0:0", {"AREA": "TR1", "SEX": "F"}, "2021", None, {})], key=str)


def test_timetable(spark):
    page = '<table class="hs-kv"><tr><td>Line</td><td>:</td><td><b>12</b></td></tr></table><table class="hs-table"><tr><th>Week</th><th>Sunday</th></tr><tr><td class="hs-times">6:05<br>07:10 A<br/>x</td><td class="hs-times" >8:00 -</td></tr></table><table id="route-table"><tr><td>1</td><td>S9</td><td>First</td></tr><tr><td>no</td><td>a</td><td>b</td></tr></table>'
    r = nested.timetable(spark.createDataFrame([(page,), (None,)], "html string")).collect()
    assert r[0].facts == {"Line": "12"} and [tuple(x) for x in r[0].departures] == [("Week", 21900, None), ("Week", 25800, "A"), ("Sunday", 28800, None)]
    assert [tuple(x) for x in r[0].stops] == [(1, "S9", "First")]


def test_unread(spark):
    sources = spark.createDataFrame([("a",), ("b",), (None,)], "path string")
    assert sorted(r.path or "" for r in nested.unread(sources, spark.createDataFrame([("a",), (None,)], "path string")).collect()) == ["", "b"]


def test_publish(spark, tmp_path):
    to = str(tmp_path / "t")
    assert sinks.publish(spark.range(5), to, "1") == 5 and spark.read.parquet(to).count() == 5
    assert sinks.publish(spark.range(9), to, "1") == 5  # this version is there
    assert sinks.publish(spark.range(9), to, "2") == 9 and spark.read.parquet(to).count() == 9
    with pytest.raises(Exception):
        sinks.publish(spark.range(3).select(F.raise_error(F.lit("broken")).alias("x")), to, "3")
    assert spark.read.parquet(to).count() == 9
    assert sinks.unit_path("price", "trend", "a.db", "t") == sinks.unit_path("price", "trend", "a.db", "t") != sinks.unit_path("price", "trend", "b.db", "t")


def test_semicolons(spark, tmp_path):
    sinks.write_semicolons(spark.createDataFrame([("a;b", 1.5, 2), ('q"x', None, 3)], "s string, d double, i int").coalesce(1), str(tmp_path / "c"))
    text = "".join(p.read_text(encoding="utf-8") for p in sorted((tmp_path / "c").glob("part-*")))
    assert text == '﻿s;d;i\n"a;b";1,5;2\n"q""x";;3\n'


def test_beyond_and_serving(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2)], "k string, id long")
    first, state = sinks.beyond(df, {"a": 1}, "k")
    assert sorted(tuple(r) for r in first.collect()) == [("a", 5), ("b", 2)] and state == {"a": 5, "b": 2}
    again, same = sinks.beyond(df, state, "k")
    assert again.count() == 0 and same == state
    shown = sinks.serving(spark.createDataFrame([(3, "p", False), (1, "q", None), (2, "r", True)], "id int, phone string, hidden boolean"), ["phone"], ["hidden"], "id", 2)
    assert shown.columns == ["id"] and sorted(r.id for r in shown.collect()) == [1, 3]
    places = spark.createDataFrame([(1, 40.0, 30.0, 7), (1, 50.0, 30.0, 8), (None, 40.0, 30.0, None)], "id int, lat double, lon double, parent int")
    assert sinks.checked(places, "id", spark.createDataFrame([(7,)], "parent int"), "parent", (35, 25, 43, 46)) == {"null_keys": 1, "repeated_keys": 1, "orphans": 1, "outside": 1}
    sinks.indexed(df, str(tmp_path / "i"), "k", 4)
    assert sorted(r.id for r in sinks.looked_up(spark, str(tmp_path / "i"), "k", "a", 4).collect()) == [1, 5]
    sinks.logged(spark, str(tmp_path / "log"), rows=3)
    sinks.logged(spark, str(tmp_path / "log"), rows=4)
    assert sorted(json.loads(r.value)["rows"] for r in spark.read.text(str(tmp_path / "log")).collect()) == [3, 4]


def test_upserting_stream(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "t")
    schema = "k int, v string, t int, seen int"
    rows = lambda *r: spark.createDataFrame(r, schema).coalesce(1).write.mode("append").parquet(str(source))
    run = lambda: events.upserting(spark.readStream.schema(schema).parquet(str(source)), table, ["k"], "t", ("seen",)).awaitTermination()
    rows((1, "a", 1, 0), (2, "b", 1, 0), (1, "z", 0, 0))
    run()
    rows((1, "c", 2, 9), (2, "b", 2, 9), (2, "late", 0, 9), (3, "d", 1, 9))
    run()
    run()  # nothing new
    assert sorted((r.k, r.v) for r in events.version(spark, table).collect()) == [(1, "c"), (2, "b"), (3, "d")]
    assert [(r.k, r.v) for r in spark.read.parquet(f"{table}-history").collect()] == [(1, "a")]


def test_snapshot_events(spark):
    a = spark.createDataFrame([(1, 40.0, 30.0), (2, 40.0, 30.0), (3, 40.0, 30.0)], "id int, lat double, lon double")
    b = spark.createDataFrame([(2, 40.0, 30.0001), (3, 40.01, 30.0), (4, 40.0, 30.0)], "id int, lat double, lon double")
    assert events.snapshot_events(None, a, ["id"], "2024-01-01").count() == 0
    assert sorted((r.id, r.event) for r in events.snapshot_events(a, b, ["id"], "2024-01-02").collect()) == [(1, "removed"), (3, "moved"), (4, "added")]
