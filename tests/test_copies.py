"""Queries on pairs of which many are copies: each of these tests failed before, by what it asks of the plan or of the operator."""

import contextlib
import io
import itertools

import pytest

from pyspark.sql import functions as F

from stratafold import catalog
from stratafold.operators import matching, relational

PLACES = "id long, name string, phone string, lat double, lon double, food boolean"


def plan(df):
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        df.explain()
    return told.getvalue()


@pytest.fixture(scope="module")
def copies(spark):
    """Two tables of places, many of them at one position with one name."""
    names = ["Kafe Ada", "Kafe Adam", "Berber", None]
    a = spark.createDataFrame([(i, names[i % 4], None if i % 5 else f"5{i:09d}", 40.0 + i % 3 / 100, 30.0, i % 2 == 0) for i in range(60)], PLACES)
    b = spark.createDataFrame([(i, names[i % 3], None if i % 7 else f"5{i:09d}", 40.0005 + i % 3 / 100, 30.0, i % 3 == 0) for i in range(50)], PLACES)
    return a, b


def test_place_pairs_weigh_copies_once_and_send_no_table_to_all(spark, sf_dir, copies):
    a, b = copies
    classes, pairs = matching.place_classes(a, b), matching.place_pairs(a, b)
    assert 0 < classes.count() < pairs.count() == pairs.select("a_id", "b_id").distinct().count()
    held = [(x, y) for x, y in itertools.product(a.collect(), b.collect()) if x.id % 3 == y.id % 3 and (x.name and {x.name, y.name} <= {"Kafe Ada", "Kafe Adam"} or x.name == y.name or x.phone and x.phone == y.phone)]
    assert {(r.a_id, r.b_id) for r in pairs.collect()} == {(x.id, y.id) for x, y in held}
    assert "Broadcast" not in plan(catalog.QUERIES["place_match_scores"](spark, sf_dir))


def test_matches_of_copies_are_greedy_without_rounds(copies, monkeypatch):
    want = {(r.a, r.b, r.score) for r in matching.matched(matching.place_pairs(*copies), 0.5).collect()}
    monkeypatch.setattr(relational, "one_to_one", None)
    assert {(r.a, r.b, r.score) for r in matching.place_matches(*copies, 0.5).collect()} == want and len(want) > 20


def test_groups_of_long_chains_take_few_rounds_and_send_nothing_to_all(spark, monkeypatch):
    """A street of places, each within reach of the next one alone: the driver keeps something of each round."""
    rounds, cut = [], relational.cut

    def told(df):
        done = cut(df)
        rounds.append(df._jdf.queryExecution().executedPlan().toString())  # as Spark ran it, after what it learned of sizes meanwhile
        return done

    monkeypatch.setattr(relational, "cut", told)
    order = [i * 37 % 101 for i in range(101)]  # ids in no order along the street
    links = spark.createDataFrame([*zip(order, order[1:], strict=False), (500, 501), (700, 700)], "x long, y long")
    found = {(r.node, r.root) for r in relational.connected(links).collect()}
    assert found == {(i, 0) for i in range(101)} | {(500, 500), (501, 500), (700, 700)}
    assert len(rounds) < 15 and not any("Broadcast" in ran for ran in rounds) and "isFinalPlan=true" in rounds[-1]


def test_large_groups_of_pairs_go_by_rounds(spark):
    pairs = spark.createDataFrame([(a, b, 1.0, 0) for a in range(4) for b in range(3)] + [(9, 9, 0.5, 1)], "a long, b long, score double, group_ long")
    for most in (1, 100):
        assert sorted((r.a, r.b) for r in relational.one_to_one_by_group(pairs, most).collect()) == [(0, 0), (1, 1), (2, 2), (9, 9)]


def test_cells_are_as_high_as_the_distance(spark):
    """250 m due north are a bit more than 250 / 111,320 degrees, so cells of that height let pairs two cells apart go by."""
    from stratafold.operators import spatial

    # From just below a cell's upper edge to just above the next cell's, by cells of either height
    south = [(k + 1) * 250 / d - 1e-7 for d in (111_320, 111_000) for k in range(100)]
    a = spark.createDataFrame([(i, y, 30.0) for i, y in enumerate(south)], "id long, lat double, lon double")
    b = a.select(F.col("id").alias("other"), (F.col("lat") + 249.9 / 111_195.1).alias("lat2"), F.col("lon").alias("lon2"))
    assert spatial.within(a, b, 250.0).where("id = other").count() == len(south)


def test_positions_of_copies_meet_once(spark):
    from stratafold.operators import spatial

    rows = [(i, 40.0 + i % 4 * 0.1, 30.0) for i in range(24)] + [(99, None, 30.0)]
    found = [(r.a_id, r.b_id) for r in spatial.pairs_within(spark.createDataFrame(rows, "id long, lat double, lon double"), 20_000).collect()]
    assert sorted(found) == [(i, j) for i in range(24) for j in range(i + 1, 24) if abs(i % 4 - j % 4) < 2]
    assert "collect_list" in plan(catalog.QUERIES["grid_distance_join"](spark, "/root/testdata/sf0.001"))


def test_quarters_that_are_alike_are_weighed_once(spark, sf_dir):
    columns = "id long, district long, name string, people long"
    web = spark.createDataFrame([(i, i % 2, "Ada Mah." if i % 3 else "Bag", 100) for i in range(12)] + [(50, 0, None, 1), (51, None, "Ada", 1)], columns)
    official = spark.createDataFrame([(i, i % 2, "ADA", 100 if i % 4 else None) for i in range(8)], columns)
    found = {(r.a_id, r.b_id): r.consistency for r in matching.district_pairs(web, official).collect()}
    assert found == {(i, j): 1.0 if j % 4 else None for i in range(12) for j in range(8) if i % 3 and i % 2 == j % 2}
    assert "collect_list" in plan(catalog.QUERIES["district_match_scores"](spark, sf_dir))


def test_names_of_a_block_are_compared_once(spark, sf_dir):
    assert "collect_list" in plan(catalog.QUERIES["jaro_winkler_match"](spark, sf_dir))


def test_nearest_searches_a_position_once(spark, monkeypatch):
    from stratafold.operators import spatial

    asked, within = [], spatial.within
    monkeypatch.setattr(spatial, "within", lambda a, b, metres: asked.append((a.count(), b.count())) or within(a, b, metres))
    points = "lat double, lon double"
    a = spark.createDataFrame([(i, 40.0, 30.0 + i % 2) for i in range(10)] + [(10, None, 30.0)], f"k long, {points}")
    b = spark.createDataFrame([(i, 40.001, 30.0 + i % 2) for i in range(20, 40)] + [(5, 44.0, 34.0)], f"id long, {points}")
    assert sorted((r.k, r.id) for r in spatial.nearest(a, "k", b, "id").collect()) == [(i, 20 + i % 2) for i in range(10)]
    assert asked[0] == (3, 3)


def test_schools_of_a_position_and_kind_meet_once(spark, sf_dir):
    told = plan(catalog.QUERIES["nearest_schools_by_kind"](spark, sf_dir))
    assert "partial_min(id" in told and "Broadcast" not in told.split("SortMergeJoin")[-1]


def test_types_of_a_block_are_compared_once(spark, sf_dir):
    assert "collect_list" in plan(catalog.QUERIES["token_jaccard_pairs"](spark, sf_dir))


def test_what_is_asked_alike_is_looked_up_once(spark):
    asked = spark.createDataFrame([(i, "P 1", "d1" if i % 2 else None, "Q 1" if i % 3 else None) for i in range(12)], "id long, province string, district string, quarter string")
    known = spark.createDataFrame([(9, "p1", "d1", "q1", None), (4, "p1", "d1", "q1", None), (7, "p1", "d2", "q1", "x"), (8, "p1", "d1", "z", None)], "rule long, province string, district string, quarter string, area string")
    found = matching.rule_lookup(asked, known)
    want = {i: ((4, "exact") if i % 3 else (4, "district")) if i % 2 else (4, "quarter") for i in range(12) if i % 2 or i % 3}
    assert {r.id: (r.rule, r.how) for r in found.collect()} == want
    assert "partial_min(rule" in plan(found)


def test_each_number_said_counts_as_in_sql(spark, tmp_path):
    """A total that equals the customer: both numbers count where neither is known, and a customer's number does not back a total."""
    import duckdb

    rows = [(6, 1000, 1000.5), (9, 1000, 1000.5), (12, 1001, 1000.5), (4, 7, 1000.5), (2, 1000, 1000.5)]
    con = duckdb.connect()
    con.execute("create table orders as select * from (values " + ", ".join(f"({a}::bigint, {b}::bigint, {c}::double)" for a, b, c in rows) + ") t(o_orderkey, o_custkey, o_totalprice)")
    con.execute(f"copy orders to '{tmp_path}/orders.parquet' (format parquet)")
    want = dict(con.sql(catalog.ORACLE_SQL["number_audit"]).fetchall())
    assert {r.id: r.unsupported for r in catalog.QUERIES["number_audit"](spark, str(tmp_path)).collect()} == want and want[6] == 2 and want[9] == 1
