"""Queries that once did their job in part only, against plain loops: each of these tests failed before."""

from collections import defaultdict
from math import asin, cos, radians, sin, sqrt

import pytest

from stratafold import catalog
from stratafold.plans.model import run


def meters(a, b):
    p, q = radians(a.lat), radians(b.lat)
    return 2 * 6371008.8 * asin(sqrt(sin((q - p) / 2) ** 2 + cos(p) * cos(q) * sin(radians(b.lon - a.lon) / 2) ** 2))


@pytest.fixture(scope="module")
def places(spark):
    return run(spark, "/root/testdata/sf0.01", "select id, lat, lon from poi").collect()


def test_distance_join_has_every_pair(spark, places):
    want = {(a.id, b.id) for a in places for b in places if a.id < b.id and abs(a.lat - b.lat) < 0.2 and meters(a, b) <= 20000}
    found = [(r.a_id, r.b_id) for r in catalog.QUERIES["grid_distance_join"](spark, "/root/testdata/sf0.01").collect()]
    assert len(found) == len(set(found)) and set(found) == want and any(a % 5 for a, _ in want)


def test_comparables_reach_the_whole_radius(spark, places):
    """For every target, ids divisible by 50, all places within 40 km."""
    want = {(t.id, x.id) for t in places if t.id % 50 == 0 for x in places if x.id != t.id and meters(t, x) <= 40000}
    found = [(r.target, r.id) for r in catalog.QUERIES["comparables_similarity"](spark, "/root/testdata/sf0.01").collect()]
    assert set(found) == want and len(found) == len(want) and 42 not in {t for t, _ in want}


def test_stop_patterns_are_ordered_sequences(spark):
    trips = defaultdict(list)
    for r in spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_suppkey").collect():
        trips[r.l_orderkey].append((r.l_linenumber, r.l_suppkey))
    want = defaultdict(list)
    for trip, stops in trips.items():
        want[tuple(sorted(stops))].append(trip)
    found = catalog.QUERIES["stop_pattern_signature"](spark, "/root/testdata/sf0.01").collect()
    assert sorted((r.trips, r.sample) for r in found) == sorted((len(x), min(x)) for x in want.values())
    assert len({r.signature for r in found}) == len(found) == len(want)
