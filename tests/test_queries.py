"""Every query of the reference's own operators against its oracle on the smallest tables."""

import math

import duckdb
import pytest

from stratafold import catalog
from stratafold.plans.model import TABLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)) or str(value) in ("<NA>", "NaT"):
        return "null"
    if isinstance(value, str):
        return value
    try:
        return f"{float(value):.6g}"
    except (TypeError, ValueError):
        return str(value)


def rows(df):
    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_twin(name, spark, sf_dir, duck):
    ours, theirs = catalog.QUERIES[name](spark, sf_dir).toPandas(), duck.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_flagship(spark, sf_dir):
    assert catalog.flagship(spark, sf_dir).count() > 0


def test_plans_are_checked(spark, sf_dir):
    from stratafold.plans import surface as S

    engine = S.Engine(spark, sf_dir)
    state = lambda make, *a, **k: S.answer(engine, make, *a, **k)["state"]
    assert state(S.Rank, "price", "ilce", dim="F") == "ok"
    assert state(S.Rank, "price", "ilce") == state(S.Rank, "price", "ilce", dim="X") == state(S.Rank, "price", "mahalle", dim="F") == "invalid"
    assert state(S.Rank, "price", "ilce", "MAH_1_BUILDING", dim="F") == state(S.Rank, "price", "ilce", limit=0) == state(S.Rank, "price") == "invalid"
    assert state(S.Rank, "price", "ilce", dim="F", period="1875-01") == state(S.Rank, "height", "ilce") == state(S.Profile, "XX_1") == "not_found"
    assert state(S.Compare, ("ILCE_1",), ("price",)) == state(S.Listing, order="distance") == state(S.Surroundings, 38, 34, 10) == "invalid"
    told = S.answer(engine, S.Coverage, "share rents")
    assert told["state"] == "ambiguous" and told["candidates"] == ["listing_share"] and S.measure("population").id == "people"
    assert state(S.Projection, "ILCE_1", "listing_share") == "invalid" and state(S.Projection, "MAH_1_BUILDING", "people") == "not_found"
    assert S.fingerprint(S.Coverage("price")) == S.fingerprint(S.Coverage("price")) != S.fingerprint(S.Coverage("people"))
    assert {t["name"] for t in S.tools()} >= {"rank", "outlook"} and len(S.tools()) == 16
    units = engine.scope("mahalle", "IL_1")
    assert {r.geo_id.split("_")[1] for r in units.collect()} == {str(r.n_nationkey) for r in spark.read.parquet(f"{sf_dir}/nation.parquet").where("n_regionkey = 1").collect()}


def test_place_matches_are_greedy(spark, sf_dir):
    from stratafold.operators import matching
    from stratafold.plans.model import given
    from stratafold.plans.queries_matching import _A, _B

    pairs = matching.place_pairs(given(spark, sf_dir, _A), given(spark, sf_dir, _B))
    held = sorted(((r.score, r.meters, r.a_id, r.b_id) for r in pairs.where("score >= 0.5").collect()), key=lambda x: (-(x[0] * 1e6 - x[1] / 1e6), x[2], x[3]))
    used_a, used_b, want = set(), set(), set()
    for _, _, a, b in held:
        if a not in used_a and b not in used_b:
            used_a.add(a)
            used_b.add(b)
            want.add((a, b))
    assert {(r.a, r.b) for r in matching.matched(pairs, 0.5).collect()} == want and want


def test_matchers(spark):
    from stratafold.operators import matching

    a = spark.createDataFrame([(1, "P", "D1", ["devlet"], ["hastane"]), (2, "P", "D2", ["sehir"], ["hastane"]), (3, "Q", "D1", ["x"], ["y"])], "id int, province string, district string, words array<string>, kinds array<string>")
    b = spark.createDataFrame([(10, "P", "D1", ["devlet"], ["hastane"], 40.0, 30.0), (11, "P", "D9", ["sehir"], ["hastane"], 40.0, 30.0), (12, "P", "D9", ["sehit"], ["hastane"], 41.0, 30.0)], "place_id int, province string, district string, words array<string>, kinds array<string>, lat double, lon double")
    got = {r.id: (r.place_id, r.score, r.status) for r in matching.facilities(a, b).collect()}
    assert got[1] == (10, 1.0, "matched") and got[2][2] == "matched" and got[2][0] == 11 and got[3] == (None, None, "none")
    new = spark.createDataFrame([(1, "Kafe Çınar", 40.0, 30.0), (2, "Other", 40.0, 30.0)], "id int, name string, lat double, lon double")
    known = spark.createDataFrame([(7, "KAFE CINAR", 40.0005, 30.0), (8, "kafe çınar", 41.0, 30.0)], "id int, name string, lat double, lon double")
    assert [(r.a_id, r.b_id, r.likeness) for r in matching.same_business(new, known).collect()] == [(1, 7, 1.0)]
