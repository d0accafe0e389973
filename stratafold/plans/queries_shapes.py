"""Aggregates, windows, sorts, joins and checks that the model's analyses are put together from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import haversine, rules
from ..operators import relational, spatial
from .model import TABLES, given, run
from .twins import twin, twin_tables

# Aggregates


@twin("approximate_distincts", "select source, md5(text) h from documents", "select source, count(distinct h) exact_n, true close from i group by source")
def approximate_distincts(i):
    n = i.groupBy("source").agg(F.count_distinct("h").alias("exact_n"), F.approx_count_distinct("h", 0.02).alias("about"))
    return n.select("source", "exact_n", (F.abs(F.col("about") / F.col("exact_n") - 1) <= 0.1).alias("close"))


@twin("most_frequent_mode", "select c_nationkey k, c_mktsegment x from customer", "select k, (select x from (select x, count(*) n from i j where j.k = i.k group by x order by n desc, x limit 1)) as x from (select distinct k from i) i")
def most_frequent_mode(i):
    n = i.groupBy("k", "x").count()
    return n.groupBy("k").agg(F.min_by("x", F.struct(-F.col("count"), F.col("x"))).alias("x"))


@twin("distinct_lists", "select geo_id, src from obs", "select geo_id, string_agg(distinct src, ',' order by src) sources from i group by geo_id")
def distinct_lists(i):
    return i.groupBy("geo_id").agg(F.array_join(F.sort_array(F.collect_set("src")), ",").alias("sources"))


@twin("first_value_pivot", "select c_nationkey k, c_mktsegment seg, c_name v from customer", "select k, " + ", ".join(f"min(v) filter (where seg = '{x}') {x.lower()}" for x in ("AUTOMOBILE", "BUILDING", "HOUSEHOLD")) + " from i group by all")
def first_value_pivot(i):
    wide = i.groupBy("k").pivot("seg", ["AUTOMOBILE", "BUILDING", "HOUSEHOLD"]).agg(F.min("v"))
    return wide.select("k", *(F.col(x).alias(x.lower()) for x in ("AUTOMOBILE", "BUILDING", "HOUSEHOLD")))


@twin("corridor_profile", "select user_id corridor, cast(ts as date) d, extract(hour from ts) h, value * 10 speed, event_type kind from events",
    """with t as (select corridor, d, count(*) n from i group by 1, 2), p as (select corridor, count(*) n, avg(speed) mean, min(speed) least, 100.0 * (count(*) filter (kind = 'error')) / count(*) jam from i group by 1),
    x as (select corridor, h, count(*) n, row_number() over (partition by corridor order by count(*) desc, h) r from i group by 1, 2)
    select p.corridor, (select avg(n) from t where t.corridor = p.corridor) daily, x.h::bigint peak, round(p.mean, 8) mean, p.least, round(p.jam, 8) jam, case when p.jam >= 30 then 'heavy' when p.jam >= 20 then 'middle' else 'light' end cls from p join x on x.corridor = p.corridor and x.r = 1""")
def corridor_profile(i):
    hours = i.groupBy("corridor", "h").agg(F.count("*").alias("n"))
    peak = hours.groupBy("corridor").agg(F.min_by("h", F.struct(-F.col("n"), F.col("h"))).cast("long").alias("peak"))
    whole = i.groupBy("corridor").agg((F.count("*") / F.count_distinct("d")).alias("daily"), F.round(F.avg("speed"), 8).alias("mean"), F.min("speed").alias("least"), F.round(100 * F.avg((F.col("kind") == "error").cast("int")), 8).alias("jam"))
    return whole.join(peak, "corridor").withColumn("cls", F.when(F.col("jam") >= 30, "heavy").when(F.col("jam") >= 20, "middle").otherwise("light"))


@twin("histogram_top5", "select p_brand k, p_size x from part", """with c as (select k, x, count(*) n, row_number() over (partition by k order by count(*) desc, x) r from i group by 1, 2), s as (select k, avg(x) mean, median(x) median, max(x) most from i group by k)
    select s.k, round(mean, 8) mean, median, most, '[' || string_agg('{"x":' || x || ',"n":' || n || '}', ',' order by r) || ']' as top from s join c on c.k = s.k and r <= 5 group by all""")
def histogram_top5(i):
    counts = i.groupBy("k", "x").agg(F.count("*").alias("n"))
    five = counts.groupBy("k").agg(F.to_json(F.transform(F.slice(F.sort_array(F.collect_list(F.struct(-F.col("n"), "x", "n"))), 1, 5), lambda s: F.struct(s["x"].alias("x"), s["n"].alias("n")))).alias("top"))
    return i.groupBy("k").agg(F.round(F.avg("x"), 8).alias("mean"), F.percentile("x", 0.5).alias("median"), F.max("x").alias("most")).join(five, "k")


@twin("source_match_rates", "select o_orderpriority src, o_custkey % 7 <> 0 placed, o_totalprice > 200000 priced from orders", "select src, count(*) n, round(sum(placed::int)::double / count(*), 9) placed, round(sum(priced::int)::double / count(*), 9) priced from i group by src")
def source_match_rates(i):
    share = lambda c: F.round(F.avg(F.col(c).cast("int")), 9).alias(c)
    return i.groupBy("src").agg(F.count("*").alias("n"), share("placed"), share("priced"))


@twin("column_profiles", "select c_custkey, case when c_custkey % 9 = 0 then null when c_custkey % 9 = 1 then '' else lpad(cast(c_custkey as string), 6, '0') end code, 'TR' country, c_mktsegment from customer",
    " union all ".join(f"select '{c}' col, count(*) n, (count(*) filter ({c} is null)) nulls, (count(*) filter ({c} = '')) empties, count(distinct {c}) distincts, min({c}) lowest, max({c}) highest, (count(*) filter (regexp_matches({c}, '^0[0-9]'))) leading_zeros, count(distinct {c}) <= 1 constant from i" for c in ("code", "country", "c_mktsegment")))
def column_profiles(i):
    return relational.profile(i, ["code", "country", "c_mktsegment"])


# Windows and sorts


@twin("distinct_over_window", "select doc_id, source, lang from documents", "select i.doc_id, d.n langs from i join (select source, count(distinct lang) n from i group by source) d on i.source is not distinct from d.source")
def distinct_over_window(i):
    return i.select("doc_id", F.size(F.collect_set("lang").over(W.partitionBy("source"))).cast("long").alias("langs"))


@twin("surrogate_keys", "select n_name nm, n_regionkey from nation", "select nm, 'GEO_' || lpad((select count(*) from i j where (j.n_regionkey, j.nm) <= (i.n_regionkey, i.nm))::varchar, 6, '0') id from i")
def surrogate_keys(i):
    return relational.numbered(i, ["n_regionkey", "nm"]).select("nm", F.concat(F.lit("GEO_"), F.lpad(F.col("place").cast("string"), 6, "0")).alias("id"))


@twin("latest_manifest", "select o_custkey path, o_orderkey ordinal, o_orderdate seen, o_orderstatus status from orders", "select path, status, ordinal from i where not exists (select 1 from i j where j.path = i.path and (j.seen, j.ordinal) > (i.seen, i.ordinal))")
def latest_manifest(i):
    return i.groupBy("path").agg(F.max(F.struct("seen", "ordinal", "status")).alias("m")).select("path", "m.status", "m.ordinal")


@twin("group_minimum", "select p_brand k, p_retailprice v from part", "select distinct k, min(v) over (partition by k) least from i")
def group_minimum(i):
    return i.groupBy("k").agg(F.min("v").alias("least"))


@twin("composite_order", "select p_partkey id, case when p_partkey % 5 = 0 then null else p_brand end brand, p_size from part", "select id, row_number() over (order by case when brand is null then 1 else 0 end, brand, p_size desc, id) place from i")
def composite_order(i):
    return relational.numbered(i, [F.col("brand").isNull(), "brand", F.col("p_size").desc(), "id"]).select("id", "place")


@twin("competition_rank", "select s_suppkey, s_acctbal from supplier", "select s_suppkey, (select count(*) from i j where j.s_acctbal > i.s_acctbal) + 1 rnk, (select count(*) from i) n from i")
def competition_rank(i):
    return relational.ranked(i, "s_acctbal", descending=True).select("s_suppkey", F.col("least_rank").alias("rnk"), "n")


@twin("rank_average_ties", "select p_partkey, p_size from part", "select p_partkey, (select count(*) filter (j.p_size < i.p_size) + (count(*) filter (j.p_size = i.p_size) + 1) / 2.0 from i j)::double avg_rank from i")
def rank_average_ties(i):
    return relational.ranked(i, "p_size").select("p_partkey", F.col("average_rank").alias("avg_rank"))


@twin("ordered_listing", "select id, case when id % 13 = 0 then null else cast(rating as double) end rating, price from poi", "select id, rating, row_number() over (order by rating is null, rating desc, price desc, id) i from i order by 3 limit 50")
def ordered_listing(i):
    top = i.orderBy(F.col("rating").desc_nulls_last(), F.col("price").desc_nulls_last(), "id").limit(50)  # a report of 50
    return top.select("id", "rating", F.row_number().over(W.orderBy(F.col("rating").desc_nulls_last(), F.col("price").desc_nulls_last(), "id")).cast("long").alias("i"))


@twin("point_cap_flagged", "select id, price from poi", "select id, (select count(*) from i) n, (select count(*) from i) > 400 cut from (select id from i order by price desc, id limit 400)")
def point_cap_flagged(i):
    n = i.agg(F.count("*").alias("n"))
    return i.orderBy(F.col("price").desc(), "id").limit(400).select("id").crossJoin(F.broadcast(n)).withColumn("cut", F.col("n") > 400)


@twin("locality_order", "select id, lat, lon from poi", """with c as (select id, floor((lat - 35) / 8 * 256)::int y, floor((lon - 25) / 21 * 256)::int x from i), b as (select id, unnest(range(8)) k, x, y from c)
    select id, sum((((x >> k) & 1) << (2 * k)) + (((y >> k) & 1) << (2 * k + 1)))::bigint z from b group by id""")
def locality_order(i):
    return spatial.locality(i, "lat", "lon", (35.0, 25.0, 43.0, 46.0), bits=8).select("id", "z")


@twin("trailing_12m_sum", "select geo_id, period, h from obs", """with m as (select geo_id, period, period[1:4]::int * 12 + period[6:7]::int i, count(*) n from i group by 1, 2, 3)
    select a.geo_id, a.period, sum(b.n)::bigint total from m a join m b on a.geo_id = b.geo_id and b.i between a.i - 11 and a.i group by 1, 2 having count(*) = 12""")
def trailing_12m_sum(i):
    m = i.groupBy("geo_id", "period").agg(F.count("*").alias("n")).withColumn("at", rules.period_number(F.col("period")))
    year = W.partitionBy("geo_id").orderBy("at").rangeBetween(-11, 0)
    return m.select("geo_id", "period", F.sum("n").over(year).alias("total"), F.count("*").over(year).alias("months")).where("months = 12").drop("months")


@twin("winner_runner_up", "select geo_id, period, dim, src, v, upd, h from obs", """with r as (select *, row_number() over (partition by geo_id, period, dim order by upd desc, src, h) rk from i)
    select w.geo_id, w.period, w.dim, w.src winner, u.src runner_up, w.v winner_v, u.v runner_v from r w left join r u on w.geo_id = u.geo_id and w.period = u.period and w.dim = u.dim and u.rk = 2 where w.rk = 1""")
def winner_runner_up(i):
    best = W.partitionBy("geo_id", "period", "dim").orderBy(F.col("upd").desc(), "src", "h")
    led = i.select("geo_id", "period", "dim", F.col("src").alias("winner"), F.lead("src").over(best).alias("runner_up"), F.col("v").alias("winner_v"), F.lead("v").over(best).alias("runner_v"), F.row_number().over(best).alias("rk"))
    return led.where("rk = 1").drop("rk")


_EVIDENCE = """select o_orderkey observation, o_custkey % 400 k, case o_orderstatus when 'F' then 3 when 'O' then 2 else 1 end cls, o_orderkey % 3 governance, 40 + o_orderkey % 7 * 5 quality, o_orderkey % 4 completeness,
    case when o_orderkey % 9 = 0 then null else cast(o_orderdate as string) end seen, case when o_orderkey % 5 = 0 then null else substr(cast(o_orderdate as string), 1, 7) end period, md5(cast(o_orderkey as string)) content from orders"""


@twin("conflict_decisions", _EVIDENCE, """with r as (select *, row_number() over (partition by k order by cls desc, governance desc, quality desc, completeness desc, seen desc nulls last, period desc nulls last, content, observation) n from i), g as (select k, count(*) c from i group by k having count(*) > 1)
    select g.k, w.observation selected, c - 1 alternatives, case when w.cls > u.cls then 'record_class_priority' when w.governance > u.governance then 'source_governance_priority' when w.quality > u.quality then 'quality_score' when w.completeness > u.completeness then 'payload_completeness'
    when w.seen is not null and w.seen is distinct from u.seen then 'latest_collection_time' when w.period is not null and w.period is distinct from u.period then 'latest_period' else 'stable_content_hash_tiebreak' end reason,
    case when w.cls > u.cls or w.governance > u.governance or w.quality >= u.quality + 10 then 'high' when w.quality > u.quality or w.completeness > u.completeness then 'medium' else 'low' end confidence
    from g join r w on w.k = g.k and w.n = 1 join r u on u.k = g.k and u.n = 2""")
def conflict_decisions(i):
    return relational.decisions(i, "k", "observation").select("k", "selected", "alternatives", "reason", "confidence")


@twin("conflict_rate_by_reason", _EVIDENCE, """with r as (select k, cls, governance, row_number() over (partition by k order by cls desc, governance desc, quality desc, completeness desc, seen desc nulls last, period desc nulls last, content, observation) n from i)
    select w.cls > u.cls by_class, count(*) n from r w join r u on w.k = u.k and w.n = 1 and u.n = 2 group by 1""")
def conflict_rate_by_reason(i):
    return relational.decisions(i, "k", "observation").groupBy((F.col("reason") == "record_class_priority").alias("by_class")).agg(F.count("*").alias("n"))


# Joins


@twin_tables("level_lookup", """with i as (select o_orderkey id, case o_orderkey % 4 when 0 then 'il' when 1 then 'ilce' when 2 then 'mahalle' else 'x' end lvl, case o_orderkey % 4 when 0 then 'IL_' || (o_custkey % 6) when 1 then 'ILCE_' || (o_custkey % 30) else 'MAH_' || (o_custkey % 25) || '_BUILDING' end code from orders)
    select i.id, i.lvl, coalesce(a.geo_id, b.geo_id, c.geo_id) geo from i left join geo a on a.geo_id = code and lvl = 'il' and a.level = 'il' left join geo b on b.geo_id = code and lvl = 'ilce' and b.level = 'ilce' left join geo c on c.geo_id = code and lvl = 'mahalle' and c.level = 'mahalle'""")
def level_lookup_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One join on (level, code) in place of one for each level."""
    rows = given(spark, sf_dir, "select o_orderkey id, case o_orderkey % 4 when 0 then 'il' when 1 then 'ilce' when 2 then 'mahalle' else 'x' end lvl, case o_orderkey % 4 when 0 then 'IL_' || (o_custkey % 6) when 1 then 'ILCE_' || (o_custkey % 30) else 'MAH_' || (o_custkey % 25) || '_BUILDING' end code from orders")
    places = given(spark, sf_dir, "select * from geo").select(F.col("level").alias("lvl"), F.col("geo_id").alias("code"), F.col("geo_id").alias("geo"))
    return rows.join(places, ["lvl", "code"], "left").select("id", "lvl", "geo")


_NEAR = "select id, name, brand, category, lat, lon, price, rating from poi"


def _pois(spark: SparkSession, sf_dir: str, text: str = _NEAR) -> DataFrame:
    return given(spark, sf_dir, text)


@twin_tables("bbox_range_join", "with c as (select * from poi where id % 50 = 0) select c.id center, count(*) n from c join poi p on p.lat between c.lat - 0.4 and c.lat + 0.4 and p.lon between c.lon - 0.3 and c.lon + 0.3 group by c.id")
def bbox_range_join(spark, sf_dir):
    """Boxes around every place whose id is divisible by 50, against all places, by cells of one degree's half."""
    p = _pois(spark, sf_dir)
    pairs = spatial.box_join(p.where("id % 50 = 0").select(F.col("id").alias("center"), "lat", "lon"), p.select("id", "lat", "lon"), 0.4, 0.3)
    return pairs.groupBy("center").agg(F.count("*").alias("n"))


_SUPPLIERS = "select s_suppkey, cast(36 + (s_suppkey * 53 % 600) / 100.0 as double) lat, cast(26 + (s_suppkey * 71 % 1900) / 100.0 as double) lon from supplier"


@twin_tables("nearest_neighbour_minby", f"""with s as ({_SUPPLIERS}), d as (select s_suppkey, p.id, 2 * 6371008.8 * asin(sqrt(power(sin(radians(p.lat - s.lat) / 2), 2) + cos(radians(s.lat)) * cos(radians(p.lat)) * power(sin(radians(p.lon - s.lon) / 2), 2))) m from s cross join poi p)
    select s_suppkey, arg_min(id, (round(m, 3), id)) nearest, round(min(m), 2) meters from d group by s_suppkey""")
def nearest_neighbour_minby(spark, sf_dir):
    return spatial.nearest(given(spark, sf_dir, _SUPPLIERS), "s_suppkey", _pois(spark, sf_dir), "id", cell=0.5).select("s_suppkey", F.col("id").alias("nearest"), F.round("meters", 2).alias("meters"))


@twin_tables("grid_distance_join", None)
def grid_distance_join(spark, sf_dir):
    """The pairs of the text of this name in queries_sql, which stays the oracle's: positions meet once, and their ids after that."""
    p = run(spark, sf_dir, "select id, cast(lat as double) lat, cast(lon as double) lon from poi")
    return spatial.pairs_within(p, 20_000).select("a_id", "b_id", F.col("m3").alias("meters"))


@twin_tables("nearest_settlement", f"""with s as ({_SUPPLIERS}), d as (select s_suppkey, p.id, 2 * 6371008.8 * asin(sqrt(power(sin(radians(p.lat - s.lat) / 2), 2) + cos(radians(s.lat)) * cos(radians(p.lat)) * power(sin(radians(p.lon - s.lon) / 2), 2))) m from s cross join poi p)
    select s.s_suppkey, x.nearest, x.meters from s left join (select s_suppkey, arg_min(id, (round(m, 3), id)) nearest, round(min(m), 2) meters from d where m <= 15000 group by s_suppkey) x on x.s_suppkey = s.s_suppkey""")
def nearest_settlement(spark, sf_dir):
    """The nearest place within 15 km; null where there is none."""
    s = given(spark, sf_dir, _SUPPLIERS)
    near = spatial.within(s, _pois(spark, sf_dir).select("id", F.col("lat").alias("lat2"), F.col("lon").alias("lon2")), 15_000)
    best = near.groupBy("s_suppkey").agg(F.min(F.struct(F.round("meters", 3).alias("m"), "id", "meters")).alias("b"))
    return s.select("s_suppkey").join(best, "s_suppkey", "left").select("s_suppkey", F.col("b.id").alias("nearest"), F.round("b.meters", 2).alias("meters"))


_AREAS = "select n_nationkey id, cast(36 + n_nationkey % 6 as double) lat0, cast(26 + n_nationkey % 18 as double) lon0, cast(1 + n_nationkey % 3 as double) side from nation"


@twin_tables("point_in_rectangle_smallest", f"with r as ({_AREAS}) select p.id, arg_min(r.id, (r.side, r.id)) area_id, count(*) hits from poi p join r on p.lat >= r.lat0 and p.lat < r.lat0 + r.side and p.lon >= r.lon0 and p.lon < r.lon0 + r.side group by p.id")
def point_in_rectangle_smallest(spark, sf_dir):
    """Each area in the cells that it covers, joined to points by cell."""
    areas = given(spark, sf_dir, _AREAS).select(F.col("id").alias("area"), "lat0", "lon0", (F.col("lat0") + F.col("side")).alias("lat1"), (F.col("lon0") + F.col("side")).alias("lon1"), "side")
    hits = spatial.covering(_pois(spark, sf_dir), areas, cell=1.0)
    return hits.groupBy("id").agg(F.min(F.struct("side", "area"))["area"].alias("area_id"), F.count("*").alias("hits"))


@twin_tables("containing_or_nearest", f"""with r as ({_AREAS}), c as (select id area, lat0 + side / 2 clat, lon0 + side / 2 clon from r), h as (select p.id, min(r.id) area from poi p join r on p.lat >= r.lat0 and p.lat < r.lat0 + r.side and p.lon >= r.lon0 and p.lon < r.lon0 + r.side group by p.id),
    d as (select p.id, c.area, 2 * 6371008.8 * asin(sqrt(power(sin(radians(c.clat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(c.clat)) * power(sin(radians(c.clon - p.lon) / 2), 2))) m from poi p, c where p.id not in (select id from h))
    select p.id, coalesce(h.area, n.area) area, case when h.area is not null then 'contains' when n.area is not null then 'nearest' end how from poi p left join h on h.id = p.id left join (select id, arg_min(area, (round(m, 3), area)) area from d where m <= 60000 group by id) n on n.id = p.id""")
def containing_or_nearest(spark, sf_dir):
    """The area that holds a point, else the one whose centre is nearest within 60 km."""
    p = _pois(spark, sf_dir).select("id", "lat", "lon")
    areas = given(spark, sf_dir, _AREAS).select(F.col("id").alias("area"), "lat0", "lon0", (F.col("lat0") + F.col("side")).alias("lat1"), (F.col("lon0") + F.col("side")).alias("lon1"), "side")
    inside = spatial.covering(p, areas, cell=1.0).groupBy("id").agg(F.min("area").alias("held"))
    centres = areas.select("area", ((F.col("lat0") + F.col("lat1")) / 2).alias("lat2"), ((F.col("lon0") + F.col("lon1")) / 2).alias("lon2"))
    near = spatial.within(p.join(inside, "id", "left_anti"), centres, 60_000).groupBy("id").agg(F.min(F.struct(F.round("meters", 3).alias("m"), "area"))["area"].alias("nearest"))
    found = p.select("id").join(inside, "id", "left").join(near, "id", "left")
    return found.select("id", F.coalesce("held", "nearest").alias("area"), F.when(F.col("held").isNotNull(), "contains").when(F.col("nearest").isNotNull(), "nearest").alias("how"))


@twin_tables("comparables_similarity", """with t as (select * from poi where id % 50 = 0), d as (select t.id target, p.id, 2 * 6371.0088 * asin(sqrt(power(sin(radians(p.lat - t.lat) / 2), 2) + cos(radians(t.lat)) * cos(radians(p.lat)) * power(sin(radians(p.lon - t.lon) / 2), 2))) km, t.brand = p.brand nb, t.category = p.category ds, least(t.price, p.price) / greatest(t.price, p.price) ar, greatest(0.2, 1 - (p.id % 900) / 730.0) rec
    from t join poi p on p.id <> t.id and p.lat between t.lat - 0.5 and t.lat + 0.5)
    select target, id, round(100 * (0.35 * case when nb then 1.0 when ds then 0.7 else 0.35 end + 0.30 * ar + 0.25 * greatest(0, 1 - km / 40) + 0.10 * rec)::double, 1) score from d where km <= 40""")
def comparables_similarity(spark, sf_dir):
    """Likeness of all places within 40 km to each target: place, area (here the price), distance, age."""
    return _comparables(spark, sf_dir).select("target", "id", "score")


def _comparables(spark, sf_dir):
    p = _pois(spark, sf_dir)
    t = p.where("id % 50 = 0").select(F.col("id").alias("target"), "lat", "lon", F.col("brand").alias("b0"), F.col("category").alias("c0"), F.col("price").alias("p0"))
    near = spatial.within(t, p.select("id", F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), "brand", "category", "price"), 40_000).where("id <> target")
    place = F.when(F.col("brand") == F.col("b0"), 1.0).when(F.col("category") == F.col("c0"), 0.7).otherwise(0.35)
    area = F.least("price", "p0") / F.greatest("price", "p0")
    age = F.greatest(F.lit(0.2), 1 - (F.col("id") % 900) / 730.0)
    return near.withColumn("score", F.round(100 * (0.35 * place + 0.30 * area + 0.25 * F.greatest(F.lit(0.0), 1 - F.col("meters") / 40_000) + 0.10 * age), 1))


@twin_tables("comparable_statistics", """with t as (select * from poi where id % 50 = 0), d as (select t.id target, p.price v, p.id, 2 * 6371.0088 * asin(sqrt(power(sin(radians(p.lat - t.lat) / 2), 2) + cos(radians(t.lat)) * cos(radians(p.lat)) * power(sin(radians(p.lon - t.lon) / 2), 2))) km, t.brand = p.brand nb, t.category = p.category ds, least(t.price, p.price) / greatest(t.price, p.price) ar, greatest(0.2, 1 - (p.id % 900) / 730.0) rec
    from t join poi p on p.id <> t.id and p.lat between t.lat - 0.5 and t.lat + 0.5), s as (select target, v, id, greatest(1, round(100 * (0.35 * case when nb then 1.0 when ds then 0.7 else 0.35 end + 0.30 * ar + 0.25 * greatest(0, 1 - km / 40) + 0.10 * rec)::double, 1)) w from d where km <= 40),
    c as (select *, sum(w) over (partition by target order by v, id rows between unbounded preceding and current row) upto, sum(w) over (partition by target) whole from s)
    select t.id target, count(c.v) n, case when count(c.v) > 0 then 'available' else 'insufficient_comparables' end status, round(quantile_cont(c.v, 0.5)) median, round(min(c.v) filter (upto >= whole / 2 - 1e-9)) weighted, round(quantile_cont(c.v, 0.25)) low, round(quantile_cont(c.v, 0.75)) high from t left join c on c.target = t.id group by t.id""")
def comparable_statistics(spark, sf_dir):
    c = _comparables(spark, sf_dir).withColumn("w", F.greatest(F.lit(1.0), "score"))
    per = W.partitionBy("target")
    held = c.withColumn("upto", F.sum("w").over(per.orderBy("price", "id").rowsBetween(W.unboundedPreceding, 0))).withColumn("whole", F.sum("w").over(per))
    found = held.groupBy("target").agg(F.count("*").alias("n"), F.round(F.percentile("price", 0.5)).alias("median"), F.round(F.min(F.when(F.col("upto") >= F.col("whole") / 2 - 1e-9, F.col("price")))).alias("weighted"), F.round(F.percentile("price", 0.25)).alias("low"), F.round(F.percentile("price", 0.75)).alias("high"))
    targets = _pois(spark, sf_dir).where("id % 50 = 0").select(F.col("id").alias("target"))
    return targets.join(found, "target", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("status", F.when(F.col("n") > 0, "available").otherwise("insufficient_comparables"))


@twin_tables("frequency_expansion", "select o_orderkey trip, (o_orderkey % 20 * 900 + unnest(range(0, 3600 + (o_orderkey % 5) * 1800, 600 + (o_orderkey % 3) * 300)))::bigint departure from orders")
def frequency_expansion(spark, sf_dir):
    """Every departure of a headway, however long its range."""
    o = given(spark, sf_dir, "select o_orderkey trip, o_orderkey % 20 * 900 first_s, 3600 + (o_orderkey % 5) * 1800 span, 600 + (o_orderkey % 3) * 300 headway from orders")
    return o.select("trip", F.explode(F.sequence(F.col("first_s"), F.col("first_s") + F.col("span") - 1, F.col("headway"))).alias("departure"))


@twin_tables("stop_pattern_signature", "with s as (select l_orderkey trip, count(*) n, string_agg(l_suppkey || '#' || l_linenumber, ',' order by l_linenumber, l_suppkey) sig from lineitem group by 1) select n || '-' || md5(sig) signature, min(trip) as sample, count(*) trips from s group by 1")
def stop_pattern_signature(spark, sf_dir):
    stops = given(spark, sf_dir, "select l_orderkey trip, l_linenumber seq, l_suppkey stop from lineitem").groupBy("trip").agg(F.sort_array(F.collect_list(F.struct("seq", "stop"))).alias("s"))
    told = F.array_join(F.transform("s", lambda x: F.concat_ws("#", x["stop"].cast("string"), x["seq"].cast("string"))), ",")
    return stops.groupBy(F.concat(F.size("s").cast("string"), F.lit("-"), F.md5(told)).alias("signature")).agg(F.min("trip").alias("sample"), F.count("*").alias("trips"))


@twin_tables("pattern_trip_times", "with o as (select distinct l_linenumber seq, l_linenumber * 300 a from lineitem) select o_orderkey trip, seq, (o_orderkey % 86400 + a)::bigint arrival from orders, o where o_orderstatus = 'P'")
def pattern_trip_times(spark, sf_dir):
    """Stop times of trips that share a pattern of offsets."""
    offsets = given(spark, sf_dir, "select distinct 'P' pattern, l_linenumber seq, l_linenumber * 300 a from lineitem")
    trips = given(spark, sf_dir, "select o_orderkey trip, o_orderstatus pattern, o_orderkey % 86400 t0 from orders")
    return trips.join(offsets, "pattern").select("trip", "seq", (F.col("t0") + F.col("a")).alias("arrival"))


@twin_tables("stop_positions_filled", """with s as (select l_orderkey route, l_linenumber seq, row_number() over (partition by l_orderkey order by l_linenumber, l_suppkey, l_partkey) n, case when l_suppkey % 3 = 0 then null else 36.0 + l_suppkey % 500 / 100.0 end lat from lineitem),
    w as (select *, last_value(lat ignore nulls) over b p, last_value(case when lat is not null then n end ignore nulls) over b pn, first_value(lat ignore nulls) over f q, first_value(case when lat is not null then n end ignore nulls) over f qn from s window b as (partition by route order by n rows between unbounded preceding and 1 preceding), f as (partition by route order by n rows between 1 following and unbounded following))
    select route, n, round(coalesce(lat, case when qn - pn <= 6 then p + (n - pn) * (q - p) / (qn - pn) end)::double, 8) lat, case when lat is not null then 'given' when qn - pn <= 6 then 'between' end how from w""")
def stop_positions_filled(spark, sf_dir):
    """Positions between the nearest known stops on both sides, at most six apart."""
    s = given(spark, sf_dir, "select l_orderkey route, l_linenumber seq, l_suppkey, l_partkey, cast(case when l_suppkey % 3 = 0 then null else 36.0 + l_suppkey % 500 / 100.0 end as double) lat from lineitem")
    s = s.withColumn("n", F.row_number().over(W.partitionBy("route").orderBy("seq", "l_suppkey", "l_partkey")).cast("long"))
    return relational.interpolated(s, ["route"], "n", "lat", most=6).select("route", "n", F.round("lat", 8).alias("lat"), "how")


@twin_tables("departures_by_place", """with d as (select e.event_id, e.user_id % 25 nk, extract(hour from ts) * 3600 + extract(minute from ts) * 60 s, extract(isodow from ts) w from events e) select n_name place, event_id, lpad((s // 3600)::varchar, 2, '0') || ':' || lpad((s // 60 % 60)::varchar, 2, '0') hhmm from d join nation on n_nationkey = nk where w = 1 and s between 25200 and 32400""")
def departures_by_place(spark, sf_dir):
    """The board of all places: Mondays from seven to nine."""
    e = given(spark, sf_dir, "select event_id, cast(user_id % 25 as int) n_nationkey, ts from events")
    s = F.hour("ts") * 3600 + F.minute("ts") * 60
    board = e.where((F.weekday("ts") == 0) & F.pmod(s, F.lit(86400)).between(25200, 32400))
    return board.join(F.broadcast(given(spark, sf_dir, "select n_nationkey, n_name place from nation")), "n_nationkey").select("place", "event_id", rules.clock(s).alias("hhmm"))


# Checks and catalogues


@twin_tables("data_dictionary", " union all ".join(f"select '{t}' tbl, (row_number() over ())::int ordinal, column_name col from (describe select * from {t})" for t in ("customer", "orders", "documents")))
def data_dictionary(spark, sf_dir):
    rows = [(t, i, f.name) for t in ("customer", "orders", "documents") for i, f in enumerate(spark.read.parquet(f"{sf_dir}/{t}.parquet").schema, 1)]
    return spark.createDataFrame(rows, "tbl string, ordinal int, col string")


@twin_tables("column_roles", """with c as (select 'poi' tbl, * from (values ('id', 'BIGINT', 1), ('name', 'VARCHAR', 2), ('lat', 'DOUBLE', 3), ('price', 'DOUBLE', 4), ('created_at', 'VARCHAR', 5), ('props_json', 'VARCHAR', 6), ('category', 'VARCHAR', 7)) t(col, typ, n))
    select col, case when n = 1 and col = 'id' then 'key' when col in ('lat', 'lon') then 'coordinate' when col like '%_at' then 'time' when col like '%json%' then 'json' when typ = 'DOUBLE' then 'measure' when col = 'name' then 'text' else 'dimension' end as role from c""")
def column_roles(spark, sf_dir):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("id bigint, name string, lat double, price double, created_at string, props_json string, category string")
    return spark.createDataFrame(list(relational.roles(schema).items()), "col string, role string")


@twin_tables("personal_columns", "select 'phone' col from (select 1)")
def personal_columns(spark, sf_dir):
    """Columns that a product must not show."""
    return spark.createDataFrame([(c,) for c in relational.personal(["id", "name", "phone", "price"])], "col string")


@twin("columns_excluded", "select * from supplier", "select * exclude (s_acctbal, s_nationkey) from i")
def columns_excluded(i):
    return i.drop("s_acctbal", "s_nationkey")


@twin("product_names", "select c_custkey, c_name, c_acctbal, c_mktsegment from customer", "select c_custkey musteri_id, c_mktsegment pazar, c_acctbal bakiye from i")
def product_names(i):
    return i.select(F.col("c_custkey").alias("musteri_id"), F.col("c_mktsegment").alias("pazar"), F.col("c_acctbal").alias("bakiye"))


@twin("eligible_rows", "select h, v, projected, src from obs", "select h from i where v > 0 and projected = 0 and src not in ('4-NOT SPECIFIED')")
def eligible_rows(i):
    return i.where((F.col("v") > 0) & (F.col("projected") == 0) & ~F.col("src").isin("4-NOT SPECIFIED")).select("h")


@twin("dimension_filter", "select id, brand, category from poi", "select id from i where case when 'sektor:Brand#2' like 'sektor:%' then brand = 'Brand#2' end union all select id from i where category = 'ECONOMY'")
def dimension_filter(i):
    pick = lambda rule: i.where(relational.dimension(rule, {"sektor": "brand", "kategori": "category"})).select("id")
    return pick("sektor:Brand#2").unionByName(pick("kategori:ECONOMY"))


@twin("inventory_classes", "select o_orderkey path, case when o_orderkey % 10 = 0 then null else o_custkey end file from orders",
    """select path, case when file is null then 'D_outside' when file % 3 = 0 then 'A_canonical' when file % 5 = 0 then 'B_staged' when file % 7 = 0 then 'C1_copy_processed' when file % 11 = 0 then 'C2_quarantine' when file % 13 = 0 then 'C3_out_of_scope' else 'C4_unprocessed' end cls from i""")
def inventory_classes(i):
    known = i.select("file").where("file is not null").distinct()
    marks = known.select("file", *((F.col("file") % n == 0).alias(c) for n, c in ((3, "a"), (5, "b"), (7, "c1"), (11, "c2"), (13, "c3"))))
    found = i.join(marks, "file", "left")
    return found.select("path", F.when(F.col("file").isNull(), "D_outside").when(F.col("a"), "A_canonical").when(F.col("b"), "B_staged").when(F.col("c1"), "C1_copy_processed").when(F.col("c2"), "C2_quarantine").when(F.col("c3"), "C3_out_of_scope").otherwise("C4_unprocessed").alias("cls"))


_KEYWORDS = [("price", ["ring", "small"], 0.5), ("place", ["large", "medium"], 0.4), ("people", ["economy", "bolt"], 0.3)]


@twin("keyword_scores", "select p_partkey id, lower(p_name) nm, lower(p_type) cols from part", "with k as (select * from (values ('price', 'ring', 0.5), ('price', 'small', 0.5), ('place', 'large', 0.4), ('place', 'medium', 0.4), ('people', 'economy', 0.3), ('people', 'bolt', 0.3)) t(cat, kw, base)), s as (select id, cat, sum(case when contains(nm, kw) then base else 0 end + case when contains(cols, kw) then 0.8 * base else 0 end)::double s from i, k group by id, cat), t as (select id, arg_min(cat, (-s, cat)) cat, max(s) best, sum(s) whole from s where s > 0 group by id) select i.id, coalesce(cat, 'unknown') category, coalesce(round(least(0.95, 0.4 + 0.6 * (best / whole) * least(1.0, best / 0.9)), 3), 0) confidence from i left join t on t.id = i.id")
def keyword_scores(i):
    return relational.keyword_classes(i, _KEYWORDS, F.col("nm"), F.col("cols")).select("id", F.col("category"), F.col("confidence"))


@twin("schema_clusters", "select p_brand f, p_type c from part union all select p_brand, 'size' || cast(p_size % 4 as string) from part where p_brand <> 'Brand#1'", """with recursive s as (select distinct f, c from i), n as (select f, count(*) n from s group by f), p as (select a.f x, b.f y, count(*) k from s a join s b on a.c = b.c and a.f <> b.f group by 1, 2),
    e as (select x, y from p join n u on u.f = x join n v on v.f = y where k * 1.0 / (u.n + v.n - k) >= 0.8), r as (select f, f as c from n union select r.f, e.y from r join e on e.x = r.c) select f, min(c) cluster from r group by f""")
def schema_clusters(i):
    return relational.alike_sets(i, "f", "c", 0.8).select("f", "cluster")


@twin_tables("shard_merge", "with a as (select s_suppkey k, s_name v, null::double bal, 1 ord from supplier where s_suppkey % 2 = 0 union all select s_suppkey, s_name || '*', s_acctbal, 2 from supplier where s_suppkey % 3 = 0) select k, arg_max(v, ord) v, max(bal) filter (ord = 2) bal from a group by k")
def shard_merge(spark, sf_dir):
    """Shards with other columns become one table; a key's row of the last shard stays."""
    a = given(spark, sf_dir, "select s_suppkey k, s_name v from supplier where s_suppkey % 2 = 0")
    b = given(spark, sf_dir, "select s_suppkey k, s_name || '*' v, s_acctbal bal from supplier where s_suppkey % 3 = 0")
    return relational.merge_shards([a, b], ["k"]).select("k", "v", "bal")


@twin_tables("name_map_fallback", "select s_suppkey, coalesce((select n_name from nation where n_nationkey = s_nationkey and n_nationkey < 12), (select r_name from region where r_regionkey = s_nationkey % 7), 'manual') nm from supplier")
def name_map_fallback(spark, sf_dir):
    s = given(spark, sf_dir, "select s_suppkey, s_nationkey n, s_nationkey % 7 r from supplier")
    first = given(spark, sf_dir, "select n_nationkey n, n_name nm, 1 preference from nation where n_nationkey < 12")
    then = given(spark, sf_dir, "select r_regionkey r, r_name nm, 2 preference from region")
    offers = s.join(first, "n").select("s_suppkey", "preference", "nm").unionByName(s.join(then, "r").select("s_suppkey", "preference", "nm"))
    best = offers.groupBy("s_suppkey").agg(F.min(F.struct("preference", "nm"))["nm"].alias("nm"))
    return s.select("s_suppkey").join(best, "s_suppkey", "left").select("s_suppkey", F.coalesce("nm", F.lit("manual")).alias("nm"))


@twin("spearman_average_rank", "select c_custkey, c_nationkey x, cast(floor(c_acctbal / 100) as int) y from customer", """with a as (select x, sum(count(*)) over (order by x) - (count(*) - 1) / 2.0 rx from i group by x), b as (select y, sum(count(*)) over (order by y) - (count(*) - 1) / 2.0 ry from i group by y)
    select round(corr(rx, ry), 9) spearman, count(*) n from i join a using (x) join b using (y)""")
def spearman_average_rank(i):
    rx = relational.ranked(i, "x").select("c_custkey", "y", F.col("average_rank").alias("rx"))
    both = relational.ranked(rx, "y").select("rx", F.col("average_rank").alias("ry"))
    return both.agg(F.round(F.corr("rx", "ry"), 9).alias("spearman"), F.count("*").alias("n"))


@twin("raw_copy_staging", "select c_custkey, c_name, c_mktsegment from customer", "select row_number() over (order by c_custkey) ordinal, c_custkey::varchar raw_c_custkey, c_name raw_c_name, c_mktsegment raw_c_mktsegment, sha256(c_custkey::varchar || chr(31) || c_name || chr(31) || c_mktsegment) row_hash, 'customer' source from i")
def raw_copy_staging(i):
    """Every column as it is, as text, with the row's hash, number and source; numbers come range by range, not from one task."""
    raw = relational.numbered(i, ["c_custkey"])
    return raw.select(F.col("place").alias("ordinal"), *(F.col(c).cast("string").alias(f"raw_{c}") for c in i.columns), rules.row_hash(*(F.col(c) for c in i.columns)).alias("row_hash"), F.lit("customer").alias("source"))
