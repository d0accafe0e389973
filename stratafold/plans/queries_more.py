"""Further loaders, marts, land and transit analyses over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fold, rules
from ..operators import spatial
from ..sources import nested
from .model import given
from .twins import twin, twin_tables

_POI = "select id, name, brand, category, cast(lat as double) lat, cast(lon as double) lon, price, cast(rating as double) rating from poi"
_SUPPLIERS = "select s_suppkey, cast(36 + (s_suppkey * 53 % 600) / 100.0 as double) lat, cast(26 + (s_suppkey * 71 % 1900) / 100.0 as double) lon from supplier"
_M = "2 * 6371008.8 * asin(sqrt(power(sin(radians(p.lat - s.lat) / 2), 2) + cos(radians(s.lat)) * cos(radians(p.lat)) * power(sin(radians(p.lon - s.lon) / 2), 2)))"

# Nested sources over texts that the tables hold


@twin_tables("json_dictionary", "select 'r' || n_regionkey path, n_name as key, n_nationkey::varchar code, case when n_nationkey % 2 = 0 then n_name end note from nation")
def json_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = given(spark, sf_dir, "select n_regionkey, n_name, n_nationkey from nation")
    entry = F.struct("n_name", F.struct(F.col("n_nationkey").alias("code"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("note")))
    docs = pairs.groupBy(F.concat(F.lit("r"), "n_regionkey").alias("path")).agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("doc"))
    rows = nested.dictionary(docs)
    return rows.select("path", "key", F.try_element_at("fields", F.lit("code")).alias("code"), F.try_element_at("fields", F.lit("note")).alias("note"))


@twin_tables("json_guide", "select r_name as key, n_name child, (row_number() over (partition by r_regionkey order by n_nationkey))::int place from region left join nation on n_regionkey = r_regionkey")
def json_guide(spark, sf_dir):
    lists = given(spark, sf_dir, "select r_name, n_name, n_nationkey from region left join nation on n_regionkey = r_regionkey").groupBy("r_name").agg(F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]).alias("districts"))
    docs = lists.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("r_name", F.struct(F.col("r_name").alias("name"), "districts"))))).alias("doc")).withColumn("path", F.lit("guide"))
    return nested.guide(docs).select("key", "child", "place")


@twin_tables("json_record_lists", "select p_brand path, 'parts' under, p_partkey::varchar id from part")
def json_record_lists(spark, sf_dir):
    parts = given(spark, sf_dir, "select p_brand, p_partkey from part").groupBy(F.col("p_brand").alias("path")).agg(F.to_json(F.struct(F.lit(1).alias("version"), F.array(F.struct(F.lit("x").alias("id"))).alias("few"), F.collect_list(F.struct(F.col("p_partkey").alias("id"))).alias("parts"))).alias("doc"))
    return nested.records(parts).select("path", "under", F.try_element_at("fields", F.lit("id")).alias("id"))


@twin_tables("geojson_boxes", "select s_suppkey::varchar id, 'LineString' kind, round(26 + (s_suppkey * 71 % 1900) / 100e0, 6) west, round(27.5 + (s_suppkey * 71 % 1900) / 100e0, 6) east, round(36 + (s_suppkey * 53 % 600) / 100e0 + 0.25, 6) lat from supplier")
def geojson_boxes(spark, sf_dir):
    s = given(spark, sf_dir, _SUPPLIERS)
    feature = F.struct(F.col("s_suppkey").alias("id"), F.struct(F.col("s_suppkey").alias("n")).alias("properties"), F.struct(F.lit("LineString").alias("type"), F.array(F.array("lon", "lat"), F.array(F.col("lon") + 1.5, F.col("lat") + 0.5)).alias("coordinates")).alias("geometry"))
    docs = s.groupBy((F.col("s_suppkey") % 7).cast("string").alias("path")).agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features"))).alias("doc"))
    return nested.boxed(nested.geojson(docs)).select("id", "kind", *(F.round(c, 6).alias(c) for c in ("west", "east", "lat")))


@twin_tables("sdmx_observations", "select 'R' || n_regionkey area, c_mktsegment sector, '20' || lpad((c_nationkey % 10)::varchar, 2, '0') period, sum(c_acctbal::decimal(18, 2))::double v from customer join nation on n_nationkey = c_nationkey group by 1, 2, 3")
def sdmx_observations(spark, sf_dir):
    """The same sums by way of an SDMX document, whose series keys are places in lists of values."""
    sums = given(spark, sf_dir, "select n_regionkey area, c_mktsegment sector, c_nationkey % 10 p, cast(sum(cast(c_acctbal as decimal(18, 2))) as string) v from customer join nation on n_nationkey = c_nationkey group by 1, 2, 3")
    sectors = sums.agg(F.sort_array(F.collect_set("sector")).alias("sectors"))
    keyed = sums.crossJoin(F.broadcast(sectors)).select(F.concat_ws(":", F.col("area").cast("string"), (F.array_position("sectors", F.col("sector")) - 1).cast("string")).alias("k"), F.col("p").cast("string").alias("p"), "v")
    series = keyed.groupBy("k").agg(F.struct(F.map_from_entries(F.collect_list(F.struct("p", F.array("v")))).alias("observations")).alias("s"))
    named = lambda array, f: F.transform(array, lambda x: F.struct(f(x).alias("id")))
    structure = F.struct(
        F.struct(F.array(F.struct(F.lit("AREA").alias("id"), named(F.sequence(F.lit(0), F.lit(4)), lambda x: F.concat(F.lit("R"), x.cast("string"))).alias("values")), F.struct(F.lit("SECTOR").alias("id"), named(F.col("sectors"), lambda x: x).alias("values"))).alias("series"), F.array(F.struct(F.lit("TIME").alias("id"), named(F.sequence(F.lit(0), F.lit(9)), lambda x: F.concat(F.lit("20"), F.lpad(x.cast("string"), 2, "0"))).alias("values"))).alias("observation")).alias("dimensions")
    )
    docs = series.agg(F.map_from_entries(F.collect_list(F.struct("k", "s"))).alias("series")).crossJoin(sectors).select(F.lit("d").alias("path"), F.to_json(F.struct(F.struct(structure.alias("structure"), F.array(F.struct("series")).alias("dataSets")).alias("data"))).alias("doc"))
    return nested.sdmx(docs).select(F.col("dims")["AREA"].alias("area"), F.col("dims")["SECTOR"].alias("sector"), "period", F.col("value").alias("v"))


# Loaders and marts


@twin_tables("indicator_loader", """select 'ILCE_' || c_nationkey geo_id, '2001' period, 'mean_balance' ind, round(avg(c_acctbal), 6) v from customer group by 1 union all select 'ILCE_' || c_nationkey, '2001', 'customers', count(*)::double from customer group by 1
    union all select 'IL_' || n_regionkey, '2001', 'suppliers', count(*)::double from supplier join nation on n_nationkey = s_nationkey group by 1""")
def indicator_loader(spark, sf_dir):
    """Wide sources, each with its way to a place, become long observations by their specifications."""
    specs = [("select c_nationkey k, avg(c_acctbal) mean_balance, cast(count(*) as double) customers from customer group by 1", "ILCE_", None, ["mean_balance", "customers"]), ("select s_nationkey k, cast(count(*) as double) suppliers from supplier group by 1", "IL_", "select n_nationkey k, n_regionkey up from nation", ["suppliers"])]
    out = None
    for rows, head, way, columns in specs:
        df = given(spark, sf_dir, rows)
        df = df.join(given(spark, sf_dir, way), "k").groupBy(F.col("up").alias("k")).agg(*(F.sum(c).alias(c) for c in columns)) if way else df
        long = df.unpivot("k", columns, "ind", "v").select(F.concat(F.lit(head), "k").alias("geo_id"), F.lit("2001").alias("period"), "ind", F.round("v", 6).alias("v"))
        out = long if out is None else out.unionByName(long)
    return out


@twin_tables("product_price_loader", "select 'parts' system, p_partkey::varchar product, p_retailprice price, 'TL' currency from part union all select 'lines', l_partkey || '/' || l_linenumber, round(l_extendedprice / l_quantity, 9), 'TL' from lineitem where l_quantity > 0")
def product_price_loader(spark, sf_dir):
    a = given(spark, sf_dir, "select 'parts' system, cast(p_partkey as string) product, p_retailprice price from part")
    b = given(spark, sf_dir, "select 'lines' system, l_partkey || '/' || l_linenumber product, round(l_extendedprice / l_quantity, 9) price from lineitem where l_quantity > 0")
    return a.unionByName(b).withColumn("currency", F.lit("TL"))


@twin_tables("latest_value_table", "select geo_id, dim, v, period from cell c where projected = 0 and not exists (select 1 from cell d where d.projected = 0 and d.geo_id = c.geo_id and d.dim = c.dim and d.period > c.period)")
def latest_value_table(spark, sf_dir):
    return given(spark, sf_dir, "select * from cell where projected = 0").groupBy("geo_id", "dim").agg(F.max_by("v", "period").alias("v"), F.max("period").alias("period"))


@twin_tables("district_mart", """select 'ILCE_' || n_nationkey geo_id, (select count(*) from customer where c_nationkey = n_nationkey) people, (select count(*) from supplier where s_nationkey = n_nationkey) suppliers, (select round(avg(o_totalprice), 6) from orders join customer on o_custkey = c_custkey where c_nationkey = n_nationkey) mean_price,
    (select count(*) from nation m where m.n_regionkey = n.n_regionkey) siblings from nation n""")
def district_mart(spark, sf_dir):
    n = given(spark, sf_dir, "select n_nationkey k, n_regionkey r from nation")
    count = lambda text, c: given(spark, sf_dir, text).groupBy("k").agg(F.count("*").alias(c))
    mean = given(spark, sf_dir, "select c_nationkey k, o_totalprice v from orders join customer on o_custkey = c_custkey").groupBy("k").agg(F.round(F.avg("v"), 6).alias("mean_price"))
    held = n.join(count("select c_nationkey k from customer", "people"), "k", "left").join(count("select s_nationkey k from supplier", "suppliers"), "k", "left").join(mean, "k", "left")
    return held.select(F.concat(F.lit("ILCE_"), "k").alias("geo_id"), F.coalesce("people", F.lit(0)).alias("people"), F.coalesce("suppliers", F.lit(0)).alias("suppliers"), "mean_price", F.count("*").over(W.partitionBy("r")).alias("siblings"))


@twin("silver_rows", "select c_custkey id, case c_custkey % 4 when 0 then ' null ' when 1 then '1,5' when 2 then '12' else 'x' end price, ' ' || c_name || ' ' nm, c_custkey % 3 <> 0 keyed from customer",
    "select id, case when trim(price) = 'null' then null else try_cast(replace(trim(price), ',', '.') as double) end price, trim(nm) nm, case when not keyed then 'missing_natural_key' else 'valid' end status, case when keyed then 75 else 50 end quality from i")
def silver_rows(i):
    """Trimmed values, null words as null, numbers as numbers, with their validation and quality."""
    none = F.lower(F.trim("price")).isin("", "null", "none", "nan", "-")
    quality = rules.record_quality(F.lit("observed"), F.col("keyed"), F.lit(True), F.lit(True))
    return i.select("id", F.when(~none, rules.plain_number(F.col("price"))).alias("price"), F.trim("nm").alias("nm"), F.when(F.col("keyed"), "valid").otherwise("missing_natural_key").alias("status"), quality.alias("quality"))


@twin_tables("latest_attributes_and_reviews", "select user_id, arg_max(event_type, (ts, event_id)) last_type, string_agg(event_type, ' | ' order by ts, event_id) told from events where event_id % 10 = user_id % 10 group by 1")
def latest_attributes_and_reviews(spark, sf_dir):
    e = given(spark, sf_dir, "select user_id, event_type, ts, event_id from events where event_id % 10 = user_id % 10")
    told = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id", "event_type"))), lambda x: x["event_type"]), " | ")
    return e.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"), told.alias("told"))


@twin_tables("notices_and_pages", "select l_orderkey, l_linenumber, o_orderstatus, s_name from lineitem join orders on o_orderkey = l_orderkey and o_custkey % 3 = l_suppkey % 3 left join supplier on s_suppkey = l_suppkey and s_nationkey < 12")
def notices_and_pages(spark, sf_dir):
    l = given(spark, sf_dir, "select l_orderkey, l_linenumber, l_suppkey, l_suppkey % 3 m from lineitem")  # noqa: E741
    o = given(spark, sf_dir, "select o_orderkey l_orderkey, o_custkey % 3 m, o_orderstatus from orders")
    s = given(spark, sf_dir, "select s_suppkey l_suppkey, s_name from supplier where s_nationkey < 12")
    return l.join(o, ["l_orderkey", "m"]).join(s, "l_suppkey", "left").select("l_orderkey", "l_linenumber", "o_orderstatus", "s_name")


@twin("polygon_records", "select n_nationkey id, case when n_nationkey % 6 = 0 then 0 when n_nationkey % 6 = 1 then null else n_nationkey end district, n_name from nation", "select id, case when coalesce(district, 0) = 0 then 'water_or_island' else 'district' end kind, case when coalesce(district, 0) = 0 then 'no_district' else '' end flags from i")
def polygon_records(i):
    none = F.coalesce("district", F.lit(0)) == 0
    return i.select("id", F.when(none, "water_or_island").otherwise("district").alias("kind"), F.concat_ws(",", F.when(none, "no_district")).alias("flags"))


# Land


@twin_tables("watercourses", f"""with s as ({_SUPPLIERS}), p as (select p_partkey id, case when p_partkey % 3 = 0 then 'dry_creek' else 'stream' end kind, 36 + (p_partkey * 37 % 600) / 100.0 lat, 26 + (p_partkey * 91 % 1900) / 100.0 lon from part), d as (select s_suppkey, kind, {_M} m from s cross join p)
    select s_suppkey, count(*) filter (kind = 'stream') streams, round(min(m) filter (kind = 'stream'), 2) nearest_stream, count(*) filter (kind = 'dry_creek') creeks, round(min(m) filter (kind = 'dry_creek'), 2) nearest_creek from d where m <= 40000 group by 1""")
def watercourses(spark, sf_dir):
    p = given(spark, sf_dir, _POI).select(F.when(F.col("id") % 3 == 0, "dry_creek").otherwise("stream").alias("kind"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    near = spatial.within(given(spark, sf_dir, _SUPPLIERS), p, 40_000)
    of = lambda kind: F.when(F.col("kind") == kind, F.col("meters"))
    return near.groupBy("s_suppkey").agg(F.count(of("stream")).alias("streams"), F.round(F.min(of("stream")), 2).alias("nearest_stream"), F.count(of("dry_creek")).alias("creeks"), F.round(F.min(of("dry_creek")), 2).alias("nearest_creek"))


@twin_tables("segment_distances", """with s as (select s_suppkey, (26 + (s_suppkey * 71 % 1900) / 100e0) x, (36 + (s_suppkey * 53 % 600) / 100e0) y from supplier), g as (select n_nationkey line, 26 + n_nationkey % 18 ax, 36 + n_nationkey % 6 ay, 26 + n_nationkey % 18 + 1 + n_nationkey % 3 bx, 36 + n_nationkey % 6 + n_nationkey % 2 by_ from nation),
    d as (select s_suppkey, line, (x - ax) * cos(radians(y)) * 111320 px, (y - ay) * 111320e0 py, (bx - ax) * cos(radians(y)) * 111320 vx, (by_ - ay) * 111320e0 vy from s, g), t as (select *, greatest(0, least(1, (px * vx + py * vy) / (vx * vx + vy * vy))) t from d)
    select s_suppkey, arg_min(line, (round(sqrt(power(px - t * vx, 2) + power(py - t * vy, 2)), 3), line)) line, round(min(sqrt(power(px - t * vx, 2) + power(py - t * vy, 2))) / 1000, 1) km from t group by 1""")
def segment_distances(spark, sf_dir):
    """The nearest of a few lines; the lines are a bounded dimension, so they are broadcast."""
    lines = given(spark, sf_dir, "select n_nationkey line, cast(26 + n_nationkey % 18 as double) ax, cast(36 + n_nationkey % 6 as double) ay, cast(26 + n_nationkey % 18 + 1 + n_nationkey % 3 as double) bx, cast(36 + n_nationkey % 6 + n_nationkey % 2 as double) by from nation")
    pairs = given(spark, sf_dir, _SUPPLIERS).crossJoin(F.broadcast(lines))
    east = F.cos(F.radians("lat")) * 111_320
    px, py, vx, vy = (F.col("lon") - F.col("ax")) * east, (F.col("lat") - F.col("ay")) * 111_320, (F.col("bx") - F.col("ax")) * east, (F.col("by") - F.col("ay")) * 111_320
    long = vx * vx + vy * vy
    t = F.when(long > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (px * vx + py * vy) / long))).otherwise(0.0)
    m = F.sqrt(F.pow(px - t * vx, 2) + F.pow(py - t * vy, 2))
    best = pairs.withColumn("m", m).groupBy("s_suppkey").agg(F.min(F.struct(F.round("m", 3).alias("r"), "line", "m")).alias("b"))
    return best.select("s_suppkey", "b.line", F.round(F.col("b.m") / 1000, 1).alias("km"))


@twin_tables("layer_findings", f"""with s as ({_SUPPLIERS}), p as (select p_partkey id, case p_partkey % 3 when 0 then 'fault' when 1 then 'rail' else 'water' end layer, 36 + (p_partkey * 37 % 600) / 100.0 lat, 26 + (p_partkey * 91 % 1900) / 100.0 lon from part), d as (select s_suppkey, layer, {_M} m from s cross join p),
    f as (select s_suppkey, layer, min(m) m, count(*) n from d where m <= case layer when 'fault' then 20000 when 'rail' then 5000 else 2000 end group by 1, 2)
    select s_suppkey, layer, round(m, 1) m, n, case when m <= 25 then 'on_site' when layer = 'fault' then 'high' when layer = 'rail' then 'middle' else 'low' end severity from f""")
def layer_findings(spark, sf_dir):
    """What lies near by layer, each within its own reach."""
    layer = F.when(F.col("id") % 3 == 0, "fault").when(F.col("id") % 3 == 1, "rail").otherwise("water")
    p = given(spark, sf_dir, _POI).select(layer.alias("layer"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    reach = F.when(F.col("layer") == "fault", 20_000).when(F.col("layer") == "rail", 5_000).otherwise(2_000)
    found = spatial.within(given(spark, sf_dir, _SUPPLIERS), p, 20_000).where(F.col("meters") <= reach).groupBy("s_suppkey", "layer").agg(F.min("meters").alias("m"), F.count("*").alias("n"))
    severity = F.when(F.col("m") <= 25, "on_site").when(F.col("layer") == "fault", "high").when(F.col("layer") == "rail", "middle").otherwise("low")
    return found.select("s_suppkey", "layer", F.round("m", 1).alias("m"), "n", severity.alias("severity"))


@twin_tables("nearest_schools_by_kind", f"""with s as ({_SUPPLIERS}), p as (select p_partkey id, p_type kind, p_size * 40 seats, 36 + (p_partkey * 37 % 600) / 100.0 lat, 26 + (p_partkey * 91 % 1900) / 100.0 lon from part), d as (select s_suppkey, id, kind, seats, {_M} m from s cross join p), r as (select *, row_number() over (partition by s_suppkey, kind order by round(m, 3), id) i from d where m <= 60000)
    select s_suppkey, kind, max(id) filter (i = 1) nearest, count(*) n, sum(case when seats between 50 and 1500 then seats end)::bigint seats from r group by 1, 2""")
def nearest_schools_by_kind(spark, sf_dir):
    """The nearest of each kind and the seats of all within reach, implausible ones left out."""
    p = given(spark, sf_dir, "select p_partkey id, p_type kind, p_size * 40 seats, cast(36 + (p_partkey * 37 % 600) / 100.0 as double) lat2, cast(26 + (p_partkey * 91 % 1900) / 100.0 as double) lon2 from part")
    s = given(spark, sf_dir, _SUPPLIERS)
    # One row for each kind at a position, and one search for each position
    p = p.groupBy("lat2", "lon2", "kind").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.sum(F.when(F.col("seats").between(50, 1500), F.col("seats"))).alias("seats"))
    near = spatial.within(s.select("lat", "lon").distinct(), p, 60_000)
    best = near.groupBy("lat", "lon", "kind").agg(F.min(F.struct(F.round("meters", 3).alias("m"), "id"))["id"].alias("nearest"), F.sum("n").alias("n"), F.sum("seats").alias("seats"))
    return s.join(best, ["lat", "lon"]).select("s_suppkey", "kind", "nearest", "n", "seats")


@twin_tables("region_profile", """select 'MAH_' || c_nationkey || '_' || c_mktsegment geo_id, coalesce(case when count(*) >= 14 then avg(c_acctbal) end, max(d), max(r)) is not null found, case when count(*) >= 14 then 'mahalle' when max(dn) >= 55 then 'ilce' else 'il' end scope, round(case when count(*) >= 14 then avg(c_acctbal) when max(dn) >= 55 then max(d) else max(r) end, 6) v
    from customer join (select c_nationkey k, avg(c_acctbal) d, count(*) dn from customer group by 1) on k = c_nationkey join (select n_nationkey k2, r from nation join (select n_regionkey rk, avg(c_acctbal) r from customer join nation on c_nationkey = n_nationkey group by 1) on rk = n_regionkey) on k2 = c_nationkey group by c_nationkey, c_mktsegment""")
def region_profile(spark, sf_dir):
    """Each quarter's mean from the first of quarter, district and province that has enough rows: one pass over three groupings, then the least scope."""
    c = given(spark, sf_dir, "select c_nationkey k, c_mktsegment seg, n_regionkey r, c_acctbal v from customer join nation on c_nationkey = n_nationkey")
    units = c.select("k", "seg", "r").distinct()
    mean = lambda keys, least: c.groupBy(*keys).agg(F.avg("v").alias("v"), F.count("*").alias("n")).where(F.col("n") >= least)
    offers = [units.join(mean(keys, least), keys).select("k", "seg", F.lit(i).alias("rank"), F.lit(scope).alias("scope"), "v") for i, (scope, keys, least) in enumerate((("mahalle", ["k", "seg"], 14), ("ilce", ["k"], 55), ("il", ["r"], 1)))]
    best = offers[0].unionByName(offers[1]).unionByName(offers[2]).groupBy("k", "seg").agg(F.min(F.struct("rank", "scope", "v")).alias("b"))
    return best.select(F.concat(F.lit("MAH_"), "k", F.lit("_"), "seg").alias("geo_id"), F.lit(True).alias("found"), "b.scope", F.round("b.v", 6).alias("v"))


@twin("scenario_ranks", "select s_suppkey id, s_nationkey scenario, s_acctbal v from supplier", "select id, scenario, (select count(*) from i j where j.scenario = i.scenario and j.v > i.v) + 1 as place, round((select avg(v) from i j where j.scenario = i.scenario), 8) mean from i")
def scenario_ranks(i):
    per = W.partitionBy("scenario")
    return i.select("id", "scenario", F.rank().over(per.orderBy(F.col("v").desc())).cast("long").alias("place"), F.round(F.avg("v").over(per), 8).alias("mean"))


@twin("valuation_withheld", "select id, price from poi", "select id, null::double value, 'not_computed' status from i")
def valuation_withheld(i):
    """No value is computed on purpose: a price isn't an appraisal."""
    return i.select("id", F.lit(None).cast("double").alias("value"), F.lit("not_computed").alias("status"))


@twin_tables("circle_overlay", """with c as (select s_suppkey, 36 + (s_suppkey * 53 % 600) / 100e0 lat, 26 + (s_suppkey * 71 % 1900) / 100e0 lon from supplier), r as (select n_nationkey area, 36 + n_nationkey % 6 lat0, 26 + n_nationkey % 18 lon0, 1 + n_nationkey % 3 side from nation),
    o as (select s_suppkey, area, greatest(0, least(lat + 0.3, lat0 + side) - greatest(lat - 0.3, lat0)) * greatest(0, least(lon + 0.4, lon0 + side) - greatest(lon - 0.4, lon0)) / (side * side) w from c, r)
    select s_suppkey, round(sum(w * (select count(*) from customer where c_nationkey = area)), 6) people from o where w > 0 group by 1""")
def circle_overlay(spark, sf_dir):
    """People of areas by the part of each that a box covers."""
    areas = given(spark, sf_dir, "select n_nationkey area, cast(36 + n_nationkey % 6 as double) lat0, cast(26 + n_nationkey % 18 as double) lon0, cast(1 + n_nationkey % 3 as double) side from nation")
    people = given(spark, sf_dir, "select c_nationkey area from customer").groupBy("area").agg(F.count("*").alias("people"))
    boxes = given(spark, sf_dir, _SUPPLIERS).select("s_suppkey", (F.col("lat") - 0.3).alias("s"), (F.col("lat") + 0.3).alias("n"), (F.col("lon") - 0.4).alias("w"), (F.col("lon") + 0.4).alias("e"))
    return spatial.overlaid(boxes, areas.join(people, "area", "left"), "s_suppkey", "people").withColumn("people", F.round("people", 6))


# Transit


@twin_tables("stop_route_view", "select l_suppkey stop, o_orderpriority route, count(distinct l_orderkey) trips, min(l_linenumber) first_place, max(n_name) place from lineitem join orders on o_orderkey = l_orderkey join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey group by 1, 2")
def stop_route_view(spark, sf_dir):
    times = given(spark, sf_dir, "select l_suppkey stop, l_orderkey trip, l_linenumber seq from lineitem")
    trips = given(spark, sf_dir, "select o_orderkey trip, o_orderpriority route from orders")
    stops = given(spark, sf_dir, "select s_suppkey stop, n_name place from supplier join nation on n_nationkey = s_nationkey")
    return times.join(trips, "trip").join(stops, "stop").groupBy("stop", "route").agg(F.count_distinct("trip").alias("trips"), F.min("seq").alias("first_place"), F.max("place").alias("place"))


@twin_tables("transit_near_points", f"""with s as ({_SUPPLIERS}), p as (select p_partkey id, p_brand route, p_partkey % 2 direction, p_partkey % 5 <> 0 scheduled, 36 + (p_partkey * 37 % 600) / 100.0 lat, 26 + (p_partkey * 91 % 1900) / 100.0 lon from part), d as (select s_suppkey, p.*, {_M} m from s cross join p), n as (select *, max(scheduled::int) over (partition by s_suppkey) any_scheduled from d where m <= 20000)
    select s_suppkey, route, direction, arg_min(id, (round(m, 3), id)) stop, round(min(m), 1) m from n where scheduled or any_scheduled = 0 group by 1, 2, 3""")
def transit_near_points(spark, sf_dir):
    """The nearest stop of each route and direction; stops without a timetable only where there are no others."""
    p = given(spark, sf_dir, "select p_partkey id, p_brand route, p_partkey % 2 direction, p_partkey % 5 <> 0 scheduled, cast(36 + (p_partkey * 37 % 600) / 100.0 as double) lat2, cast(26 + (p_partkey * 91 % 1900) / 100.0 as double) lon2 from part")
    near = spatial.within(given(spark, sf_dir, _SUPPLIERS), p, 20_000).withColumn("any", F.max(F.col("scheduled").cast("int")).over(W.partitionBy("s_suppkey")))
    best = near.where("scheduled or any = 0").groupBy("s_suppkey", "route", "direction").agg(F.min(F.struct(F.round("meters", 3).alias("r"), "id", "meters")).alias("b"))
    return best.select("s_suppkey", "route", "direction", F.col("b.id").alias("stop"), F.round("b.meters", 1).alias("m"))


@twin_tables("lifecycle_near", "select id, names, case when names > 1 then 'renamed' else 'same' end status from (select user_id id, count(distinct event_type) names from events group by 1)")
def lifecycle_near(spark, sf_dir):
    e = given(spark, sf_dir, "select user_id id, event_type from events")
    return e.groupBy("id").agg(F.count_distinct("event_type").alias("names")).withColumn("status", F.when(F.col("names") > 1, "renamed").otherwise("same"))


# Functions declared in SQL


@twin("sql_functions", "select n_nationkey id, n_name || ' Mah.' nm from nation", "select id, trim(regexp_replace(lower(nm), '[^a-z0-9]+', ' ', 'g')) plain, right(regexp_replace('+90 ' || id || '55', '[^0-9]', '', 'g'), 10) digits from i")
def sql_functions(i):
    """Folding and digits as functions of a session, for those who write SQL."""
    i.sparkSession.sql("create or replace temporary function stratafold_digits(x string) returns string return right(regexp_replace(x, '[^0-9]', ''), 10)")
    return i.select("id", fold(F.col("nm")).alias("plain"), F.expr("stratafold_digits('+90 ' || id || '55')").alias("digits"))


