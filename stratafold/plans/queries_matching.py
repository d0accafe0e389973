"""Matching over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matching, relational
from .model import given
from .twins import twin, twin_tables

_A = "select p_partkey id, p_name || case p_partkey % 3 when 0 then ' cafe' else '' end name, case when p_partkey % 4 = 0 then '5' || lpad(cast(p_partkey as string), 9, '0') end phone, 36 + (p_partkey * 37 % 600) / 100e0 lat, 26 + (p_partkey * 91 % 1900) / 100e0 lon, p_partkey % 2 = 0 food from part"
_B = "select p_partkey id, case p_partkey % 5 when 0 then 'the ' || p_name when 1 then upper(p_name) else p_name || ' cafe' end name, case when p_partkey % 6 = 0 then '5' || lpad(cast(p_partkey as string), 9, '0') end phone, 36.0005 + (p_partkey * 37 % 600) / 100e0 lat, 26 + (p_partkey * 91 % 1900) / 100e0 + (p_partkey % 20) / 10000e0 lon, p_partkey % 3 <> 0 food from part"
_SCORED = f"""with a as ({_A}), b as ({_B}), p as (select a.id a_id, b.id b_id, lower(a.name) an, lower(b.name) bn, a.phone = b.phone same_phone, a.food af, b.food bf, 12742017.6 * asin(sqrt(power(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * power(sin(radians(b.lon - a.lon) / 2), 2))) m
      from a join b on abs(a.lat - b.lat) <= 0.0024 and abs(a.lon - b.lon) <= 0.004),
    n as (select *, jaro_winkler_similarity(an, bn) jw, len(list_intersect(string_split(an, ' '), string_split(bn, ' ')))::double / len(list_distinct(list_concat(string_split(an, ' '), string_split(bn, ' ')))) tj from p where m <= 250),
    s as (select *, case when tj >= 0.5 and 0.8 + 0.2 * tj > jw then 0.8 + 0.2 * tj else jw end sim, coalesce(same_phone, false) ph from n),
    e as (select *, case when sim >= 0.8 then 0.92 * (sim - 0.8) / 0.2 when sim >= 0.75 then 0.1 else 0 end ne, case when m > 200 then 0.1 when m > 120 then 0.25 when m > 60 then 0.5 when m > 25 then 0.7 else 0.85 end de from s where sim >= 0.75 or ph)
    select a_id, b_id, (1 - (1 - ne) * (1 - de) * (case when ph then 0.05 else 1 end) * (case when af and bf then 0.7 else 1 end)) * case when af and not bf then 0.55 else 1 end score, m, sim from e"""


@twin_tables("place_match_scores", f"select a_id, b_id, round(score, 6) score, round(sim, 6) sim from ({_SCORED})")
def place_match_scores(spark, sf_dir):
    pairs = matching.place_classes(given(spark, sf_dir, _A), given(spark, sf_dir, _B))
    # The operator's own score has four digits; the twin is held to the sixth of what it is made of
    return relational.expanded(_exact(pairs), a_ids="a_id", b_ids="b_id").select("a_id", "b_id", "score", "sim")


def _exact(pairs):
    sim, m = F.col("name_sim"), F.col("meters")
    open_name = 1 - F.when(sim >= 0.8, 0.92 * (sim - 0.8) / 0.2).when(sim >= 0.75, 0.1).otherwise(0.0)
    open_place = F.when(m <= 25, 0.15).when(m <= 60, 0.3).when(m <= 120, 0.5).when(m <= 200, 0.75).otherwise(0.9)
    score = (1 - open_name * open_place * F.when(F.col("phone_match"), 0.05).otherwise(1.0) * F.when(F.col("af") & F.col("bf"), 0.7).otherwise(1.0)) * F.when(F.col("af") & ~F.col("bf"), 0.55).otherwise(1.0)
    held = pairs.withColumn("whole", score).where(F.abs(F.col("whole") - F.col("score")) <= 0.5e-4 + 1e-9)
    # Halves of the sixth digit fall as the oracle's do, by the product and not by the number's decimal text
    low = lambda c: F.floor(F.col(c) * 1e6)
    sixth = lambda c: (low(c) + F.when(F.col(c) * 1e6 - low(c) >= 0.5, 1).otherwise(0)) / 1e6
    return held.select("a_ids", "b_ids", sixth("whole").alias("score"), sixth("name_sim").alias("sim"))


@twin_tables("place_matches", None)
def place_matches(spark, sf_dir):
    """One-to-one matches; tested against a greedy loop."""
    return matching.place_matches(given(spark, sf_dir, _A), given(spark, sf_dir, _B), 0.5)


_WEB = "select c_custkey id, c_nationkey district, 'Quarter ' || c_mktsegment || case c_custkey % 3 when 0 then ' Mahallesi' when 1 then ' Mah.' else '' end name, 100 + c_custkey % 40 people from customer where c_custkey % 5 = 0"
_OFFICIAL = "select s_suppkey id, s_nationkey district, 'QUARTER ' || case s_suppkey % 3 when 0 then 'BUILDING' when 1 then 'MACHINERY' else 'AUTOMOBIL' end name, case when s_suppkey % 4 = 0 then null else 110 + s_suppkey % 9 end people from supplier"


@twin_tables("district_match_scores", f"""with a as ({_WEB}), b as ({_OFFICIAL}), p as (select a.id a_id, b.id b_id, jaro_winkler_similarity(trim(replace(replace(lower(a.name), ' mahallesi', ''), ' mah.', '')), lower(b.name)) n, case when b.people > 0 then greatest(0, 1 - abs(a.people::double / b.people - 1) / 0.3) end c from a join b using (district))
    select a_id, b_id, round(n, 4) as name, round(c, 4) consistency from p where n >= 0.8""")
def district_match_scores(spark, sf_dir):
    return matching.district_pairs(given(spark, sf_dir, _WEB), given(spark, sf_dir, _OFFICIAL)).drop("score")


@twin("category_cascade", "select o_custkey id, case o_orderstatus when 'F' then 'food' when 'O' then 'shop' else 'food' end cat, o_orderpriority method, case o_orderkey % 4 when 0 then 0.97 when 1 then 0.88 when 2 then 0.93 else 0.80 end conf, o_orderkey % 4 priority from orders where o_orderkey % 4 = o_custkey % 4",
    """with r as (select *, row_number() over (partition by id order by priority, conf desc, cat, method) i, count(*) over (partition by id) n from i), k as (select id, count(distinct cat) cats from i group by id)
    select id, cat, method, round((case when cats > 1 then conf * 0.85 when n > 1 then least(0.99, conf + 0.02) else conf end)::double, 3) conf, n sources, case when cats > 1 then 'CROSS_SOURCE_CONFLICT(' || cats || ')' end flags from r join k using (id) where i = 1""")
def category_cascade(i):
    found = matching.category_evidence(i.withColumn("conf", F.col("conf").cast("double")))
    return found.withColumn("conf", F.round("conf", 3))


@twin("name_changes", "select event_id % 50 id, event_id seen, event_type name from events", """with l as (select id, seen, name as after, lag(name) over (partition by id order by seen) before from i)
    select id, seen, before, after, case when strpos(after, before) > 0 or strpos(before, after) > 0 then 'spelling' else 'successor' end event from l where before is not null and before <> after""")
def name_changes(i):
    return matching.renamed(i)


@twin_tables("quarter_resolver", """with p as (select c_custkey id, 'P' || c_nationkey % 5 province, 'D' || c_nationkey % 7 district, 'Q ' || c_custkey % 40 nm from customer), q as (select s_suppkey geo_id, 'P' || s_nationkey % 5 province, 'D' || s_nationkey % 7 district, 'Q ' || s_suppkey % 45 nm from supplier),
    f as (select p.id, (select min(geo_id) from q where q.province = p.province and q.district = p.district and q.nm = p.nm) e, (select count(*) from q where q.province = p.province and q.nm = p.nm) n, (select min(geo_id) from q where q.province = p.province and q.nm = p.nm) o from p)
    select id, case when e is not null then e when n = 1 then o end geo_id, case when e is not null then 'district_and_name' when n = 1 then 'only_in_province' when n > 1 then 'ambiguous' else 'not_found' end how, case when e is not null then 0.95::double when n = 1 then 0.8::double end confidence from f""")
def quarter_resolver(spark, sf_dir):
    p = given(spark, sf_dir, "select c_custkey id, 'P' || c_nationkey % 5 province, 'D' || c_nationkey % 7 district, 'Q ' || c_custkey % 40 || ' Mahallesi' name from customer")
    q = given(spark, sf_dir, "select s_suppkey geo_id, 'P' || s_nationkey % 5 province, 'D' || s_nationkey % 7 district, 'q ' || s_suppkey % 45 name from supplier")
    return matching.quarter_of(p, q)


@twin_tables("zoning_lookup", """with a as (select c_custkey id, 'p' || c_nationkey % 5 p, 'd' || c_nationkey % 7 d, case when c_custkey % 3 = 0 then '' else 'q' || c_custkey % 30 end q from customer), k as (select s_suppkey as rule, 'p' || s_nationkey % 5 p, 'd' || s_nationkey % 7 d, 'q' || s_suppkey % 35 q, 'area' || s_suppkey % 3 ar from supplier),
    m as (select id, rule, case when a.d = k.d and a.q <> '' and (strpos(k.q, a.q) > 0 or strpos(a.q, k.q) > 0 or strpos(ar, a.q) > 0) then 1 when a.q <> '' and (strpos(k.q, a.q) > 0 or strpos(a.q, k.q) > 0 or strpos(ar, a.q) > 0) then 2 when a.d = k.d then 3 end r from a join k on a.p = k.p)
    select id, arg_min(rule, (r, rule)) as rule, case min(r) when 1 then 'exact' when 2 then 'quarter' else 'district' end how from m where r is not null group by id""")
def zoning_lookup(spark, sf_dir):
    a = given(spark, sf_dir, "select c_custkey id, 'P ' || c_nationkey % 5 province, 'D' || c_nationkey % 7 district, case when c_custkey % 3 = 0 then null else 'Q ' || c_custkey % 30 end quarter from customer")
    k = given(spark, sf_dir, "select s_suppkey rule, 'p' || s_nationkey % 5 province, 'd' || s_nationkey % 7 district, 'q' || s_suppkey % 35 quarter, 'area ' || s_suppkey % 3 area from supplier")
    return matching.rule_lookup(a, k)
