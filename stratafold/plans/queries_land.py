"""Further declarative queries: land and transit engines, governance, entity resolution, collector-side parsers and scores. Same rules as in queries_sql."""

from __future__ import annotations

from .queries_sql import FOLD, dist_to, distance

_DRY = "(o_orderkey * 131 % 9000)"
_SLOPE = "(p_partkey % 40)"

SQL: dict[str, str] = {
    # Distance-banded scores (synthetic distances by arithmetic on keys)
    "water_score": "with d as (select p_partkey, p_partkey * 37 % 3000 net, p_partkey * 91 % 4000 stream, p_partkey * 53 % 4500 well, p_partkey * 17 % 2500 canal, p_partkey * 71 % 3500 spring from part) select p_partkey, case when net <= 150 then 45 when net <= 500 then 32 when net <= 1500 then 18 else 5 end + case when stream < 600 or well < 800 then 30 when stream < 2000 or well < 2500 then 20 else 10 end + case when canal < 400 then 15 when canal < 1500 or stream < 400 then 10 else 2 end + case when spring < 1000 then 10 else 0 end score from d",
    "water_network_cost": "with d as (select p_partkey, p_partkey * 37 % 3000 net from part) select p_partkey, cast(case when net <= 500 then net * 180 + 25000 when net <= 1500 then net * 180 + 35000 end as bigint) cost from d",
    "slope_class": f"select p_partkey, case when {_SLOPE} < 3 then 'flat' when {_SLOPE} < 8 then 'gentle' when {_SLOPE} < 15 then 'moderate' when {_SLOPE} < 25 then 'steep' else 'very_steep' end slope_class, case when {_SLOPE} < 3 then 1.0 when {_SLOPE} < 8 then 1.05 when {_SLOPE} < 15 then 1.2 when {_SLOPE} < 25 then 1.45 else 1.8 end * cast(1 as double) multiplier from part",
    "aspect_sun_score": "with a as (select p_partkey, p_partkey * 29 % 360 aspect, p_partkey % 40 slope from part) select p_partkey, case when slope < 1 then 95 else case cast(floor((aspect + 22.5) / 45) as int) % 8 when 0 then 40 when 1 then 60 when 2 then 80 when 3 then 95 when 4 then 100 when 5 then 90 when 6 then 75 else 50 end end score from a",
    "seismic_score": "with d as (select p_partkey, (p_partkey * 13 % 1800) / 10.0 km from part) select p_partkey, case when km > 150 then 95 when km <= 5 then 25 when km <= 15 then 50 when km <= 35 then 70 when km <= 70 then 85 else 95 end score from d",
    "flood_score": "with d as (select p_partkey, least(p_partkey * 91 % 900, p_partkey * 57 % 1200) m from part) select p_partkey, case when m <= 60 then 20 when m <= 150 then 55 when m <= 400 then 80 else 100 end score from d",
    "composite_land_score": "with s as (select p_partkey, p_partkey * 7 % 101 water, p_partkey * 11 % 101 slope, p_partkey * 13 % 101 sun, p_partkey * 17 % 101 flood, p_partkey * 19 % 101 quake from part), t as (select p_partkey, greatest(10, least(100, cast(floor((35 * water + 25 * slope + 15 * sun + 15 * flood + 10 * quake) / 100) as int))) score from s) select p_partkey, score, case when score >= 85 then 'A+' when score >= 70 then 'A' when score >= 55 then 'B' when score >= 40 then 'C' else 'D' end cls from t",
    "nearest_per_class": "with d as (select case when category like '%BRASS%' then 'well' when category like '%STEEL%' then 'canal' when category like '%TIN%' then 'spring' else 'tank' end cls, id, " + dist_to(39.5, 33.5) + " m from poi where lat between 38 and 41 and lon between 32 and 35) select cls, count(*) n, min_by(id, round(m, 3) * 1e7 + id) nearest, round(min(m), 2) meters from d group by cls",
    "segment_distance": "with s as (select id, lat, lon, (lon - 30) * 111320 * cos(radians(39.0)) px, (lat - 39) * 111320 py, 50000.0 bx, 20000.0 by_ from poi), t as (select *, greatest(0.0, least(1.0, (px * bx + py * by_) / (bx * bx + by_ * by_))) u from s) select id, round(sqrt(power(px - u * bx, 2) + power(py - u * by_, 2)), 3) meters from t",
    "bounding_box": "select id, round(lat - 500 / 111320.0, 9) south, round(lat + 500 / 111320.0, 9) north, round(lon - 500 / (111320.0 * cos(radians(lat))), 9) west, round(lon + 500 / (111320.0 * cos(radians(lat))), 9) east from poi",
    "ring_counts": "with d as (select brand, " + dist_to(39.0, 34.0) + " m from poi) select brand, count(case when m <= 50000 then 1 end) within_50, count(case when m <= 100000 then 1 end) within_100, count(case when m <= 300000 then 1 end) within_300 from d group by brand",
    "local_density_ratio": "with d as (select brand, " + dist_to(39.0, 34.0) + " m from poi) select brand, round((count(case when m <= 100000 then 1 end) / 31415.926536) / nullif(count(case when m <= 500000 then 1 end) / 785398.163397, 0), 6) ratio from d group by brand",
    "buildable_capacity": "select p_partkey, cast(p_size * 50 as double) area, cast(p_size * 75 as double) gross, cast(p_size * 15 as double) footprint, cast(ceil(1.5 / 0.3 - 1e-9) as int) floors from part",
    "area_band_segments": "select case when p_size <= 10 then '1-10' when p_size <= 25 then '11-25' when p_size <= 40 then '26-40' else '41+' end band, count(*) n, round(avg(p_retailprice), 6) mean, bool_or(p_size = 30) matches from part group by 1",
    "zoning_shares_top6": "with c as (select p_type z, count(*) n from part group by 1), r as (select z, n, round(100.0 * n / sum(n) over (), 6) share, row_number() over (order by n desc, z) i from c) select z, n, share, i from r where i <= 6",
    "index_history_split": "select geo_id, period, round(avg(case when projected = 0 then v end), 4) observed, round(avg(case when projected = 1 then v end), 4) projection from cell group by geo_id, period",
    "representative_fallback": "with n as (select geo_id, unit_id, count(*) n from obs group by 1, 2), r as (select *, row_number() over (partition by geo_id order by n desc, unit_id) i from n) select geo_id, unit_id representative, n from r where i = 1",
    "transactions_by_year": "select substr(period, 1, 4) yr, dim, count(*) n, round(avg(v), 4) mean from obs where substr(period, 1, 4) >= '1997' group by 1, 2",
    "access_gate": "select c_custkey, case c_mktsegment when 'BUILDING' then 'full' when 'MACHINERY' then 'basic' else 'none' end package, c_mktsegment = 'BUILDING' or (c_mktsegment = 'MACHINERY' and c_nationkey < 12) allowed from customer",
    "air_quality_exceedance": "with d as (select event_type station, substr(cast(ts as string), 1, 10) dd, avg(value) v from events group by 1, 2) select station, count(*) n_days, round(avg(v), 6) mean, count(case when v > 50 then 1 end) over_50 from d group by station",
    "period_block": "select geo_id, count(case when period like '2000-%' then 1 end) last_12, count(case when period like '1999-%' then 1 end) previous_12, round(100.0 * count(case when period like '2000-%' then 1 end) / nullif(count(case when period like '1999-%' then 1 end), 0) - 100, 6) change_pct from obs group by geo_id",
    # Parsers
    "dataset_classifier": "select doc_id, case when " + FOLD.format(x="source") + " like '%1%' then 'listing' when source like '%2%' then 'index' when source like '%3%' then 'poi' else 'other' end domain, case when lang = 'en' then 'public' else 'internal' end policy from documents",
    "sector_classifier": "select p_partkey, case when lower(p_type) like '%brass%' then 'Metal' when lower(p_type) like '%promo%' then 'Promotion' when lower(p_type) like '%plated%' then 'Coating' when lower(p_type) like '%tin%' then 'Tin' else 'Other' end sector from part",
    "quota_selection": "with c as (select p_partkey, case when p_brand like '%1%' then 'a' when p_brand like '%2%' then 'b' when p_brand like '%3%' then 'c' end grp, p_retailprice from part), r as (select *, row_number() over (partition by grp order by p_retailprice desc, p_partkey) i from c where grp is not null) select grp, p_partkey, i from r where i <= case grp when 'a' then 20 when 'b' then 10 else 5 end",
    "registry_filter": "select o_orderkey from orders where upper(o_orderpriority) like '%URGENT%' or upper(o_orderpriority) like '%LOW%'",
    "band_parse": "with b as (select p_partkey, cast(p_size as string) || '-' || cast(p_size + 10 as string) t from part) select p_partkey, cast(regexp_extract(t, '^([0-9]+)-([0-9]+)$', 1) as bigint) lo, cast(regexp_extract(t, '^([0-9]+)-([0-9]+)$', 2) as bigint) hi from b",
    "area_extract": "with t as (select p_partkey, p_name || ' ' || cast(p_size * 12 as string) || ' m2 arsa' t from part) select p_partkey, cast(regexp_extract(t, '([0-9]+) m2', 1) as bigint) m2 from t",
    "room_type_guess": "select doc_id, case when lower(text) like '%villa%' then 'villa' when lower(text) like '%arsa%' then 'land' when strlen_ > 2000 then 'long' else 'unknown' end guess from (select doc_id, text, n_chars strlen_ from documents) d",
    "address_parse": "with a as (select c_custkey, 'Cadde ' || cast(c_nationkey as string) || ' No: ' || cast(c_custkey % 200 as string) || ' ' || lpad(cast(c_custkey % 81 as string), 2, '0') || '100' t from customer) select c_custkey, regexp_extract(t, 'Cadde ([0-9]+)', 1) street, regexp_extract(t, 'No: ([0-9]+)', 1) house, regexp_extract(t, '([0-9]{5})$', 1) postal from a",
    "mojibake_repair": "select n_nationkey, replace(replace(replace(n_name || 'Ã¼Ã§Ä±', 'Ã¼', 'ü'), 'Ã§', 'ç'), 'Ä±', 'ı') fixed from nation",
    "ingest_coverage": "select o_orderstatus fmt, count(*) inventory, count(c_custkey) staged, round(100.0 * count(c_custkey) / count(*), 4) coverage from orders left join (select c_custkey from customer where c_custkey % 10 <> 0) c on c_custkey = o_custkey group by 1",
    "flight_board_diff": "with a as (select o_custkey k, max(o_totalprice) t from orders where o_orderkey % 2 = 0 group by 1), b as (select o_custkey k, max(o_totalprice) t from orders where o_orderkey % 3 = 0 group by 1) select coalesce(a.k, b.k) k, case when a.k is null then 'new' when b.k is null then 'cancelled' when a.t <> b.t then 'changed' end change, a.t before_t, b.t after_t from a full outer join b on a.k = b.k where a.k is null or b.k is null or a.t <> b.t",
    "district_center": "select brand, round(avg(lat), 8) lat, round(avg(lon), 8) lon from poi group by brand",
    "venue_summary": "select l_suppkey, count(distinct l_partkey) products, round(avg(case when l_returnflag = 'R' then l_extendedprice end), 4) mean_r, round(avg(case when l_returnflag = 'N' then l_extendedprice end), 4) mean_n from lineitem group by l_suppkey",
    "brand_district_counts": "select p_brand, p_size % 7 district, count(*) n from part group by 1, 2",
    "welfare_index": "with g as (select c_nationkey k, c_mktsegment s, count(*) n, avg(c_acctbal) p, 100.0 * count(case when c_acctbal > 8000 then 1 end) / count(*) lux, 100.0 * count(case when c_acctbal < 0 then 1 end) / count(*) eco from customer group by 1, 2 having count(*) >= 2), z as (select *, least(99.5, greatest(25.0, 50 + (p - 4500) / 200 + 0.8 * lux - 0.4 * eco)) score from g) select k, s, n, round(score, 6) score, case when score >= 85 then 'A+' when score >= 75 then 'A' when score >= 65 then 'B+' else 'B' end cls from z",
    # Entity resolution and governance
    "confidence_rules": "with c as (select s_nationkey k, count(*) n, count(distinct s_acctbal) d from supplier group by 1) select k, n, case when n = 1 then 0.99 when n = 2 then 0.95 when n <= 4 then 0.5 else 0.33 end * cast(1 as double) confidence from c",
    "coverage_labels": "select n_nationkey, case when c.k is not null and s.k is not null then 'customer+supplier' when c.k is not null then 'customer_only' when s.k is not null then 'supplier_only' else 'none' end label from nation left join (select distinct c_nationkey k from customer where c_acctbal > 9500) c on c.k = n_nationkey left join (select distinct s_nationkey k from supplier where s_acctbal > 5000) s on s.k = n_nationkey",
    "coordinate_recovery": "with p as (select id, brand, case when id % 11 = 0 then null else lat end lat from poi), r as (select brand, max_by(lat, id) lat from p where lat is not null group by brand) select p.id, coalesce(p.lat, r.lat) lat, p.lat is null recovered from p left join r on p.brand = r.brand",
    "evidence_union_best": "with e as (select p_partkey k, 'rule' src, cast(0.92 as double) c from part where p_size > 30 union all select p_partkey, 'name', 0.85 from part where p_partkey % 3 = 0 union all select p_partkey, 'hint', 0.55 from part), r as (select *, row_number() over (partition by k order by c desc, src) i from e) select k, src, round(c, 4) c from r where i = 1",
    "schema_signatures": "select source, count(*) n, min(lang) || '/' || max(lang) signature from documents group by source",
    "publication_registry": "select distinct o_orderpriority src, coalesce(case o_orderpriority when '1-URGENT' then 'owned' when '5-LOW' then 'open' end, 'fallback') policy from orders",
    "winner_reason_counts": "with r as (select geo_id, period, dim, src, upd, h, row_number() over (partition by geo_id, period, dim order by projected, upd desc, src, h) i, lead(upd) over (partition by geo_id, period, dim order by projected, upd desc, src, h) u2, lead(src) over (partition by geo_id, period, dim order by projected, upd desc, src, h) s2 from obs) select case when u2 is null then 'single' when upd <> u2 then 'newer' when src <> s2 then 'source' else 'hash' end reason, count(*) n from r where i = 1 group by 1",
    # Transit
    "stop_time_fill": "with t as (select o_custkey trip, cast(row_number() over (partition by o_custkey order by o_orderkey) as bigint) seq, case when o_orderkey % 3 = 0 then o_totalprice end t from orders), w as (select *, max(case when t is not null then seq end) over (partition by trip order by seq rows between unbounded preceding and current row) a, min(case when t is not null then seq end) over (partition by trip order by seq rows between current row and unbounded following) b from t) select trip, seq, case when t is not null then 'given' when a is not null and b is not null then 'interpolated' else 'missing' end kind, a prev_seq, b next_seq from w",
    "service_labels": "select user_id, count(distinct @dow(ts)) n_weekdays, case when count(distinct @dow(ts)) = 7 then 'daily' when count(distinct case when @dow(ts) in (0, 6) then @dow(ts) end) = 0 then 'weekdays' else 'some' end label from events group by user_id",
    "line_hour_ratio": "with e as (select event_type line, extract(hour from ts) h, count(*) n from events group by 1, 2) select line, h as hr, n, round(n / avg(n) over (partition by line), 6) ratio from e",
}
