"""Relational operators and plan analyses as declarative queries: name -> (text, what it covers). Catalyst plans them; the same text, with the
few marked differences of dialect, is the oracle's."""

from __future__ import annotations

HAVERSINE = "2 * 6371008.8 * asin(sqrt(power(sin(radians({b}lat - {a}lat) / 2), 2) + cos(radians({a}lat)) * cos(radians({b}lat)) * power(sin(radians({b}lon - {a}lon) / 2), 2)))"


def distance(a: str, b: str) -> str:
    return HAVERSINE.format(a=a, b=b)


def dist_to(lat: float, lon: float, b: str = "") -> str:
    return f"2 * 6371008.8 * asin(sqrt(power(sin(radians({b}lat - {lat}) / 2), 2) + cos(radians({lat})) * cos(radians({b}lat)) * power(sin(radians({b}lon - {lon}) / 2), 2)))"


FOLD = "trim(regexp_replace(translate(lower(translate({x}, 'İI', 'iı')), 'çğıöşüâîû', 'cgiosuaiu'), '[^a-z0-9]+', ' '@all))"

SQL: dict[str, str] = {
    # Predicates and projections
    "geo_scope_filter": "select geo_id, name from geo where level = 'mahalle' and parent_id in (select geo_id from geo where level = 'ilce' and parent_id = 'IL_1')",
    "period_normalize": "select event_id, regexp_replace(concat(substr(cast(ts as string), 1, 4), '-', cast(cast(substr(cast(ts as string), 6, 2) as int) as string)), '^([0-9]{4})-([0-9])$', @padded) period from events",
    "coord_validity": """select id, case when id % 97 = 0 or lat is null or lon is null then 'MISSING' when lat = floor(lat) and lon = floor(lon) then 'INTEGER_DEGREE' when lat = lon then 'LON_EQ_LAT'
        when lat not between 35.5 and 42.5 or lon not between 25.5 and 45.0 then 'OUT_OF_RANGE' else 'VALID' end status from poi""",
    "safe_cast_numbers": "select doc_id, try_cast(substr(source, 4) as double) n, try_cast(lang as double) none from documents",
    "unit_scale_case": "select o_orderkey, round(o_totalprice * case when o_orderpriority in ('1-URGENT', '2-HIGH') then 1.0 else 100.0 end, 4) scaled from orders",
    "observation_kind": "select h, case when projected = 1 or period > '2001-05' then 'projected' else 'observed' end kind from obs",
    "review_flags": "select id, concat_ws(',', case when rating < 1 then 'low_rating' end, case when price > 1500 then 'high_price' end, case when lat > 41 then 'north' end) flags from poi",
    "stable_ids": "select s_suppkey, 'SUP_' || md5(s_name || '|' || cast(s_nationkey as string)) stable_id from supplier",
    "change_detection": """select a.c_custkey, a.c_nationkey old_nation, b.n2 new_nation from customer a join (select c_custkey, case when c_custkey % 7 = 0 then null else c_nationkey end n2 from customer) b
        on a.c_custkey = b.c_custkey where a.c_nationkey is distinct from b.n2""",
    "future_dated": "select o_orderkey, substr(cast(o_orderdate as string), 1, 4) yr from orders where substr(cast(o_orderdate as string), 1, 7) > '2001-05'",
    "text_search_fold": "select doc_id from documents where " + FOLD.format(x="text") + " like '%the and%'",
    "fold_names": "select n_nationkey, " + FOLD.format(x="n_name || ' ÇĞÖ-Şü'") + " folded from nation",
    "slug_names": "select p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '_'@all), '^_+|_+$', ''@all) slug from part",
    "phone_digits": "select c_custkey, right(regexp_replace('+90 (5' || cast(c_custkey * 7919 % 1000000000 as string) || ') ' || c_name, '[^0-9]', ''@all), 10) digits from customer",
    "localized_number_parse": "select o_orderkey, cast(replace(replace(replace(cast(cast(floor(o_totalprice) as bigint) as string) || ',5', '.', ''), ',', '.'), ' ', '') as double) parsed from orders",
    "significant_rounding": "select p_partkey, case when abs(p_retailprice) < 1e6 then round(round(p_retailprice / power(10, floor(log10(abs(p_retailprice))) - 5)) * power(10, floor(log10(abs(p_retailprice))) - 5), 6) else round(p_retailprice, 2) end shown from part where p_retailprice <> 0",
    # Joins
    "full_outer_profile_merge": "select coalesce(a.k, b.k) k, a.n customers, b.n suppliers from (select c_nationkey k, count(*) n from customer where c_nationkey < 20 group by 1) a full outer join (select s_nationkey k, count(*) n from supplier where s_nationkey > 5 group by 1) b on a.k = b.k",
    "semi_scope": "select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')",
    "anti_orphans": "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)",
    "cross_snapshots": "select e.event_type, d.d as snapshot, count(case when substr(cast(e.ts as string), 1, 10) <= d.d then 1 end) so_far from events e cross join (select '2024-01-05' d union all select '2024-01-15' union all select '2024-01-25') d group by 1, 2",
    "hierarchy_self_join": "select m.geo_id mahalle, i.geo_id ilce, p.geo_id il, u.geo_id ulke from geo m join geo i on m.parent_id = i.geo_id join geo p on i.parent_id = p.geo_id join geo u on p.parent_id = u.geo_id where m.level = 'mahalle'",
    "fallback_scope_lookup": """select g.geo_id, coalesce(a.n, b.n, c.n) n, case when a.n is not null then 'mahalle' when b.n is not null then 'ilce' else 'il' end scope from geo g
        left join (select unit_id, count(*) n from obs where dim = 'P' and v > 300000 group by 1) a on a.unit_id = g.geo_id
        left join (select geo_id, count(*) n from obs where dim = 'P' and v > 350000 group by 1) b on b.geo_id = g.parent_id
        left join (select il_id, count(*) n from obs group by 1) c on c.il_id = (case when g.level = 'mahalle' then 'IL_' || (cast(split_part(g.parent_id, '_', 2) as int) % 5) end) where g.level = 'mahalle'""",
    "correlated_scalar": "select n_nationkey, (select count(*) from customer where c_nationkey = n_nationkey) customers, (select max(s_acctbal) from supplier where s_nationkey = n_nationkey) best from nation",
    "grid_distance_join": "with g as (select *, cast(floor(lat / 0.5) as bigint) gy, cast(floor(lon / 0.5) as bigint) gx from poi), n as (select g.*, dy.d dy, dx.d dx from g cross join (select -1 d union all select 0 union all select 1) dy cross join (select -1 d union all select 0 union all select 1) dx) select a.id a_id, b.id b_id, round(" + distance("a.", "b.") + ", 3) meters from n a join g b on b.gy = a.gy + a.dy and b.gx = a.gx + a.dx and b.id > a.id where " + distance("a.", "b.") + " <= 20000",
    "series_alignment": "with x as (select geo_id, avg(v) x from cell where dim = 'F' group by 1), y as (select geo_id, avg(v) y from cell where dim = 'O' group by 1) select x.geo_id, round(x, 4) x, round(y, 4) y from x join y on x.geo_id = y.geo_id where x is not null and y is not null",
    "parent_value_inheritance": "with own as (select unit_id, avg(v) v from obs where v > 400000 group by 1), par as (select geo_id, avg(v) v from obs group by 1) select g.geo_id, round(coalesce(own.v, par.v), 4) v, case when own.v is null then 'inherited' else 'own' end origin from geo g left join own on own.unit_id = g.geo_id left join par on par.geo_id = g.parent_id where g.level = 'mahalle'",
    "snapshot_diff_events": "with a as (select distinct user_id, event_type from events where substr(cast(ts as string), 1, 10) < '2024-01-11'), b as (select distinct user_id, event_type from events where substr(cast(ts as string), 1, 10) >= '2024-01-20') select coalesce(a.user_id, b.user_id) user_id, coalesce(a.event_type, b.event_type) event_type, case when a.user_id is null then 'added' when b.user_id is null then 'removed' else 'stayed' end change from a full outer join b on a.user_id = b.user_id and a.event_type = b.event_type",
    # Aggregates
    "obs_dedup_latest": "select geo_id, period, dim, v, copies, conflict from cell",
    "conflict_summary": "select dim, cast(sum(copies) as bigint) n_rows, count(*) cells, count(case when conflict then 1 end) conflicts from cell group by dim",
    "filtered_aggregates": "select c_mktsegment, count(*) filter (where c_acctbal > 0) positive, round(avg(c_acctbal) filter (where c_acctbal > 0 or c_nationkey = 3), 6) mean_positive, count(distinct case when c_acctbal < 0 then c_nationkey end) nations_negative from customer group by c_mktsegment",
    "distribution_quantiles": "select dim, count(*) n, min(v) lowest, percentile_cont(0.1) within group (order by v) p10, percentile_cont(0.25) within group (order by v) p25, percentile_cont(0.5) within group (order by v) median, percentile_cont(0.75) within group (order by v) p75, percentile_cont(0.9) within group (order by v) p90, max(v) highest, round(avg(v), 4) mean, round(stddev_pop(v), 4) sd from cell where period = (select max(period) from cell where projected = 0) group by dim",
    "nearest_rank_quantile": "with r as (select o_orderpriority p, o_totalprice v, row_number() over (partition by o_orderpriority order by o_totalprice) i, count(*) over (partition by o_orderpriority) n from orders) select p, max(case when i = least(n, cast(floor(n * 0.9) as bigint) + 1) then v end) p90 from r group by p",
    "weighted_median": "with r as (select c_mktsegment s, c_custkey, c_acctbal v, c_nationkey + 1 w from customer), c as (select *, sum(w) over (partition by s order by v, c_custkey rows between unbounded preceding and current row) upto, sum(w) over (partition by s) total from r) select s segment, min(v) weighted_median from c where upto * 2 >= total group by s",
    "having_groups": "select o_custkey, count(*) n from orders group by o_custkey having count(*) >= 12 and count(distinct o_orderstatus) = 3",
    "wide_pivot": "select geo_id, max(v) filter (where dim = 'F' and period = '2000-12') f, max(v) filter (where dim = 'O' and period = '2000-12') o, max(v) filter (where dim = 'P' and period = '2000-12') p from cell group by geo_id",
    "additive_rollup": "select g.parent_id il, cast(sum(p.people) as bigint) people, count(*) contributors from pop p join geo g on g.geo_id = p.ilce_id group by g.parent_id",
    "groups_plus_all": "with e as (select event_type g, value from events union all select 'all', value from events) select g, count(*) n, round(avg(value), 6) mean from e group by g",
    "zero_filled_counts": "select g.geo_id, coalesce(c.n, 0) n from geo g left join (select unit_id, count(*) n from obs where v > 450000 group by 1) c on c.unit_id = g.geo_id where g.level = 'mahalle'",
    "density_per_1000": "select g.geo_id, coalesce(c.n, 0) n, round(1000.0 * coalesce(c.n, 0) / nullif(p.people, 0), 6) per_1000 from geo g join pop p on p.unit_id = g.geo_id left join (select unit_id, count(*) n from obs where dim = 'P' group by 1) c on c.unit_id = g.geo_id where p.people >= 5",
    "pop_change_5y": "with y as (select 'ILCE_' || c_nationkey geo_id, substr(cast(o_orderdate as string), 1, 4) yr, count(distinct c_custkey) n from orders join customer on o_custkey = c_custkey group by 1, 2), m as (select max(yr) last_yr from y) select geo_id, max(case when yr = last_yr then n end) n_last, max(case when cast(yr as int) = cast(last_yr as int) - 5 then n end) n_before, round(100.0 * max(case when yr = last_yr then n end) / nullif(max(case when cast(yr as int) = cast(last_yr as int) - 5 then n end), 0) - 100, 6) change_pct from y cross join m group by geo_id",
    "category_share_classified": "with c as (select case when p_size > 40 then null else p_brand end category, count(*) n from part group by 1) select category, n, case when category is not null then round(100.0 * n / sum(case when category is not null then n end) over (), 6) end share from c",
    "share_of_year_total": "with y as (select substr(cast(o_orderdate as string), 1, 4) yr, o_orderpriority sector, sum(o_totalprice) v from orders group by 1, 2) select yr, sector, round(100 * v / sum(v) over (partition by yr), 6) share from y",
    "duplicate_groups": "select md5(text) h, count(*) n, min(doc_id) first_doc, count(distinct source) sources from documents group by md5(text) having count(*) > 1",
    "audit_summary": "select min(period) earliest, max(period) latest, count(case when projected = 1 then 1 end) projected_rows, count(distinct src) sources, count(distinct geo_id) geos from obs",
    "accounting_check": "select bool_and(n = m) ok, count(*) cells from (select o_orderstatus s, count(*) n from orders group by 1) a join (select o_orderstatus s2, sum(k) m from (select o_orderstatus, o_orderpriority, count(*) k from orders group by 1, 2) x group by 1) b on a.s = b.s2",
    "pearson_corr": "select round(corr(x, y), 9) pearson, count(*) n from (select max(v) filter (where dim = 'F') x, max(v) filter (where dim = 'O') y from cell group by geo_id, period) z where x is not null and y is not null",
    "most_common_value": "with c as (select o_custkey, o_orderpriority p, count(*) n from orders group by 1, 2), r as (select *, row_number() over (partition by o_custkey order by n desc, p) i from c) select o_custkey, p, n from r where i = 1",
    "column_profile": "select 'c_name' col, count(*) n, count(case when c_name is null then 1 end) nulls, count(case when c_name = '' then 1 end) empties, count(distinct c_name) distincts, min(c_name) lowest, max(c_name) highest from customer union all select 'c_mktsegment', count(*), count(case when c_mktsegment is null then 1 end), count(case when c_mktsegment = '' then 1 end), count(distinct c_mktsegment), min(c_mktsegment), max(c_mktsegment) from customer",
    "content_detectors": "select source, count(case when @like(text, '[A-Za-z0-9._]+@[A-Za-z0-9]+[.][a-z]+') then 1 end) mails, count(case when @like(text, '[0-9]{3}-[0-9]{3,4}') then 1 end) phones, count(distinct lang) langs from documents group by source",
    "coverage_report": "select dim, count(distinct geo_id) geos, count(distinct period) periods, min(period) first_period, max(period) last_period, count(case when projected = 1 then 1 end) projected_cells, count(case when conflict then 1 end) conflicts, round(100.0 * count(distinct geo_id) / (select count(*) from geo where level = 'ilce'), 4) pct_units from cell group by dim",
    "lifecycle_fold": "with d as (select distinct user_id, cast(substr(cast(ts as string), 9, 2) as int) dd, event_type from events), w as (select *, lag(event_type) over (partition by user_id order by dd, event_type) before from d) select user_id, min(dd) first_day, max(dd) last_day, count(distinct dd) n_days, count(case when before is not null and before <> event_type then 1 end) changes, min(dd) = 1 left_censored from w group by user_id",
    "turnover_present_added_removed": "with p as (select distinct event_type g, user_id, cast(floor((cast(substr(cast(ts as string), 9, 2) as int) - 1) / 10) as int) snap from events), s as (select g, user_id, snap, lag(snap) over (partition by g, user_id order by snap) before, lead(snap) over (partition by g, user_id order by snap) after from p) select g, snap, count(*) present, count(case when snap > 0 and (before is null or before < snap - 1) then 1 end) added, count(case when snap < 2 and (after is null or after > snap + 1) then 1 end) leaving from s group by g, snap",
    "first_last_per_year_delta": "with y as (select o_custkey, substr(cast(o_orderdate as string), 1, 4) yr, count(*) n, min_by(o_totalprice, substr(cast(o_orderdate as string), 1, 10) || md5(cast(o_orderkey as string))) first_v, max_by(o_totalprice, substr(cast(o_orderdate as string), 1, 10) || md5(cast(o_orderkey as string))) last_v from orders group by 1, 2) select o_custkey, yr, n, round(last_v - first_v, 4) delta from y where n >= 2",
    "index_composite_banded": "with r as (select c_nationkey k, avg(c_acctbal) a, count(*) n from customer group by 1), s as (select k, least(100.0, greatest(0.0, a / 100 + n / 2.0)) score from r) select k, round(score, 6) score, case when score >= 70 then 'high' when score >= 40 then 'medium' else 'low' end band from s",
    "hour_daytype_profile": "select case when @dow(ts) in (0, 6) then 'weekend' else 'weekday' end day_type, extract(hour from ts) hr, count(*) n, round(avg(value), 6) mean from events group by 1, 2",
    # Windows, sorts, sets
    "keep_latest": "with r as (select *, row_number() over (partition by geo_id, period, dim order by upd desc nulls last, src, h) i from obs) select geo_id, period, dim, src, v, upd from r where i = 1",
    "copies_window": "select doc_id, count(*) over (partition by md5(text)) copies, row_number() over (partition by md5(text) order by doc_id) place from documents",
    "fill_down_running_max": "select o_orderkey, max(case when o_orderkey % 10 = 0 then o_orderkey end) over (partition by o_orderstatus order by o_orderkey rows between unbounded preceding and current row) filled from orders",
    "percentile_position": "with u as (select geo_id, avg(v) v from cell where dim = 'F' group by 1), r as (select *, row_number() over (order by v desc, geo_id) i, count(*) over () n from u) select geo_id, i, round(100.0 * (n - i) / (n - 1), 6) percentile from r",
    "rank_units_topk": "with u as (select c.geo_id, max(period) period, max_by(v, period) v from cell c where dim = 'F' and il_id = 'IL_2' and projected = 0 group by c.geo_id), r as (select *, row_number() over (order by v desc, geo_id) i, count(*) over () n from u) select geo_id, period, v, i, round(case when n > 1 then 100.0 * (n - i) / (n - 1) end, 6) percentile from r where i <= 5",
    "yoy_same_month": "with m as (select geo_id, cast(substr(period, 1, 4) as int) yr, substr(period, 6, 2) mo, avg(v) v from cell where projected = 0 group by 1, 2, 3) select a.geo_id, a.yr, a.mo, round(100 * (a.v / b.v - 1), 6) yoy from m a join m b on a.geo_id = b.geo_id and a.mo = b.mo and a.yr = b.yr + 1",
    "series_change_cagr": "with s as (select geo_id, min(period) a, max(period) z, min_by(v, period) va, max_by(v, period) vz from cell where dim = 'F' and projected = 0 group by geo_id), m as (select *, (cast(substr(z, 1, 4) as int) * 12 + cast(substr(z, 6, 2) as int)) - (cast(substr(a, 1, 4) as int) * 12 + cast(substr(a, 6, 2) as int)) n_months from s) select geo_id, a, z, n_months, round(vz / va - 1, 8) change, case when n_months >= 12 then round(power(vz / va, 12.0 / n_months) - 1, 8) end cagr from m",
    "last_n_slice": "with m as (select period, sum(quantity) q from ind group by 1), r as (select *, row_number() over (order by period desc) i from m) select sum(case when i <= 12 then q end) last_12, sum(case when i between 13 and 24 then q end) previous_12, count(case when i <= 24 then 1 end) n_months from r",
    "nearest_k_per_category": "with d as (select id, category, " + dist_to(39.0, 35.0) + " m from poi where lat between 37 and 41 and lon between 33 and 37), r as (select *, row_number() over (partition by category order by m, id) i from d where m <= 150000) select category, id, round(m, 2) meters, i from r where i <= 3",
    "radius_sector_counts": "select brand, count(*) n, round(min(" + dist_to(38.5, 34.0) + "), 2) nearest from poi where lat between 37 and 40 and lon between 32 and 36 and " + dist_to(38.5, 34.0) + " <= 120000 group by brand",
    "top_categories": "with c as (select category, count(*) n from poi group by 1), r as (select *, row_number() over (order by n desc, category) i from c) select category, n, i from r where i <= 15",
    "set_union_distinct": "select c_nationkey k from customer union select s_nationkey from supplier",
    "set_intersect": "select c_nationkey k from customer where c_acctbal > 9000 intersect select s_nationkey from supplier",
    "set_except": "select n_nationkey k from nation except select s_nationkey from supplier where s_acctbal > 5000",
    "upsert_last_write": "with n as (select c_custkey, c_name, 2 ver from customer where c_custkey % 3 = 0 union all select c_custkey, c_name, 1 from customer), r as (select *, row_number() over (partition by c_custkey order by ver desc) i from n) select c_custkey, c_name, ver from r where i = 1",
    "upsert_coalesce": "select coalesce(o.k, n.k) k, coalesce(n.v, o.v) v from (select c_custkey k, c_acctbal v from customer where c_custkey % 2 = 0) o full outer join (select c_custkey k, case when c_custkey % 5 = 0 then null else c_acctbal + 1 end v from customer where c_custkey % 3 = 0) n on o.k = n.k",
    "history_capture_scd2": "select a.c_custkey, a.c_mktsegment old_segment, b.seg new_segment from customer a join (select c_custkey, case when c_custkey % 4 = 0 then 'MOVED' else c_mktsegment end seg from customer) b on a.c_custkey = b.c_custkey where a.c_mktsegment is distinct from b.seg",
    # Plan analyses
    "compare_places_pivot": "with p as (select max(period) period from (select period from cell where dim = 'F' and projected = 0 and geo_id in ('ILCE_1', 'ILCE_2', 'ILCE_3') group by period having count(distinct geo_id) = 3) x) select c.period, round(max(v) filter (where geo_id = 'ILCE_1'), 4) a, round(max(v) filter (where geo_id = 'ILCE_2'), 4) b, round(max(v) filter (where geo_id = 'ILCE_3'), 4) c from cell c join p on c.period = p.period where dim = 'F' group by c.period",
    "profile_latest_all_measures": "select dim, max(period) period, max_by(v, period) v from cell where geo_id = 'ILCE_7' and projected = 0 group by dim",
    "latest_period_bind": "select geo_id, v from cell where dim = 'O' and period = (select max(period) from cell where dim = 'O' and projected = 0)",
    "parent_share_compare": "with c as (select unit_id, geo_id, count(*) n from obs group by 1, 2) select unit_id, round(100.0 * n / sum(n) over (partition by geo_id), 6) share from c",
    "similar_units_zscore": "with f as (select geo_id, avg(case when dim = 'F' then ln(v) end) a, avg(case when dim = 'O' then ln(v) end) b from cell group by 1), z as (select geo_id, (a - avg(a) over ()) / case when stddev_pop(a) over () = 0 then 1 else stddev_pop(a) over () end a, (b - avg(b) over ()) / case when stddev_pop(b) over () = 0 then 1 else stddev_pop(b) over () end b from f where a is not null and b is not null) select z.geo_id, round(sqrt(power(z.a - t.a, 2) + power(z.b - t.b, 2)), 8) dist from z join z t on t.geo_id = 'ILCE_5' where z.geo_id <> 'ILCE_5'",
    "suitability_score": "with m as (select geo_id, avg(v) price, count(*) n from cell group by 1), r as (select geo_id, 100.0 * (rank() over (order by price) + (count(*) over (partition by price) - 1) / 2.0 - 1) / (count(*) over () - 1) p1, 100.0 * (rank() over (order by n) + (count(*) over (partition by n) - 1) / 2.0 - 1) / (count(*) over () - 1) p2 from m) select geo_id, round(0.6 * (100 - p1) + 0.4 * p2, 6) score from r",
    # Governance, entity resolution
    "canonical_resolution": "with r as (select o_orderkey, row_number() over (partition by o_custkey, substr(cast(o_orderdate as string), 1, 7) order by case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end, o_totalprice desc, o_orderkey) i from orders) select o_orderkey from r where i = 1",
    "main_value_picker": "select geo_id, period, dim, min_by(v, src || '|' || h) main_v, count(distinct src) sources, count(distinct v) n_values, round((max(v) - min(v)) / nullif(avg(v), 0), 8) spread from obs group by 1, 2, 3",
    "natural_key_hash": "select o_orderkey, @sha(concat_ws('|', cast(o_custkey as string), substr(cast(o_orderdate as string), 1, 7), o_orderstatus)@bits) natural_key from orders",
    "row_classifier": "select h, case when v is null or v <= 0 then 'quarantine' when projected = 1 then 'projection' else 'observed' end cls, case when projected = 1 then 'future_period_after_reference' else 'measured' end reason from obs",
    "main_table_integrity": "select 'orders->customer' chk, count(*) broken from orders left join customer on o_custkey = c_custkey where c_custkey is null union all select 'customer->nation', count(*) from customer left join nation on c_nationkey = n_nationkey where n_nationkey is null union all select 'duplicate order ids', count(*) - count(distinct o_orderkey) from orders",
    "publish_gate": "select src, count(*) n, bool_and(projected = 0) publishable from obs where src in ('1-URGENT', '5-LOW') group by src",
    # Transit and time
    "last_stop_fill": "with t as (select o_custkey trip, o_orderkey stop, o_orderdate t from orders), r as (select *, row_number() over (partition by trip order by t desc, stop desc) i from t) select trip, stop last_stop from r where i = 1",
    "sessionize_events": "with q as (select user_id, event_id, @epoch(ts) t from events), g as (select *, case when t - lag(t) over (partition by user_id order by t, event_id) <= 3600 then 0 else 1 end begins from q), s as (select *, sum(begins) over (partition by user_id order by t, event_id rows between unbounded preceding and current row) sid from g) select user_id, cast(sid as bigint) sid, count(*) n from s group by 1, 2",
    "departures_board": "select user_id, event_id, extract(hour from ts) hr from events where extract(hour from ts) * 60 + extract(minute from ts) between 420 and 540 and @dow(ts) = 1",
    "interpolate_gaps": "with m as (select cast(substr(cast(ts as string), 9, 2) as int) d, avg(value) v from events where event_type = 'click' group by 1), k as (select d, case when d % 4 = 1 then v end v from m), w as (select d, v, max(case when v is not null then d end) over (order by d rows between unbounded preceding and current row) d0, min(case when v is not null then d end) over (order by d rows between current row and unbounded following) d1 from k) select w.d, round(case when w.d0 = w.d1 then a.v else a.v + (b.v - a.v) * (w.d - w.d0) / (w.d1 - w.d0) end, 6) v from w left join k a on a.d = w.d0 left join k b on b.d = w.d1",
    "tpch_pricing_summary": "select l_returnflag, l_linestatus, round(sum(l_quantity), 4) qty, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) charge, round(avg(l_discount), 8) disc, count(*) n from lineitem where l_shipdate <= cast('1998-09-02' as timestamp) group by 1, 2",
}
