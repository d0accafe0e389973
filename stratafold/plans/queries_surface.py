"""The sixteen analyses with parameters, each held against SQL that knows nothing of the plan surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import surface as S
from .twins import twin_tables

_LISTINGS = "select geo_id, period, count(*)::double v from obs where projected = 0 group by 1, 2"


def plan(name: str, made, oracle: str | None, *rounded: str):
    @twin_tables(name, oracle)
    def run(spark, sf_dir):
        found = S.Engine(spark, sf_dir).run(made)
        return found.withColumns({c: F.round(c, 8) for c in rounded}) if rounded else found

    return run


plan("plan_profile", S.Profile("ILCE_7"), f"""with p as ({_LISTINGS}), up as (select 'IL_' || n_regionkey u from nation where n_nationkey = 7)
    select 'price' measure, dim, max(period) period, arg_max(v, period) v, null::double parent_v from cell where geo_id = 'ILCE_7' and projected = 0 group by dim
    union all select 'listings', null, max(period), arg_max(v, period), (select count(*) from obs, up where il_id = u and projected = 0 and period = (select max(period) from p where geo_id = 'ILCE_7'))::double from p where geo_id = 'ILCE_7'
    union all select 'people', null, '2001', count(*)::double, (select count(*) from customer join nation on c_nationkey = n_nationkey, up where 'IL_' || n_regionkey = u)::double from customer where c_nationkey = 7
    union all select 'listing_share', null, period, round(100.0 * count(*) filter (dim = 'F') / count(*), 8), null from obs where geo_id = 'ILCE_7' and projected = 0 and period = (select max(period) from p where geo_id = 'ILCE_7') group by period""", "v")

plan("plan_compare", S.Compare(("ILCE_1", "ILCE_2", "ILCE_3"), ("price", "listings"), dim="F"), f"""with v as (select 'price' measure, geo_id, period, v from cell where dim = 'F' and projected = 0 union all select 'listings', geo_id, period, v from ({_LISTINGS})), c as (select measure, max(period) period from (select measure, period from v where geo_id in ('ILCE_1', 'ILCE_2', 'ILCE_3') group by 1, 2 having count(*) = 3) group by 1)
    select measure, period, max(v) filter (geo_id = 'ILCE_1') "ILCE_1", max(v) filter (geo_id = 'ILCE_2') "ILCE_2", max(v) filter (geo_id = 'ILCE_3') "ILCE_3" from v join c using (measure, period) group by 1, 2""")

plan("plan_rank", S.Rank("price", "ilce", "IL_2", limit=4, dim="F", least_people=10, least_listings=2), f"""with l as (select max(period) p from cell where dim = 'F' and projected = 0), u as (select geo_id, v from cell, l where dim = 'F' and projected = 0 and period = p and il_id = 'IL_2' and geo_id in (select geo_id from ({_LISTINGS}), l where period = p and v >= 2) and geo_id in (select 'ILCE_' || c_nationkey from customer group by 1 having count(*) >= 10))
    select geo_id, v, rank() over (order by v desc, geo_id) place, round(100 * (1 - percent_rank() over (order by v desc, geo_id)), 8) percentile from u order by place limit 4""", "percentile")

plan("plan_series", S.SeriesOf(("ILCE_3", "ILCE_4"), "listings", first="1996-01", last="2000-12"), f"""with s as (select geo_id, period, v, row_number() over (partition by geo_id order by period) a, row_number() over (partition by geo_id order by period desc) z, datediff('month', date '1900-01-01', (period || '-01')::date) m from ({_LISTINGS}) where geo_id in ('ILCE_3', 'ILCE_4') and period between '1996-01' and '2000-12')
    select f.geo_id, f.period as first, l.period as last, round(l.v / f.v - 1, 8) as change, null::double points, round(power(l.v / f.v, 12.0 / (l.m - f.m)) - 1, 8) cagr, round(l.v / (select v from s where s.geo_id = f.geo_id and s.m = l.m - 12) - 1, 8) yoy from s f join s l on f.geo_id = l.geo_id and f.a = 1 and l.z = 1""", "change", "cagr", "yoy")

plan("plan_distribution", S.Distribution("price", "ilce", period="1999-06", dim="O"), "select count(*) n, min(v) lowest, round(quantile_cont(v, 0.1), 8) p10, round(quantile_cont(v, 0.25), 8) p25, round(median(v), 8) median, round(quantile_cont(v, 0.75), 8) p75, round(quantile_cont(v, 0.9), 8) p90, max(v) highest, round(avg(v), 8) mean, round(stddev_pop(v), 8) sd from cell where dim = 'O' and period = '1999-06' and projected = 0", "p10", "p25", "median", "p75", "p90", "mean", "sd")

_METRES = "2 * 6371008.8 * asin(sqrt(power(sin(radians(lat - 38.5) / 2), 2) + cos(radians(38.5)) * cos(radians(lat)) * power(sin(radians(lon - 34.0) / 2), 2)))"
plan("plan_surroundings", S.Surroundings(38.5, 34.0, 120_000), f"select brand, count(*) n, round(min(m), 2) nearest from (select brand, {_METRES} m from poi) where m <= 120000 group by brand")
plan("plan_surrounding_categories", S.Surroundings(38.5, 34.0, 200_000, report="categories"), f"select category, count(*) n from poi where {_METRES} <= 200000 group by category order by 2 desc, 1 limit 15")
plan("plan_nearest_list", S.Surroundings(38.5, 34.0, 200_000, category="ECONOMY", limit=7, report="list"), f"select id, name, round({_METRES}, 2) m from poi where category = 'ECONOMY' and {_METRES} <= 200000 order by {_METRES}, id limit 7")

plan("plan_density", S.Density("IL_1", limit=10, least_people=3), """select 'MAH_' || c_nationkey || '_' || c_mktsegment geo_id, count(*) filter (c_acctbal > 0) n, count(*)::double people, round(1000.0 * count(*) filter (c_acctbal > 0) / count(*), 8) per_1000 from customer join nation on n_nationkey = c_nationkey
    where n_regionkey = 1 group by 1 having count(*) >= 3 order by per_1000 desc, geo_id limit 10""", "per_1000")

plan("plan_shares", S.Shares("ILCE_5"), """with o as (select geo_id, il_id, nullif(src, '4-NOT SPECIFIED') dim from obs), a as (select dim, count(*) n from o where geo_id = 'ILCE_5' group by 1), b as (select dim, count(*) n from o where il_id = (select 'IL_' || n_regionkey from nation where n_nationkey = 5) group by 1)
    select a.dim, a.n, case when a.dim is not null then round(100.0 * a.n / (select sum(n) from a where dim is not null), 8) end share, case when b.dim is not null then round(100.0 * b.n / (select sum(n) from b where dim is not null), 8) end parent_share from a left join b on a.dim is not distinct from b.dim""", "share", "parent_share")

plan("plan_similar", S.Similar("ILCE_7", (("listings", None), ("people", None)), n=5), f"""with p as ({_LISTINGS}), l as (select geo_id, ln(v) x from p where period = (select max(period) from p)), c as (select 'ILCE_' || c_nationkey geo_id, ln(count(*)) y from customer group by 1), j as (select * from l join c using (geo_id)),
    z as (select geo_id, (x - (select avg(x) from j)) / (select case when stddev_pop(x) = 0 then 1 else stddev_pop(x) end from j) x, (y - (select avg(y) from j)) / (select stddev_pop(y) from j) y from j)
    select o.geo_id, round(sqrt(power(o.x - m.x, 2) + power(o.y - m.y, 2)), 8) distance from z o, z m where m.geo_id = 'ILCE_7' and o.geo_id <> 'ILCE_7' order by 2, 1 limit 5""", "distance")

plan("plan_turnover", S.Turnover(), """with e as (select distinct event_type kind, user_id, ((day(ts) - 1) // 10)::int snap from events), k as (select distinct kind, snap from e), p as (select kind, snap, count(*) n from e group by 1, 2),
    a as (select kind, snap, count(*) n from e where snap > 0 and not exists (select 1 from e f where f.kind = e.kind and f.user_id = e.user_id and f.snap = e.snap - 1) group by 1, 2), r as (select kind, snap + 1 snap, count(*) n from e where not exists (select 1 from e f where f.kind = e.kind and f.user_id = e.user_id and f.snap = e.snap + 1) group by 1, 2),
    t as (select kind, snap, p.n present, coalesce(a.n, 0) added, coalesce(r.n, 0) removed from p left join a using (kind, snap) left join r using (kind, snap)) select *, added - removed net, round(100.0 * (added + removed) / (present + removed), 8) churn from t""", "churn")

plan("plan_listing", S.Listing(brand="Brand#2", least_rating=2.5, order="price", limit=25), "select id, name, rating::double rating, price from poi where brand = 'Brand#2' and rating >= 2.5 order by price, id limit 25")

plan("plan_relation", S.Relation("people", "listings", "ilce", period_y="1999-03"), f"""with j as (select c.v x, p.v y from (select 'ILCE_' || c_nationkey geo_id, count(*)::double v from customer group by 1) c join ({_LISTINGS}) p using (geo_id) where p.period = '1999-03'), r as (select x, y, (select count(*) filter (k.x < j.x) + (count(*) filter (k.x = j.x) + 1) / 2.0 from j k) rx, (select count(*) filter (k.y < j.y) + (count(*) filter (k.y = j.y) + 1) / 2.0 from j k) ry from j)
    select count(*) n, round(corr(x, y), 8) pearson, round(corr(rx, ry), 8) spearman from r""", "pearson", "spearman")

plan("plan_coverage", S.Coverage("price"), "select count(distinct geo_id) geos, count(distinct period) periods, min(period) as first, max(period) as last, count(*) filter (projected = 1) projected, (select count(*) from nation) units, 100.0::double * count(distinct geo_id) / (select count(*) from nation) share from cell")

plan("plan_suitable", S.Suitable((S.Criterion("people", 2.0), S.Criterion("listings", 1.0, more_is_better=False)), limit=8), f"""with p as ({_LISTINGS}), l as (select geo_id, v from p where period = (select max(period) from p)), c as (select 'ILCE_' || c_nationkey geo_id, count(*) v from customer group by 1),
    a as (select geo_id, 100 * ((select count(*) filter (k.v < c.v) + (count(*) filter (k.v = c.v) + 1) / 2.0 from c k) - 1) / ((select count(*) from c) - 1) p from c), b as (select geo_id, 100 - 100 * ((select count(*) filter (k.v < l.v) + (count(*) filter (k.v = l.v) + 1) / 2.0 from l k) - 1) / ((select count(*) from l) - 1) p from l),
    s as (select geo_id, case when b.p is null then a.p else (2 * a.p + b.p) / 3 end score, case when b.p is null then 2 / 3.0 else 1 end covered, a.p ap, b.p bp from a left join b using (geo_id)), k as (select * from s where covered >= 0.7),
    f as (select geo_id, score, covered, row_number() over (order by score desc, geo_id) place, row_number() over (order by bp desc, geo_id) w1, row_number() over (order by ap desc, geo_id) w2 from k)
    select geo_id, round(score, 8) score, covered::double covered, place, least(place, w1, w2) best_place, greatest(place, w1, w2) worst_place from f where place <= 8""", "score")

plan("plan_projection", S.Projection("IL_1", "listings", 6), None)
plan("plan_outlook", S.Outlook("ILCE_4", 6), None)
