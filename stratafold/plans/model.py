"""The place-data model over the base tables, as common table expressions that both Spark SQL and the oracle's dialect read.

  geo     geo_id, level (ulke, il, ilce, mahalle), parent_id, name
  obs     price observations: geo_id (ilce), unit_id (mahalle), il_id, period (yyyy-MM), dim, src, v, upd, h, projected
  cell    obs after the dedup aggregate: one row per geo_id, period and dim, with its value, copies and conflict flag
  pop     people (customers) of a mahalle unit
  poi     points of interest with coordinates, category, brand and rating
  ind     indicator observations: month, dim1, dim2, quantity, revenue
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

CTES = {
    "geo": """select 'TR' geo_id, 'ulke' level, cast(null as string) parent_id, 'TR' name
      union all select 'IL_' || r_regionkey, 'il', 'TR', r_name from region
      union all select 'ILCE_' || n_nationkey, 'ilce', 'IL_' || n_regionkey, n_name from nation
      union all select 'MAH_' || n_nationkey || '_' || s.seg, 'mahalle', 'ILCE_' || n_nationkey, n_name || ' ' || s.seg
        from nation cross join (select distinct c_mktsegment seg from customer) s""",
    "obs": """select 'ILCE_' || c_nationkey geo_id, 'MAH_' || c_nationkey || '_' || c_mktsegment unit_id, 'IL_' || n_regionkey il_id,
        substr(cast(o_orderdate as string), 1, 7) period, o_orderstatus dim, o_orderpriority src, o_totalprice v,
        substr(cast(o_orderdate as string), 1, 10) upd, md5(cast(o_orderkey as string)) h,
        case when substr(cast(o_orderdate as string), 1, 7) >= '2001-06' then 1 else 0 end projected
      from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "cell": """select geo_id, il_id, period, dim, projected, max_by(v, upd || '|' || src || '|' || h) v, count(*) copies,
        max(v) - min(v) > 1e-9 + 1e-6 * max(abs(v)) conflict from obs group by geo_id, il_id, period, dim, projected""",
    "pop": """select 'MAH_' || c_nationkey || '_' || c_mktsegment unit_id, 'ILCE_' || c_nationkey ilce_id, count(*) people from customer group by 1, 2""",
    "poi": """select p_partkey id, p_name name, p_type category, p_brand brand, p_size / 10.0 rating, p_retailprice price,
        36 + (p_partkey * 37 % 600) / 100.0 lat, 26 + (p_partkey * 91 % 1900) / 100.0 lon from part""",
    "ind": """select substr(cast(l_shipdate as string), 1, 7) period, l_returnflag dim1, l_linestatus dim2, sum(l_quantity) quantity,
        sum(l_extendedprice * (1 - l_discount)) revenue from lineitem group by 1, 2, 3""",
}
_NEEDS = {"cell": ["obs"]}


def expand(text: str, duck: bool = False) -> str:
    """A query with the expressions of the model that it names put before it; @name marks what the dialects spell differently."""
    wanted: list[str] = []

    def want(name: str) -> None:
        for other in _NEEDS.get(name, []):
            want(other)
        if name not in wanted:
            wanted.append(name)

    for name in CTES:
        if re.search(rf"\b(?:from|join)\s+{name}\b", text):
            want(name)
    head = ", ".join(f"{n} as ({CTES[n]})" for n in wanted)
    text = text.strip()
    if head:
        text = f"with {head}, {text[4:].strip()}" if text.lower().startswith("with") else f"with {head} {text}"
    for mark, (ours, theirs) in MARKS.items():
        text = text.replace(mark, theirs if duck else ours)
    return text


#: What the dialects spell differently: (Spark, oracle)
MARKS = {
    "@all": ("", ", 'g'"),  # regexp_replace of every match
    "@sha": ("sha2", "sha256"),
    "@bits": (", 256", ""),
    "@padded": ("'$1-0$2'", r"'\1-0\2'"),
    "@day": ("day", "'day'"),
    "@like(": ("regexp_like(", "regexp_matches("),
    "@dow(ts)": ("(dayofweek(ts) - 1)", "extract(dow from ts)"),
    "@stops": (
        "md5(concat_ws(',', transform(sort_array(collect_list(struct(l_linenumber seq, l_suppkey stop))), x -> coalesce(cast(x.stop as string), '') || '#' || coalesce(cast(x.seq as string), ''))))",
        "md5(string_agg(coalesce(cast(l_suppkey as string), '') || '#' || coalesce(cast(l_linenumber as string), ''), ',' order by l_linenumber nulls first, l_suppkey nulls first))",
    ),  # of a trip's stops in their order
    "@epoch(ts)": ("unix_timestamp(ts)", "cast(floor(epoch(ts)) as bigint)"),
}


def source(sf_dir: str, name: str) -> str:
    """A base table as a relation of Spark SQL: read by its path, so that no view of the session is touched."""
    return f"(select * from parquet.`{sf_dir}/{name}.parquet`)"


def given(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The query's result as it is."""
    text = expand(text)
    tables = [f"{name} as {source(sf_dir, name)}" for name in TABLES if re.search(rf"\b{name}\b", text)]
    if tables:
        text = f"with {', '.join(tables)}, {text[4:].strip()}" if text.lower().startswith("with") else f"with {', '.join(tables)} {text}"
    return spark.sql(text)


def run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    df = given(spark, sf_dir, text)
    # Places and hours count as longs, and exact decimals of literals as doubles, so that both dialects return one schema
    kinds = {n: "double" if t.startswith("decimal") else "long" for n, t in df.dtypes if t.startswith("decimal") or n in ("i", "hr", "rnk", "place")}
    return df.withColumns({n: df[n].cast(kind) for n, kind in kinds.items()}) if kinds else df
