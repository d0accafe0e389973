"""Reusable relational operators over DataFrames: latest rows, deduplicated observations, upserts, history, differences, ranks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, NumericType, StructType

from .lineage import cut

#: Ids in one array of a class at most.
CHUNK = 1000


def keep_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key: the first by order. Give an order that has no ties for a result that doesn't depend on the plan."""
    return df.withColumn("_i", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_i = 1").drop("_i")


def dedup_observations(df: DataFrame, keys: list[str], value: str, rank: list[str]) -> DataFrame:
    """(keys, value, copies, conflict): the value of the row with the largest rank, rows merged, and whether their values differ by more than
    1e-9 and a millionth. One exchange, after a partial aggregate; a hot key is one row for each task."""
    key = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rank))
    spread = F.max(value) - F.min(value) > 1e-9 + 1e-6 * F.max(F.abs(value))
    return df.groupBy(*keys).agg(F.max_by(value, key).alias(value), F.count("*").alias("copies"), spread.alias("conflict"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], how: str = "last") -> DataFrame:
    """Rows by key. how: 'last' takes new rows, 'first' keeps old ones, 'coalesce' takes new values that aren't null. Keys are unique on each side."""
    if how == "first":
        return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))
    if how == "last":
        return new.unionByName(old.join(new.select(*keys), keys, "left_anti"))
    if how != "coalesce":
        raise ValueError(how)
    rest = [c for c in old.columns if c not in keys]
    both = old.alias("o").join(new.alias("n"), keys, "full_outer")
    return both.select(*keys, *(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in rest))


def _differs(columns: list[str], a: str, b: str) -> Column:
    return reduce(lambda x, y: x | y, (~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns), F.lit(False))


def history(old: DataFrame, new: DataFrame, keys: list[str], volatile: tuple[str, ...] = ()) -> DataFrame:
    """The old rows whose key comes again with another value in a column that isn't volatile: what a history table takes up."""
    rest = [c for c in old.columns if c not in keys and c not in volatile]
    return old.alias("o").join(new.alias("n"), keys).where(_differs(rest, "o", "n")).select(*keys, *(F.col(f"o.{c}").alias(c) for c in old.columns if c not in keys))


def snapshot_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, change): added, removed or changed between two snapshots; equal rows are left out."""
    rest = [c for c in before.columns if c not in keys]
    a, b = before.withColumn("_a", F.lit(1)).alias("a"), after.withColumn("_b", F.lit(1)).alias("b")
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(_differs(rest, "a", "b"), "changed")
    return a.join(b, keys, "full_outer").select(*keys, change.alias("change")).where("change is not null")


def zero_filled(units: DataFrame, counted: DataFrame, key: str, n: str) -> DataFrame:
    """Every unit with its count, 0 where it has none."""
    return units.select(key).join(counted.select(key, n), key, "left").fillna(0, [n])


def top(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first k rows and their places; Spark keeps k rows for each task."""
    return df.orderBy(*order).limit(k).withColumn("place", F.row_number().over(W.orderBy(*order)))


def average_rank(value: str, groups: list[str] | None = None) -> Column:
    """Rank from 1, ties sharing the mean of their places."""
    part = [F.col(g) for g in groups or []]
    return F.rank().over(W.partitionBy(*part).orderBy(value)) + (F.count("*").over(W.partitionBy(*part, F.col(value))) - 1) / 2


def percent_position(value: str, n_first: bool = True, groups: list[str] | None = None) -> Column:
    """100 for the best and 0 for the last; n_first: the largest is the best. Null for a single row."""
    part = [F.col(g) for g in groups or []]
    i, n = average_rank(value, groups), F.count("*").over(W.partitionBy(*part))
    return F.when(n > 1, 100 * ((i - 1) if n_first else (n - i)) / (n - 1))


def weighted_median(df: DataFrame, groups: list[str], value: str, weight: str) -> DataFrame:
    """(groups, weighted_median): the first value at which half of the weight is reached."""
    w = W.partitionBy(*groups)
    upto = F.sum(weight).over(w.orderBy(value).rangeBetween(W.unboundedPreceding, W.currentRow))
    return df.withColumns({"_u": upto, "_t": F.sum(weight).over(w)}).where("_u * 2 >= _t").groupBy(*groups).agg(F.min(value).alias("weighted_median"))


def sessions(df: DataFrame, key: str, time: str, gap_seconds: int) -> DataFrame:
    """df with session: a number that goes up where more than gap_seconds have passed since the key's last row."""
    w = W.partitionBy(key).orderBy(time)
    pause = F.unix_timestamp(time) - F.unix_timestamp(F.lag(time).over(w))
    return df.withColumn("_b", F.when(pause <= gap_seconds, 0).otherwise(1)).withColumn("session", F.sum("_b").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_b")


def one_to_one(pairs: DataFrame) -> DataFrame:
    """(a, b, score) of a greedy assignment: the pair with the best score first, then the best among what is left; ties go to the smaller ids.

    In rounds until all is settled: pairs that are the best of both their ends are final, and take their ends out. The greedy order gives the same
    result, and rounds are few unless scores fall along a chain. Each round is checkpointed."""
    left, done = cut(pairs.select("a", "b", "score")), []
    while not left.isEmpty():
        order = [F.col("score").desc(), "a", "b"]
        ranked = left.withColumns({"_x": F.row_number().over(W.partitionBy("a").orderBy(*order)), "_y": F.row_number().over(W.partitionBy("b").orderBy(*order))})
        best = cut(ranked.where("_x = 1 and _y = 1").drop("_x", "_y"))
        done.append(best)
        left = cut(left.join(best.select("a"), "a", "left_anti").join(best.select("b"), "b", "left_anti"))
    return reduce(DataFrame.unionByName, done, left).select("a", "b", "score")


def one_to_one_by_group(pairs: DataFrame, most: int = 2_000_000) -> DataFrame:
    """(a, b, score) of one_to_one for pairs (a, b, score, group_) of which no two groups share an end.

    Each group's pairs are walked in their order once, by a task that keeps the ends in use alone; so ties, which settle one pair a round in one_to_one,
    cost nothing. Groups of more pairs than `most` go by rounds."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, used_a, used_b = None, set(), set()
        for batch in batches:
            stay = []
            for g, a, b in zip(*(batch.column(c).to_pylist() for c in ("group_", "a", "b")), strict=True):
                if g != group:
                    group, used_a, used_b = g, set(), set()
                stay.append(a not in used_a and b not in used_b)
                if stay[-1]:
                    used_a.add(a)
                    used_b.add(b)
            yield batch.select(["a", "b", "score"]).filter(pa.array(stay, pa.bool_()))

    pairs = cut(pairs.select("a", "b", "score", "group_"))
    large = pairs.groupBy("group_").agg(F.count("*").alias("n_")).where(F.col("n_") > most).select("group_")
    if some := not large.isEmpty():
        large = cut(large)
    walked = pairs.join(large, "group_", "left_anti") if some else pairs
    ordered = walked.repartition("group_").sortWithinPartitions("group_", F.col("score").desc(), "a", "b")
    kinds = dict(pairs.dtypes)
    settled = ordered.select("group_", "a", "b", "score").mapInArrow(walk, ", ".join(f"{c} {kinds[c]}" for c in ("a", "b", "score")))
    return settled.unionByName(one_to_one(pairs.join(large, "group_", "left_semi"))) if some else settled


def classed(df: DataFrame, row_id: str, keys: list[str], members: str) -> DataFrame:
    """(keys, members): rows that are equal in keys as one, with their ids in an array of CHUNK at most; a larger class is several rows."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(row_id))
    return df.select(*keys, row_id, F.floor((place - 1) / CHUNK).alias("chunk_")).groupBy(*keys, "chunk_").agg(F.collect_list(F.struct(row_id)).alias(members)).drop("chunk_")


def expanded(df: DataFrame, **members: str) -> DataFrame:
    """df with each row as often as its arrays of classed have members, all with all: name of the array -> column of the id, which keeps its own name."""
    for array, row_id in members.items():
        df = df.withColumn(array, F.explode(array)).withColumn(row_id, F.col(f"{array}.{row_id}")).drop(array)
    return df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys over as many partitions as the session's shuffles have: few rows of classes stand for many pairs, which Spark can't tell by their size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def running(df: DataFrame, order: list, amount: Column) -> DataFrame:
    """df with before_: the sum of amount over all earlier rows by order, which should have no ties.

    No task sees all rows: these are sorted by ranges, summed within each, and offset by what the ranges ahead hold. Only a row for each range is ordered
    in one task."""
    held = cut(df.withColumn("amount_", amount).orderBy(*order).withColumns({"range_": F.spark_partition_id(), "at_": F.monotonically_increasing_id()}))
    ahead = F.sum("whole_").over(W.orderBy("range_").rowsBetween(W.unboundedPreceding, -1))
    offsets = held.groupBy("range_").agg(F.sum("amount_").alias("whole_")).select("range_", F.coalesce(ahead, F.lit(0)).alias("ahead_"))
    inside = F.sum("amount_").over(W.partitionBy("range_").orderBy("at_").rowsBetween(W.unboundedPreceding, -1))
    return held.withColumn("inside_", F.coalesce(inside, F.lit(0))).join(offsets, "range_").withColumn("before_", F.col("inside_") + F.col("ahead_")).drop("amount_", "range_", "at_", "inside_", "ahead_")


def numbered(df: DataFrame, order: list) -> DataFrame:
    """df with place, from 1 on by order."""
    return running(df, order, F.lit(1).cast("long")).withColumn("place", F.col("before_") + 1).drop("before_")


def ranked(df: DataFrame, value: str, descending: bool = False) -> DataFrame:
    """df with least_rank (one more than the rows that are better), average_rank (ties share the mean of their places) and n (all rows)."""
    counts = df.groupBy(value).agg(F.count("*").alias("same_"))
    by = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    placed = running(counts, [by], F.col("same_")).select(F.col(value).alias("value_"), (F.col("before_") + 1).alias("least_rank"), (F.col("before_") + (F.col("same_") + 1) / 2).alias("average_rank"))
    n = counts.agg(F.sum("same_").alias("n"))
    return df.join(placed, F.col(value).eqNullSafe(F.col("value_"))).drop("value_").crossJoin(F.broadcast(n))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(col, n, nulls, empties, distincts, lowest, highest, leading_zeros, constant) of text columns, in one pass."""

    def seen(c: str) -> Column:
        x = F.col(c)
        hits = lambda test: F.count(F.when(test, 1))
        return F.struct(
            F.lit(c).alias("col"), F.count("*").alias("n"), hits(x.isNull()).alias("nulls"), hits(x == "").alias("empties"), F.count_distinct(x).alias("distincts"),
            F.min(x).alias("lowest"), F.max(x).alias("highest"), hits(x.rlike("^0[0-9]")).alias("leading_zeros"), (F.count_distinct(x) <= 1).alias("constant"),
        )

    return df.agg(F.array(*map(seen, columns)).alias("all_")).select(F.inline("all_"))


def decisions(evidence: DataFrame, key: str, row_id: str) -> DataFrame:
    """(key, selected, alternatives, reason, confidence) for keys with several rows: the best by class, governance, quality, completeness, time, period,
    content and id, why it is ahead of the next, and how sure that is. One window in place of two joined rankings."""
    criteria = ["cls", "governance", "quality", "completeness"]
    best = W.partitionBy(key).orderBy(*(F.col(c).desc() for c in criteria), F.col("seen").desc_nulls_last(), F.col("period").desc_nulls_last(), "content", row_id)
    after = {c: F.lead(c).over(best).alias(f"{c}_") for c in (*criteria, "seen", "period")}
    led = evidence.select("*", *after.values(), F.row_number().over(best).alias("i_"), F.count("*").over(W.partitionBy(key)).alias("n_")).where("i_ = 1 and n_ > 1")
    ahead = lambda c: F.col(c) > F.col(f"{c}_")
    other = lambda c: F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.col(f"{c}_"))
    names = dict(zip(criteria, ("record_class_priority", "source_governance_priority", "quality_score", "payload_completeness"), strict=True))
    reason = reduce(lambda chain, c: chain.when(ahead(c), names[c]), criteria[1:], F.when(ahead("cls"), names["cls"])).when(other("seen"), "latest_collection_time").when(other("period"), "latest_period").otherwise("stable_content_hash_tiebreak")
    sure = F.when(ahead("cls") | ahead("governance") | (F.col("quality") >= F.col("quality_") + 10), "high").when(ahead("quality") | ahead("completeness"), "medium").otherwise("low")
    return led.select(key, F.col(row_id).alias("selected"), (F.col("n_") - 1).alias("alternatives"), reason.alias("reason"), sure.alias("confidence"))


def interpolated(df: DataFrame, keys: list[str], order: str, value: str, most: int | None = None) -> DataFrame:
    """df whose null values lie on the line between the nearest known ones of their key on both sides, where these are `most` apart or less, with how:
    given, between, or null."""
    back, on = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1), W.partitionBy(*keys).orderBy(order).rowsBetween(1, W.unboundedFollowing)
    at = F.when(F.col(value).isNotNull(), F.col(order))
    known = df.withColumns({"p_": F.last(value, True).over(back), "pn_": F.last(at, True).over(back), "q_": F.first(value, True).over(on), "qn_": F.first(at, True).over(on)})
    gap = F.col("qn_") - F.col("pn_")
    near = gap.isNotNull() if most is None else gap <= most
    line = F.col("p_") + (F.col(order) - F.col("pn_")) * (F.col("q_") - F.col("p_")) / gap
    how = F.when(F.col(value).isNotNull(), "given").when(near, "between")
    return known.withColumn("how", how).withColumn(value, F.coalesce(value, F.when(near, line))).drop("p_", "pn_", "q_", "qn_")


def keyword_classes(df: DataFrame, rules: list[tuple[str, list[str], float]], name: Column, columns: Column) -> DataFrame:
    """df with category and confidence: rules are (category, keywords, points); a keyword in the name gives its points, one in the column names 0.8 of them."""
    hits = lambda text, points: lambda kw: F.when(F.contains(text, F.lit(kw)), points).otherwise(0.0)
    scores = [F.struct((reduce(lambda a, b: a + b, [hits(name, base)(kw) + hits(columns, 0.8 * base)(kw) for kw in words])).alias("s"), F.lit(cat).alias("cat")) for cat, words, base in rules]
    held = df.withColumn("scores_", F.filter(F.array(*scores), lambda x: x["s"] > 0))
    ordered = F.array_sort(F.transform("scores_", lambda x: F.struct((-x["s"]).alias("s"), x["cat"].alias("cat"))))
    whole = F.aggregate("scores_", F.lit(0.0), lambda acc, x: acc + x["s"])
    best = F.try_element_at(ordered, F.lit(1))
    sure = F.round(F.least(F.lit(0.95), 0.4 + 0.6 * (-best["s"] / whole) * F.least(F.lit(1.0), -best["s"] / 0.9)), 3)
    return held.withColumns({"category": F.coalesce(best["cat"], F.lit("unknown")), "confidence": F.coalesce(sure, F.lit(0.0))}).drop("scores_")


def _stars(links: DataFrame) -> DataFrame:
    """links (u, v) after each node hung its larger neighbours, and then its smaller ones and itself, on the smallest that it knows of."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    large = both.where("v > u").hint("merge").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    small = down.hint("merge").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over links (x, y); nodes without links aren't there. Large and small stars in turn until none changes: rounds,
    and with them what the driver keeps of its jobs, grow with the logarithm of the longest path. A checkpoint a round; no table is sent to all."""
    links = cut(links.select(F.col("x").alias("u"), F.col("y").alias("v")).distinct())
    stars, done = links.where("u <> v"), False
    while not done:
        stars = cut(_stars(stars))
        # Done where each node hangs on one other that hangs on none
        ends = stars.select(F.col("u").alias("node"), F.lit(1).alias("up_")).union(stars.select("v", F.lit(0)))
        done = ends.groupBy("node").agg(F.sum("up_").alias("n_"), F.min("up_").alias("least_")).where("n_ > 1 or n_ = 1 and least_ = 0").isEmpty()
    roots = stars.union(stars.select("v", "v")).union(links.where("u = v").select("u", "v"))
    return roots.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def alike_sets(df: DataFrame, item: str, element: str, similarity: float) -> DataFrame:
    """(item, cluster): items whose sets of elements are that similar by Jaccard, or linked by others that are; cluster is the smallest item. Equal sets
    meet first, so copies of a set are one row in the join by elements."""
    sets = df.groupBy(item).agg(F.sort_array(F.collect_set(element)).alias("set_")).withColumn("key_", F.sha2(F.to_json("set_"), 256))
    distinct = sets.groupBy("key_").agg(F.min(item).alias("first_"), F.first("set_").alias("set_"))
    parts = distinct.select("first_", F.size("set_").alias("n_"), F.explode("set_").alias("e_"))
    a, b = parts.select(F.col("first_").alias("x"), F.col("n_").alias("m"), "e_"), parts.select(F.col("first_").alias("y"), F.col("n_").alias("n"), "e_")
    pairs = a.join(b, "e_").where("x < y").groupBy("x", "y", "m", "n").agg(F.count("*").alias("k"))
    roots = connected(pairs.where(F.col("k") / (F.col("m") + F.col("n") - F.col("k")) >= similarity).select("x", "y"))
    named = distinct.join(roots, F.col("first_") == F.col("node"), "left").select("key_", F.coalesce("root", "first_").alias("cluster"))
    return sets.join(named, "key_").select(item, "cluster")


def merge_shards(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """The rows of shards whose columns may differ, with nulls for what a shard lacks; a key's row is that of the last shard that has it."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumn("shard_", F.lit(i)) for i, f in enumerate(frames)])
    rest = [c for c in every.columns if c not in keys and c != "shard_"]
    return every.groupBy(*keys).agg(F.max_by(F.struct(*rest), "shard_").alias("row_")).select(*keys, "row_.*")


def dimension(rule: str, columns: dict[str, str]) -> Column:
    """A predicate of 'kind:value'; columns: the column of each kind."""
    kind, _, value = rule.partition(":")
    if kind not in columns or not value:
        raise ValueError(f"no such dimension: {rule}")
    return F.col(columns[kind]) == value


def roles(schema: StructType) -> dict[str, str]:
    """What each column is for, by its name, place and type."""

    def role(i: int, name: str, kind) -> str:
        low = name.lower()
        if i == 0 and (low == "id" or low.endswith("_id")):
            return "key"
        if low in ("geo_id", "parent_geo_id"):
            return "geo"
        if low in ("lat", "lon", "latitude", "longitude"):
            return "coordinate"
        if low in ("period", "date", "ts") or low.endswith(("_at", "_date", "_time")):
            return "time"
        if low in ("unit", "currency"):
            return "unit"
        if "json" in low or isinstance(kind, ArrayType | MapType | StructType):
            return "json"
        if isinstance(kind, NumericType):
            return "measure"
        return "text" if low in ("name", "title", "address", "description") or low.endswith("_name") else "dimension"

    return {f.name: role(i, f.name, f.dataType) for i, f in enumerate(schema)}


def personal(columns: list[str]) -> list[str]:
    """Those of the columns that name a person or a way to reach one."""
    marks = ("phone", "mail", "owner", "person", "tckn", "iban", "author")
    return [c for c in columns if any(m in c.lower() for m in marks)]
