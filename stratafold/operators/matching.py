"""Entity matching: candidates by blocks or cells, evidence as columns, one-to-one assignment. Pairs come from equality joins only."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import _jaro_winkler, fold, jaro_winkler, remembered, rules
from . import relational, spatial
from .lineage import cut


def ratio(a: Column, b: Column) -> Column:
    """Ratcliff and Obershelp's likeness of two texts, 0 to 1; null where one is null."""

    def one(x: str | None, y: str | None) -> float | None:
        return None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio()

    return F.pandas_udf(lambda x, y: pd.Series([one(p, q) for p, q in zip(x, y, strict=True)], dtype="float64"), "double")(a, b)


def words_alike(a: Column, b: Column, least: float = 0.85) -> Column:
    """A fuzzy F1 of two arrays of words: those of the first that equal a word of the second, or are that much alike by ratio."""

    def one(x, y) -> float | None:
        if x is None or y is None:
            return None
        p, q = set(x), set(y)
        if not p or not q:
            return float(not p and not q)
        hits = sum(any(u == v or difflib.SequenceMatcher(None, u, v).ratio() >= least for v in q) for u in p)
        return 2 * hits / (len(p) + len(q))

    return F.pandas_udf(lambda x, y: pd.Series([one(p, q) for p, q in zip(x, y, strict=True)], dtype="float64"), "double")(a, b)


def token_share(a: Column, b: Column) -> Column:
    """Shared words over all words of two folded texts, 0 where either has none."""
    x, y = (F.array_distinct(F.filter(F.split(t, " "), lambda w: w != "")) for t in (a, b))
    return F.size(F.array_intersect(x, y)) / F.greatest(F.lit(1), F.size(F.array_union(x, y)))


def _name_likeness(a: str | None, b: str | None) -> float:
    """Jaro-Winkler of two folded names, or what their shared words say; 0 where one is null."""
    if a is None or b is None:
        return 0.0
    x, y = ({w for w in t.split(" ") if w} for t in (a, b))
    share = len(x & y) / max(1, len(x | y))
    return max(_jaro_winkler(a, b), 0.80 + 0.20 * share if share >= 0.5 else 0.0)


def name_likeness(a: Column, b: Column) -> Column:
    return remembered(_name_likeness)(a, b)


def place_classes(a: DataFrame, b: DataFrame, metres: float = 250.0) -> DataFrame:
    """place_pairs of classes: places of one position, folded name, phone and kind are one row, with their ids in a_ids and b_ids; with af and bf, the kinds."""
    left = a.select(F.col("id").alias("a_id"), "lat", "lon", fold(F.col("name")).alias("an"), F.col("phone").alias("ap"), F.col("food").alias("af"))
    right = b.select(F.col("id").alias("b_id"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), fold(F.col("name")).alias("bn"), F.col("phone").alias("bp"), F.col("food").alias("bf"))
    near = spatial.within(relational.classed(left, "a_id", ["lat", "lon", "an", "ap", "af"], "a_ids"), relational.classed(right, "b_id", ["lat2", "lon2", "bn", "bp", "bf"], "b_ids"), metres)
    near = near.withColumn("name_sim", name_likeness(F.col("an"), F.col("bn")))
    near = near.withColumn("phone_match", F.coalesce((F.length("ap") == 10) & (F.col("ap") == F.col("bp")), F.lit(False))).where((F.col("name_sim") >= 0.75) | F.col("phone_match"))
    name = F.when(F.col("name_sim") >= 0.80, 0.92 * (F.col("name_sim") - 0.80) / 0.20).when(F.col("name_sim") >= 0.75, 0.10).otherwise(0.0)
    m = F.col("meters")
    distance = F.when(m <= 25, 0.85).when(m <= 60, 0.70).when(m <= 120, 0.50).when(m <= 200, 0.25).otherwise(0.10)
    against = F.coalesce(F.col("af") & ~F.col("bf"), F.lit(False))
    kind = F.when(F.col("af") & F.col("bf"), 0.30).otherwise(0.0)
    score = F.when(against, 0.55).otherwise(1.0) * rules.noisy_or(name, distance, F.when(F.col("phone_match"), 0.95), kind)
    flags = F.concat_ws(",", F.when(against, "CATEGORY_CONFLICT"), F.when(m > 120, "FAR_gt120m"), F.when(F.col("name_sim") < 0.85, "WEAK_NAME"))
    return near.withColumns({"score": F.round(score, 4), "flags": flags})


def place_pairs(a: DataFrame, b: DataFrame, metres: float = 250.0) -> DataFrame:
    """Scored candidates of points of interest, a (id, name, phone, lat, lon, food) with b: a_id, b_id, meters, name_sim, phone_match, score, flags.

    Evidence is names (Jaro-Winkler, or shared words), distance in steps, equal phones and kinds; a kind that contradicts takes 45 % of the score. Pairs
    whose names aren't alike and whose phones differ are no candidates. Places that are alike in all that counts are weighed once."""
    pairs = relational.expanded(place_classes(a, b, metres), a_ids="a_id", b_ids="b_id")
    return pairs.select("a_id", "b_id", "meters", "name_sim", "phone_match", "score", "flags")


def matched(pairs: DataFrame, least: float = 0.0) -> DataFrame:
    """(a, b, score): the greedy one-to-one assignment of pairs that reach a score; nearer pairs go first among equals."""
    held = pairs.where(F.col("score") >= least).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), (F.col("score") * 1e6 - F.col("meters") / 1e6).alias("score"))
    return relational.one_to_one(held).withColumn("score", F.round(F.col("score") / 1e6, 4))


def place_matches(a: DataFrame, b: DataFrame, least: float = 0.0, metres: float = 250.0) -> DataFrame:
    """matched of place_pairs. Positions that pairs connect make a group, within which the pairs are walked."""
    held = cut(place_classes(a, b, metres).where(F.col("score") >= least).select("a_ids", "b_ids", F.xxhash64(F.lit("a"), "lat", "lon").alias("x"), F.xxhash64(F.lit("b"), "lat2", "lon2").alias("y"), (F.col("score") * 1e6 - F.col("meters") / 1e6).alias("score")))
    groups = relational.connected(held.select("x", "y").distinct()).select(F.col("node").alias("x"), F.col("root").alias("group_"))
    pairs = relational.expanded(held.hint("merge").join(groups, "x"), a_ids="a_id", b_ids="b_id").withColumnsRenamed({"a_id": "a", "b_id": "b"})
    # An id may be there several times, at positions of several groups
    ids = a.select("id", F.lit(1).alias("side_")).union(b.select("id", F.lit(2)))
    if not ids.groupBy("id", "side_").count().where("count > 1").isEmpty():
        pairs = pairs.withColumn("group_", F.lit(0).cast("long"))
    return relational.one_to_one_by_group(pairs).withColumn("score", F.round(F.col("score") / 1e6, 4))


def district_pairs(web: DataFrame, official: DataFrame) -> DataFrame:
    """Candidates of quarters, (id, district, name, people) on both sides, whose names are alike within a district: a_id, b_id, name, consistency, score."""
    a = web.select(F.col("id").alias("a_id"), "district", rules.place_name(F.col("name")).alias("an"), F.col("people").alias("ap"))
    b = official.select(F.col("id").alias("b_id"), "district", rules.place_name(F.col("name")).alias("bn"), F.col("people").alias("bp"))
    # Quarters of one name and number of people are weighed once
    a, b = relational.classed(a, "a_id", ["district", "an", "ap"], "a_ids"), relational.classed(b, "b_id", ["district", "bn", "bp"], "b_ids")
    pairs = relational.spread(a, "district").hint("merge").join(relational.spread(b, "district"), "district").withColumn("name", jaro_winkler(F.col("an"), F.col("bn"))).where("name >= 0.80")
    agree = F.when((F.col("ap") > 0) & (F.col("bp") > 0), F.greatest(F.lit(0.0), 1 - F.least(F.lit(1.0), F.abs(F.col("ap") / F.col("bp") - 1) / 0.30)))
    scored = pairs.withColumn("consistency", agree)
    scored = scored.select("a_ids", "b_ids", F.round("name", 4).alias("name"), F.round("consistency", 4).alias("consistency"), rules.population_score(F.col("name"), F.col("consistency")).alias("score"))
    return relational.expanded(relational.spread(scored), a_ids="a_id", b_ids="b_id").select("a_id", "b_id", "name", "consistency", "score")


def category_evidence(evidence: DataFrame) -> DataFrame:
    """(id, cat, method, conf, sources, flags) of evidence (id, cat, method, conf, priority): the most trusted method's category; agreement of several adds 0.02, up
    to 0.99, and disagreement takes 15 %."""
    per = evidence.groupBy("id").agg(F.min(F.struct("priority", (-F.col("conf")).alias("less"), "cat", "method", "conf")).alias("b"), F.count("*").alias("sources"), F.count_distinct("cat").alias("cats"))
    conf = F.when(F.col("cats") > 1, F.round(F.col("b.conf") * 0.85, 3)).when(F.col("sources") >= 2, F.round(F.least(F.lit(0.99), F.col("b.conf") + 0.02), 3)).otherwise(F.col("b.conf"))
    flags = F.when(F.col("cats") > 1, F.concat(F.lit("CROSS_SOURCE_CONFLICT("), F.col("cats").cast("string"), F.lit(")")))
    return per.select("id", "b.cat", "b.method", conf.alias("conf"), "sources", flags.alias("flags"))


def facilities(listed: DataFrame, places: DataFrame) -> DataFrame:
    """For each listed facility (id, province, district, words, kinds) the best place (place_id, province, district, words, kinds, lat, lon) of its province, as id,
    place_id, score and status: 0.6 for alike words, 0.25 for shared kinds, 0.15 for a common district. Accepted from 0.6 on in the same district or with
    words alike by 0.8; ambiguous where another one is within 0.03, has other words and lies more than 300 m away."""
    a = listed.select("id", "province", F.col("district").alias("d1"), F.col("words").alias("w1"), F.col("kinds").alias("k1"))
    b = places.select("place_id", "province", F.col("district").alias("d2"), F.col("words").alias("w2"), F.col("kinds").alias("k2"), "lat", "lon")
    same = (F.col("d1") == F.col("d2")).cast("int")
    kinds = F.when(F.size(F.array_union("k1", "k2")) > 0, F.size(F.array_intersect("k1", "k2")) / F.size(F.array_union("k1", "k2"))).otherwise(1.0)
    pairs = a.join(b, "province").withColumn("alike", words_alike(F.col("w1"), F.col("w2"))).withColumn("score", 0.6 * F.col("alike") + 0.25 * kinds + 0.15 * same)
    good = pairs.where((F.col("score") >= 0.6 - 1e-12) & ((same == 1) | (F.col("alike") >= 0.8)))
    best = W.partitionBy("id").orderBy(F.col("score").desc(), "place_id")
    nxt = {c: F.lead(c).over(best).alias(f"{c}_") for c in ("score", "w2", "lat", "lon")}
    led = good.select("*", *nxt.values(), F.row_number().over(best).alias("i")).where("i = 1")
    from ..functions import haversine

    far = haversine(F.col("lat"), F.col("lon"), F.col("lat_"), F.col("lon_")) > 300
    unsure = F.coalesce((F.col("score") - F.col("score_") < 0.03) & (F.col("w2") != F.col("w2_")) & far, F.lit(False))
    found = led.select("id", F.when(~unsure, F.col("place_id")).alias("place_id"), F.round("score", 3).alias("score"), F.when(unsure, "ambiguous").otherwise("matched").alias("status"))
    return listed.select("id").join(found, "id", "left").withColumn("status", F.coalesce("status", F.lit("none")))


def same_business(a: DataFrame, b: DataFrame, metres: float = 150.0, least: float = 0.92) -> DataFrame:
    """(a_id, b_id, likeness): for each new place (id, name, lat, lon) the known one within a distance whose folded name is most alike, from a likeness on; ties go
    to the smaller id."""
    left = a.select(F.col("id").alias("a_id"), "lat", "lon", fold(F.col("name")).alias("an"))
    right = b.select(F.col("id").alias("b_id"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), fold(F.col("name")).alias("bn"))
    alike = spatial.within(left, right, metres).withColumn("likeness", ratio(F.col("an"), F.col("bn"))).where(F.col("likeness") >= least)
    return alike.groupBy("a_id").agg(F.min(F.struct((-F.col("likeness")).alias("less"), "b_id")).alias("b")).select("a_id", "b.b_id", (-F.col("b.less")).alias("likeness"))


def renamed(history: DataFrame) -> DataFrame:
    """(id, seen, before, after, event) where a place's name (id, seen, name) becomes another one: successor where it has nothing of the old name, spelling where
    it is alike or one holds the other."""
    order = W.partitionBy("id").orderBy("seen")
    led = history.withColumn("before", F.lag("name").over(order)).where("before is not null and not (before <=> name)")
    old, new = fold(F.col("before")), fold(F.col("name"))
    real = (ratio(old, new) < 0.6) & ~F.contains(new, old) & ~F.contains(old, new)
    return led.select("id", "seen", "before", F.col("name").alias("after"), F.when(real, "successor").otherwise("spelling").alias("event"))


def quarter_of(places: DataFrame, quarters: DataFrame) -> DataFrame:
    """(id, geo_id, how, confidence): the official quarter (geo_id, province, district, name) of a named place (id, province, district, name): by district and name,
    else by a name that is its province's only one, else none; a name that several have is ambiguous."""
    name = lambda c: rules.place_name(F.col(c))
    a = places.select("id", "province", "district", name("name").alias("n"))
    q = quarters.select("geo_id", "province", "district", name("name").alias("n"))
    exact = q.groupBy("province", "district", "n").agg(F.min("geo_id").alias("exact"))
    alone = q.groupBy("province", "n").agg(F.min("geo_id").alias("only"), F.count("*").alias("many"))
    found = a.join(exact, ["province", "district", "n"], "left").join(alone, ["province", "n"], "left")
    only = F.when(F.col("many") == 1, F.col("only"))
    how = F.when(F.col("exact").isNotNull(), "district_and_name").when(only.isNotNull(), "only_in_province").when(F.col("many") > 1, "ambiguous").otherwise("not_found")
    sure = F.when(F.col("exact").isNotNull(), 0.95).when(only.isNotNull(), 0.80)
    return found.select("id", F.coalesce("exact", only).alias("geo_id"), how.alias("how"), sure.alias("confidence"))


def rule_lookup(asked: DataFrame, known: DataFrame) -> DataFrame:
    """(id, rule, how): for (id, province, district, quarter) the first rule (rule, province, district, quarter, area) by order that fits: province, district
    and a quarter of which one holds the other; else province and quarter; else province and district."""
    n = lambda c: F.regexp_replace(fold(F.col(c)), " ", "")
    a = asked.select("id", n("province").alias("p"), n("district").alias("d"), F.coalesce(n("quarter"), F.lit("")).alias("q"))
    k = known.select("rule", n("province").alias("p"), n("district").alias("kd"), F.coalesce(n("quarter"), F.lit("")).alias("kq"), F.coalesce(n("area"), F.lit("")).alias("ka"))
    # What is asked alike has one answer, and of rules that say the same the first one counts
    asks = a.groupBy("p", "d", "q").agg(F.count("*").alias("n_"))
    k = k.groupBy("p", "kd", "kq", "ka").agg(F.min("rule").alias("rule"))
    pairs = relational.spread(asks, "p", "d", "q").join(k, "p")
    here = F.contains(F.col("kq"), F.col("q")) | F.contains(F.col("q"), F.col("kq")) | F.contains(F.col("ka"), F.col("q"))
    rank = F.when((F.col("d") == F.col("kd")) & (F.col("q") != "") & here, 1).when((F.col("q") != "") & here, 2).when(F.col("d") == F.col("kd"), 3)
    best = pairs.withColumn("rank", rank).where("rank is not null").groupBy(F.col("p").alias("p_"), F.col("d").alias("d_"), F.col("q").alias("q_")).agg(F.min(F.struct("rank", "rule")).alias("b"))
    found = a.join(best, (F.col("p") == F.col("p_")) & F.col("d").eqNullSafe(F.col("d_")) & (F.col("q") == F.col("q_")))
    # An id may ask several times
    one = found.groupBy("id").agg(F.min("b").alias("b"))
    return one.select("id", "b.rule", F.element_at(F.array(F.lit("exact"), F.lit("quarter"), F.lit("district")), F.col("b.rank")).alias("how"))
