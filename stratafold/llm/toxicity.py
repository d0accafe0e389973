"""Toxicity by two class-conditional Kneser-Ney models.

Toxic and ordinary labelled texts each give a model of words, spelled out as a chain of ever longer beginnings (1 to 8 letters, then
the word). A link of the chain has discounted counts of its class, and what the discount takes is spread by counts that both classes
share. An expression that a class has seen seldom is thus priced by the shared counts in both models and tells nothing, but for what its
beginning tells: a rare inflection of a known stem is judged by the stem. As in Kneser-Ney models, a word counts once
for each different word that it follows, so copies of a text add nothing.

A text's evidence is the difference of its two log-likelihoods by words, less an offset that takes out what comes from its language
and subject: the median difference of its words, with a few words that tell nothing among them and without those that tell much
for toxicity. So neither a text's toxic words nor a few others move the offset, and a toxic text of one word has its
whole difference as evidence. A logistic curve, fitted on other labelled rows, turns it into a score.

The models are fitted on a bounded sample of the labelled rows (TRAIN), so that what every task holds is bounded too. Counting
is distributed. Links whose counts don't pass the discount in either class have no say, so only the others reach the driver, and they
represent the models exactly. All documents are scored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import in_batches, lean, returned, table

#: Toxic rows that the models are fitted on, at most, and ordinary rows for each of them. The curve takes a quarter of both.
TRAIN, ORDINARY = 2_500, 3
#: What is taken from every count.
DISCOUNT = 4
#: Rows of documents that are held out: crc32 of the doc_id as text, modulo FOLDS, is 0; the fold CURVE serves the curve.
FOLDS, CURVE = 5, 4
#: The part of all weight that toxic rows have when the curve is fitted.
WEIGHT = 0.35
#: Letters of the beginnings; then comes the word.
LETTERS = 8
#: For the offset: words with a greater difference are toxic ones, and words that tell nothing, as many as a short text has.
STRONG, NEUTRAL = 1.0, 4
_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    return _fold(doc_id) == 0


@dataclass
class Model:
    """Differences of log-likelihood, toxic less ordinary, in place of both models."""

    known: dict[str, float]  #: of a beginning, or word of more than LETTERS letters, summed along its chain
    other: dict[str, float]  #: of whatever else follows a beginning
    slope: float = 1.0
    offset: float = 0.0
    _seen: dict[str, float] = field(default_factory=dict, repr=False)

    def _word(self, word: str) -> float:
        at = ""
        for end in (*range(1, LETTERS + 1), None):
            link = word[:end]
            if link == at:
                break
            if link not in self.known:
                return self.known.get(at, 0.0) + self.other.get(at, 0.0)
            at = link
        return self.known.get(at, 0.0)

    def evidence(self, text: str | None) -> float:
        """The mean difference of the words less the offset; 0 without words."""
        found, seen = words(text), self._seen
        if not found:
            return 0.0
        if len(seen) > 100_000:
            seen.clear()
        values = np.empty(len(found))
        for i, word in enumerate(found):
            value = seen.get(word)
            if value is None:
                value = seen[word] = self._word(word)
            values[i] = value
        return float(values.mean() - np.median(np.concatenate([values[values <= STRONG], np.zeros(NEUTRAL)])))

    def score(self, text: str | None) -> float:
        z = self.slope * self.evidence(text) + self.offset
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def sample(docs: DataFrame, labels: DataFrame, train: int = TRAIN) -> tuple[DataFrame, DataFrame]:
    """(toxic, text) for the models and for the curve, outside the held-out fold: the first rows of each class by a hash of doc_id, ORDINARY
    ordinary ones for each toxic one. Labels other than 0 and 1, and null ones, are left; of several labels for a doc_id the largest counts."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).select("*", _fold(F.col("doc_id")).alias("fold"))
    numbers = {r["curve"]: r["n"] for r in known.where((F.col("toxic") == 1) & (F.col("fold") != 0)).groupBy((F.col("fold") == CURVE).alias("curve")).agg(F.count("*").alias("n")).collect()}
    texts = in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = []
    for curve, most in ((False, train), (True, train // 4)):
        rows = known.where((F.col("fold") == CURVE) if curve else ~F.col("fold").isin(0, CURVE))
        n = min(numbers.get(curve, 0), most)
        first = [rows.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(k) for c, k in ((1, n), (0, ORDINARY * n))]
        # (ORDINARY + 1) * train rows of 12 bytes at most
        out.append(texts.join(F.broadcast(first[0].unionByName(first[1]).select("doc_id", "toxic")), "doc_id").select("toxic", "text"))
    return out[0], out[1]


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, before, word): each word with the one before it, once for the batch."""
    for b in batches:
        held: tuple[set, set] = (set(), set())
        for toxic, text in zip(b.column("toxic").to_pylist(), b.column("text").to_pylist(), strict=True):
            found = words(text)
            held[toxic].update(zip(["", *found], found, strict=False))
        for toxic, pairs in enumerate(held):
            if pairs:
                before, word = zip(*pairs, strict=True)
                yield pa.RecordBatch.from_pydict({"toxic": pa.array([toxic] * len(word), pa.int32()), "before": pa.array(before), "word": pa.array(word)})


def fit(docs: DataFrame, labels: DataFrame, train: int = TRAIN, discount: int = DISCOUNT) -> Model:
    """The models and the curve. Without rows of both classes nothing is evidence and every score is below 0.5."""
    rows, others = sample(docs, labels, train)
    counts = rows.mapInArrow(_followed, "toxic int, before string, word string").distinct().groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))
    ends = F.explode(F.array(*(F.lit(i) for i in (*range(1, LETTERS + 1), 1 << 20))))
    links = counts.select("t", "o", "word", ends.alias("end")).select("t", "o", F.expr("left(word, end)").alias("link"), F.expr(f"left(word, if(end > {LETTERS}, {LETTERS}, end - 1))").alias("stem"))
    links = links.groupBy("stem", "link").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    links = links.persist()
    # A beginning that is a word of its own is also a link from itself: the end of the word
    stems = {r["stem"]: (r["t"], r["o"], r["ct"], r["co"]) for r in links.groupBy("stem").agg(F.sum("t").alias("t"), F.sum("o").alias("o"), F.sum(F.least("t", F.lit(discount))).alias("ct"), F.sum(F.least("o", F.lit(discount))).alias("co")).where((F.col("t") > discount) | (F.col("o") > discount)).collect()}
    found = sorted(((r["link"], r["stem"], r["t"], r["o"]) for r in links.where(f"link <> stem and (t > {discount} or o > {discount})").collect()), key=lambda x: len(x[0]))
    links.unpersist()
    known, other = {}, {}
    for stem, (t, o, ct, co) in stems.items():
        other[stem] = math.log((ct / t) / (co / o)) if t and o else 0.0
    for link, stem, a, b in found:
        t, o, ct, co = stems[stem]
        share = (a + b) / (t + o)
        toxic = (max(a - discount, 0) + ct * share) / t if t else share
        ordinary = (max(b - discount, 0) + co * share) / o if o else share
        known[link] = known.get(stem, 0.0) + math.log(toxic / ordinary)
    model = Model(known, other)
    model.slope, model.offset = _curve(others, model)
    return model


def _curve(rows: DataFrame, model: Model) -> tuple[float, float]:
    """Slope and offset of the logistic curve."""
    held = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"y": b.column("toxic"), "x": pa.array([held.value.evidence(x) for x in b.column("text").to_pylist()], pa.float64())})

    found = rows.mapInArrow(run, "y int, x double").toPandas()  # two numbers for each row of the bounded sample
    held.destroy()
    x, y = found["x"].to_numpy(), found["y"].to_numpy()
    if not 0 < y.sum() < len(y):
        return 0.0, -4.0
    scale = float(np.std(x)) or 1.0
    z = np.stack([x / scale, np.ones_like(x)], axis=1)
    weight = np.where(y == 1, WEIGHT / y.sum(), (1 - WEIGHT) / (len(y) - y.sum()))
    beta = np.zeros(2)
    for _ in range(50):  # Newton's method with a little ridge, which keeps separable classes finite
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -50, 50)))
        gradient = z.T @ (weight * (p - y)) + 1e-4 * beta
        hessian = (z.T * (weight * p * (1 - p))) @ z + 1e-4 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row of docs, by the text alone. Null and empty texts have no evidence and get the curve's value at 0; rows
    that repeat are scored alike; an empty table gives an empty result."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "score": pa.array([held.value.score(x) for x in b.column("text").to_pylist()], pa.float64())})

    return in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run), "doc_id long, score double")


def keep_clean(docs: DataFrame, labels: DataFrame, train: int = TRAIN) -> DataFrame:
    """docs without rows whose score is 0.5 or more, with their columns as they were."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, train))

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for x in texts:
                yield pa.array([held.value.score(text) for text in x.to_pylist()], pa.float64())
        finally:
            held.value._seen.clear()
            returned()

    run.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return in_batches(docs).where(F.arrow_udf(run, "double")(F.coalesce("text", F.lit(""))) < 0.5)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = scored(docs, fit(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
