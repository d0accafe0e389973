"""Language-model scoring by cross-entropy difference.

Two bigram models of the same form share one vocabulary: a target model, of documents that labels mark as good, and a background
model of all documents. A document's score is the mean over its words of the difference between the loss under the
target model and the loss under the background model: the lower, the more it reads like the target.

The models are counts of every word and bigram of the corpus, known by 63 bits of hash. They grow with the corpus and stay distributed:
  1. Documents are dealt to blocks of bounded size, labels with them. A block lists its distinct n-grams in the order of their hashes, with its own
     counts of them, and sends the list, cut by ranges of hashes, to the parts: a frequent n-gram is one entry for each block.
  2. A part adds up what all blocks have of an n-gram, and answers each block's list, entry by entry, with what the other blocks have.
  3. A block lists its n-grams again, adds the answers, and has the whole corpus' counts of whatever its own documents hold.
Texts are shuffled once, and of an n-gram a block sends some six bytes and gets one or two. Nothing is collected but a row of totals.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import in_batches, returned, stored, table

#: Words' worth of weight that the backoff has in every context.
KAPPA = 32.0
#: Input bytes, as the files hold them, of a block of documents and of a part of the n-grams.
BLOCK = 8 << 20
#: What stands for the word before a text's first one.
BEGIN = np.uint64(0)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Hashes(dict):
    """Words to their hashes."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    return x ^ (x >> np.uint64(27))


@dataclass
class _Grams:
    """Distinct n-grams of a block in the order of their hashes: all counts, those of good documents, and where each token's are."""

    hashes: np.ndarray
    counts: np.ndarray
    good: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, good: np.ndarray) -> _Grams:
        order = np.argsort(hashes)
        held = hashes[order]
        new = np.append(True, held[1:] != held[:-1]) if len(held) else np.empty(0, bool)
        first = np.flatnonzero(new)
        at = np.empty(len(held), np.int32)
        at[order] = np.cumsum(new, dtype=np.int32) - 1
        more = np.add.reduceat(good[order], first, dtype=np.int64) if len(first) else np.empty(0, np.int64)
        return cls(held[first], np.diff(first, append=len(held)), more, at)

    def edges(self, parts: int) -> np.ndarray:
        """Where each part's range of hashes begins, and the end."""
        starts = [(p << 64) // parts for p in range(parts)]
        return np.append(np.searchsorted(self.hashes, np.array(starts, np.uint64)), len(self.hashes))


class _Block:
    """The documents of a block and their n-grams. Words are parted by ASCII white space, A-Z lower-cased."""

    def __init__(self, rows: pa.Table) -> None:
        ids, texts, marks = (rows.column(c) for c in ("doc_id", "text", "good"))
        labelled = {i for i, mark in zip(ids.to_pylist(), marks.to_pylist(), strict=True) if mark}
        docs = rows.filter(pc.is_null(marks))
        self.ids = docs.column("doc_id").to_pylist()
        known = _Hashes()
        held, sizes = [], []
        for text in docs.column("text").cast(pa.large_binary()):
            found = (text.as_py() or b"").lower().split()
            sizes.append(len(found))
            held.append(np.fromiter(map(known.__getitem__, found), np.uint64, len(found)))
        del known, docs, texts
        self.sizes = np.array(sizes, np.int64)
        words = np.concatenate(held) if held else np.empty(0, np.uint64)
        del held
        self.starts = (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]
        good = np.repeat(np.array([i in labelled for i in self.ids], bool), self.sizes)
        before = np.empty_like(words)
        before[1:] = words[:-1]
        before[self.starts] = BEGIN
        self.pairs = _Grams.of(_mixed(before * _A + words), good)
        del before
        # The beginning of a text stands among the words, ahead of all others
        begins = np.full(len(self.starts), BEGIN)
        self.words = _Grams.of(np.concatenate([words, begins]), np.concatenate([good, good[self.starts]]))
        self.words.at = self.words.at[: len(words)]


def _planes(values: np.ndarray) -> bytes:
    """First bytes of all values, then all second bytes, and so on, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes())


def _values(data: bytes, kind: str) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(wide, -1).T.reshape(-1).view(kind)


def _asked(parts: int):
    """Step 1: a row for each part and kind of n-gram (pairs or words) of which the block has any."""

    def run(rows: pa.Table) -> pa.Table:
        block = _Block(rows)
        out: dict[str, list] = {name: [] for name in ("part", "block", "words", "h", "b", "t")}
        for words, grams in ((False, block.pairs), (True, block.words)):
            edges = grams.edges(parts).tolist()
            for part, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                if a < b:
                    steps = np.diff(grams.hashes[a:b], prepend=np.uint64(0))
                    for name, value in (("part", part), ("block", rows.column("block")[0].as_py()), ("words", words), ("h", _planes(steps)), ("b", _planes(grams.counts[a:b].astype("<u4"))), ("t", _planes(grams.good[a:b].astype("<u4")))):
                        out[name].append(value)
        del block
        returned()
        return pa.table([pa.array(out[f.name], f.type) for f in _ASKED_ARROW], schema=_ASKED_ARROW)

    return run


_ASKED = "part int, block int, words boolean, h binary, b binary, t binary"
_ASKED_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("words", pa.bool_()), ("h", pa.binary()), ("b", pa.binary()), ("t", pa.binary())])


def _gathered(rows: pa.Table) -> tuple[list[int], list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Blocks, sizes of their lists, and the lists one after the other: hashes and counts."""
    h = [np.cumsum(_values(x, "<u8"), dtype=np.uint64) for x in rows.column("h").to_pylist()]
    b, t = (np.concatenate([_values(x, "<u4") for x in rows.column(c).to_pylist()]).astype(np.int64) for c in ("b", "t"))
    return rows.column("block").to_pylist(), list(map(len, h)), np.concatenate(h), b, t


def _answered(rows: pa.Table) -> pa.Table:
    """Step 2: (block, words, part, b, t): for each entry of a list, what other blocks have of it."""
    out: dict[str, list] = {name: [] for name in ("block", "words", "part", "b", "t")}
    part = rows.column("part")[0].as_py()
    for words in (False, True):
        lot = rows.filter(pc.equal(rows.column("words"), words))
        if not lot.num_rows:
            continue
        blocks, sizes, h, b, t = _gathered(lot)
        order = np.argsort(h)
        held = h[order]
        new = np.append(True, held[1:] != held[:-1])
        first, which = np.flatnonzero(new), np.cumsum(new) - 1
        del held, h
        others = []
        for counts in (b, t):
            total = np.empty(len(order), np.int64)
            total[order] = np.add.reduceat(counts[order], first)[which]
            others.append(total - counts)
        at = 0
        for block, size in zip(blocks, sizes, strict=True):
            for name, value in (("block", block), ("words", words), ("part", part), *((n, _planes(x[at : at + size].astype("<u8"))) for n, x in zip("bt", others, strict=True))):
                out[name].append(value)
            at += size
        del order, others, b, t
    returned()
    return pa.table([pa.array(out[f.name], f.type) for f in _ANSWER_ARROW], schema=_ANSWER_ARROW)


_ANSWER = "block int, words boolean, part int, b binary, t binary"
_ANSWER_ARROW = pa.schema([("block", pa.int32()), ("words", pa.bool_()), ("part", pa.int32()), ("b", pa.binary()), ("t", pa.binary())])


def _totalled(rows: pa.Table) -> pa.Table:
    """(v, nb, nt): a part's distinct words and tokens, of all documents and of the good ones."""
    lot = rows.filter(rows.column("words"))
    found = (0, 0, 0)
    if lot.num_rows:
        _, _, h, b, t = _gathered(lot)
        word = h != BEGIN
        found = (len(np.unique(h[word])), int(b[word].sum()), int(t[word].sum()))
    return pa.table({name: pa.array([x], pa.int64()) for name, x in zip(("v", "nb", "nt"), found, strict=True)})


def _summed(grams: _Grams, answers: pa.Table, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """The corpus' counts of a block's n-grams."""
    own = answers.filter(pc.equal(answers.column("words"), words)).sort_by("part")
    out = []
    for name, counts in (("b", grams.counts), ("t", grams.good)):
        others = [_values(x, "<u8").astype(np.int64) for x in own.column(name).to_pylist()]
        out.append(counts + (np.concatenate(others) if others else np.zeros(0, np.int64)))
    return out[0], out[1]


def _scored(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Step 3: (doc_id, n_words, target_loss, background_loss) of a block's documents."""
    block = _Block(rows)
    n = block.sizes
    losses = [np.zeros(len(n)), np.zeros(len(n))]
    if len(block.starts):
        v, nb, nt = (answers.column(c)[0].as_py() for c in ("v", "nb", "nt"))
        pairs, words = _summed(block.pairs, answers, False), _summed(block.words, answers, True)
        for i, tokens in ((0, nt), (1, nb)):
            k = 1 - i
            word = words[k][block.words.at]
            context = np.empty_like(word)
            context[1:] = word[:-1]
            context[block.starts] = words[k][0]
            loss = np.log((context + KAPPA) / (pairs[k][block.pairs.at] + KAPPA * (word + 1) / (tokens + v)))
            losses[i][n > 0] = np.add.reduceat(loss, block.starts) / n[n > 0]
    ids = pa.array(block.ids, pa.int64())
    del block
    returned()
    return pa.table({"doc_id": ids, "n_words": pa.array(n, pa.int64()), "target_loss": pa.array(losses[0], mask=n == 0), "background_loss": pa.array(losses[1], mask=n == 0)})


def scored(docs: DataFrame, labels: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, score) per row of docs: mean losses by words, and their difference. Documents that any label of
    theirs calls good (quality 1) make the target model.

    A model's likelihood of a word is (count of the bigram + KAPPA * share of the word) / (count of the word before + KAPPA), where the share is
    (count of the word + 1) / (words of the model + distinct words of the corpus); what comes before a text counts once for each text that has words.

    Null and empty texts, and those without words, have 0 words and null losses and score. Rows that repeat count, and are scored, once for each; rows
    that share a doc_id share its label and meet in one block; those without one have none and are dealt by their text. Without good documents the target
    model is uniform; an empty table gives an empty result. Other columns, whatever their names, are not read. A text has to fit in a task's
    memory about forty times; `block` is the input's bytes for a block and for a part."""
    n = max(1, -(-stored(docs.select("doc_id", "text")) // block))
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    to = F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")), F.lit(n)).cast("int").alias("block")
    marks = labels.where("quality = 1").select(doc_id, F.lit(None).cast("string").alias("text"), F.lit(True).alias("good")).where("doc_id is not null").distinct()
    dealt = in_batches(docs).select(doc_id, "text", F.lit(None).cast("boolean").alias("good")).unionByName(marks).select(to, "*").repartition(n, "block")
    asked = dealt.groupBy("block").applyInArrow(_asked(n), _ASKED).repartition(n, "part")
    totals = asked.groupBy("part").applyInArrow(_totalled, "v long, nb long, nt long").agg(*(F.sum(c).alias(c) for c in ("v", "nb", "nt")))
    answers = asked.groupBy("part").applyInArrow(_answered, _ANSWER).crossJoin(F.broadcast(totals))  # one row
    found = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scored, "doc_id long, n_words long, target_loss double, background_loss double")
    return found.withColumn("score", F.col("target_loss") - F.col("background_loss"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
