"""Document fingerprints: homomorphic multiset hashes of a text's paragraphs.

A paragraph (a line of the text) is hashed to a wide vector, and a text's fingerprint is the sum of its paragraphs'
vectors, lane by lane, modulo a power of two. Sums don't depend on the order, so texts with the same paragraphs in
any order have equal fingerprints, and a paragraph is put in or taken out by adding or subtracting its vector.

The vector has two parts. EXACT lanes of 32 bits, modulo 2**32, come from four seeded 64-bit hashes and decide equality. The
rest is for likeness: each of the paragraph's pieces (sentences) is hashed to 120 lanes of one bit, three to a word, each modulo 2**20 with a spare
bit above it that takes the carry and is cleared. About half their pieces' number, lanes are sums of plus or minus a half, so the scalar product of two
fingerprints estimates what the texts share. The fingerprint's text form holds all of the vector, and likeness is a function of two of these
alone. Everything is a SQL expression; a text never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import table

#: Paragraphs and pieces of paragraphs.
PARAGRAPH = "\\n"
PIECE = "[\\n.!?]+"
_SEEDS = (11, 23, 37, 51)
_LANE = (1 << 20) - 1
_ONES = 1 | 1 << 21 | 1 << 42
_MASK = _LANE * _ONES
#: Rows for each bucket of the search for the next document, and buckets at most. Beyond them buckets grow, and a window's rows spill to disk.
ROWS, BUCKETS = 64, 4096


def vector(text: Column) -> Column:
    """The fingerprint of a text as an array of longs: the number of pieces, 8 exact lanes, 40 words of likeness lanes. Null counts
    as empty, which has one paragraph, the empty one, and no pieces. A text may be of any length: sums are modulo powers throughout."""
    whole = F.coalesce(text, F.lit(""))
    paragraphs = F.split(whole, PARAGRAPH)
    pieces = F.filter(F.transform(F.split(whole, PIECE), lambda x: F.trim(x)), lambda x: x != "")
    exact = F.aggregate(
        F.transform(paragraphs, lambda p: F.array(*(F.xxhash64(F.lit(s), p) for s in _SEEDS))),
        F.array_repeat(F.lit(0).cast("long"), 8),
        lambda a, h: F.array(*((a[i] + F.shiftrightunsigned(h[i // 2], 32 * (i % 2)).bitwiseAND(0xFFFFFFFF)).bitwiseAND(0xFFFFFFFF) for i in range(8))),
    )
    like = F.aggregate(
        F.transform(pieces, lambda p: F.struct(F.xxhash64(F.lit(_SEEDS[0]), p).alias("x"), F.xxhash64(F.lit(_SEEDS[1]), p).alias("y"))),
        F.array_repeat(F.lit(0).cast("long"), 41),
        lambda a, h: F.array(a[0] + 1, *((a[i + 1] + F.shiftrightunsigned(h["x"] if i < 20 else h["y"], i % 20).bitwiseAND(_ONES)).bitwiseAND(_MASK) for i in range(40))),
    )
    return F.concat(exact, like)


def _fold(v: Column, w: Column, sign: int) -> Column:
    spare = (_LANE + 1) * _ONES

    def lane(a: Column, b: Column, i: Column) -> Column:
        wide = F.when(i < 8, F.lit(0xFFFFFFFF)).when(i == 8, F.lit((1 << 62) - 1)).otherwise(F.lit(_MASK))
        # The spare bits are lent before anything is taken away, so that no lane borrows from its neighbour
        lent = F.when(i < 8, F.lit(1 << 32)).when(i == 8, F.lit(0)).otherwise(F.lit(spare))
        return (a + b if sign > 0 else a + lent - b).bitwiseAND(wide)

    return F.transform(F.arrays_zip(v.alias("a"), w.alias("b")), lambda x, i: lane(x["a"], x["b"], i))


def put_in(v: Column, paragraphs: Column) -> Column:
    """The fingerprint with the paragraphs of a text added, as if they stood on further lines."""
    return _fold(v, vector(paragraphs), 1)


def take_out(v: Column, paragraphs: Column) -> Column:
    """The fingerprint with the paragraphs of a text removed; they must be among its own."""
    return _fold(v, vector(paragraphs), -1)


def written(v: Column) -> Column:
    """A fingerprint as text: its numbers in order, with commas between them."""
    return F.array_join(v.cast("array<string>"), ",")


def read(fingerprint: Column) -> Column:
    """The fingerprint that written() has made text of."""
    return F.split(fingerprint, ",").cast("array<bigint>")


def _lanes(v: Column) -> Column:
    """Likeness lanes about their middle, half the number of pieces: what a lane has more or less, which is far below 2**19 for any text."""
    half, odd = F.shiftright(v[8], 1), (v[8] % 2) / 2.0
    words = F.slice(v, 10, 40)

    def third(shift: int) -> Column:
        return F.transform(words, lambda x: (F.shiftrightunsigned(x, shift) - half + (1 << 19)).bitwiseAND(_LANE) - (1 << 19) - odd)

    return F.concat(third(0), third(21), third(42))


def _product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def _alike(a: Column, b: Column, xx: Column, yy: Column, xy: Column) -> Column:
    norm = F.sqrt(xx * yy)
    cosine = F.when(norm > 0, xy / norm).otherwise(0.0)
    return F.when(F.slice(a, 1, 8) == F.slice(b, 1, 8), 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine)))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: 1 where the exact lanes are equal, else the cosine of two fingerprints, at least 0. It
    estimates how many sentences two texts share, with a deviation of about 0.1."""
    x, y = _lanes(a), _lanes(b)
    return _alike(a, b, _product(x, x), _product(y, y), _product(x, y))


def with_likeness(df: DataFrame, one: str, others: dict[str, str]) -> DataFrame:
    """df with the likeness of column one's fingerprint to those of others' columns; others: new column: column. Lanes and their squares are made once."""
    names = {c: f"_{i}" for i, c in enumerate(dict.fromkeys([one, *others.values()]))}
    held = df.withColumns({f"{n}_lanes": _lanes(F.col(c)) for c, n in names.items()})
    held = held.withColumns({f"{n}_square": _product(F.col(f"{n}_lanes"), F.col(f"{n}_lanes")) for n in names.values()})
    x = names[one]
    found = {new: _alike(F.col(one), F.col(c), F.col(f"{x}_square"), F.col(f"{names[c]}_square"), _product(F.col(f"{x}_lanes"), F.col(f"{names[c]}_lanes"))) for new, c in others.items()}
    return held.select(*df.columns, *(v.alias(new) for new, v in found.items()))


def _bounds(docs: DataFrame, rows: int, buckets: int) -> list[int]:
    """Rising doc_ids that part docs into buckets of about so many rows each; so many buckets at most."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    n = min(ids.count() // rows, buckets - 1)
    if n < 1:
        return []
    found = ids.agg(F.percentile_approx("doc_id", [i / (n + 1) for i in range(1, n + 1)], 4 * buckets).alias("at")).first()
    return sorted({int(x) for x in found["at"] or ()})


def _bucket(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the bounds are at most doc_id, by halving; -1 for null."""
    if not bounds:
        return F.when(doc_id.isNull(), -1).otherwise(0)
    held = F.lit(bounds)

    def step(found: Column, width: Column) -> Column:
        there = F.least(found + width, F.lit(len(bounds)))
        return F.when(F.element_at(held, there) <= doc_id, there).otherwise(found)

    widths = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    return F.when(doc_id.isNull(), -1).otherwise(F.aggregate(F.lit(widths), F.lit(0), step))


def with_next(docs: DataFrame, rows: int = ROWS, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, text, vec, next_text, next_vec) per row of docs: next is the following one by descending doc_id, the first after
    the last. Null texts are empty; null doc_ids come last; rows that share a doc_id are ordered by text. Other columns, whatever their names, are not
    read; an empty table gives an empty result.

    Documents are parted by quantiles of their doc_ids, so that a window sees a bucket of them, however the ids lie (more only where rows share
    a doc_id), and a bucket's last row takes the first row of the next bucket that has any. A few thousand numbers of buckets at most are ordered in
    one task, and as many bounds reach the driver."""
    doc_id = F.col("doc_id").cast("long")
    held = docs.select(_bucket(doc_id, _bounds(docs, rows, buckets)).alias("bucket"), doc_id.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = W.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    heads = held.withColumn("rank", F.row_number().over(order)).where("rank = 1").select("bucket", "text")
    down = W.orderBy(F.col("bucket").desc())
    below = held.groupBy("bucket").agg(F.lit(1).alias("one")).select("bucket", F.coalesce(F.lead("bucket").over(down), F.first("bucket").over(down)).alias("below"))
    edges = below.join(heads.select(F.col("bucket").alias("below"), F.col("text").alias("head_text"), vector(F.col("text")).alias("head_vec")), "below").select("bucket", "head_text", "head_vec")
    led = held.withColumn("vec", vector(F.col("text"))).select("*", F.lead("text").over(order).alias("lead_text"), F.lead("vec").over(order).alias("lead_vec"))
    return led.join(edges, "bucket").select("doc_id", "text", "vec", F.coalesce("lead_text", "head_text").alias("next_text"), F.coalesce("lead_vec", "head_vec").alias("next_vec"))


def compared(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited, vec, edited_vec, next_vec) per row of docs: edited is the text with its last half, rounded down in code points,
    replaced by as many first code points of the next document's text, or all that it has. One exchange moves the texts."""
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), F.left("next_text", half))
    return with_next(docs).select("doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), "vec", "next_vec").withColumn("edited_vec", vector(F.col("edited")))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_likeness(compared(table(spark, sf_dir, "documents").select("doc_id", "text")), "vec", {"near_edited": "edited_vec", "near_next": "next_vec"})
    return found.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), written(F.col("vec")).alias("fingerprint"), written(F.col("edited_vec")).alias("edited_fingerprint"), "near_edited", "near_next")
