"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target / source size. Within its
source, documents stand in a fixed order; expected copies are prefix-summed along it, one offset of the
source is added, and a document is emitted once for each integer boundary that its interval crosses. The
order goes by size, so that the copies follow the sizes and taken words come near the target.

The prefix sum needs no task that sees a whole source: documents fall into cells (source, size class,
slice), and slices get more as the corpus grows. Cells are counted, the counts are
prefix-summed, and a document's place is its cell's start plus its place in the cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .base import cut, table

#: Copies of a document at most: the ratio of a target to its source's size.
MOST = 3
#: Slices of a size class, each of which holds about that part of it, for up to FULL documents; beyond that twice as many for each doubling.
SLICES, FULL = 256, 1 << 24
WORD = "[^\\x20\\x09-\\x0D]+"


def size(text: str | Column) -> Column:
    """Words in the text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key() -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))


def targets(sized: DataFrame, most: int = MOST) -> DataFrame:
    """(key, source_size, target) for (key, size) rows, of which a source may have many: sources in order of code points, null
    last, weigh 1, 2, 3 and again; a target is at most `most` times its source's size, and what is
    over is shared again by weight until none is above.

    Closed form: in rising order of limit / weight, those that stop at their limit come first and the
    rest share what they leave by weight. Only one row per source is ordered here."""
    per = sized.groupBy("key").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("key") == "", "key")
    weighed = per.select("*", ((F.row_number().over(order) - 1) % 3 + 1).cast("long").alias("w"), (most * F.col("source_size")).alias("lim"))
    rising = W.orderBy(F.col("lim") / F.col("w"), F.col("key") == "", "key")
    every = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    gone = F.coalesce(F.sum("lim").over(rising.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    level = (F.sum("source_size").over(every) - gone) / F.sum("w").over(rising.rowsBetween(0, W.unboundedFollowing))
    levels = weighed.withColumn("level", level)
    fits = F.max(F.when(F.col("level") * F.col("w") <= F.col("lim"), F.col("level"))).over(every)
    share = F.col("fits") * F.col("w")
    return levels.withColumn("fits", fits).select("key", "source_size", F.when(share < F.col("lim"), share).otherwise(F.col("lim").cast("double")).alias("target"))


def copies(docs: DataFrame, words: str | Column, most: int = MOST, seed: str = "mix") -> DataFrame:
    """(row_, size, source_size, target, copies) per row of docs: row_ is a struct with all columns of docs, which keep whatever names they have;
    words: the size, a column of docs or an expression; copies: 0 to `most`.

    A null size is 0. A null source is a source of its own. A source without words has target 0 and its rows 0 copies.
    Rows that share a doc_id count as rows of their own; where they are also equal in size, which of
    them gets one copy more is not fixed, but their number is. Null doc_ids are ties like any others. Texts aren't looked at, but for their size. An
    empty table gives an empty result."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    bits = F.bin("size")
    #: Four classes for each doubling of the size
    cls = F.concat(F.lpad(F.length(bits).cast("string"), 2, "0"), F.substring(F.concat(bits, F.lit("00")), 2, 2))
    slices = SLICES << ((docs.count() - 1) // FULL).bit_length() if docs.take(1) else SLICES
    cell = ["key", "class", "slice"]
    size_of = F.coalesce(words if isinstance(words, Column) else F.col(words), F.lit(0)).cast("long")
    rows = docs.select(F.struct(*docs.columns).alias("row_"), _key().alias("key"), F.col("doc_id").alias("id"), digest.alias("tie"), size_of.alias("size"))
    placed = rows.select("*", cls.alias("class"), (F.conv(F.substring("tie", 1, 8), 16, 10).cast("long") % slices).alias("slice"))
    counts = cut(placed.groupBy(*cell).agg(F.count("*").alias("n"), F.sum("size").alias("size")))
    before = F.sum("n").over(W.partitionBy("key").orderBy("class", "slice").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select(*cell, F.coalesce(before, F.lit(0)).alias("start")).join(targets(counts, most), "key")
    place = F.row_number().over(W.partitionBy(*cell).orderBy("size", "tie", "id"))
    known = placed.withColumn("place", place).join(starts, cell)
    offset = (F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|offset|"), "key")), 1, 4), 16, 10).cast("long") + 0.5) / 65536.0
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = F.col("start") + F.col("place")
    crossed = F.floor(offset + each * upto) - F.floor(offset + each * (upto - 1))
    return known.select("row_", "size", "source_size", "target", crossed.cast("long").alias("copies"))


def mix(docs: DataFrame, most: int = MOST, seed: str = "mix") -> DataFrame:
    """The mixed corpus: every row of docs as often as the mix takes it, with the columns of docs, whatever their names. Each is
    handled once, with its text, in one exchange by cell."""
    found = copies(docs, size("text"), most, seed).where("copies > 0")
    return found.select(F.explode(F.array_repeat("row_", F.col("copies").cast("int"))).alias("row_")).select("row_.*")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(table(spark, sf_dir, "documents").select("doc_id", "source", size("text").alias("words")))
    return copies(rows, "words").select("row_.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP5_SQL = r"""
with d as (select doc_id, coalesce('=' || source, '') k, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size from documents),
s as (select k, sum(size)::bigint source_size, 3 * sum(size)::bigint lim, (row_number() over (order by k = '', k) - 1) % 3 + 1 w from d group by k),
l as (select *, ((sum(source_size) over ())::bigint - coalesce(sum(lim) over (order by lim / w, k = '', k rows between unbounded preceding and 1 preceding), 0)::bigint)
   / (sum(w) over (order by lim / w, k = '', k rows between current row and unbounded following))::bigint as lev from s),
t as (select k, source_size, w, lim, (select max(lev) from l where lev * w <= lim) fits from s),
g as (select k, source_size, case when fits * w < lim then fits * w else lim::double end target from t),
p as (select d.*, g.source_size, g.target, md5('mix|' || coalesce(doc_id::varchar, '')) h, lpad(length(bin(size))::varchar, 2, '0') || substr(bin(size) || '00', 2, 2) c from d join g using (k)),
q as (select *, row_number() over (partition by k order by c, ('0x' || substr(h, 1, 8))::bigint % 256, size, h, doc_id) i,
   (('0x' || substr(md5('mix|offset|' || k), 1, 4))::bigint + 0.5) / 65536.0::double o,
   case when source_size > 0 then target / source_size else 0 end f from p)
select doc_id, size, source_size, target, ((floor(o + f * i) - floor(o + f * (i - 1))) * size)::bigint taken from q
"""
