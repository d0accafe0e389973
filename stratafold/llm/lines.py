"""Substring dedup by hashing the sentences of lines.

A text's units are its lines' sentences: runs up to and with their final marks. Whole lines are too coarse, as passages that repeat begin and end
inside of them. Each unit is normalised (lower case, white space at its ends and in runs) and hashed to 128 bits; digests are
grouped over all documents, the earliest occurrence of each by (doc_id, place) stays, and later ones go. What goes keeps its offsets in the
input text. Line breaks stay.

Units of fewer than LEAST words stay as well: greetings, headings and short sentences recur by chance in texts that share nothing else.

Only digests and places are grouped. Firsts come from an aggregate with a partial one in every task, so a unit that a third of all rows hold
is one row for each task before any exchange. An occurrence finds its digest's first by a sort-merge join, whose side of occurrences Spark may
split where one digest is frequent; digests without a repeat take no part in it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import cut, in_batches, lean, table

#: A line break, or a sentence.
UNIT = r"[^.!?\n]+[.!?]*|[.!?]+|\n"
#: Words of a unit that may go, at least.
LEAST = 10
_NONE = (1 << 63) - 1
_SPACE, _UNIT = re.compile("[ \t\n\x0b\f\r]+"), re.compile(UNIT)


def normalised(unit: str) -> str:
    return _SPACE.sub(" ", unit.lower()).strip(" ")


def units(text: str | None) -> list[tuple[int, int]]:
    """(begin, end) of a text's units, in code points, line breaks left out."""
    return [x.span() for x in _UNIT.finditer(text or "") if x[0] != "\n"]


def _digests(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: tuple[list, ...] = ([], [], [], [])
            for k, tag, text in zip(b.column("k").to_pylist(), b.column("tag").to_pylist(), b.column("text").to_pylist(), strict=True):
                for begin, end in units(text):
                    plain = normalised(text[begin:end])
                    if plain and plain.count(" ") + 1 >= least:
                        for column, value in zip(rows, (k, tag, begin, blake2b(plain.encode(), digest_size=16).digest()), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.binary())], ["k", "tag", "at", "digest"])

    return run


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row_, kept, n_units, gone)."""
    for b in batches:
        kept, n, gone = [], [], []
        for text, tag, found in zip(b.column("text").to_pylist(), b.column("tag").to_pylist(), b.column("found").to_pylist(), strict=True):
            places = {x["at"] for x in found or () if x["tag"] == tag}
            text, spans = text or "", units(text)
            went = [x for x in spans if x[0] in places]
            edges = [0, *(x for span in went for x in span), len(text)]
            kept.append("".join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
            n.append(len(spans))
            gone.append([{"begin": x, "end": y} for x, y in went])
        yield pa.RecordBatch.from_arrays([b.column("row_"), pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))], ["row_", "kept", "n_units", "gone"])


def without_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(row_, kept, n_units, gone): row_ is a struct with all columns of docs but text; kept: the text without the units that
    went; gone: (begin, end) of each unit that went, in code points of the input text.

    A unit goes where its digest occurs in a document with a smaller doc_id, or earlier in its own. Units of under `least` words when
    normalised stay (1: only blank ones do). Null texts count as empty, which has no units. Rows that share a doc_id are told apart by their texts; equal
    rows are one and are cut alike. A null doc_id comes after all others. Columns of docs keep whatever names they have, in row_. A text has to fit in
    a task's memory, however long. An empty table gives an empty result."""
    others = [c for c in docs.columns if c != "text"]
    rows = in_batches(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE)).alias("k"), F.shiftright(F.xxhash64("text"), 32).cast("int").alias("tag"), F.struct(*others).alias("row_"), "text")
    found = cut(rows.select("k", "tag", "text").mapInArrow(lean(_digests(least)), "k long, tag int, at long, digest binary"))
    place = F.struct("k", "tag", "at")
    # Cut, so that both sides of the join come from exchanges of their own: only then can Spark split a frequent digest's occurrences
    firsts = cut(found.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("digest", "first"))
    gone = found.join(firsts, "digest").where(F.struct("k", "tag", "at") != F.col("first"))
    per = gone.groupBy("k").agg(F.collect_list(F.struct("tag", "at")).alias("found"))
    kind = docs.select(F.struct(*others).alias("row_")).schema["row_"].dataType.simpleString()
    return rows.join(per, "k", "left").select("row_", "text", "tag", "found").mapInArrow(lean(_without), f"row_ {kind}, kept string, n_units long, gone array<struct<begin:bigint,end:bigint>>")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.array_join(F.transform("gone", lambda x: F.concat_ws("-", x["begin"].cast("string"), x["end"].cast("string"))), ";")
    return found.select(F.col("row_.doc_id").alias("doc_id"), "n_units", F.size("gone").cast("long").alias("n_removed"), spans.alias("removed_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
with s as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^.!?\n]+[.!?]*|[.!?]+|\n') a from documents),
u as (select doc_id, unnest(a) t, unnest(range(len(a))) i from s),
o as (select *, length(t) n, coalesce(sum(length(t)) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0)::bigint b,
  trim(regexp_replace(lower(t), '[ \t\n\x0b\f\r]+', ' ', 'g')) p from u),
g as (select *, p <> '' and length(p) - length(replace(p, ' ', '')) >= 9 and row_number() over (partition by p order by doc_id, i) > 1 as rep from o),
c as (select doc_id, (count(*) filter (t <> chr(10)))::bigint n_units, (count(*) filter (rep))::bigint n_removed,
  coalesce(string_agg(b || '-' || (b + n), ';' order by i) filter (rep), '') removed_spans,
  sha256(coalesce(string_agg(t, '' order by i) filter (not rep), '')) kept_sha256 from g group by doc_id)
select d.doc_id, coalesce(n_units, 0)::bigint n_units, coalesce(n_removed, 0)::bigint n_removed, coalesce(removed_spans, '') removed_spans,
  coalesce(kept_sha256, sha256('')) kept_sha256 from documents d left join c on d.doc_id = c.doc_id
"""
