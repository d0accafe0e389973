"""Removal of repeated byte strings across documents, by suffix arrays of shards.

A suffix array of a whole corpus can't be one task's work, so strings are dealt to shards by content:
  1. Every window of `length` bytes has an anchor: its 24-byte piece with the smallest hash (the first of equals).
     Equal windows have equal anchors at equal places, so a window that occurs in two documents has an
     anchor whose hash occurs in both. Only hashes and places are shuffled, packed, about one for 14 bytes.
  2. Anchors whose hash occurs in one document alone can be left; around the others lie the candidate windows.
  3. Candidate windows get a second anchor, of 12 bytes, and runs of windows whose anchors have one hash, RUN at most, go as one segment
     to the shard of that hash. Equal windows meet in one shard, whatever surrounds them.
  4. A shard sorts the suffixes of its distinct segments by induced sorting, finds suffixes that share `length`
     bytes with their predecessors from permuted common prefixes, takes the smallest doc_id of each class,
     and reports the windows of larger doc_ids.
  5. Reports are merged per document, whose text is then cut.
Hashes only choose what is compared and where: each string that is removed was compared byte by byte.
Shards are as many as the input's size asks for, and a task takes one after the other, so that it holds a bounded share; texts are shuffled once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import chunks, in_batches, lean, stored, table
from .suffix import prefixes, suffix_array

LENGTH = 50
_FIRST, _SECOND = 24, 12
#: Bytes of a hash that are shuffled, besides what its part tells.
_HASH = 5
#: Bytes of text that are hashed at a time, and anchors or bytes of segments that are packed at a time.
_CHUNK, _FLUSH = 1 << 20, 1 << 20
#: Windows of a segment, at most: a long run of equal bytes makes many segments, but they are equal.
RUN = 64
#: Input bytes, as the files hold them, for each shuffle task, parts for each of these, and tasks at most. Beyond them tasks take more parts.
_SHARE, _PARTS, _TASKS = 4 << 20, 8, 1 << 16
_NONE = (1 << 63) - 1
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _A
    x ^= x >> np.uint64(29)
    x *= _B
    x ^= x >> np.uint64(32)
    return x


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the pieces of `size` bytes, 8 to 24, from each place on; the last places lack some bytes."""
    held = np.zeros(len(data) + 40, np.uint8)
    held[: len(data)] = data
    word = np.empty(len(data) + 24, np.uint64)
    for s in range(8):
        part = word[s::8]
        part[:] = held[s : s + 8 * len(part)].view("<u8")
    n, out = len(data), _mix(word[: len(data)])
    for at in [*range(8, size - 7, 8), *([size - 8] if size % 8 else [])]:
        out = _mix(out ^ (word[at : at + n] + _B))
    return out


def _anchors(grams: np.ndarray, size: int, length: int) -> np.ndarray:
    """For each place, where the piece with the smallest hash lies in the window of `length` bytes from there."""
    span = length - size + 1
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    have = 1
    while have * 2 <= span:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < span:
        low = np.minimum(low[: len(low) - (span - have)], low[span - have :])
    return (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, the starts of texts, and their sizes."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers starts[i], starts[i] + 1, ..., counts[i] of them, for all i."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary array of consecutive pieces of data."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _dealt(parts: np.ndarray, columns: dict[str, np.ndarray], sizes: np.ndarray | None = None, data: np.ndarray | None = None) -> pa.RecordBatch:
    """One row per part that occurs: each column's values packed in a compressed binary, and, where items of bytes are given, these too."""
    zstd = zstandard.ZstdCompressor(level=3).compress
    order = np.argsort(parts, kind="stable")
    held = parts[order]
    new = np.flatnonzero(np.diff(held, prepend=-1))
    counts = np.diff(new, append=len(held))
    out = {"part": pa.array(held[new].astype(np.int32))}
    for name, column in columns.items():
        wide, column = column.dtype.itemsize, column[order]
        # First bytes of all values, then all second bytes, and so on: alike ones together, for the shuffle's compression
        planes = [column[a : a + n].view(np.uint8).reshape(-1, wide).T.tobytes() for a, n in zip(new.tolist(), counts.tolist(), strict=True)]
        out[name] = pa.array(planes if name == "h" else list(map(zstd, planes)), pa.binary())  # hashes don't get smaller
    if sizes is not None:
        starts = np.cumsum(sizes) - sizes
        whole = data[_spans(starts[order], sizes[order])].tobytes()
        edges = [0, *np.cumsum(np.add.reduceat(sizes[order], new)).tolist()] if len(new) else [0]
        out["bytes"] = pa.array([zstd(whole[a:b]) for a, b in zip(edges, edges[1:], strict=False)], pa.binary())
    return pa.RecordBatch.from_pydict(out)


def _unpacked(batches: list[pa.RecordBatch], name: str, kind: str) -> np.ndarray:
    """The values of a column that _dealt has packed."""
    wide = np.dtype(kind).itemsize
    plain = (lambda x: x) if name == "h" else zstandard.ZstdDecompressor().decompress
    planes = [np.frombuffer(plain(x), np.uint8).reshape(wide, -1).T.reshape(-1) for b in batches for x in b.column(name).to_pylist()]
    return np.concatenate(planes).view(kind) if planes else np.empty(0, kind)


def _per_document(keys: dict[str, np.ndarray], values: np.ndarray) -> pa.RecordBatch:
    """One row per combination of keys, with its values packed."""
    order = np.lexsort(tuple(keys.values()))
    sorted_, values = {name: x[order] for name, x in keys.items()}, values[order]
    new = np.zeros(len(order), bool)
    new[0] = True
    for x in sorted_.values():
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    wide = values.dtype.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    return pa.RecordBatch.from_pydict({**{name: pa.array(x[first]) for name, x in sorted_.items()}, "packed": _binaries(values.reshape(-1).view(np.uint8), np.diff(first, append=len(order)) * wide)})


def _hashed(length: int, parts: int):
    """Step 1: (part, h, k, at)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            h, k, at = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            return _dealt((h % np.uint64(parts)).astype(np.int64), {"h": h.view(np.uint8).reshape(-1, 8)[:, 8 - _HASH :].copy().view(f"V{_HASH}").reshape(-1), "k": k, "at": at})

        for b in batches:
            ks = b.column("k").to_numpy()
            for first, texts in chunks(b.column("text"), _CHUNK):
                data, starts, sizes = _joined(texts)
                windows = np.maximum(sizes - length + 1, 0)
                if not windows.sum():
                    continue
                row = np.repeat(np.arange(len(texts)), windows)
                grams = _grams(data, _FIRST)
                where = _anchors(grams, _FIRST, length)[_spans(starts, windows)]
                new = _changes(grams[where], row)
                row, where = row[new], where[new]
                held.append((grams[where], ks[first + row], (where - starts[row]).astype(np.uint32)))
                if sum(len(x[0]) for x in held) >= _FLUSH:
                    yield flush()
        if held:
            yield flush()

    return run


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Places where any column has another value than at the place before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The rows of one part after the other; they come in the order of parts."""
    held: list[pa.RecordBatch] = []
    now = None
    for b in batches:
        parts = b.column("part").to_numpy()
        first = _changes(parts)
        for i, n in zip(first.tolist(), np.diff(first, append=len(parts)).tolist(), strict=True):
            if held and parts[i] != now:
                yield held
                held = []
            now = parts[i]
            held.append(b.slice(i, n))
    if held:
        yield held


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: the anchors of a part whose hash occurs in several documents, packed per document."""
    for held in _by_part(batches):
        yield from _common(held)


def _common(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    short = _unpacked(held, "h", f"V{_HASH}").view(np.uint8).reshape(-1, _HASH)
    h = np.zeros((len(short), 8), np.uint8)
    h[:, 8 - _HASH :] = short
    del short
    h = h.view("<u8").reshape(-1)
    k, at = _unpacked(held, "k", "<i8"), _unpacked(held, "at", "<u4")
    del held
    order = np.argsort(h)
    h = h[order]
    own = k[order]
    new = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    many = np.minimum.reduceat(own, new) < np.maximum.reduceat(own, new)
    keep = order[np.repeat(many, np.diff(new, append=len(h)))]
    if len(keep):
        yield _per_document({"k": k[keep]}, at[keep])


def _segments(length: int, parts: int):
    """Step 3: (part, k, tag, at, size, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            part, k, tag, at, size, data = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            return _dealt(part, {"k": k, "tag": tag, "at": at, "size": size.astype(np.uint16)}, size, data)

        for b in batches:
            ks, tags = b.column("k").to_numpy(), b.column("tag").to_numpy()
            found = b.column("packed")
            for first, texts in chunks(b.column("text"), _CHUNK):
                data, starts, sizes = _joined(texts)
                if not len(data):
                    continue
                windows = np.maximum(sizes - length + 1, 0)
                repeated = np.zeros(len(data), bool)
                for i in np.flatnonzero(windows):
                    at = np.frombuffer(b"".join(found[first + int(i)].as_py() or ()), "<u4")
                    repeated[starts[i] + at[at < sizes[i]].astype(np.int64)] = True  # a namesake's may not fit
                window = _spans(starts, windows)
                if len(window):
                    grams = _grams(data, _FIRST)
                    where = _anchors(grams, _FIRST, length)[window]
                    new = _changes(grams[where], np.repeat(np.arange(len(texts)), windows))
                    window = window[np.repeat(repeated[where[new]], np.diff(new, append=len(window)))]
                    del grams, where
                del repeated
                if not len(window):
                    continue
                grams = _grams(data, _SECOND)
                anchor = _anchors(grams, _SECOND, length)[window]
                new = _changes(grams[anchor], window - np.arange(len(window)))
                runs = np.diff(new, append=len(window))
                pieces = -(-runs // RUN)
                new = _spans(new, pieces) + (RUN - 1) * (_spans(np.zeros_like(pieces), pieces))
                begin, size = window[new], np.diff(new, append=len(window)) + length - 1
                row = np.searchsorted(starts, begin, "right") - 1
                part = (grams[anchor[new]] % np.uint64(parts)).astype(np.int64)
                held.append((part, ks[first + row], tags[first + row], (begin - starts[row]).astype(np.uint32), size, data[_spans(begin, size)]))
                if sum(len(x[5]) for x in held) >= 8 * _FLUSH:
                    yield flush()
        if held:
            yield flush()

    return run


def _classes(length: int):
    """Step 4: the windows (from, past the last) that a smaller doc_id has too, packed per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _by_part(batches):
            yield from _sorted_part(held, length)

    return run


def _sorted_part(held: list[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    k, tag, at, size = (_unpacked(held, *x) for x in (("k", "<i8"), ("tag", "<i4"), ("at", "<u4"), ("size", "<u2")))
    size = size.astype(np.int64)
    coded = _binaries(_unpacked(held, "bytes", "u1"), size).dictionary_encode()
    held.clear()
    which = coded.indices.to_numpy()
    distinct = coded.dictionary.to_pylist()
    del coded
    least = np.full(len(distinct), _NONE, np.int64)
    np.minimum.at(least, which, k)
    data = np.frombuffer(b"\xff".join(distinct), np.uint8)  # UTF-8 has no such byte
    sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
    del distinct
    starts = np.cumsum(sizes + 1) - sizes - 1
    windows = sizes - length + 1
    place = _spans(starts, windows)
    order = suffix_array(data)
    alike = prefixes(data, order) >= length
    whole = np.zeros(len(data), bool)
    whole[place] = True
    # What shares `length` bytes with a window has no break within them, so it is a window too
    order = order[whole[order]]
    new = np.flatnonzero(~alike[order])
    del whole, alike
    owner = np.zeros(len(data), np.int64)
    owner[place] = np.repeat(least, windows)
    smallest = np.zeros(len(data), np.int64)
    smallest[order] = np.repeat(np.minimum.reduceat(owner[order], new), np.diff(new, append=len(order)))
    del owner, order
    for lot in np.array_split(np.arange(len(k)), max(1, len(k) >> 16)):  # bounded room for occurrences
        n = windows[which[lot]]
        of = np.repeat(lot, n)
        over = smallest[_spans(starts[which[lot]], n)] < k[of]
        begin = _spans(at[lot].astype(np.int64), n)[over]
        of = of[over]
        if not len(of):
            continue
        new = np.append(True, (of[1:] != of[:-1]) | (begin[1:] != begin[:-1] + 1))
        last = np.append(new[1:], True)
        ranges = np.stack([begin[new], begin[last] + length], axis=1).astype(np.uint32)
        yield _per_document({"k": k[of[new]], "tag": tag[of[new]]}, ranges)


def _merged(packed: list[dict] | None, tag: int) -> np.ndarray:
    """Disjoint ranges in order, of a row's packed ones, which may overlap or touch."""
    ranges = np.frombuffer(b"".join(x["packed"] for x in packed or () if x["tag"] == tag), "<u4").reshape(-1, 2).astype(np.int64)
    if len(ranges) < 2:
        return ranges
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ranges[:, 1])
    new = np.flatnonzero(np.append(True, ranges[1:, 0] > reach[:-1]))
    return np.stack([ranges[new, 0], reach[np.append(new[1:] - 1, len(ranges) - 1)]], axis=1)


def _cut(as_text: bool):
    """Step 5: (row, kept, spans), or (row, text) with a code point that lost some of its bytes gone whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, spans = [], []
            for text, tag, packed in zip(b.column("text").cast(pa.large_binary()), b.column("tag").to_pylist(), b.column("packed"), strict=True):
                data, ranges = text.as_py() or b"", _merged(packed.as_py(), tag)
                if len(ranges):
                    edges = [0, *ranges.reshape(-1).tolist(), len(data)]
                    data = b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                kept.append(data)
                if not as_text:
                    spans.append([{"begin": int(x), "end": int(y)} for x, y in ranges])
            row = b.column("row_")
            if as_text:
                yield pa.RecordBatch.from_arrays([row, pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())], ["row_", "text"])
            else:
                yield pa.RecordBatch.from_arrays([row, pa.array(kept, pa.binary()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))], ["row_", "kept", "spans"])

    return run


def _shards(docs: DataFrame) -> tuple[int, int]:
    """Shuffle tasks and parts, by the size of the input."""
    shares = max(16, math.ceil(stored(docs) / _SHARE))
    return min(shares, _TASKS), shares * _PARTS


def _removed(docs: DataFrame, length: int, parts: int | None, as_text: bool) -> DataFrame:
    tasks, parts = (parts, parts * _PARTS) if parts else _shards(docs.select("doc_id", "text"))
    others = [c for c in docs.columns if c != "text"]
    # tag tells rows that share a doc_id apart
    rows = in_batches(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE)).alias("k"), F.shiftright(F.xxhash64("text"), 32).cast("int").alias("tag"), F.struct(*others).alias("row_"), "text")
    by_part = lambda df: df.repartition(tasks, "part").sortWithinPartitions("part")
    anchors = by_part(rows.select("k", "text").mapInArrow(lean(_hashed(length, parts)), "part int, h binary, k binary, at binary"))
    found = anchors.mapInArrow(lean(_repeated), "k long, packed binary")
    per = found.groupBy("k").agg(F.collect_list("packed").alias("packed"))
    segments = by_part(rows.join(per, "k").mapInArrow(lean(_segments(length, parts)), "part int, k binary, tag binary, at binary, size binary, bytes binary"))
    gone = segments.mapInArrow(lean(_classes(length)), "k long, tag int, packed binary")
    ranges = gone.groupBy("k").agg(F.collect_list(F.struct("tag", "packed")).alias("packed"))
    kind = docs.select(F.struct(*others).alias("row_")).schema["row_"].dataType.simpleString()
    schema = f"row_ {kind}, text string" if as_text else f"row_ {kind}, kept binary, spans array<struct<begin:bigint,end:bigint>>"
    return rows.join(ranges, "k", "left").select("row_", "text", "tag", "packed").mapInArrow(lean(_cut(as_text)), schema)


def without_repeats(docs: DataFrame, length: int = LENGTH, parts: int | None = None) -> DataFrame:
    """(row_, kept, spans): row_ is a struct with all columns of docs but text; kept: the bytes that stay, of the
    text in UTF-8; spans: the maximal runs (begin, end) of bytes that went, in bytes of the input text.

    Bytes go that are covered by a string of `length` bytes (32 or more) that starts also in a document with a smaller
    doc_id, judged on the input. Null and empty texts, and those shorter than `length`, stay as they are. Rows that share a doc_id are
    one document and don't remove from one another. A null doc_id counts as larger than all others. Columns of docs keep whatever names they have, in
    row_. An empty table gives an empty result. One text has to fit in a task's memory about sixty times; a shard's memory goes with `parts`, the
    number of tasks."""
    return _removed(docs, length, parts, False)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with what stays of each text, and n_chars, where docs has it, counted anew. A code point that lost some of its bytes goes whole.
    Null texts come back empty. No row is dropped."""
    found = _removed(docs, length, None, True).select("row_.*", "text")
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["begin"])
    out = without_repeats(docs).select(F.col("row_.doc_id").alias("doc_id"), F.octet_length("kept").cast("long").alias("left"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    return out.select("doc_id", (F.col("left") + F.col("n_removed")).alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")
