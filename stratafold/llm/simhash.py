"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into two segments of 32 bits. Where two fingerprints differ in two bits or
fewer, one segment differs in one bit at most: either that segment is equal and the other one differs
in two at most, or it differs in one bit and the other one in one at most. So each fingerprint is
indexed under every one-wildcard variant of both segments, and under both segments as they are. Each
index key also holds a part of the other segment that a pair must share (one of its halves, which one
differing bit leaves, or one of its thirds, which two leave): keys then hold 42 bits or more, so
buckets stay small for far more fingerprints than 32 bits would allow. An equality join on the keys
proposes pairs, in which a wildcard bucket joins only members with that bit clear to members with it
set, and the whole distance decides within the join.

similar_roots serves a similarity of shingle sets, far more bits apart than segments can hold: see there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import cut, in_batches, lean, utf8
from .components import components

#: The longest distance that two segments can serve.
BITS = 2
#: Hashes whose bits are spread out at a time.
_SPREAD = 1 << 13
#: Pairs that are weighed at a time, about.
_PAIRS = 1 << 13
#: For a similarity: 64-bit lanes of a fingerprint, keys of each fingerprint, and bits of a key beyond those that number the texts.
LANES, KEYS, SPARE = 4, 128, 4


def simhash(data: bytes, words: int = 3, seed: int = 42) -> int:
    """The fingerprint of a text in UTF-8: A-Z lower-cased, words parted by ASCII white space, shingles
    of so many words with repeats, XXH64 each; a bit is set where over half of the hashes have it.
    Fewer words make one shingle, no words make 0."""
    parts = data.lower().split()  # bytes: both touch ASCII alone
    if not parts:
        return 0
    return int(_majority(_hashes(parts, words, seed), lambda x: x[:, None], 1).view("<i8")[0])


def _hashes(parts: list[bytes], words: int, seed: int) -> np.ndarray:
    """XXH64 of each shingle of a text's words, as often as it occurs; fewer words make one shingle."""
    n = len(parts) - words + 1
    if n < 1:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), seed)], np.uint64)
    return np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(islice(parts, i, None) for i in range(words)), strict=False)), repeat(seed)), np.uint64, n)


def _majority(hashes: np.ndarray, lanes: Callable[[np.ndarray], np.ndarray], n: int) -> np.ndarray:
    """The bits that over half of the hashes have, as bytes; lanes makes n words of each hash. Some thousands of hashes are spread out at a time."""
    total = np.zeros(64 * n, np.int64)
    for at in range(0, len(hashes), _SPREAD):
        rows = np.ascontiguousarray(lanes(hashes[at : at + _SPREAD]).astype("<u8"))
        total += np.unpackbits(rows.view(np.uint8).reshape(-1, 8 * n), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * total > len(hashes), bitorder="little")


def _tag() -> Column:
    """What tells rows that share a doc_id apart."""
    return F.xxhash64("text").alias("tag")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, tag, fp: long), one row per row of docs. A null text counts as empty; a null doc_id stays; tag is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([simhash(x, words) for x in utf8(b.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tag"), fps], ["doc_id", "tag", "fp"])

    return in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), _tag(), "text").mapInArrow(lean(run), "doc_id long, tag long, fp long")


def _keys(fps: DataFrame, side: int) -> DataFrame:
    """(key, f, plain): side 0 has the wildcard variants whose bit is clear, side 1 those whose bit is set; both
    have the segments as they are. A slot is segment * 35 + s: s < 3 is the plain segment with third s
    of the other one; then come 32 wildcards, each with both halves."""

    def low(c: Column, bits: int) -> Column:
        return c.bitwiseAND((1 << bits) - 1)

    split = fps.select("f", F.explode(F.sequence(F.lit(0), F.lit(1))).alias("seg")).select(
        "f", "seg",
        low(F.when(F.col("seg") == 0, F.col("f")).otherwise(F.shiftrightunsigned("f", 32)), 32).alias("own"),
        low(F.when(F.col("seg") == 0, F.shiftrightunsigned("f", 32)).otherwise(F.col("f")), 32).alias("other"),
    ).select("*", F.explode(F.sequence(F.lit(-3), F.lit(31))).alias("i"))
    plain = F.col("i") < 0
    bit = F.expr("shiftleft(1L, greatest(i, 0))")
    member = plain | ((F.col("own").bitwiseAND(bit) != 0) == F.lit(bool(side)))
    own = F.when(plain, F.col("own")).otherwise(F.col("own").bitwiseAND(F.bitwise_not(bit)))
    third = F.expr("shiftright(other, 11 * (i + 3)) & 2047L")
    halves = F.array(F.expr("other & 65535L"), F.expr("65536L + shiftright(other, 16)"))
    # 7 bits for segment and i, 32 for the segment, 17 for the part of the other one
    parts = split.where(member).select("f", plain.alias("plain"), F.expr("shiftleft(seg * 35L + i + 3L, 49)").alias("head"), F.shiftleft(own, 17).alias("own"), F.explode(F.when(plain, F.array(third)).otherwise(halves)).alias("part"))
    return parts.select((F.col("head") + F.col("own") + F.col("part")).alias("key"), "f", "plain")


def links(fps: DataFrame) -> DataFrame:
    """(u, v): every pair of different fingerprints, of the column f, that differ in BITS bits or fewer.
    A pair can come twice. f holds distinct longs."""
    a, b = _keys(fps, 0), _keys(fps, 1)
    near = F.bit_count(F.col("a.f").bitwiseXOR(F.col("b.f"))) <= BITS
    return a.alias("a").join(b.alias("b"), (F.col("a.key") == F.col("b.key")) & (~F.col("a.plain") | (F.col("a.f") < F.col("b.f"))) & near).select(F.col("a.f").alias("u"), F.col("b.f").alias("v"))


def _parts(data: bytes) -> list[bytes]:
    return data.lower().split()


def _text(parts: list[bytes]) -> int:
    """What texts of the same words share: 64 bits of hash, as a signed number."""
    return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(parts))).view(np.int64))


def _lanes(hashes: np.ndarray) -> np.ndarray:
    """LANES further hashes mixed from each."""
    found = []
    for i in range(LANES):
        x = hashes + np.uint64((0x9E3779B97F4A7C15 * i) & ((1 << 64) - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        found.append(x ^ (x >> np.uint64(31)))
    return np.stack(found, 1)


def long_simhash(parts: list[bytes], words: int, seed: int = 42) -> bytes:
    """The fingerprint of LANES * 64 bits of a text's words."""
    return _majority(_hashes(parts, words, seed), _lanes, LANES).tobytes()


def _set(text: bytes, words: int) -> np.ndarray:
    """A text's distinct shingles, as sorted hashes of 64 bits."""
    return np.unique(_hashes(_parts(text), words, 42))


def similarity_of(a: bytes, b: bytes, words: int) -> float:
    """Jaccard similarity of the sets of two texts' shingles; texts without words are alike."""
    return _similarity(_set(a, words), _set(b, words))


def _similarity(x: np.ndarray, y: np.ndarray) -> float:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared / (len(x) + len(y) - shared)


def _far(similarity: float) -> int:
    """Bits by which fingerprints of texts that similar differ at most, but for one pair in 30,000 (four deviations)."""
    share = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    return int(64 * LANES * share + 4 * np.sqrt(64 * LANES * share * (1 - share))) + 1


@lru_cache(maxsize=4)
def _places(size: int) -> np.ndarray:
    """The bits that each key holds, the same everywhere."""
    rng = np.random.default_rng(42)
    return np.stack([rng.permutation(64 * LANES)[:size] for _ in range(KEYS)])


def long_fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, tag, f: long, fp: binary), one row per row of docs; f is shared by texts of the same words, tag is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known: dict[bytes, tuple[int, bytes]] = {}  # copies are often near each other
            f, fp = [], []
            for text in utf8(b.column("text")):
                if text not in known:
                    parts = _parts(text)
                    known[text] = _text(parts), long_simhash(parts, words)
                f.append(known[text][0])
                fp.append(known[text][1])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tag"), pa.array(f, pa.int64()), pa.array(fp, pa.binary())], ["doc_id", "tag", "f", "fp"])

    return in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), _tag(), "text").mapInArrow(lean(run), "doc_id long, tag long, f long, fp binary")


def _keyed(size: int):
    """(key, f): the KEYS keys of each fingerprint, of `size` bits each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.int64(1) << np.arange(size, dtype=np.int64)
        for b in batches:
            if b.num_rows:
                bits = np.unpackbits(np.frombuffer(b"".join(b.column("fp").to_pylist()), np.uint8).reshape(-1, 8 * LANES), axis=1, bitorder="little")
                keys = np.stack([(bits[:, p] @ weights) + (np.int64(i) << np.int64(size)) for i, p in enumerate(_places(size))], 1)
                yield pa.RecordBatch.from_pydict({"key": keys.reshape(-1), "f": np.repeat(b.column("f").to_numpy(), KEYS)})

    return run


def _texts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(f, text): a text of each f that is asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_text(_parts(x)) for x in utf8(b.column("text"))], pa.int64()), b.column("text")], ["f", "text"])

    return in_batches(docs).select("text").mapInArrow(lean(run), "f long, text string").join(asked, "f", "left_semi").dropDuplicates(["f"])


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (u, v) of nodes (f, fp) whose texts' shingle sets have that similarity or more. Those whose fingerprints are too far apart are
    left without a look at their texts."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = _far(similarity)
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint64) for c in ("a", "b"))
            stay = np.bitwise_count(x ^ y).reshape(-1, LANES).sum(axis=1, dtype=np.int64) <= most
            yield pa.RecordBatch.from_pydict({"u": b.column("u"), "v": b.column("v")}).filter(pa.array(stay))

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stay, last, held = [], None, None
            for x, y in zip(b.column("a").cast(pa.large_binary()), b.column("b").cast(pa.large_binary()), strict=True):
                x, y = x.as_py() or b"", y.as_py() or b""
                if y != last:  # many texts in a row may be held against one
                    last, held = y, _set(y, words)
                stay.append(_similarity(_set(x, words), held) >= similarity)
            yield pa.RecordBatch.from_pydict({"u": b.column("u"), "v": b.column("v")}).filter(pa.array(stay, pa.bool_()))

    side = lambda df, name, held, to: df.select(F.col("f").alias(name), F.col(held).alias(to))
    proposed = cut(pairs.join(side(nodes, "u", "fp", "a"), "u").join(side(nodes, "v", "fp", "b"), "v").select("u", "v", "a", "b").mapInArrow(lean(near), "u long, v long"))
    found = _texts(docs, proposed.select("u").union(proposed.select("v")).distinct().withColumnRenamed("u", "f"))
    return proposed.join(side(found, "u", "text", "a"), "u").join(side(found, "v", "text", "b"), "v").select("u", "v", "a", "b").mapInArrow(lean(alike), "u long, v long")


def similar_roots(docs: DataFrame, nodes: DataFrame, words: int, similarity: float) -> DataFrame:
    """(node, root): components of nodes (f, fp) whose texts' shingle sets have that similarity or more; nodes without a link may lack.

    Each of KEYS keys holds some bits of a fingerprint, enough that unrelated texts seldom share one: SPARE more than number the texts. First each text is
    held against the nearest one, by fingerprint, of lesser f that it shares a key with, which links nearly all members of a large group of near copies by
    one proposal each. Then the shingle sets of texts that share a key, have near fingerprints and are in two components go to that key, where all such
    pairs are held against each other inside the task. No step makes a row for each pair: rows are members of keys, KEYS for each text at most, and links of
    a forest. No link is wrong; a pair can be missed only where all its keys differ or its fingerprints are farther apart than _far."""
    size, most = min(48, nodes.count().bit_length() + SPARE), _far(similarity)
    keys = nodes.select("f", "fp").mapInArrow(lean(_keyed(size)), "key long, f long")
    met = cut(_by_key(keys).mapInArrow(lean(_crowded), "key long, f long"))
    members = met.join(nodes.select("f", "fp"), "f")
    nearest = _by_key(members).mapInArrow(lean(_nearest(most)), "u long, v long, d long").groupBy("u").agg(F.min(F.struct("d", "v")).alias("best"))
    first = cut(components(verified(nearest.select("u", "best.v"), docs, nodes, words, similarity)))
    apart = cut(_by_key(_rooted_by(first, members, "f")).mapInArrow(lean(_apart(size, most)), "key long, f long, f_root long, fp binary"))
    sets = _texts(docs, apart.select("f").distinct()).mapInArrow(lean(_sets(words)), "f long, shingles binary")
    return _joined(first, _by_key(apart.join(sets, "f")).mapInArrow(lean(_linked(size, most, similarity)), "u long, v long"))


def _by_key(df: DataFrame) -> DataFrame:
    return df.repartition("key").sortWithinPartitions("key")


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by key, in tables of whole keys, with the sizes of these."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column("key").to_numpy()
        last = len(keys) - int(np.argmax(keys[::-1] != keys[-1])) if keys[0] != keys[-1] else 0
        if held and keys[0] != held[-1].column("key")[-1].as_py() or last:
            first = b.slice(0, last)
            whole = pa.Table.from_batches([*held, first], b.schema)
            held = []
            if whole.num_rows:
                yield whole, _counts(whole.column("key").to_numpy())
        held.append(b.slice(last))
    if held:
        whole = pa.Table.from_batches(held)
        yield whole, _counts(whole.column("key").to_numpy())


def _counts(keys: np.ndarray) -> np.ndarray:
    return np.diff(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), append=len(keys))


def _crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose key another one has too."""
    for whole, counts in _buckets(batches):
        yield from whole.filter(pa.array(np.repeat(counts > 1, counts))).to_batches()


def _bits(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, LANES)


def _lags(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows (later, earlier) of one key, by how far these are apart, some thousands at a time."""
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    later, held, n = np.arange(len(place)), [], 0
    for lag in range(1, int(counts.max())):
        later = later[place[later] >= lag]
        held.append((later, later - lag))
        n += len(later)
        if n >= _PAIRS:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, n = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _nearest(most: int):
    """(u, v, d): each member of a key with the nearest one before it, if at most so many bits apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, counts in _buckets(batches):
            f, fp = whole.column("f").to_numpy(), _bits(whole.column("fp"))
            order = np.lexsort((f, np.repeat(np.arange(len(counts)), counts)))  # by f within each key
            f, fp = f[order], fp[order]
            least, of = np.full(len(f), most + 1), np.arange(len(f))
            for x, y in _lags(counts):
                d = np.bitwise_count(fp[x] ^ fp[y]).sum(axis=1, dtype=np.int64)
                less = np.flatnonzero(d < least[x])
                less = less[np.argsort(-d[less], kind="stable")]  # of several for one x, the last one stays
                least[x[less]], of[x[less]] = d[less], y[less]
            stay = least <= most
            yield pa.RecordBatch.from_pydict({"u": f[stay], "v": f[of[stay]], "d": least[stay]})

    return run


@lru_cache(maxsize=4)
def _masks(size: int) -> np.ndarray:
    """The bits of each key, as lanes."""
    bits = np.zeros((KEYS, 64 * LANES), np.uint8)
    np.put_along_axis(bits, _places(size), 1, 1)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _due(x: np.ndarray, y: np.ndarray, fp: np.ndarray, root: np.ndarray, key: np.ndarray, size: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs that are in two components, near, and share no key before this one, where they would be held against each other."""
    two = root[x] != root[y]
    x, y = x[two], y[two]
    apart = fp[x] ^ fp[y]
    near = np.bitwise_count(apart).sum(axis=1, dtype=np.int64) <= most
    x, y, apart = x[near], y[near], apart[near]
    first = np.ones(len(x), bool)
    number = key[x] >> np.int64(size)
    for i, mask in enumerate(_masks(size)):
        open_ = np.flatnonzero(first & (number > i))
        if not len(open_):
            break
        first[open_] = (apart[open_] & mask).any(axis=1)
    return x[first], y[first]


def _apart(size: int, most: int):
    """The members of keys that are in a pair of _due."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, counts in _buckets(batches):
            key, root, fp = whole.column("key").to_numpy(), whole.column("f_root").to_numpy(), _bits(whole.column("fp"))
            due = np.zeros(len(key), bool)
            for pair in _lags(counts):
                for side in _due(*pair, fp, root, key, size, most):
                    due[side] = True
            yield from whole.select(["key", "f", "f_root", "fp"]).filter(pa.array(due)).to_batches()

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("f"), pa.array([_set(x, words).tobytes() for x in utf8(b.column("text"))], pa.binary())], ["f", "shingles"])

    return run


def _shared_bits(sets: list[np.ndarray]) -> np.ndarray:
    """A row of bits for each set, one for each element that several have."""
    _, which, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(n > 1) - 1
    row, stay = np.repeat(np.arange(len(sets)), [len(x) for x in sets]), n[which] > 1
    row, column = row[stay], column[which[stay]]
    wide = max(64, -(-int((n > 1).sum()) // 64) * 64)
    out = np.zeros((len(sets), wide // 8), np.uint8)
    np.bitwise_or.at(out, (row, column >> 3), np.left_shift(1, column & 7).astype(np.uint8))
    return out.view(np.uint64)


def _linked(size: int, most: int, similarity: float):
    """(u, v): links of a forest that brings the components of a key's members together, from all of its pairs of _due."""

    def forest(key: np.ndarray, f: np.ndarray, root: np.ndarray, fp: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        bits, sizes, root = _shared_bits(sets), np.array([len(x) for x in sets]), root.copy()
        for pair in _lags(np.array([len(f)])):
            x, y = _due(*pair, fp, root, key, size, most)
            shared = np.zeros(len(x), np.int64)
            for lot in np.array_split(np.arange(len(x)), 1 + len(x) * bits.shape[1] // (1 << 21)):  # 16 MB at a time
                shared[lot] = np.bitwise_count(bits[x[lot]] & bits[y[lot]]).sum(axis=1, dtype=np.int64)
            alike = shared / (sizes[x] + sizes[y] - shared) >= similarity
            x, y = x[alike], y[alike]
            while len(x):
                yield f[x[0]], f[y[0]]
                root[root == root[x[0]]] = root[y[0]]
                two = root[x] != root[y]
                x, y = x[two], y[two]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, counts in _buckets(batches):
            key, f, root, fp = *(whole.column(c).to_numpy() for c in ("key", "f", "f_root")), _bits(whole.column("fp"))
            sets = [np.frombuffer(x, np.uint64) for x in whole.column("shingles").to_pylist()]
            found, at = [], 0
            for n in counts.tolist():
                here = slice(at, at + n)
                found += forest(key[here], f[here], root[here], fp[here], sets[here])
                at += n
            u, v = np.array(found, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_pydict({"u": u, "v": v})

    return run


def _rooted_by(roots: DataFrame, df: DataFrame, name: str) -> DataFrame:
    """df with the root of a node of that name; nodes that lack are their own."""
    known = roots.select(F.col("node").alias(name), F.col("root").alias("root_"))
    return df.join(known, name, "left").withColumn(f"{name}_root", F.coalesce("root_", name)).drop("root_")


def _joined(roots: DataFrame, more: DataFrame) -> DataFrame:
    """roots with the components that more links (u, v) between nodes bring together."""
    links = _rooted_by(roots, _rooted_by(roots, more, "u"), "v")
    tops = components(links.select(F.col("u_root").alias("u"), F.col("v_root").alias("v")))
    over = tops.select(F.col("node").alias("root"), F.col("root").alias("over"))
    return cut(roots.join(over, "root", "left").select("node", F.coalesce("over", "root").alias("root")).unionByName(tops.join(roots, "node", "left_anti")))


def _rooted(fps: DataFrame, distinct: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """fps with root, the same in one component, and component_id, the smallest doc_id in it; distinct: (key, least); roots: (node, root)."""
    rooted = distinct.join(roots.withColumnRenamed("node", key), key, "left").select(key, "least", F.coalesce("root", key).alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(key, "component_id", "root")
    return fps.join(named, key).select("doc_id", key, "component_id", "tag", "root")


def near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp, component_id, tag, root), one row per row of docs. component_id is the smallest doc_id that can be
    reached over links of BITS differing bits or fewer; rows of one component share a root; tag is a hash of the text.

    Rows with equal fingerprints meet once, in an aggregate with a partial sum, before any pair is
    sought, so a large group of copies counts as one fingerprint. Null and empty texts have
    fingerprint 0 and are linked like any other. Rows that repeat a doc_id each get their row. A null doc_id is never a
    component's id unless the component has no other. Texts may be of any length: each is handled alone. Other columns, whatever their names, are
    not read. An empty table gives an empty result."""
    fps = cut(fingerprints(docs, words))
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    return _rooted(fps, distinct, components(links(distinct.select(F.col("fp").alias("f")))), "fp")


def similar(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, f, component_id, tag, root), like near_duplicates, over links between texts whose shingle sets are that similar or more
    (similar_roots); texts of the same words meet first, as one f. Texts without words are one component."""
    fps = cut(long_fingerprints(docs, words))
    distinct = cut(fps.groupBy("f").agg(F.min("doc_id").alias("least"), F.min("fp").alias("fp")))
    return _rooted(fps, distinct.select("f", "least"), similar_roots(docs, distinct, words, similarity), "f")


def keep_one(docs: DataFrame, words: int = 3, similarity: float | None = None) -> DataFrame:
    """docs without the documents that have a near duplicate of a smaller doc_id in their component: one
    doc_id of each component stays, with its columns as they were. Near are texts of BITS differing bits or fewer or, given a similarity, those
    whose shingles are that similar. Rows that share a doc_id are judged each by the component that its own text put it into: a copy of another
    document goes, whatever else has its doc_id. A row without a doc_id stays only where its component has none with one, and there only the
    rows of one text stay."""
    found = near_duplicates(docs, words) if similarity is None else similar(docs, words, similarity)
    found = cut(found.select("doc_id", "tag", "component_id", "root"))
    named = found.where("doc_id = component_id").select("doc_id", "tag").distinct()
    nameless = found.where("component_id is null").groupBy("root").agg(F.min("tag").alias("tag")).select(F.lit(None).cast("long").alias("doc_id"), "tag")
    stay = named.unionByName(nameless).select(F.col("doc_id").alias("_kept"), F.col("tag").alias("_tag"))
    return docs.join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col("_kept")) & (_tag() == F.col("_tag")), "left_semi")


def op1(spark, sf_dir):
    from .base import table

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
