"""SentencePiece encoding and decoding with the tokenizers library.

A SentencePiece model is a protobuf of scored pieces, a normaliser and a trainer specification. The few fields that matter are
parsed here and rebuilt as a tokenizer: the normaliser with the metaspace marker, the unigram or merge model with its scores, byte
fallback and the decoder. A merge model's merges follow from its pieces: whichever two pieces make a third, in the order of its score.
Texts are encoded in batches by the library's own threads, and every text's ids are held against the original processor's.

Where no piece of a merge model goes on past the end of a word, merges in one word have no bearing on another. Texts are then normalised whole, and
their distinct words encoded, decoded and held against the original processor once, as long as a worker remembers them, by rows of words that come apart
again where a piece begins with a space: what a text becomes is what its words become. Other models have whole texts encoded and compared.
"""

from __future__ import annotations

import gc
import re
import struct
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import in_batches, lean, table

#: Where the default model lies, on every machine. A parameter of every function here.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Words that a worker remembers, about; the older half goes, but for what has been met since.
KNOWN = 1 << 18
SPACE = "▁"
#: Kinds of pieces and models (fixed values of the format)
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, MERGES = 1, 2
#: Characters in a batch that the library's threads share, and these.
_BATCH, THREADS = 1 << 19, "1"
#: Words that the original processor decodes at a time.
_ROW = 512


@dataclass
class Spec:
    """What a model file says."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    model: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    fewer_spaces: bool = True
    escape: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: integers, or bytes for everything else."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}[kind] if kind in (1, 5) else varint()
        yield key >> 3, data[at : at + size]
        at += size


def parse(data: bytes) -> Spec:
    spec = Spec()
    for number, value in _fields(data):
        if number == 1:
            held = dict(_fields(value))
            spec.pieces.append(held.get(1, b"").decode())
            spec.scores.append(struct.unpack("<f", held[2])[0] if 2 in held else 0.0)
            spec.kinds.append(held.get(3, NORMAL))
        elif number == 2:
            held = dict(_fields(value))
            spec.model, spec.byte_fallback = held.get(3, UNIGRAM), bool(held.get(35, 0))
        elif number == 3:
            held = dict(_fields(value))
            spec.charsmap = held.get(2, b"")
            spec.dummy_prefix, spec.fewer_spaces, spec.escape = (bool(held.get(n, 1)) for n in (3, 4, 5))
    return spec


def _merges(spec: Spec, ids: dict[str, int]) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, in falling order of its score."""
    found = []
    for piece, score, kind in zip(spec.pieces, spec.scores, spec.kinds, strict=True):
        if kind == NORMAL:
            pairs = [(piece[:i], piece[i:]) for i in range(1, len(piece)) if piece[:i] in ids and piece[i:] in ids]
            found += [(-score, ids[a], ids[b], a, b) for a, b in pairs]
    return [(a, b) for *_, a, b in sorted(found)]


def _by_words(spec: Spec) -> bool:
    """Whether no piece goes on past the end of a word, so that words can be encoded, and remembered, one by one."""
    return not any(SPACE in p.lstrip(SPACE) for p, k in zip(spec.pieces, spec.kinds, strict=True) if k in (NORMAL, USER))


def build(spec: Spec):
    """The tokenizer of a model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    ids = {piece: i for i, piece in enumerate(spec.pieces)}
    unknown = spec.kinds.index(UNKNOWN)
    if spec.model == MERGES:
        plain = {p: i for p, i in ids.items() if spec.kinds[i] == NORMAL}
        model = models.BPE(ids, _merges(spec, plain), unk_token=spec.pieces[unknown], fuse_unk=True, byte_fallback=spec.byte_fallback)
    else:
        model = models.Unigram(list(zip(spec.pieces, spec.scores, strict=True)), unk_id=unknown, byte_fallback=spec.byte_fallback)
    tokenizer = Tokenizer(model)
    steps = [normalizers.Precompiled(spec.charsmap)] if spec.charsmap else []
    if spec.fewer_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE))
    steps.append(normalizers.Replace(" ", SPACE))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if _by_words(spec):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"), "isolated")
    back = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence(back + [decoders.Strip(" ", 1, 0)] * spec.dummy_prefix)
    return tokenizer


@lru_cache(maxsize=2)
def load(path: str):
    """(tokenizer, original processor) of a model file, once for each process."""
    import sentencepiece

    with open(path, "rb") as f:
        data = f.read()
    return build(parse(data)), sentencepiece.SentencePieceProcessor(model_proto=data)


def _plain(spec: Spec) -> bool:
    """Whether words can be handled one by one: a merge model that keeps to them, and a normaliser that only marks spaces."""
    return spec.model == MERGES and _by_words(spec) and spec.dummy_prefix and spec.escape and not spec.fewer_spaces and not spec.charsmap


class _Words:
    """What words become: ids (32 bits each) and, where it isn't the word itself, the text that these decode to; odd: words of which the original processor
    says otherwise."""

    def __init__(self, path: str) -> None:
        self.tokenizer, self.original = load(path)
        self.split = re.compile(f"{SPACE}+[^{SPACE}]*").findall
        self.begins = np.array([self.tokenizer.id_to_token(i).startswith(SPACE) for i in range(self.tokenizer.get_vocab_size())])
        self.ids: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.back: dict[str, str] = {}
        self.odd: set[str] = set()

    def _learn(self, words: list[str]) -> None:
        """Plain words, with one space ahead, go by rows; whatever else, or a row that doesn't come apart again, word by word."""
        plain = [w for w in words if len(w) > 1 and w.rfind(SPACE) == 0 and " " not in w]
        rows = [plain[at : at + _ROW] for at in range(0, len(plain), _ROW)]
        texts = [" ".join([w[1:] for w in row]) for row in rows]
        encoded = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        decoded = self.tokenizer.decode_batch(encoded, skip_special_tokens=False)
        single = []
        for row, text, ids, back in zip(rows, texts, encoded, decoded, strict=True):
            held = np.array(ids, np.int32)
            at = np.flatnonzero(self.begins[held])
            # A piece that begins with a space begins a word; as many spaces as between words, so each word is its own
            if len(at) != len(row) or at[0] or back != text:
                single += row
                continue
            data, edges = held.tobytes(), [*(4 * at).tolist(), 4 * len(held)]
            own = [data[x:y] for x, y in zip(edges, edges[1:], strict=False)]
            self.ids.update(zip(row, own, strict=True))
            others = self.original.encode([w[1:] for w in row], num_threads=1)
            flat = list(chain.from_iterable(others))
            if flat != ids or list(map(len, others)) != (np.diff(at, append=len(held))).tolist():
                self.odd.update(w for w, x, other in zip(row, own, others, strict=True) if x != array("i", other).tobytes())
            if self.original.decode(flat) != text:
                self.odd.update(w for w, other in zip(row, others, strict=True) if self.original.decode(other) != w[1:])
        if len(plain) < len(words):
            known = set(plain)
            single += [w for w in words if w not in known]
        if single:
            self._learn_each(single)

    def _learn_each(self, words: list[str]) -> None:
        bare = [w[1:] for w in words]  # either side puts the first space itself, but not before nothing
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(bare, add_special_tokens=False)]
        others = self.original.encode(bare, num_threads=1)
        if SPACE in words:
            at = words.index(SPACE)
            ids[at], others[at] = [self.tokenizer.token_to_id(SPACE)], [self.original.piece_to_id(SPACE)]
        back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        if ids != others:
            self.odd.update(w for w, own, other in zip(words, ids, others, strict=True) if own != other)
        # Words in a row decode to words with spaces between; only where they don't, one by one
        for at in range(0, len(words), _ROW):
            row = slice(at, at + _ROW)
            if self.original.decode(list(chain.from_iterable(others[row]))) != " ".join(back[row]):
                self.odd.update(w for w, other, text in zip(words[row], others[row], back[row], strict=True) if self.original.decode(other) != text)
        self.ids.update(zip(words, [array("i", x).tobytes() for x in ids], strict=True))
        self.back.update((w, text) for w, text in zip(words, back, strict=True) if text != w[1:])

    def of(self, texts: list[str]) -> tuple[pa.Array, list[str], list[bool]]:
        held = [self.split(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        wanted = set().union(*held)
        new = wanted.difference(self.ids)
        if new and len(self.ids) + len(new) > KNOWN // 2:
            # What has not been met since the last time is forgotten
            self.before, self.ids, new = self.ids, {}, wanted
            self.back = {w: x for w, x in self.back.items() if w in self.before}
            self.odd.intersection_update(self.before)
        if new:
            met = new.intersection(self.before)
            self.ids.update((w, self.before[w]) for w in met)
            self._learn(list(new.difference(met)))
        ids = [b"".join(map(self.ids.__getitem__, words)) for words in held]
        if self.back and not wanted.isdisjoint(self.back):
            back = [" ".join([self.back.get(w, w[1:]) for w in words]) for words in held]
        else:
            back = [t.replace(SPACE, " ") for t in texts]
        same = [not self.odd or self.odd.isdisjoint(words) for words in held]
        offsets = np.zeros(len(ids) + 1, np.int32)
        np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), np.int32))), back, same


def _whole(path: str) -> Callable[[list[str]], tuple[pa.Array, list[str], list[bool]]]:
    """The same for models whose texts must be handled whole."""
    tokenizer, original = load(path)

    def of(texts: list[str]) -> tuple[pa.Array, list[str], list[bool]]:
        ids = [x.ids if t else [] for x, t in zip(tokenizer.encode_batch_fast(texts, add_special_tokens=False), texts, strict=True)]
        back = tokenizer.decode_batch(ids, skip_special_tokens=False)
        same = [original.encode(t, num_threads=1) == own and original.decode(own) == decoded for t, own, decoded in zip(texts, ids, back, strict=True)]
        return pa.array(ids, pa.list_(pa.int32())), back, same

    return of


@lru_cache(maxsize=2)
def _plain_file(path: str) -> bool:
    with open(path, "rb") as f:
        return _plain(parse(f.read()))


def encoder(path: str) -> Callable[[list[str]], tuple[pa.Array, list[str], list[bool]]]:
    """A function of texts that gives their ids, what these decode to, and whether the original processor says the same."""
    return _Words(path).of if _plain_file(path) else _whole(path)


def encoded(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids, decoded, same) per row of docs: the ids of the whole text, the text that they decode to, and whether the
    original processor gives the same ids and text, for every row.

    Null and empty texts give no ids and the empty text. Special tokens' strings in a text are ordinary text. Rows that repeat, or share a doc_id, are
    encoded alike; a null doc_id stays null; other columns, whatever their names, are not read; an empty table gives an empty result. A task holds a
    batch of about half a million characters, or one text, however long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", THREADS)
        of = encoder(model)
        gc.disable()  # many short lists, no cycles
        try:
            for b in batches:
                texts = [x or "" for x in b.column("text").to_pylist()]
                sizes = np.cumsum([len(x) for x in texts])
                edges = [0, *(np.flatnonzero(np.diff(sizes // _BATCH)) + 1).tolist(), len(texts)]
                for first, last in zip(edges, edges[1:], strict=False):
                    ids, back, same = of(texts[first:last])
                    yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id").slice(first, last - first), "ids": ids, "decoded": pa.array(back, pa.string()), "same": pa.array(same, pa.bool_())})
        finally:
            gc.enable()

    return in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run), "doc_id long, ids array<int>, decoded string, same boolean")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encoded(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.length("decoded").cast("long").alias("decoded_chars"), F.sha2("decoded", 256).alias("decoded_sha256"), "same")
