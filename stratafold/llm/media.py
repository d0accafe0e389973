"""Media columns: progressive JPEG, written and read in numpy.

Bytes are stored as quantised coefficients, the unit that the format keeps without loss: 64 bytes make a block, byte i of it the i-th coefficient
in zigzag order, raised by 256 so that none is zero. Blocks fill the luma component of a 4:2:0 image, then both chroma ones. The image is written
in spectral bands, all bits but the last first (successive approximation), and refined by further scans.

The reader takes any Huffman-coded progressive JPEG of 8 bits: it accumulates all scans into coefficient arrays, transforms them back by a matrix
product, repeats chroma samples to full resolution, and gives an RGB tensor. Scans without a free choice of code (one symbol, or corrections only)
are read as whole arrays; the others symbol by symbol.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import chunks, in_batches, lean, table

BLOCK = 64
#: MCUs in a row of the stored image, at most.
ACROSS = 1024
_CHUNK = 4 << 20
_MARK = b"payload="


def _zigzag() -> np.ndarray:
    """Place (row * 8 + column) of each coefficient in zigzag order."""
    cells = [(r + c, r if (r + c) % 2 else c, r * 8 + c) for r in range(8) for c in range(8)]
    return np.array([at for *_, at in sorted(cells)])


def _transform() -> np.ndarray:
    """64 x 64: coefficients in zigzag order to samples."""
    x, u = np.arange(8)[:, None], np.arange(8)[None, :]
    one = np.cos((2 * x + 1) * u * np.pi / 16) * np.where(u == 0, math.sqrt(0.125), 0.5)
    both = np.einsum("yv,xu->vuyx", one, one).reshape(64, 64)
    return both[_zigzag()].astype(np.float32)


_INVERSE = _transform()

# Writing


def _segment(marker: int, data: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(data) + 2) + data


def _huffman(kind: int, number: int, symbols: list[int], length: int) -> bytes:
    """A table whose codes are all of one length."""
    counts = [0] * 16
    counts[length - 1] = len(symbols)
    return _segment(0xC4, bytes([kind << 4 | number, *counts, *symbols]))


def _packed(bits: np.ndarray) -> bytes:
    spare = -len(bits) % 8
    return np.packbits(np.append(bits, np.ones(spare, np.uint8)) if spare else bits).tobytes().replace(b"\xff", b"\xff\x00")


def _scan(components: list[tuple[int, int, int]], first: int, last: int, high: int, low: int, data: bytes) -> bytes:
    return _segment(0xDA, bytes([len(components), *(x for c, dc, ac in components for x in (c, dc << 4 | ac)), first, last, high << 4 | low])) + data


def _mcu_order(down: int, across: int) -> np.ndarray:
    """Places of luma blocks in the order of interleaved scans, four for each MCU."""
    return np.arange(4 * down * across).reshape(down, 2, across, 2).transpose(0, 2, 1, 3).reshape(-1, 4)


def _difference(d: int) -> str:
    size = abs(d).bit_length()
    return f"{size:04b}" + (f"{d if d > 0 else d + (1 << size) - 1:0{size}b}" if size else "")


_DIFFERENCES = {d: _difference(d) for d in range(-255, 256)}


def pad(data: bytes) -> bytes:
    """data with zeros up to a positive multiple of 64."""
    return data + bytes(-len(data) % BLOCK if data else BLOCK)


def encode(payload: bytes) -> bytes:
    """A progressive JPEG that holds a payload, whose size is a positive multiple of 64."""
    mcus = -(-len(payload) // (6 * BLOCK))
    across = min(mcus, ACROSS)
    down = -(-mcus // across)
    n = down * across
    blocks = np.zeros((6 * n, BLOCK), np.uint8)
    blocks.reshape(-1)[: len(payload)] = np.frombuffer(payload, np.uint8)
    parts = (blocks[: 4 * n], blocks[4 * n : 5 * n], blocks[5 * n :])
    dc = np.concatenate([parts[0][:, 0][_mcu_order(down, across)], parts[1][:, :1], parts[2][:, :1]], axis=1)
    upper = 128 + (dc >> 1).astype(np.int16)
    luma = np.diff(upper[:, :4].reshape(-1), prepend=0).reshape(-1, 4)
    steps = np.concatenate([luma, np.diff(upper[:, 4:], axis=0, prepend=0)], axis=1)
    bits = "".join(map(_DIFFERENCES.__getitem__, steps.reshape(-1).tolist()))
    out = [
        b"\xff\xd8",
        _segment(0xFE, _MARK + b"%d" % len(payload)),
        _segment(0xDB, bytes([0]) + bytes([1]) * 64),
        _segment(0xC2, struct.pack(">BHHB", 8, 16 * down, 16 * across, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])),
        _huffman(0, 0, list(range(9)), 4),  # sizes of differences
        _huffman(1, 0, [0x08], 1),  # a coefficient of eight bits that follows no zero
        _huffman(1, 1, [r << 4 for r in range(15)], 4),  # runs of blocks without new coefficients
        _scan([(1, 0, 0), (2, 0, 0), (3, 0, 0)], 0, 0, 0, 1, _packed(np.frombuffer(bits.encode(), np.uint8) - 48)),
    ]
    for c, part in enumerate(parts, 1):
        for first, last in ((1, 5), (6, 63)) if c == 1 else ((1, 63),):
            value = part[:, first : last + 1].reshape(-1)
            nine = np.zeros((len(value), 9), np.uint8)
            nine[:, 1:] = np.unpackbits(128 | value >> 1).reshape(-1, 8)
            out.append(_scan([(c, 0, 0)], first, last, 0, 1, _packed(nine.reshape(-1))))
    out.append(_scan([(1, 0, 0), (2, 0, 0), (3, 0, 0)], 0, 0, 1, 0, _packed((dc & 1).reshape(-1))))
    for c, part in enumerate(parts, 1):
        rest = []
        for at in range(0, len(part), 32767):
            lot = part[at : at + 32767]
            r = len(lot).bit_length() - 1
            head = f"{r:04b}" + (f"{len(lot) - (1 << r):0{r}b}" if r else "")
            rest += [np.frombuffer(head.encode(), np.uint8) - 48, (lot[:, 1:] & 1).reshape(-1)]
        out.append(_scan([(c, 0, 1)], 1, 63, 1, 0, _packed(np.concatenate(rest))))
    return b"".join([*out, b"\xff\xd9"])


# Reading


@dataclass
class _Component:
    id: int
    h: int
    v: int
    quant: int
    down: int = 0  #: rows of blocks, those that only whole MCUs have among them
    across: int = 0
    own_down: int = 0  #: rows that scans of this component alone have
    own_across: int = 0
    coefficients: np.ndarray = field(default=None, repr=False)  #: (down, across, 64), zigzag order


class _Bits:
    def __init__(self, data: bytes) -> None:
        self.data = data
        self.at = 0

    @cached_property
    def text(self) -> str:
        return bin(int.from_bytes(b"\x01" + self.data, "big"))[3:]

    def get(self, n: int) -> int:
        if not n:
            return 0
        self.at += n
        return int(self.text[self.at - n : self.at] or "1", 2)

    def symbol(self, codes: dict[str, int], lengths: list[int]) -> int:
        for n in lengths:
            found = codes.get(self.text[self.at : self.at + n])
            if found is not None:
                self.at += n
                return found
        raise ValueError("no such Huffman code")

    def signed(self, size: int) -> int:
        value = self.get(size)
        return value if not size or value >> (size - 1) else value - (1 << size) + 1

    def array(self, n: int) -> np.ndarray:
        """The next n bits."""
        first, last = self.at // 8, -(-(self.at + n) // 8)
        out = np.unpackbits(np.frombuffer(self.data[first:last], np.uint8))[self.at - 8 * first :][:n]
        self.at += n
        return out


class Image:
    """Coefficient arrays of a progressive JPEG; whole: take whole-array steps where scans allow it."""

    def __init__(self, data: bytes, whole: bool = True) -> None:
        self.whole, self.comment, self.interval = whole, b"", 0
        self.quants: dict[int, np.ndarray] = {}
        self.tables: dict[int, tuple[dict[str, int], list[int]]] = {}
        self.parts: dict[int, _Component] = {}
        at = 2
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG")
        while at < len(data):
            marker = data[at + 1]
            if marker == 0xD9:
                break
            if marker == 0xFF:
                at += 1
                continue
            (size,) = struct.unpack_from(">H", data, at + 2)
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xDB:
                self._quantisers(body)
            elif marker == 0xC4:
                self._codes(body)
            elif marker == 0xC2:
                self._frame(body)
            elif marker == 0xDD:
                (self.interval,) = struct.unpack(">H", body)
            elif marker == 0xFE:
                self.comment = body
            elif marker == 0xDA:
                end = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]").search(data, at)
                stop = end.start() if end else len(data)
                self._read(body, [x.replace(b"\xff\x00", b"\xff") for x in re.split(rb"\xff[\xd0-\xd7]", data[at:stop])])
                at = stop
            elif 0xC0 <= marker <= 0xCF:
                raise ValueError("only progressive Huffman JPEGs are read")

    def _quantisers(self, body: bytes) -> None:
        while body:
            wide = body[0] >> 4
            size = 128 if wide else 64
            self.quants[body[0] & 15] = np.frombuffer(body[1 : 1 + size], ">u2" if wide else "u1").astype(np.float32)
            body = body[1 + size :]

    def _codes(self, body: bytes) -> None:
        while body:
            codes, code, at = {}, 0, 17
            for length, n in enumerate(body[1:17], 1):
                for _ in range(n):
                    codes[f"{code:0{length}b}"] = body[at]
                    code, at = code + 1, at + 1
                code <<= 1
            self.tables[body[0]] = codes, sorted({len(x) for x in codes})
            body = body[at:]

    def _frame(self, body: bytes) -> None:
        _, self.height, self.width, n = struct.unpack_from(">BHHB", body)
        for i in range(n):
            c, hv, q = body[6 + 3 * i : 9 + 3 * i]
            self.parts[c] = _Component(c, hv >> 4, hv & 15, q)
        self.h, self.v = max(x.h for x in self.parts.values()), max(x.v for x in self.parts.values())
        self.mcus_down, self.mcus_across = -(-self.height // (8 * self.v)), -(-self.width // (8 * self.h))
        for x in self.parts.values():
            x.down, x.across = self.mcus_down * x.v, self.mcus_across * x.h
            x.own_down, x.own_across = -(-(-(-self.height * x.v // self.v)) // 8), -(-(-(-self.width * x.h // self.h)) // 8)
            x.coefficients = np.zeros((x.down, x.across, 64), np.int16)

    def _read(self, body: bytes, segments: list[bytes]) -> None:
        n = body[0]
        parts = [(self.parts[body[1 + 2 * i]], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(n)]
        first, last, (high, low) = body[1 + 2 * n], body[2 + 2 * n], divmod(body[3 + 2 * n], 16)
        flat, groups, tables = [], [], []
        for x, dc, ac in parts:
            flat.append(x.coefficients.reshape(-1, 64))
            at = np.arange(x.down * x.across).reshape(x.down, x.across)
            if n == 1:
                groups.append(at[: x.own_down, : x.own_across].reshape(-1, 1))
            else:
                groups.append(at.reshape(self.mcus_down, x.v, self.mcus_across, x.h).transpose(0, 2, 1, 3).reshape(-1, x.v * x.h))
            tables.append((dc, 16 | ac))
        every = len(groups[0])
        step = self.interval or every
        for i, segment in enumerate(segments):
            lot = [g[i * step : (i + 1) * step] for g in groups]
            if not len(lot[0]):
                break
            bits = _Bits(segment)
            if first == 0:
                self._flat(bits, flat, lot, [self.tables.get(dc) for dc, _ in tables], high, low)
            else:
                read = self._refined if high else self._banded
                read(bits, flat[0], lot[0].reshape(-1), self.tables[tables[0][1]], first, last, low)

    def _flat(self, bits: _Bits, flat: list, lot: list, tables: list, high: int, low: int) -> None:
        """First coefficients, of MCUs."""
        sizes = [g.shape[1] for g in lot]
        if high:
            found = bits.array(len(lot[0]) * sum(sizes)).reshape(len(lot[0]), -1).astype(np.int16) << low
            for c, g in enumerate(lot):
                at = sum(sizes[:c])
                flat[c][g.reshape(-1), 0] |= found[:, at : at + sizes[c]].reshape(-1)
            return
        order = [c for c, k in enumerate(sizes) for _ in range(k)]
        last, out = [0] * len(lot), [[] for _ in lot]
        symbol, signed = bits.symbol, bits.signed
        for _ in range(len(lot[0])):
            for c in order:
                last[c] += signed(symbol(*tables[c]))
                out[c].append(last[c])
        for c, g in enumerate(lot):
            flat[c][g.reshape(-1), 0] = np.array(out[c], np.int16) << low

    def _banded(self, bits: _Bits, flat: np.ndarray, blocks: np.ndarray, table: tuple, first: int, last: int, low: int) -> None:
        """The first scan of a band."""
        codes, lengths = table
        if self.whole and len(codes) == 1 and 0 < next(iter(codes.values())) < 16:
            (code, size), = codes.items()
            wide = len(code) + size
            found = bits.array(len(blocks) * (last - first + 1) * wide).reshape(-1, wide)[:, len(code) :]
            if size <= 8:
                value = (np.packbits(found).reshape(-1) if size == 8 else np.packbits(found, axis=1)[:, 0] >> (8 - size)).astype(np.int16)
            else:
                value = np.zeros(len(found), np.int16)
                for i in range(size):
                    value = value << 1 | found[:, i]
            if not found[:, 0].all():
                value = np.where(found[:, 0] == 1, value, value - np.int16((1 << size) - 1))
            self._put(flat, blocks, first, last, (value << low).reshape(len(blocks), -1))
            return
        run = 0
        for b in blocks.tolist():
            if run:
                run -= 1
                continue
            k = first
            while k <= last:
                r, size = divmod(bits.symbol(codes, lengths), 16)
                if size:
                    k += r
                    flat[b, k] = bits.signed(size) << low
                    k += 1
                elif r == 15:
                    k += 16
                else:
                    run = (1 << r) - 1 + bits.get(r)
                    break

    @staticmethod
    def _put(flat: np.ndarray, blocks: np.ndarray, first: int, last: int, values: np.ndarray) -> None:
        if len(blocks) == len(flat):  # all, in order
            flat[:, first : last + 1] = values
        else:
            flat[blocks, first : last + 1] = values

    def _corrected(self, bits: _Bits, flat: np.ndarray, blocks: np.ndarray, table: tuple, first: int, last: int, plus: int) -> bool:
        """Reads a scan whose coefficients are all known not to be zero: runs of blocks, with corrections. False, with nothing
        read, where there is something else in it."""
        held = flat[:, first : last + 1] if len(blocks) == len(flat) else flat[blocks, first : last + 1]
        if not held.all():
            return False
        found, i = [], 0
        while i < len(blocks):
            head = _Bits(bits.data[bits.at // 8 : bits.at // 8 + 8])  # 16 bits of a code, 14 of a run's length
            head.at = bits.at % 8
            r, size = divmod(head.symbol(*table), 16)
            if size or r == 15:
                bits.at = 0
                return False
            run = min((1 << r) + head.get(r), len(blocks) - i)
            bits.at += head.at - bits.at % 8
            found.append(bits.array(run * (last - first + 1)))
            i += run
        more = np.concatenate(found).reshape(held.shape).view(np.int8) * np.int16(plus)
        self._put(flat, blocks, first, last, held + (more if held.min() > 0 else np.where(held > 0, more, -more)))
        return True

    def _refined(self, bits: _Bits, flat: np.ndarray, blocks: np.ndarray, table: tuple, first: int, last: int, low: int) -> None:
        """A further bit of a band."""
        codes, lengths = table
        plus = 1 << low
        if self.whole and self._corrected(bits, flat, blocks, table, first, last, plus):
            return
        run, i = 0, 0
        while i < len(blocks):
            b = blocks[i]
            k = first
            if not run:
                while k <= last:
                    r, size = divmod(bits.symbol(codes, lengths), 16)
                    new = 0
                    if size:
                        new = plus if bits.get(1) else -plus
                    elif r < 15:
                        run = (1 << r) + bits.get(r)
                        break
                    while k <= last:
                        if flat[b, k]:
                            if bits.get(1):
                                flat[b, k] += plus if flat[b, k] > 0 else -plus
                        elif r:
                            r -= 1
                        else:
                            flat[b, k] = new
                            k += 1
                            break
                        k += 1
            if run:
                for k in range(k, last + 1):
                    if flat[b, k] and bits.get(1):
                        flat[b, k] += plus if flat[b, k] > 0 else -plus
                run -= 1
            i += 1

    def payload(self) -> bytes:
        """The bytes that encode() stored."""
        size = int(self.comment.removeprefix(_MARK))
        return (np.concatenate([x.coefficients.reshape(-1) for x in self.parts.values()])[:size] - 256).astype(np.uint8).tobytes()

    def tensor(self) -> np.ndarray:
        """(height, width, 3) of uint8: RGB, chroma repeated to full resolution."""
        def full(plane: np.ndarray, x: _Component) -> np.ndarray:
            if x.v < self.v:
                plane = plane.repeat(self.v // x.v, axis=0)
            return (plane.repeat(self.h // x.h, axis=1) if x.h < self.h else plane)[: self.height, : self.width]

        planes, parts = [], [*self.parts.values()]
        for x in parts:
            samples = x.coefficients.reshape(-1, 64).astype(np.float32)
            if (self.quants[x.quant] != 1).any():
                samples *= self.quants[x.quant]
            plane = (samples @ _INVERSE).reshape(x.down, x.across, 8, 8).transpose(0, 2, 1, 3).reshape(8 * x.down, 8 * x.across)
            plane += 128
            planes.append(np.clip(plane, 0, 255, out=plane))
        y = full(planes[0], parts[0])
        out = np.empty((self.height, self.width, 3), np.uint8)
        if len(planes) == 1:
            out[:] = np.rint(y)[:, :, None]
            return out
        # Chroma's part of each channel is weighed before it is repeated
        cb, cr = planes[1] - 128, planes[2] - 128
        like = parts[1].h == parts[2].h and parts[1].v == parts[2].v
        green = full(-0.344136 * cb - 0.714136 * cr, parts[1]) if like else -0.344136 * full(cb, parts[1]) - 0.714136 * full(cr, parts[2])
        for i, plane in enumerate((full(1.402 * cr, parts[2]), green, full(1.772 * cb, parts[1]))):
            channel = y + plane
            np.rint(channel, out=channel)
            out[:, :, i] = np.clip(channel, 0, 255, out=channel)
        return out


def feature(tensor: np.ndarray) -> str:
    """Size, and mean and deviation of each channel, from its histogram."""
    value, out = np.arange(256), []
    for i in range(3):
        n = np.bincount(tensor[:, :, i].reshape(-1), minlength=256)
        mean = float(n @ value) / max(1, n.sum())
        out.append(f"{mean:.3f}/{math.sqrt(float(n @ (value - mean) ** 2) / max(1, n.sum())):.3f}")
    return f"{tensor.shape[0]}x{tensor.shape[1]} " + " ".join(out)


def stored(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media) per row of docs: the text's UTF-8, padded and stored as a progressive JPEG. Null and empty texts are 64 zeros. Equal texts give
    equal media. null doc_ids and repeated rows stay as they are; an empty table gives an empty result. One text needs about thirty times its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in chunks(b.column("text"), _CHUNK):
                yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id").slice(first, len(texts)), "n_bytes": pa.array(list(map(len, texts)), pa.int64()), "media": pa.array([encode(pad(x)) for x in texts], pa.binary())})

    return in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(run), "doc_id long, n_bytes long, media binary")


def read_back(media: DataFrame, tensors: bool = True) -> DataFrame:
    """media's rows (doc_id, n_bytes, media) with payload, feature, and the full-resolution picture: its height, width and tensor_sha256 (of the RGB samples by
    rows) and, where asked for, tensor: a struct of height, width and the samples. Equal media give equal rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("height", pa.int32()), ("width", pa.int32()), ("rgb", pa.binary())])
        for b in batches:
            for first, files in chunks(b.column("media"), _CHUNK):
                payloads, features, pictures, shapes, digests = [], [], [], [], []
                for data in files:
                    image = Image(data)
                    tensor = image.tensor()
                    payloads.append(image.payload())
                    features.append(feature(tensor))
                    shapes.append(tensor.shape[:2])
                    digests.append(hashlib.sha256(np.ascontiguousarray(tensor)).hexdigest())
                    pictures.append({"height": image.height, "width": image.width, "rgb": tensor.tobytes()} if tensors else None)
                lot = b.slice(first, len(files))
                height, width = (pa.array([x[i] for x in shapes], pa.int32()) for i in (0, 1))
                names = ["doc_id", "n_bytes", "media", "payload", "feature", "height", "width", "tensor_sha256", "tensor"]
                yield pa.RecordBatch.from_arrays([*lot.columns, pa.array(payloads, pa.binary()), pa.array(features), height, width, pa.array(digests), pa.array(pictures, kind)], names)

    schema = "doc_id long, n_bytes long, media binary, payload binary, feature string, height int, width int, tensor_sha256 string, tensor struct<height:int,width:int,rgb:binary>"
    return in_batches(media).select("doc_id", "n_bytes", "media").mapInArrow(lean(run), schema)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_back(stored(table(spark, sf_dir, "documents").select("doc_id", "text")), tensors=False)
    size = F.octet_length("payload")
    return found.select("doc_id", "n_bytes", size.cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.substring("payload", size - 63, F.lit(64))).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature", "height", "width", "tensor_sha256")
