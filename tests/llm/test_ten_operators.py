"""The ten operators on small cases: brute force, round trips, odd rows."""

import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratafold.llm import crossentropy, html, lines, media, mixing, multiset, pieces, queries, simhash, substrings, toxicity
from stratafold.llm.components import components
from stratafold.llm.suffix import prefixes, suffix_array

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size_ int, k string"
WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu") for b in ("ra", "so", "ti", "vu")]


def corpus(n=120, seed=3):
    """Random texts with copies, near copies, shared passages, empty and null texts and a long one."""
    rng = random.Random(seed)
    passage = " ".join(rng.choices(WORDS, k=40))
    texts = []
    for i in range(n):
        text = "\n".join(" ".join(rng.choices(WORDS, k=rng.randint(1, 30))) + "." for _ in range(rng.randint(1, 6)))
        if i % 5 == 1:
            text = texts[-1]
        elif i % 5 == 2:
            text += f" {passage} é漢"
        elif i % 5 == 3 and texts[-1]:
            text = (texts[-1] or "").replace("ka", "kaa", 1)
        texts.append(text)
    texts[7], texts[8], texts[9], texts[10] = "", None, "   \n\t", "A" * 5000
    texts[11], texts[12] = "ab" * 700 + "x" * 300, "x" * 200 + "ba" * 400
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if i % 11 == 0 else f"s{i % 3}", len(t or ""), 1, "x") for i, t in enumerate(corpus())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def odd(spark):
    """Rows that repeat a doc_id, rows without one, and repeated rows."""
    text = "the same text goes here and it has more than fifty bytes in it, which is enough"
    rows = [(1, text, None, None, 1, 0, None), (1, text, None, None, 1, 0, None), (1, "another " + text, None, None, 1, 0, None), (None, text, None, "a", 1, 0, None), (None, None, None, "a", 1, 0, None), (2, text + "!", None, "a", 1, 0, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def linked(keys, near):
    parent = {k: k for k in keys}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if near(a, b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: root(k) for k in keys}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(60, 90)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    nodes = sorted({x for p in pairs for x in p if p[0] != p[1]})
    together = {frozenset(p) for p in pairs}
    assert found == linked(nodes, lambda a, b: frozenset((a, b)) in together)


def test_simhash_links(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << i for i in rng.sample(range(64), k)) for b in base for k in (1, 2, 3)] + [b ^ (1 << 5) ^ (1 << 40) for b in base] + [b ^ 3 << 62 for b in base]
    prints = sorted({x - (1 << 64) if x >> 63 else x for x in base + near})
    found = {tuple(sorted(r)) for r in simhash.links(spark.createDataFrame([(x,) for x in prints], "f long")).collect()}
    assert found == {(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}


def test_simhash(docs, odd, empty):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = {i: simhash.simhash((t or "").encode()) for i, t in enumerate(corpus())}
    assert {i: r.fp for i, r in got.items()} == prints
    want = linked(sorted(prints), lambda a, b: ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count() <= 2)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {r.doc_id for r in simhash.keep_one(docs).collect()} == set(want.values())
    assert simhash.keep_one(docs).columns == docs.columns
    assert len(simhash.near_duplicates(odd).collect()) == 6 and simhash.near_duplicates(empty).count() == 0
    assert simhash.simhash(b"") == simhash.simhash(b" \n") == 0 and simhash.simhash(b"A b") == simhash.simhash(b"a\tB")


def test_toxicity(spark, empty):
    rng = random.Random(4)
    bad = ["zorgix", "zorgiy", "zorgat"]
    rows, labels = [], []
    for i in range(700):
        toxic = i % 4 == 0
        body = rng.choices(WORDS, k=80) + (rng.choices(bad, k=6) if toxic else [])
        rng.shuffle(body)
        rows.append((i, " ".join(body), "en", "s", 1, 0, "x"))
        if i < 650:
            labels.append((i, int(toxic)))
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    found = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    held = [i for i in found if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(found[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.95
    assert 0 <= model.score(None) == model.score("") <= 1
    assert toxicity.scored(empty, model).count() == 0
    assert toxicity.fit(empty, known).score("x") < 0.5
    kept = toxicity.keep_clean(docs, known)
    assert kept.columns == docs.columns and abs(kept.count() - 525) < 25


def test_html():
    page = "<title>no</title><p>a<p>b<b>c</b><br>d<ul><li>x<li>y<ol><li>z</ol></ul><div hidden>no</div><table><tr><th>n<th>v<tr><td>long<td>1</table><pre>  k\n j</pre><script>no</script>&lt;e"
    assert html.render(page) == "a\n\nbc\nd\n\n- x\n- y\n  1. z\n\nn    | v\nlong | 1\n\n  k\n j\n\n<e"
    assert html.render(None) == html.render("") == "" and html.render("<div>" * 50_000 + "deep") == "deep"
    assert html.render("a < b & c</p>") .startswith("a < b & c")


def test_html_visibility():
    cases = {
        "<style>.x, p#y {display: none} @media print {.z {display:none}} /* .q{display:none} */ .v{visibility:hidden}</style><p class='a x'>no</p><p id=y>no</p><div class=z>z</div><i class=q>q</i><p class=v>no<b style='visibility: visible'>yes</b>no</p>": "z\nq\n\nyes",
        "<div style='visibility:hidden'>no<span style='visibility:visible'>in</span></div>out": "in\nout",
        "<details><summary>short</summary>no<p>no</details><details open><summary>s</summary>long</details>": "short\ns\nlong",
        "a<textarea>one\n two</textarea>b": "a\none\n two\nb",
        "pick <select><option>x<option selected>y<option>z</select> now <select multiple><option>k<option>l</select>": "pick y now k l",
        "<select><option>first<option>second</select>": "first",
        "<svg><title>no</title><text>label</text></svg> <math><mi>x</mi><mo>=</mo></math> <object data=a.swf>plain</object>": "label x= plain",
        "<div style='display:none'>no<p style='display:block'>no</p></div>a": "a",
        "<![abc[x]]>after <![if IE]>text<!endif>": "after text",
        "&#" + "9" * 5000 + ";<b>after</b>": "\ufffdafter",
        "<!": "<!",
    }
    for page, text in cases.items():
        assert html.render(page) == text, page


def test_html_tables():
    page = "<table><tr><td rowspan=2>A<td>b<tr><td>c</table>"
    assert html.render(page) == "A | b\n  | c"
    page = "<table><tr><td>a<td rowspan=3>tall<td>b<tr><td>c<td>d<tr><td colspan=9>wide cell<td>e<tr><td>f<td>g<td>h</table>"
    assert html.render(page) == "a         | tall | b\nc         |      | d\nwide cell |      | e\nf         | g    | h"
    assert html.render("<table><tr><td rowspan=9 colspan=2>x y z<td>1<tr><td>2<tr><td>3</table>") == "x y z | 1\n      | 2\n      | 3"
    assert html.render("<table><tr><td>a<td>b<td rowspan=2>c<tr><td>d</table>") == "a | b | c\nd |   |"


def test_html_rows(spark):
    rows = [(1, "u", "<p>a", 5), (1, "u", "<p>a", 5), (None, None, None, 6), (2, "v", "", None), (3, "w", "<![x[" * 3, 1), (4, "x", "<i>" * 30_000 + "z", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    assert sorted(((r.page_id or 0), r.url or "", r.text) for r in html.extracted(pages).collect()) == [(0, "", ""), (1, "u", "a"), (1, "u", "a"), (2, "v", ""), (3, "w", "<![x[" * 3), (4, "x", "z")]
    assert html.extracted(pages.limit(0)).count() == 0


def test_cross_entropy(spark, docs, odd, empty):
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(0, 120, 3)] + [(None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in crossentropy.scored(docs, labels).collect()}
    assert got[8].score is None and got[7].n_words == 0 and got[0].score == pytest.approx(got[0].target_loss - got[0].background_loss)
    assert {i: r.n_words for i, r in got.items()} == {i: len((t or "").encode().split()) for i, t in enumerate(corpus())}
    many = {r.doc_id: r for r in crossentropy.scored(docs, labels, block=500).collect()}  # many blocks and parts
    assert all(many[i].score == (r.score if r.score is None else pytest.approx(r.score, abs=1e-12)) for i, r in got.items())
    found = sorted((r.doc_id or 0, r.n_words) for r in crossentropy.scored(odd, labels).collect())
    assert len(found) == 6 and crossentropy.scored(empty, labels).count() == 0 and crossentropy.scored(docs, labels.limit(0)).count() == len(got)


def test_mixing(spark, docs, odd, empty):
    took = lambda df: mixing.copies(df, mixing.size("text")).select("row_.*", "size", "target", "copies").toPandas()
    rows = docs.select("doc_id", "source", "text")
    got = took(rows)
    texts = corpus()
    assert {r.doc_id: r.words for r in got.rename(columns={"size": "words"}).itertuples()} == {i: len((t or "").split()) for i, t in enumerate(texts)}
    assert got.copies.between(0, 3).all() and got.sort_values("doc_id").copies.tolist() == took(rows.repartition(5)).sort_values("doc_id").copies.tolist()
    for key, g in got.groupby(got.source.fillna("~")):
        assert abs((g["copies"] * g["size"]).sum() - g.target.iloc[0]) <= 0.25 * g.target.iloc[0] + g["size"].max(), key
    assert got.drop_duplicates("source").target.sum() == pytest.approx(sum(len((t or "").split()) for t in texts))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == got["copies"].sum()
    assert took(odd.select("doc_id", "source", "text")).shape[0] == 6 and mixing.mix(empty).count() == 0
    # Columns named like those of the module come back as they were, and ties are taken as often in every run
    named = spark.createDataFrame([(7, "same words here", "s", 777, -1, "k", 5) for _ in range(9)], "doc_id long, text string, source string, size int, copies int, key string, target int")
    assert {tuple(r) for r in mixing.mix(named).collect()} == {(7, "same words here", "s", 777, -1, "k", 5)} and mixing.mix(named).count() == 9


def test_targets_fill(spark):
    rows = [(s, n) for s, n in (("a", 10), ("b", 1000), ("c", 1), ("d", 500), (None, 0))]
    keyed = [("" if s is None else f"={s}", n) for s, n in rows]
    got = {r.key: (r.source_size, r.target) for r in mixing.targets(spark.createDataFrame(keyed, "key string, size long")).collect()}
    left, weights, limit, want = 1511.0, dict(zip("abcd~", (1, 2, 3, 1, 2), strict=True)), {"a": 30, "b": 3000, "c": 3, "d": 1500, "~": 0}, {}
    while True:
        share = {k: left * w / sum(weights.values()) for k, w in weights.items()}
        full = [k for k in weights if share[k] > limit[k]]
        if not full:
            want |= share
            break
        for k in full:
            want[k] = limit[k]
            left -= limit[k]
            del weights[k]
    assert {k.removeprefix("=") or "~": t for k, (_, t) in got.items()} == pytest.approx(want)


def test_lines(docs, odd, empty):
    def units(text):  # character by character
        out, begin = [], 0
        for i, c in enumerate(text):
            after = text[i + 1] if i + 1 < len(text) else "\n"
            if c == "\n":
                begin = i + 1
            elif after == "\n" or (c in ".!?" and after not in ".!?"):
                out.append((begin, i + 1))
                begin = i + 1
        return out

    for least in (1, lines.LEAST):
        seen, want = set(), {}
        for i, t in enumerate(corpus()):
            t, stay, gone = t or "", list(t or ""), []
            for x, y in units(t):
                plain = lines.normalised(t[x:y])
                if plain and len(plain.split(" ")) >= least:
                    if plain in seen:
                        gone.append((x, y))
                        stay[x:y] = [""] * (y - x)
                    seen.add(plain)
            want[i] = ("".join(stay), gone, len(units(t)))
        assert {r.row_.doc_id: (r.kept, [tuple(x) for x in r.gone], r.n_units) for r in lines.without_repeats(docs, least).collect()} == want
        assert any(gone for _, gone, _ in want.values())
    assert lines.without_repeats(odd).count() == 6 and lines.without_repeats(empty).count() == 0


def test_suffix_array():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 50, 700):
        for letters in (1, 2, 5, 256):
            data = rng.integers(0, letters, n).astype(np.uint8)
            raw = data.tobytes()
            order = suffix_array(data)
            assert order.tolist() == sorted(range(n), key=lambda i: raw[i:])
            got = prefixes(data, order).tolist() if n else []
            assert [got[i] for i in order[1:]] == [len(os.path.commonprefix([raw[i:], raw[j:]])) for i, j in zip(order, order[1:], strict=False)]
            assert not n or got[order[0]] == 0


def test_substrings(docs, odd, empty):
    first, want = {}, {}
    for i, t in enumerate(corpus()):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 49):
            if first.setdefault(data[at : at + 50], i) < i:
                gone[at : at + 50] = b"\1" * 50
        want[i] = bytes(x for x, g in zip(data, gone, strict=True) if not g)
    got = {r.row_.doc_id: r for r in substrings.without_repeats(docs).collect()}
    assert {i: bytes(r.kept) for i, r in got.items()} == want
    texts = corpus()
    for i, r in got.items():
        data = (texts[i] or "").encode()
        edges = [0, *(x for s in r.spans for x in s), len(data)]
        assert b"".join(data[edges[j] : edges[j + 1]] for j in range(0, len(edges), 2)) == want[i]
    rows = sorted((r.row_.doc_id or 99, bytes(r.kept)) for r in substrings.without_repeats(odd).collect())
    assert [x for x in rows if x[0] == 1] == sorted((1, t.encode()) for t in (r.text for r in odd.where("doc_id = 1").collect()))
    assert (2, b"!") in rows and (99, b"") in rows and len(rows) == 6
    assert substrings.without_repeats(empty).count() == 0
    assert substrings.remove_repeats(docs).columns == docs.columns


def test_media(docs, odd, empty):
    rng = random.Random(6)
    for n in (1, 6, 7, 50, 6200):
        payload = rng.randbytes(64 * n)
        image = media.Image(media.encode(payload))
        assert image.payload() == payload
        if n <= 50:
            slow = media.Image(media.encode(payload), whole=False)
            assert all((a.coefficients == b.coefficients).all() for a, b in zip(image.parts.values(), slow.parts.values(), strict=True))
            assert (slow.tensor() == image.tensor()).all() and image.tensor().shape == (image.height, image.width, 3)
    found = {r.doc_id: r for r in media.read_back(media.stored(docs)).collect()}
    for i, t in enumerate(corpus()):
        assert bytes(found[i].payload) == media.pad((t or "").encode()) and len(found[i].tensor.rgb) == 3 * found[i].tensor.height * found[i].tensor.width
        rgb = np.frombuffer(found[i].tensor.rgb, np.uint8)
        assert (found[i].height, found[i].width) == (found[i].tensor.height, found[i].tensor.width) and found[i].tensor_sha256 == hashlib.sha256(rgb).hexdigest()
    assert found[1].feature == found[0].feature and media.stored(empty).count() == 0 and media.read_back(media.stored(odd)).count() == 6
    assert media.pad(b"") == bytes(64) and media.pad(b"x" * 64) == b"x" * 64


def by_scans(blocks, side):
    """A progressive JPEG of one component whose coefficients, zeros among them, are sent symbol by symbol in four scans."""
    import struct

    def scan(first, last, high, low, bits):
        return media._segment(0xDA, bytes([1, 1, 0, first, last, high << 4 | low])) + media._packed(np.array(bits, np.uint8))

    def number(x, n):
        return [x >> i & 1 for i in range(n - 1, -1, -1)]

    symbols = list(range(250))
    code = lambda s: number(s, 8)
    signed = lambda v: number(v if v > 0 else v + (1 << abs(v).bit_length()) - 1, abs(v).bit_length())
    dc, last = [], 0
    for b in blocks:
        step, last = (b[0] >> 1) - last, b[0] >> 1
        dc += code(abs(step).bit_length()) + (signed(step) if step else [])
    runs, held, first, more = 0, [], [], []

    def flush(out):
        nonlocal runs, held
        if runs:
            n = runs.bit_length() - 1
            out += code(n << 4) + number(runs - (1 << n), n) + held
        runs, held = 0, []

    for b in blocks:
        r = 0
        for c in b[1:]:
            v = abs(c) >> 1
            if not v:
                r += 1
                continue
            flush(first)
            first += code(0xF0) * (r // 16)
            v = v if c > 0 else -v
            first += code(r % 16 << 4 | abs(v).bit_length()) + signed(v)
            r = 0
        runs += r > 0
    flush(first)
    for b in blocks:
        size = [abs(c) for c in b]
        end = max((k for k in range(1, 64) if size[k] == 1), default=0)
        r, own = 0, []
        for k in range(1, 64):
            if not size[k]:
                r += 1
                continue
            while r > 15 and k <= end:
                flush(more)
                more += code(0xF0) + own
                own, r = [], r - 16
            if size[k] > 1:
                own.append(size[k] & 1)
                continue
            flush(more)
            more += code(r << 4 | 1) + [int(b[k] > 0)] + own
            own, r = [], 0
        if r or own:
            runs += 1
            held += own
    flush(more)
    frame = media._segment(0xC2, struct.pack(">BHHB", 8, side, side, 1) + bytes([1, 0x11, 0]))
    head = b"\xff\xd8" + media._segment(0xDB, bytes([0]) + bytes([1]) * 64) + frame + media._huffman(0, 0, symbols, 8) + media._huffman(1, 0, symbols, 8)
    return head + scan(0, 0, 0, 1, dc) + scan(1, 63, 0, 1, first) + scan(0, 0, 1, 0, [b[0] & 1 for b in blocks]) + scan(1, 63, 1, 0, more) + b"\xff\xd9"


def test_media_reads_runs_of_zeros():
    rng = random.Random(12)
    for often in (0.0, 0.01, 0.1, 0.5, 1.0):
        for _ in range(6):
            blocks = [[rng.randint(-200, 200)] + [rng.choice([-9, -3, -2, -1, 1, 1, 2, 5, 40]) if rng.random() < often else 0 for _ in range(63)] for _ in range(36)]
            for whole in (True, False):
                got = media.Image(by_scans(blocks, 48), whole)
                assert got.parts[1].coefficients.reshape(-1, 64).tolist() == blocks
    assert got.tensor().shape == (48, 48, 3)


def test_pieces(docs, odd, empty):
    texts = ["", "a  b", " lead", "日本語 \U0001f600", "</s> <0x0A>", "▁x▁▁", "tab\tline\n\n", *[t or "" for t in corpus()[:30]]]
    tokenizer, original = pieces.load(pieces.MODEL)
    for t in texts[1:]:
        ids = tokenizer.encode(t, add_special_tokens=False).ids if t else []
        assert ids == original.encode(t) and tokenizer.decode(ids, skip_special_tokens=False) == original.decode(ids)
    ids, back, same = pieces.encoder(pieces.MODEL)(texts)
    whole = pieces._whole(pieces.MODEL)(texts)  # no word by itself
    assert (ids.to_pylist(), back, same) == (whole[0].to_pylist(), whole[1], whole[2]) and all(same)
    assert all(b == t for b, t in zip(back, texts, strict=True) if pieces.SPACE not in t)  # the mark itself comes back as a space
    assert all(tokenizer.normalizer.normalize_str(t) == pieces.SPACE + t.replace(" ", pieces.SPACE) for t in texts if t)
    wrong = pieces._Words(pieces.MODEL)
    wrong.original = type("Other", (), {"encode": lambda self, x, num_threads: [original.encode("other") if w == "lead" else original.encode(w) for w in x], "decode": lambda self, x: original.decode(x), "piece_to_id": lambda self, x: original.piece_to_id(x)})()
    assert wrong.of(["a lead", "a b", "", "lead"])[2] == [False, True, True, False]  # what differs is told
    got = {r.doc_id: r for r in pieces.encoded(docs).collect()}
    assert all(r.same for r in got.values()) and got[8].ids == [] and got[0].decoded == corpus()[0]
    assert pieces.encoded(odd).count() == 6 and pieces.encoded(empty).count() == 0


def test_unigram_spec():
    spec = pieces.Spec(["<unk>", "▁", "a", "b", "▁ab"], [0.0, -2.0, -3.0, -3.0, -1.0], [2, 1, 1, 1, 1])
    assert pieces.build(spec).encode("ab a").tokens == ["▁ab", "▁", "a"]


def test_multiset(spark, docs, odd, empty):
    texts = corpus()
    got = {r.doc_id: r for r in multiset.compared(docs).collect()}
    for i, t in enumerate(texts):
        t, after = t or "", texts[(i - 1) % len(texts)] or ""
        half = len(t) // 2
        assert got[i].n_chars == len(t) and got[i].edited == t[: len(t) - half] + after[:half]
        assert got[i].vec == by_hand(t) and got[i].edited_vec == by_hand(got[i].edited) and got[i].next_vec == by_hand(after)
    v = lambda x: multiset.vector(F.lit(x))
    r = spark.range(1).select((v("a.\nb c.") == v("b c.\na.")).alias("order"), (multiset.put_in(v("a."), F.lit("b c.")) == v("b c.\na.")).alias("put"), (multiset.take_out(v("a.\nb c."), F.lit("b c.")) == v("a.")).alias("take"), multiset.likeness(v("a"), v("a")).alias("same"), multiset.likeness(v("x y. z. q. r"), v("k. l. m. n")).alias("far")).first()
    assert r.order and r.put and r.take and r.same == 1.0 and r.far < 0.5
    one = spark.createDataFrame([(5, "ab")], "doc_id long, text string")
    assert multiset.compared(one).first().edited == "aa" and multiset.compared(empty).count() == 0 and multiset.compared(odd).count() == 6


def by_hand(text):
    exact, like = [0] * 8, [0] * 120
    for p in text.split("\n"):
        for i, seed in enumerate(multiset._SEEDS):
            h = xxhash.xxh64_intdigest(p.encode(), spark_seed(seed))
            exact[2 * i] = (exact[2 * i] + h) % 2**32
            exact[2 * i + 1] = (exact[2 * i + 1] + (h >> 32)) % 2**32
    pieces = [x.strip(" ") for x in re.split(multiset.PIECE, text)]
    pieces = [x for x in pieces if x]
    for p in pieces:
        for j, seed in enumerate(multiset._SEEDS[:2]):
            h = xxhash.xxh64_intdigest(p.encode(), spark_seed(seed))
            for i in range(20):
                for third in range(3):
                    like[(20 * j + i) * 3 + third] += h >> (i + 21 * third) & 1
    return exact + [len(pieces)] + [sum(like[3 * w + third] % 2**20 << 21 * third for third in range(3)) for w in range(40)]


def spark_seed(n):
    """xxhash64 of several columns takes the hash so far as the next one's seed; an int's own hash starts from 42."""
    return xxhash.xxh64_intdigest(n.to_bytes(4, "little"), 42)


def test_multiset_sparse_ids_and_buckets(spark):
    rng = random.Random(9)
    ids = [rng.getrandbits(62) - 2**61 for _ in range(300)] + [None, None, 7, 7]
    texts = {f"t{n}": i for n, i in enumerate(ids)}
    rows = spark.createDataFrame([(i, t) for t, i in texts.items()], "doc_id long, text string").repartition(3)
    order = sorted(texts, key=lambda t: (texts[t] is None, -(texts[t] or 0), t))
    want = {t: order[(n + 1) % len(order)] for n, t in enumerate(order)}
    for size, most in ((4, 4096), (4, 5), (64, 4096), (10_000, 4096)):
        assert {r.text: r.next_text for r in multiset.with_next(rows, size, most).collect()} == want
    assert multiset.with_next(rows.where("doc_id is null")).count() == 2


def test_multiset_likeness(spark):
    """Likeness comes from the written fingerprints and tells what part of their sentences two texts share; lanes wrap without touching their neighbours."""
    rng = random.Random(10)
    rows, truth = [], []
    for n in range(40):
        own = [f"sentence {n} number {i}" for i in range(60)]
        share = rng.randrange(61)
        rows.append((n, ". ".join(own), ". ".join(own[:share] + [f"other {n} at {i}" for i in range(60 - share)])))
        truth.append(share / 60)
    df = spark.createDataFrame(rows, "n int, a string, b string").select("n", multiset.vector(F.col("a")).alias("a"), multiset.vector(F.col("b")).alias("b"))
    got = df.select("n", multiset.likeness(F.col("a"), F.col("b")).alias("whole"), multiset.likeness(multiset.read(multiset.written(F.col("a"))), multiset.read(multiset.written(F.col("b")))).alias("read")).orderBy("n").collect()
    assert all(r.whole == r.read for r in got)
    once = multiset.with_likeness(df, "a", {"whole": "b", "own": "a"}).orderBy("n").collect()
    assert [r.whole for r in once] == [r.whole for r in got] and all(r.own == 1.0 for r in once)
    assert np.mean([abs(r.whole - t) for r, t in zip(got, truth, strict=True)]) < 0.1
    full = F.lit([1] * 8 + [(1 << 21) - 2] + [multiset._MASK] * 40)
    wrapped = spark.range(1).select(multiset.put_in(full, F.lit("a b c")).alias("v"), multiset.take_out(multiset.put_in(full, F.lit("a b c")), F.lit("a b c")).alias("back")).first()
    one = spark.range(1).select(multiset.vector(F.lit("a b c")).alias("v")).first().v
    lanes = lambda v: [x >> 21 * k & multiset._LANE for x in v[9:] for k in range(3)]
    assert lanes(wrapped.v) == [(x + multiset._LANE) % 2**20 for x in lanes(one)] and wrapped.back[9:] == [multiset._MASK] * 40


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_twin(name, spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    ours, theirs = queries.QUERIES[name](spark, sf_dir).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    plain = lambda df: sorted(tuple(str(x) for x in r) for r in df[columns].itertuples(index=False))
    assert plain(ours) == plain(theirs)


def test_queries_and_pipeline(spark, sf_dir):
    import corpus_pipeline

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.QUERIES["op8_progressive_jpeg"](spark, sf_dir).collect():
        payload = media.pad(texts[r.doc_id].encode())
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and {r.same for r in out.select("same").distinct().collect()} <= {True, None}
