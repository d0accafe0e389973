"""What the operators once did in part only: each of these tests failed before."""

import math
import random
from collections import Counter

import pytest

import corpus_pipeline
from stratafold.llm import crossentropy, lines, pieces, simhash, toxicity

SCHEMA = "doc_id long, text string"


def test_cross_entropy_counts_each_bigram(spark):
    """More distinct bigrams than any fixed table has entries for without sharing: scores are those of exact counts."""
    rng = random.Random(7)
    texts = {i: " ".join(f"w{rng.randrange(40_000)}" for _ in range(300)) for i in range(400)} | {400: None, 401: " \n", 402: "W1\tw2\x0bw1 w2", 403: "w1 w2\u00a0x \u00c9 \u00e9"}
    rows = [*texts.items(), (402, texts[402]), (402, "other text"), (None, "w5 w6")]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(404)] + [(0, 0), (None, 1)], "doc_id long, quality int")
    tokens = [(i, (t or "").encode().lower().split()) for i, t in rows]
    models = []
    for held in ([t for i, t in tokens if i is not None and i % 4 == 0], [t for _, t in tokens]):
        words, pairs = Counter(w for t in held for w in t), Counter(p for t in held for p in zip([None, *t], t, strict=False))
        words[None] = sum(map(bool, held))
        models.append((words, pairs, sum(n for w, n in words.items() if w is not None)))
    size, kappa = len({w for _, t in tokens for w in t}), crossentropy.KAPPA

    def loss(model, t):
        words, pairs, total = model
        return sum(-math.log((pairs[p, w] + kappa * (words[w] + 1) / (total + size)) / (words[p] + kappa)) for p, w in zip([None, *t], t, strict=False)) / len(t) if t else math.nan

    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = sorted((i if i is not None else -1, len(t), loss(models[0], t), loss(models[1], t)) for i, t in tokens)
    found = [(r.doc_id if r.doc_id is not None else -1, r.n_words, *(math.nan if x is None else x for x in (r.target_loss, r.background_loss))) for r in crossentropy.scored(docs, labels).collect()]
    assert len(found) == len(want)
    for a, b in zip(sorted(found), want, strict=True):
        assert a == pytest.approx(b, rel=1e-9, nan_ok=True)
    none = crossentropy.scored(docs, labels.where("quality > 1")).where("doc_id = 5").first()
    assert none.target_loss == pytest.approx(math.log(size)) and crossentropy.scored(docs.limit(0), labels).count() == 0


def test_pipeline_drops_texts_of_similar_shingles(spark):
    """Near copies many bits apart go, less similar texts stay, and what goes is decided on the shingles themselves."""
    rng = random.Random(8)
    rows = []
    for i in range(0, 200, 4):
        words = [f"w{rng.randrange(5_000)}" for _ in range(200)]
        # One word that changes takes 5 of 196 shingles: similarities of 0.95, 0.86 and, with twelve words, under 0.6
        rows.append((i, " ".join(words)))
        for j, n in ((1, 1), (2, 3), (3, 12)):
            near = list(words)
            for at in range(n):
                near[10 + 14 * at] = f"new{i}-{j}-{at}"
            rows.append((i + j, " ".join(near)))
    rows += [(200, ""), (201, None), (202, "\n"), (None, rows[0][1].upper()), (203, rows[0][1]), (203, "four words only here")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for i in (0, 100):
        a, *others = (t.encode() for _, t in rows[i : i + 4])
        assert [simhash.similarity_of(a, x, 5) >= 0.8 for x in others] == [True, True, False]
    kept = sorted(r.doc_id if r.doc_id is not None else -1 for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert kept == sorted([i for i in range(200) if i % 4 in (0, 3)] + [200, 203])  # the 203 that is a copy of 0 goes
    assert len(simhash.keep_one(docs).collect()) > len(kept)
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").count() == 0
    nameless = spark.createDataFrame([(1, "a b c d e f"), (None, "a b c d e f"), (None, "g h i j k l"), (None, "G h i j k l"), (2, "m n o p q r")], SCHEMA)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, nameless, "").collect()]
    assert len(kept) == 3 and (1, "a b c d e f") in kept and (2, "m n o p q r") in kept and (None, "a b c d e f") not in kept
    copies = {r.component_id for r in simhash.similar(docs).where("doc_id is null or doc_id = 0").collect()}
    assert copies == {0}


def test_pieces_hold_every_text_against_the_original(spark):
    texts = [f"word {i}" for i in range(40)] + ["", None, "\u1e9b\u0323 \ufdfa \u3000wide\u00a0 space \u200b", "\U0010fffd\ue000 a\u0301\u0327"]
    found = pieces.encoded(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()
    assert len(found) == len(texts) and all(r.same is not None for r in found)
    assert all(r.same for r in found)


def test_lines_drop_short_repeats(spark):
    docs = spark.createDataFrame([(1, "Menu\n\nx\nfirst text"), (2, " menu \n\nX\nx\n \t\nsecond text"), (3, "Reply\nMENU")], SCHEMA)
    found = {r.row_.doc_id: r.kept for r in lines.without_repeats(docs, least=1).collect()}
    assert found == {1: "Menu\n\nx\nfirst text", 2: "\n\n\n\n \t\nsecond text", 3: "Reply\n"}


def test_lines_drop_passages_inside_of_lines(spark):
    passage = "It was the last of the nine long winters here. Nobody could say why the old bridge had been left to fall!"
    docs = spark.createDataFrame([(1, f"One text. {passage} And so on."), (2, f"Quite another text ends; {passage}\nAnd so on."), (3, "And so on. Nothing else.")], SCHEMA)
    found = {r.row_.doc_id: r.kept for r in lines.without_repeats(docs).collect()}
    assert found == {1: f"One text. {passage} And so on.", 2: "Quite another text ends; It was the last of the nine long winters here.\nAnd so on.", 3: "And so on. Nothing else."}


def test_short_toxic_texts_are_toxic(spark):
    rng = random.Random(4)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu") for b in ("ra", "so", "ti", "vu")]
    rows = []
    for i in range(700):
        body = rng.choices(plain, k=80) + (rng.choices(["zorgix", "zorgiy", "zorgat"], k=6) if i % 4 == 0 else [])
        rng.shuffle(body)
        rows.append((i, " ".join(body)))
    bad = ["zorgix", "Zorgix zorgiy", "zorgat zorgix kara", "zorgix, zorgiy zorgat zorgix", " ".join(["zorgix"] * 40)]
    good = ["kara", "kara loso", "miti neso pura", "kara loso miti neso"]
    docs = spark.createDataFrame(rows + list(enumerate(bad + good, 1000)), SCHEMA)
    known = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(650)], "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    assert [model.score(x) >= 0.5 for x in bad + good] == [True] * len(bad) + [False] * len(good)
    kept = {r.text for r in toxicity.keep_clean(docs, known).collect()}
    assert kept.isdisjoint(bad) and kept.issuperset(good)
    text = " ".join(plain)
    offset = lambda x: sum(map(model._word, toxicity.words(x))) / len(x.split()) - model.evidence(x)
    assert offset(text + " zorgix" * 50) == pytest.approx(offset(text))


def test_pipeline_content(spark, sf_dir, tmp_path):
    """Every stage on odd rows and on none, and the whole against its stages: who stays, what is cut, how often the mix takes it, what the ids decode to."""
    import hashlib

    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, row_ string, key string"
    rng = random.Random(11)
    words = [f"{a}{b}{c}" for a in ("ka", "lo", "mi") for b in ("ra", "so", "ti") for c in ("n", "m", "l", "x")]
    passage = " ".join(rng.choices(words, k=30))
    rows = [(i, " ".join(rng.choices(words, k=40)) + (f" {passage}" if i % 9 == 0 else ""), "en", f"s{i % 2}", 1, i, "r", "k") for i in range(60)]
    rows += [(100, rows[3][1], "en", "s1", 1, 0, None, None), (None, "alone and without an id, as it were", None, None, None, None, None, None), (101, None, None, None, None, None, None, None), (102, "", None, "s0", 0, 0, "", "")]
    (tmp_path / "in").mkdir()
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in/documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(str(tmp_path / "in/labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "in/documents.parquet"))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path / "in"))
        assert kept.columns == docs.columns, name
        assert stage(spark, docs.limit(0), str(tmp_path / "in")).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), "").count() == 0
    clean = {r.doc_id: r for r in corpus_pipeline.substring_dedup(spark, corpus_pipeline.near_dedup(spark, docs, ""), "").collect()}
    assert set(clean) == {*range(60), None, 101} and clean[0].text == rows[0][1] and all(len(clean[i].text) < len(rows[i][1]) for i in range(9, 60, 9))
    assert clean[None].text == "alone and without an id, as it were" and clean[101].text == "" and clean[5].size == 5
    out = corpus_pipeline.run(spark, str(tmp_path / "in")).collect()
    assert out and all(r.same for r in out)
    tokenizer, _ = pieces.load(pieces.MODEL)
    for r in out:
        assert hashlib.sha256(tokenizer.decode(r.ids, skip_special_tokens=False).encode()).digest() == hashlib.sha256(clean[r.doc_id].text.encode()).digest()
    assert max(Counter(r.doc_id for r in out).values()) <= 3
    real = corpus_pipeline.run(spark, sf_dir)
    assert real.count() > 100 and real.where("not same").count() == 0


def test_all_pairs_that_share_a_key_are_held_against_each_other(spark, monkeypatch):
    """Three pairs of near copies and one frequent key: two pairs at least have no member that is the key's least or greatest."""
    from stratafold.llm import simhash

    texts = [" ".join(f"{name}{k}" for k in range(60)) + end for name in "abcd" for end in ("", " more")]
    monkeypatch.setattr(simhash, "SPARE", -len(texts).bit_length())  # keys of no bits
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.similar(docs).collect()} == {i: i - i % 2 for i in range(8)}


def test_large_groups_under_the_similarity_make_no_row_for_each_pair(spark, monkeypatch):
    """Texts that all share keys and are near, but of which few are similar enough: proposals stay fewer than texts, and components are those of all pairs."""
    rng, base = random.Random(5), [f"w{k}" for k in range(200)]
    texts = []
    for i in range(40):
        words = list(base)
        for at in rng.sample(range(20), rng.randrange(1, 6)):
            words[10 * at] = f"new{i % 30}-{at}"
        texts.append(" ".join(words))
    texts = list(dict.fromkeys(texts))
    root = list(range(len(texts)))
    for i, x in enumerate(texts):
        for j, y in enumerate(texts[:i]):
            if root[i] != root[j] and simhash.similarity_of(x.encode(), y.encode(), 5) >= 0.8:
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    assert 3 < len(set(root)) < len(texts) - 3
    asked, verified = [], simhash.verified
    monkeypatch.setattr(simhash, "SPARE", -len(texts).bit_length())  # keys of no bits
    monkeypatch.setattr(simhash, "verified", lambda pairs, *others: asked.append(pairs.count()) or verified(pairs, *others))
    found = {r.doc_id: r.component_id for r in simhash.similar(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()}
    assert found == dict(enumerate(root))
    assert max(asked) < len(texts)


def test_plain_words_are_encoded_by_rows(monkeypatch):
    """A row of words is one call, odd ones go word by word, and both say what the original processor says of whole texts, before and after words are forgotten."""
    monkeypatch.setattr(pieces, "KNOWN", 100)
    words, singles = pieces._Words(pieces.MODEL), []
    each = words._learn_each
    monkeypatch.setattr(words, "_learn_each", lambda x: singles.extend(x) or each(x))
    odd = ["a  b   c", "▁x ▁▁ y", " lead", "trail ", "\n\ttab x  ", "\U0001f600 \U0010fffd", "<s> </s> <unk> <0x41>", "", "▁", "  ", "é́ ﷺ", "x" * 300, "a▁b", "nul\x00 \x01"]
    texts = odd + [" ".join(f"word{i * j % 83}" for j in range(30)) for i in range(40)] + odd
    for at in range(0, len(texts), 9):
        ids, back, same = words.of(texts[at : at + 9])
        for text, own, decoded, agrees in zip(texts[at : at + 9], ids.to_pylist(), back, same, strict=True):
            assert agrees and own == words.original.encode(text) and decoded == words.original.decode(own), text
    assert not any(w.startswith("▁word") for w in singles) and len(words.ids) + len(words.before) <= 200
