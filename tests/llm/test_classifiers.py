from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from gatherline.llm import langid, quality, toxicity
from gatherline.llm.blocks import blocks

SF = "/root/testdata/sf0.1"


def area(score, y) -> float:
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    pos = np.asarray(y) == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.mark.parametrize("operator, label, modulus, held", [(quality, "quality", 3, 1), (toxicity, "toxic", 4, 2)])
def test_held_out_accuracy(tables, operator, label, modulus, held):
    docs, labels = tables
    rows = operator.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= (0.5 if label == "quality" else 0.3)) for r in rows)
    out = [(r.score, r[label], r.predicted) for r in rows if r.held_out and r[label] is not None]
    score, y, predicted = map(np.array, zip(*out, strict=True))
    print(label, "area", area(score, y), "accuracy", (predicted == y).mean(), "share", y.mean())
    assert area(score, y) > 0.9
    assert (predicted == y).mean() > max(y.mean(), 1 - y.mean())


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_labels_of_the_held_out_fold_are_not_read(spark, tables, operator):
    docs, labels = tables
    modulus, held = (3, 1) if operator is quality else (4, 2)
    column = "quality" if operator is quality else "toxic"
    some = docs.where("doc_id < 800")
    turned = labels.selectExpr("doc_id", f"CASE WHEN crc32(CAST(doc_id AS string)) % {modulus} = {held} THEN 1 - quality ELSE quality END AS quality", f"CASE WHEN crc32(CAST(doc_id AS string)) % {modulus} = {held} THEN 1 - toxic ELSE toxic END AS toxic")
    one, two = (sorted(operator.classify(some, x).select("doc_id", "score").collect()) for x in (labels, turned))
    assert one == two and column in turned.columns


@pytest.mark.parametrize("operator, added", [(quality, "quality_score"), (toxicity, "toxic_score")])
def test_odd_rows(spark, odd, none, labels, operator, added):
    rows = operator.classify(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    model = operator.fit(odd, labels)
    out = operator.score(odd, model)
    assert set(out.columns) == {*odd.columns, added} and out.count() == odd.count()
    assert operator.classify(none, labels).count() == 0
    assert operator.classify(odd, labels.limit(0)).count() == odd.count()


def test_identity_terms_weigh_alike():
    rng = np.random.default_rng(0)
    plain, bad = ["lunch", "garden", "music", "travel", "market", "school"], ["idiot", "scum", "vermin"]
    texts, y = [], []
    for _ in range(1500):
        words = list(rng.choice(plain, 6))
        toxic = rng.random() < 0.4
        if rng.random() < (0.8 if toxic else 0.1):
            words.append("muslim")  # in toxic texts far more often: the bias that training must not learn
        if toxic:
            words.append(str(rng.choice(bad)))
        texts.append(" ".join(words))
        y.append(int(toxic))
    model = toxicity.train(texts, np.array(y))
    free = toxicity.train(texts, np.array(y), penalty=0.0)
    def score(m, t):
        (_, _, data, offsets), = blocks(pa.array([t]))
        return float(m.score(data, offsets)[0])

    neutral, plain_text = "the muslim family likes music and travel", "the family likes music and travel"
    assert score(model, neutral) < 0.3 and abs(score(model, neutral) - score(model, plain_text)) < 0.1
    assert score(model, neutral) <= score(free, neutral)
    assert score(model, "you are scum and vermin") > 0.5


SWAPS = {"immigrants": "refugees", "christians": "jews", "musulmanes": "cristianos", "flüchtlinge": "einheimische", "réfugiés": "citoyens"}


@pytest.mark.parametrize("term", [*SWAPS])
def test_beginnings_of_identity_terms_do_not_score(term):
    rng = np.random.default_rng(1)
    plain, bad = ["lunch", "garden", "music", "travel", "market", "school"], ["idiot", "scum", "vermin"]
    texts, y = [], []
    for _ in range(1500):
        words, toxic = list(rng.choice(plain, 6)), rng.random() < 0.4
        if rng.random() < (0.8 if toxic else 0.04):
            words.append(term)
        if toxic and rng.random() < 0.7:
            words.append(str(rng.choice(bad)))
        texts.append(" ".join(words))
        y.append(int(toxic))
    model = toxicity.train(texts, np.array(y))
    def score(t):
        (_, _, data, offsets), = blocks(pa.array([t]))
        return float(model.score(data, offsets)[0])

    # The stems of the term are features, for they stand mostly in toxic texts; no swap or mention may count by them.
    named, none = score(f"the {term} like music and travel"), score("the families like music and travel")
    swapped = score("the " + SWAPS[term] + " like music and travel")
    assert abs(named - none) < 0.1 and abs(named - swapped) < 0.1
    assert score("you are scum and vermin") > 0.5


def test_quality_scores_are_means_of_look_ups():
    """A block's scores against a plain sum over the words and n-grams of each text."""
    rng = np.random.default_rng(6)
    table = rng.normal(size=quality.WORD_BUCKETS + quality.GRAM_BUCKETS + 1)
    texts = ["", "a", "ab", "one two two two three", "  blanks   here ", "größe 東京", "x" * 300, "the the"]
    (_, _, data, offsets), = blocks(pa.array(texts), limit=1 << 30)
    got = quality.score_block(table, data, offsets)
    for text, score in zip(texts, got, strict=True):
        raw = text.encode()
        words = raw.split()
        hashes = [int(quality.span_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) for w in words]
        found = [h % (quality.WORD_BUCKETS - 1) for h in hashes] + [quality.WORD_BUCKETS - 1 for a, b in zip(hashes, hashes[1:], strict=False) if a == b]
        for i in range(len(raw) - quality.GRAM + 1):
            part = re.sub(rb"\s", b" ", raw[i : i + quality.GRAM])
            if b" " not in part[1:-1]:
                found.append((int.from_bytes(part, "little") * 2654435761 % 2**32 >> 17) + quality.WORD_BUCKETS)
        want = 1 / (1 + np.exp(-(table[found].sum() / (len(found) + quality.PRIOR) + table[-1])))
        assert score == pytest.approx(want, abs=1e-9), text


def test_capitals_beyond_a_to_z_are_lowered():
    said = "ÁRABES Noël ÇA ×÷ ß Þ 東 MUSULMANES Flüchtlinge"
    assert toxicity.lowered(np.frombuffer(said.encode(), np.uint8)).tobytes().decode() == said.lower()
    assert len(toxicity.lowered(np.zeros(0, np.uint8))) == 0
    changed = [*toxicity.counterfactuals("los ÁRABES y los ASIÁTICOS", [["árabes", "asiáticos", "africanos"]])]
    assert changed == ["los árabes y los árabes", "los árabes y los africanos", "los árabes y los ", "los asiáticos y los asiáticos", "los africanos y los asiáticos", "los  y los asiáticos"]


def test_fit_in_tasks_is_training_at_hand(tables):
    """Words counted and read in tasks give the model that the same texts give at hand."""
    docs, labels = tables
    some = docs.where("doc_id < 2000")
    rows = sorted(toxicity.sample(some, labels, "toxic", 4, 2, toxicity.SAMPLE_PER_CLASS).collect())
    one = toxicity.train([r.t for r in rows], np.array([r.y for r in rows], np.int64))
    two = toxicity.fit(some, labels)
    assert (one.hashes == two.hashes).all() and np.allclose(one.weights, two.weights, atol=1e-6) and abs(one.bias - two.bias) < 1e-6
    held = sorted(quality.sample(some, labels, "quality", 3, 1, quality.SAMPLE_PER_CLASS).collect())
    made = []
    for r in held:
        (_, _, data, offsets), = blocks(pa.array([r.t]), limit=1 << 30)
        (found, times), = quality.shares(data, offsets)
        made.append((r.y, found.astype("<u2").tobytes(), times.astype("<u4").tobytes()))
    made.sort()
    table = quality.train([(np.frombuffer(f, "<u2"), np.frombuffer(t, "<u4")) for _, f, t in made], np.array([y for y, _, _ in made], np.int64))
    assert np.array_equal(table, quality.fit(some, labels))


def test_identity_terms_stand_in_one_set_each():
    terms = [t for g in toxicity.IDENTITY for t in g]
    assert len(terms) == len(set(terms))


def test_training_is_the_minimum_of_its_loss():
    """The weights against the loss written plainly: no step in any direction makes it smaller by much."""
    rng = np.random.default_rng(4)
    plain, bad = ["lunch", "garden", "music", "market"], ["idiot", "vermin"]
    texts, y = [], []
    for _ in range(400):
        words, toxic = list(rng.choice(plain, 4)), rng.random() < 0.4
        if rng.random() < (0.7 if toxic else 0.1):
            words.append("muslims")
        if toxic:
            words.append(str(rng.choice(bad)))
        texts.append(" ".join(words))
        y.append(int(toxic))
    y, penalty = np.array(y), 4.0
    model = toxicity.train(texts, y, penalty=penalty)
    index = {h: i for i, h in enumerate(model.hashes.tolist())}

    def rows(some):
        out = np.zeros((len(some), len(index)))
        (_, _, data, offsets), = blocks(pa.array(some), limit=1 << 30)
        for h, d in zip(*(x.tolist() for x in toxicity.presence(data, offsets)), strict=True):
            if h in index:
                out[d, index[h]] = 1
        return out

    x, pairs = rows(texts), [(t, c) for t in [*texts, *(term for g in toxicity.IDENTITY for term in g)] for c in toxicity.counterfactuals(t, toxicity.IDENTITY)]
    gap = rows([a for a, _ in pairs]) - rows([b for _, b in pairs])
    weight = np.where(y == 1, toxicity.TOXIC_WEIGHT, 1.0)

    def loss(w, b):
        s = x @ w + b
        return (np.logaddexp(0, np.where(y == 1, -s, s)) * weight).sum() / weight.sum() + 1e-4 * (w @ w) + penalty / (2 * len(texts)) * ((gap @ w) ** 2).sum()

    best = loss(model.weights, model.bias)
    (_, _, data, offsets), = blocks(pa.array(texts), limit=1 << 30)
    assert np.allclose(model.score(data, offsets), 1 / (1 + np.exp(-(x @ model.weights + model.bias))))
    for step in (0.05, -0.05):
        for k in range(len(index)):
            moved = model.weights.copy()
            moved[k] += step
            assert loss(moved, model.bias) > best - 1e-3
        assert loss(model.weights, model.bias + step) > best - 1e-3


def test_language_held_out_accuracy(tables):
    docs, _ = tables
    rows = langid.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    known = [r for r in rows if r.held_out and r.lang is not None and any(map(str.isalpha, r.text or ""))]
    right = np.mean([r.lang == r.lang_pred for r in known])
    print("language accuracy", right, "of", len(known))
    assert right > 0.95


def test_language_odd_rows(odd, none):
    rows = {r.doc_id: r for r in langid.identify(odd).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (1, 2, 3))
    assert rows[8].lang_pred in ("en", "de", "fr")
    assert None in rows and rows[5].lang_pred == rows[6].lang_pred
    assert langid.identify(none).count() == 0


def test_every_language_is_learned(spark):
    """More languages than any fixed number: each can be predicted."""
    rng, rows = np.random.default_rng(5), []
    letters = list("abcdefghijklmnopqrstuvwxyzäöüéèñçøåß")
    words = {f"l{g:03}": ["".join(rng.choice(letters, 6)) for _ in range(6)] for g in range(300)}
    for g in words:
        rows += [(len(rows) + k, " ".join(rng.choice(words[g], 30)), g) for k in range(8)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    by = {i: g for i, _, g in rows}
    assert len({r.lang_pred for r in got if by[r.doc_id] == r.lang_pred}) > 290
    assert np.mean([r.lang_pred == by[r.doc_id] for r in got if r.held_out]) > 0.9


def test_language_sample_is_bounded_and_repeats(spark, tables, monkeypatch):
    docs, _ = tables
    monkeypatch.setattr(langid, "SAMPLE_PER_LANGUAGE", 40)
    one, two = (sorted(langid.sample(docs.repartition(n)).collect()) for n in (3, 7))
    assert one == two
    sizes = {g: sum(r["g"] == g for r in one) for g in {r["g"] for r in one}}
    assert set(sizes.values()) == {40}


def test_language_decoding_is_nearest_codeword():
    """Loss-weighted decoding against a plain sum over the bits of every codeword."""
    rng = np.random.default_rng(2)
    x, langs = rng.random((60, langid.BUCKETS)).astype(np.float32), [f"g{i % 6}" for i in range(60)]
    for i, g in enumerate(langs):
        x[i, int(g[1])] += 3
    model = langid.train(x / x.sum(axis=1, keepdims=True), langs)
    data, offsets = np.frombuffer(b"some text here" + b"zzz", np.uint8), np.array([0, 14, 17])
    best, chance, _ = model.predict(data, offsets)
    for i, h in enumerate(langid.histograms(data, offsets)):
        margin = h @ model.weights + model.bias
        loss = [sum(t * np.log1p(np.exp(-m * b)) for t, m, b in zip(model.trust, margin, word, strict=True)) for word in model.code]
        assert best[i] == int(np.argmin(loss)) and chance[i] == pytest.approx(1 / sum(np.exp(min(loss) - v) for v in loss))


def test_codewords_stand_apart():
    for n in (2, 3, 4, 5, 12, 40):
        code = langid.codewords(n)
        gap = min(np.count_nonzero(code[i] != code[j]) for i in range(n) for j in range(i))
        assert code.shape[0] == n and gap >= max(1, code.shape[1] // 4)
