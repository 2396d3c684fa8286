from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from gatherline.llm import fim
from tests.llm.conftest import CLASHES


def by_hand(key, text: str | None) -> tuple:
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, d = len(units), hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return key, n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h[3] % 100 < 20
    return key, n, "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def rows_of(df):
    made = df.withColumn("text", fim.restore(df.form, df.output)).collect()
    return sorted((tuple(r)[:6] for r in made), key=str), sorted(((r.doc_id, r.text) for r in made), key=str)


def strange(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    parts = ["word", "Two", " ", "\n", "é", "東", "😀", "<", "<P", "P>", "S>", "<<", ">", "1", "don't", "\x00", "\r\n", "|", "$1", "\\"]
    return ["".join(rng.choices(parts, k=rng.randrange(0, 60))) for _ in range(n)] + ["a", "<P>", "x<S>y", "z<M>", "<p>", "A" * 9_000]


@pytest.mark.parametrize("chunk, stretch", [(1 << 12, 1 << 20), (1, 1), (3, 7), (16, 64)])
def test_cuts_are_those_of_a_plain_scan(spark, odd, monkeypatch, chunk, stretch):
    """Also with chunks of one byte, which fall within characters and words."""
    monkeypatch.setattr(fim, "CHUNK", chunk)
    monkeypatch.setattr(fim, "STRETCH", stretch)
    texts = [r.text for r in odd.collect() if r.text is None or len(r.text) < 60_000] + strange(150, chunk)
    column = fim.pa.array(texts, fim.pa.string())
    for low, high, data, offsets in fim.blocks(column):
        sizes = np.diff(offsets)
        per = -(-sizes // chunk)
        first = np.concatenate([[0], np.cumsum(per)])
        edges = np.append(np.repeat(offsets[:-1], per) + chunk * (np.arange(first[-1]) - np.repeat(first[:-1], per)), offsets[-1])
        units, characters = fim.counts(data, edges, offsets)
        for i in range(low, high):
            c, d = first[i - low], first[i - low + 1]
            assert units[c:d].sum() == len(re.findall(r"[A-Za-z]+|[^A-Za-z]", texts[i] or "")) and characters[c:d].sum() == len(texts[i] or "")


def test_transform_is_the_plain_one(spark, odd, documents, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(r.doc_id, r.text) for r in documents.collect()] + [(1000 + i, t) for i, t in enumerate(strange(300, 5))]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *[f"{v} AS {k}" for k, v in CLASHES.items()])
    made, restored = rows_of(fim.transform(table))
    assert made == sorted((by_hand(*r) for r in rows), key=str)
    assert restored == sorted(((i, t or "") for i, t in rows), key=str)
    assert {r[2] for r in made} == {"plain", "psm", "spm"}
    assert fim.transform(none).count() == 0 and fim.digests(none).count() == 0


def test_very_long_texts(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices(["word ", "é", "x" * 70_000, "\n", "12 "], k=200))) for i in range(6)]
    made, restored = rows_of(fim.transform(spark.createDataFrame(rows, "doc_id long, text string")))
    assert made == sorted((by_hand(*r) for r in rows), key=str) and restored == sorted(rows, key=str)


def test_digests_of_output_and_text(spark, documents):
    got = {r.doc_id: r for r in fim.digests(documents).collect()}
    for r in documents.collect():
        want = by_hand(r.doc_id, r.text)
        assert tuple(got[r.doc_id])[:5] == want[:5]
        assert (got[r.doc_id].output_sha256, got[r.doc_id].restored_sha256) == tuple(hashlib.sha256(x.encode()).hexdigest() for x in (want[5], r.text or ""))
