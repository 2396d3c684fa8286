from __future__ import annotations

import hashlib
import random
import struct
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gatherline.llm import bpe, packing, presplit

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def library(path: str) -> Tokenizer:
    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


def strange_texts(n: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    parts = ["don't", "I'LL", "we've", "''s", "'", " ", "  ", "\n", "\t", "é", "é", "ß", "İ", "ΣΑΣ", "東京", "😀👍", "１２", "²", "3.14", "AKIA", "<|endoftext|>", "<|startoftext|>", "<|", " ", " ", "​", "_", "--", "x" * 30, "\r\n", "'re", "'S", "\u0085", "naïve", "ﬁ", "\x00", "\x1f"]
    words = ["the", "Quick", "brown", "anti", "dis", "establishment", "arianism", "un", "believ", "ably"]
    return ["".join(rng.choice(parts if rng.random() < 0.5 else words) + rng.choice(["", " ", ""]) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(documents):
    return [r.text for r in documents.collect()] + strange_texts(400)


def test_bpe_is_the_librarys(spark, texts, odd):
    made = library(WORD)
    rows = list(enumerate(texts)) + [(len(texts) + i, r.text) for i, r in enumerate(odd.collect())]
    got = {r.doc_id: r for r in bpe.digests(spark.createDataFrame(rows, "doc_id long, text string"), WORD).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        ids = made.encode(t or "", add_special_tokens=False).ids
        said = made.decode(ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(said.encode()).hexdigest()), repr(t)[:200]


def test_bpe_ids_and_text(spark, odd, none):
    out = bpe.encode(odd, WORD)
    assert out.columns == ["doc_id", "ids", "decoded"] and out.count() == odd.count()
    made = library(WORD)
    for r, o in zip(sorted(out.collect(), key=str), sorted(odd.collect(), key=str), strict=True):
        assert r.decoded == made.decode(r.ids, skip_special_tokens=False)
    assert {tuple(r.ids) for r in out.where("doc_id in (1, 2, 3)").collect()} == {()}
    assert bpe.digests(none, WORD).count() == 0


def test_very_long_words(spark):
    """Unbroken runs (encoded data, minified code) in bounded memory, with the library's ids."""
    rng = random.Random(4)
    run = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    rows = [(0, run(1_000_000)), (1, " ".join(run(40_000) for _ in range(20))), (2, "a" * 200_000), (3, "=" * 100_000)]
    code, made = bpe.Codec(WORD), library(WORD)
    bytewise, other = packing.ByteLevel(BYTE), library(BYTE)
    tracemalloc.start()
    for _, text in rows:
        ids = code.encode([text])[0]
        assert ids == struct.pack(f"<{len(ids) // 4}I", *made.encode(text, add_special_tokens=False).ids)
        assert code.decode(ids).decode() == made.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        ids = bytewise.encode([text])[0]
        assert ids == struct.pack(f"<{len(ids) // 4}I", *other.encode(text, add_special_tokens=False).ids)
    code.encode(["after"])
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    print("MB kept and at most", kept / 1e6, peak / 1e6)
    assert peak < 500e6 and kept < 100e6


def test_words_that_share_a_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(presplit, "span_hashes", lambda points, starts, ends: (ends - starts).astype(np.uint64))
    code, made = bpe.Codec(WORD), library(WORD)
    text = "the cat saw the dog and the cow not far from one pig"
    ids = code.encode([text, "", text])
    assert ids[0] == ids[2] == struct.pack(f"<{len(ids[0]) // 4}I", *made.encode(text, add_special_tokens=False).ids) and ids[1] == b""


def checked_packing(rows: list, got: list, whole: bool = True):
    """Every id in one piece, offsets gapless, no sequence over the limit."""
    made = library(BYTE)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert len(pieces) == len(rows)
    for i, t in rows:
        ids = [*made.encode(t or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            part = ids[at : at + r.length]
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(struct.pack(f"<{len(part)}I", *part))), repr(t)[:200]
            at += r.length
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= packing.SEQUENCE
    return len(sequences), sum(r.length for r in got)


def test_packing_places_every_id_once(spark, texts):
    rows = list(enumerate(texts))
    n, tokens = checked_packing(rows, packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), BYTE).collect())
    assert n * packing.SEQUENCE <= 1.03 * tokens + packing.SEQUENCE


def test_packing_of_odd_rows(spark, odd, none):
    rows = [(i, r.text) for i, r in enumerate(odd.collect())]
    checked_packing(rows, packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), BYTE).collect())
    got = packing.pack(odd, BYTE)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.where("doc_id = 6 and start = 0").count() == 2  # a repeated row is packed each time
    assert packing.pack(none, BYTE).count() == 0


def test_packing_repeats_itself(spark, documents):
    a, b = (sorted(packing.pack(documents, BYTE).collect()) for _ in range(2))
    assert a == b


def test_column_generation_meets_demand_near_the_bound():
    rng = np.random.default_rng(2)
    sizes = np.arange(1, 257)
    demand = rng.integers(0, 40, 256) + (1000 * np.exp(-sizes / 20)).astype(int)
    some = demand > 0
    plan = packing.patterns(sizes[some], demand[some], 256)
    made = sum(p * k for p, k in plan)
    assert (made >= demand[some]).all() and all(p @ sizes[some] <= 256 for p, _ in plan)
    bound = sizes @ demand / 256
    assert sum(k for _, k in plan) <= 1.02 * bound + 2
