from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from gatherline.llm import lm, minhash, wordhash
from gatherline.llm.blocks import words


def twins(length: int) -> tuple[str, str]:
    """Words without an equal letter at any place that polynomial hashes modulo a power of two confuse."""
    bits = [bin(i).count("1") % 2 for i in range(length)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("length", [64, 1024, 4096, 65_536])
def test_twin_words_stay_apart(spark, length):
    one, other = twins(length)
    table = spark.createDataFrame([(1, one), (2, other), (3, f"x {one} y"), (4, f"x {other} y")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in minhash.group(table, width=2).collect()} == {(i, i) for i in range(1, 5)}
    held = next(i for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2)
    train = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 != 2]
    rows = [(train[0], f"c {one}"), (train[1], "c d"), (held, f"c {other}")]
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[held].n_known, got[held].n_tokens) == (2, 3)  # the first word and the end


def test_names_are_as_different_as_words():
    rng = random.Random(6)
    letters = ["a", "b", "\x00", "\x01", "\x07", "\x08", "é", "東"]
    many = ["".join(rng.choices(letters, k=rng.randrange(1, 14))) for _ in range(20_000)] + list(twins(2048)) + ["a" * k for k in range(1, 300)]
    data = np.frombuffer(" ".join(many).encode(), np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]))
    names = wordhash.word_names(data, starts, ends).tolist()
    assert len(names) == len(many) and len(set(zip(names, many, strict=True))) == len(set(names)) == len(set(many))


def test_names_do_not_depend_on_what_is_kept(monkeypatch):
    data = np.frombuffer(b"extraordinary words are extraordinary and unforgettable", np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]))
    one = wordhash.word_names(data, starts, ends)
    monkeypatch.setattr(wordhash, "KEPT_BYTES", 0)
    assert (one == wordhash.word_names(data, starts, ends)).all() and one[0] == one[3]
    assert len(wordhash.word_names(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0
