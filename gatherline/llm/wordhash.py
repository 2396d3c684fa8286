"""64-bit names of words that tell any two words apart.

A word of at most seven bytes is its own name, scrambled by a bijection: two such words never share one. A longer word's
name is a part of its BLAKE2 digest; digests are made once for each different word of a block, and words are told apart
there by their characters. Among n different words that leaves about n * n / 2**65 pairs of equal names.
"""

from __future__ import annotations

import hashlib

import numpy as np

from gatherline.llm.blocks import U64, mix
from gatherline.llm.presplit import distinct

SHORT = 7
#: Bytes of longer words whose names a task keeps; beyond that it starts afresh.
KEPT_BYTES = 32 << 20
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(SHORT + 1)], U64)
_kept: dict[bytes, int] = {}
_size = 0


def _name(word: bytes) -> int:
    global _size
    _size += len(word) + 150
    name = _kept[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return name


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Names of the words data[start:end]."""
    global _kept, _size
    if _size > KEPT_BYTES:
        _kept, _size = {}, 0
    sizes = ends - starts
    out = np.zeros(len(starts), U64)
    short = sizes <= SHORT
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    first = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))[starts[short]].view("<u8").ravel()
    n = sizes[short]
    out[short] = mix(first & _KEEP[n] | n.astype(U64) << U64(8 * SHORT))
    if not short.all():
        a, b = starts[~short], ends[~short]
        example, inverse = distinct(data, a, b)
        text = data.tobytes()
        words = [text[i:j] for i, j in zip(a[example].tolist(), b[example].tolist(), strict=True)]
        names = [_kept.get(w) or _name(w) for w in words]
        out[~short] = np.array(names, U64)[inverse]
    return out
