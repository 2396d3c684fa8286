"""Words as a tokenizer's splitter sees them, for whole blocks of texts at once.

Code points fall into four classes: white space, letters, numbers and others. Token borders follow from class changes,
the apostrophe endings of English and, for byte-level vocabularies, from a blank that joins the word after it.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np

from gatherline.llm.blocks import span_hashes

WHITE, LETTER, NUMBER, OTHER = range(4)
#: Unicode White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8)
    table[WHITE_SPACE] = WHITE
    return table


def distinct(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different word, and for each word the number of its own: hashes tell words apart, their characters confirm it."""
    _, example, inverse = np.unique(span_hashes(points, starts, ends), return_index=True, return_inverse=True)
    sizes, first = ends - starts, example[inverse]
    same = sizes == sizes[first]
    if same.all():
        inside = np.zeros(len(points) + 1, np.int8)
        inside[starts] += 1
        inside[ends] -= 1
        at = np.flatnonzero(np.cumsum(inside, dtype=np.int8)[:-1]).astype(np.int32)
        there = at + np.repeat((starts[first] - starts).astype(np.int32), sizes)
        same[np.searchsorted(starts, at[points[at] != points[there]], "right") - 1] = False
    if not same.all():  # two words share a hash: compare them as they are
        number: dict[bytes, int] = {}
        inverse = np.array([number.setdefault(points[a:b].tobytes(), len(number)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)
        example = np.unique(inverse, return_index=True)[1]
    return example, inverse


def split(texts: list[str], blank_joins: bool, single_numbers: bool) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different words of all texts, the word at each place, and for each text the place of its first word (one more at the end).

    blank_joins: a blank before a word belongs to it and other white space makes words of its own; else white space
    is left out. single_numbers: each number character is a word.
    """
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    n = len(points)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    if n == 0:
        return [], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    kind = classes()[points]
    first = np.zeros(n + 3, bool)
    first[offsets] = True
    start = first[: n + 1].copy()
    start[1:n] |= kind[1:] != kind[:-1]
    start[n] = True
    if single_numbers:
        start[:n] |= kind == NUMBER
    # An apostrophe alone before s, t, m, d, re, ve or ll takes those letters.
    quote = np.flatnonzero(points == 39)
    if len(quote):
        padded = np.concatenate([points, np.zeros(3, np.uint32)])
        quote = quote[start[quote] & ~first[quote + 1]]
        quote = quote[(quote + 1 < n)]
        if blank_joins:
            quote = quote[first[quote] | (points[np.maximum(quote - 1, 0)] != 32)]
        one, two = padded[quote + 1], padded[quote + 2]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ~first[quote + 2] & (((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l"))))
        taken = np.where(single, 1, np.where(double, 2, 0))
        quote, taken = quote[taken > 0], taken[taken > 0]
        start[quote + 1] = False
        after = quote + 1 + taken
        start[after] = True
    if blank_joins:
        # White space before something else in the same text: its last character stands alone or, a blank, joins.
        follow = np.flatnonzero((kind[:-1] == WHITE) & (kind[1:] != WHITE) & ~first[1:n]) + 1
        start[follow - 1] = True
        start[follow[points[follow - 1] == 32]] = False
    starts = np.flatnonzero(start[:n])
    ends = np.append(starts[1:], n)
    if not blank_joins:
        keep = kind[starts] != WHITE
        starts, ends = starts[keep], ends[keep]
    example, inverse = distinct(points, starts, ends)
    return [joined[starts[i] : ends[i]] for i in example.tolist()], inverse, np.searchsorted(starts, offsets)
