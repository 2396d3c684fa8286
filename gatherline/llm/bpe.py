"""BPE encoding and decoding by an automaton compiled from the merges.

The automaton reads tokens. It begins as one state in which every base symbol loops, and each merge (a, b) -> c is
built in, in order, as a gadget: the state that arcs labelled ``a`` lead to is replaced by a copy without its arc
``b``, and every state with an arc ``a`` gets an arc ``c`` to where ``b`` led. It then accepts exactly the sequences
that merging in rank order yields. All arcs with one label lead to one state, so a state is named by the label that
enters it. A gadget's state is kept as the difference from the state it copies (the parent, the time of the copy, and
the one arc taken away); a row of the transition table is filled in where a text first needs it.

A word has one accepted path, and so has each prefix of it: encoding keeps, for each prefix, the number of the path's
last label, and extends it by the one vocabulary entry that ends there and that the table lets follow. Decoding emits
the labels of the ids.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gatherline.llm.presplit import split

#: Bytes of words and their ids that a task keeps, prefixes of words that it keeps, of so many symbols at most, and
#: entries of the table; beyond that each starts afresh.
KEPT_BYTES = 64 << 20
KEPT_PREFIXES, PREFIX = 250_000, 24
KEPT_ENTRIES = 1_000_000


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Automaton:
    """Table-driven encoder of single words over the symbols of a BPE vocabulary; labels are their ids."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = ""):
        self.end, self.ids = end, vocab
        self.size = {i: len(t) - (len(end) if end and t.endswith(end) else 0) for t, i in vocab.items()}
        self.born: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.cut: dict[tuple[int, int], int] = {}
        for time, (a, b) in enumerate(merges):
            self._gadget(vocab[a], vocab[b], vocab[a + b], time)
        self.tails = {t[k:] for t in vocab for k in range(len(t))}
        self.follows: dict[tuple[int, int], bool] = {}
        self.prefixes: dict[str, int] = {}

    def _gadget(self, a: int, b: int, made: int, time: int) -> None:
        """Build in the merge: take arc b from the state that a enters, and let their union pass wherever a passes."""
        self.cut[a, b] = time
        self.born.setdefault(made, time)
        self.parts.setdefault(made, (a, b))

    def _arc(self, state: int, label: int, before: float) -> bool:
        """Whether the state entered by ``state`` has an arc ``label`` once the gadgets of times < before are built."""
        while True:
            if self.cut.get((state, label), before) < before:
                return False
            made, copied = self.born.get(label, -1), self.born.get(state, -1)
            if made < 0 and copied < 0:
                return True
            if made > copied:  # the arc came with the gadget of its label: had the state the left part's arc then?
                label, before = self.parts[label][0], made + 1
            elif copied > made:  # the state began as a copy of the state of its right part
                state, before = self.parts[state][1], copied
            else:
                state, label, before = self.parts[state][1], self.parts[label][0], made

    def allowed(self, state: int, label: int) -> bool:
        """The table's entry for a state and a label, filled in where it is first needed."""
        if len(self.follows) > KEPT_ENTRIES:
            self.follows.clear()
        known = self.follows[state, label] = self._arc(state, label, float("inf"))
        return known

    def _step(self, symbols: str, i: int, last: list[int], tail: str) -> int:
        """The last label of the accepted path that spells symbols[:i] (tail ends the word)."""
        ids, tails, follows = self.ids, self.tails, self.follows
        found, j = [], i - 1
        while j >= 0 and (text := symbols[j:i] + tail) in tails:
            if (label := ids.get(text)) is not None:
                found.append((j, label))
            j -= 1
        for j, label in reversed(found):
            if j == 0:
                return label
            known = follows.get((last[j], label))
            if known or (known is None and self.allowed(last[j], label)):
                return label
        raise ValueError(f"the vocabulary cannot spell {symbols[:100]!r}")

    def encode(self, symbols: str) -> list[int]:
        """Labels of the one accepted path over a word's symbols."""
        n, prefixes, step = len(symbols), self.prefixes, self._step
        last = [0] * (n + 1)
        for i in range(1, n):
            if i > PREFIX:
                last[i] = step(symbols, i, last, "")
                continue
            prefix = symbols[:i]
            label = prefixes.get(prefix)
            if label is None:
                label = prefixes[prefix] = step(symbols, i, last, "")
            last[i] = label
        last[n] = step(symbols, n, last, self.end)
        if len(prefixes) > KEPT_PREFIXES:
            prefixes.clear()
        out, i = [], n
        while i > 0:
            label = last[i]
            out.append(label)
            i -= self.size[label]
        return out[::-1]


class Codec:
    """Whole texts to ids and back, for the tokenizer file at ``path``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.label = {i: t.encode() for t, i in (model["vocab"] | self.special).items()}
        self.pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.symbols = "".join(byte_symbols()[b] for b in range(256))
        self.known: dict[str, bytes] = {}
        self.kept = 0

    @staticmethod
    def normal(text: str) -> str:
        """NFC, then each character's lower case (a final sigma is not special)."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return "σ".join(part.lower() for part in text.split("Σ"))

    def _learn(self, word: str) -> bytes:
        path = self.automaton.encode(word.encode().decode("latin-1").translate(self.symbols))
        known = self.known[word] = np.array(path, "<u4").tobytes()
        self.kept += 4 * len(word) + len(known) + 200
        return known

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian 32-bit integers."""
        if self.kept > KEPT_BYTES:
            self.known, self.kept = {}, 0
        pieces: list[str] = []
        layout: list[list[int | bytes]] = []
        for text in texts:
            row: list[int | bytes] = []
            for k, part in enumerate(self.pattern.split(text) if self.pattern and "<|" in text else [text]):
                if k % 2:
                    row.append(np.array([self.special[part]], "<u4").tobytes())
                else:
                    row.append(len(pieces))
                    pieces.append(self.normal(part))
            layout.append(row)
        words, order, firsts = split(pieces, blank_joins=False, single_numbers=True)
        coded = list(map(self.known.get, words))
        for i in [i for i, known in enumerate(coded) if known is None]:
            coded[i] = self._learn(words[i])
        order, first = order.tolist(), firsts.tolist()
        return [b"".join([p if isinstance(p, bytes) else b"".join([coded[i] for i in order[first[p] : first[p + 1]]]) for p in row]) for row in layout]

    def decode(self, ids: bytes) -> bytes:
        """The labels of ids given as little-endian 32-bit integers, joined by blanks (the file names no decoder), in UTF-8."""
        label = self.label
        return b" ".join([label[i] for i in np.frombuffer(ids, "<u4").tolist()])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _text_blocks(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, list[str]]]:
    low, n = 0, len(column)
    lengths = column.fill_null("").cast(pa.large_string())
    sizes = np.diff(np.frombuffer(lengths.buffers()[1], np.int64, n + 1, 8 * lengths.offset)) if n else []
    while low < n:
        high, size = low, 0
        while high < n and (high == low or size + sizes[high] <= limit):
            size += sizes[high]
            high += 1
        yield low, high, lengths.slice(low, high - low).to_pylist()
        low = high


def encode(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids (array of int) and decoded text of every document, by the automaton of the tokenizer file at ``path``.

    Returns id_col, ids, decoded. A null or empty text has no ids and decodes to the empty string. Rows are kept one
    for one, repeated ids included; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in batches:
            for low, high, texts in _text_blocks(batch.column(1)):
                done = code.encode(texts)
                ids = [np.frombuffer(i, "<u4").astype(np.int32) for i in done]
                yield pa.record_batch([batch.column(0).slice(low, high - low), pa.array(ids, pa.list_(pa.int32())), pa.array([code.decode(i).decode() for i in done])], ["i", "ids", "decoded"])

    source = documents.select(documents[id_col].alias("i"), documents[text_col].cast("string").alias("t"))
    kind = dict(source.dtypes)["i"]
    return source.mapInArrow(run, f"i {kind}, ids array<int>, decoded string").withColumnRenamed("i", id_col)


def digests(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the number of ids and the SHA-256 of ids and decoded text, without moving either out of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in batches:
            for low, high, texts in _text_blocks(batch.column(1)):
                done = code.encode(texts)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array([len(i) // 4 for i in done], pa.int64()),
                        pa.array([hashlib.sha256(i).hexdigest() for i in done]),
                        pa.array([hashlib.sha256(code.decode(i)).hexdigest() for i in done]),
                    ],
                    ["i", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    source = documents.select(documents[id_col].alias("i"), documents[text_col].cast("string").alias("t"))
    kind = dict(source.dtypes)["i"]
    return source.mapInArrow(run, f"i {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("i", id_col)
