"""Toxicity: a logistic classifier on word presence, regularised by counterfactuals.

Words and beginnings of words that tell the classes apart in a bounded labelled sample, for either class, are features
(abuse is inflected and compounded, so a stem says more than the words seen), and every identity term is one. Training
adds to the loss, for each labelled text that names a group, the squared change of the whole score when the term is
swapped for each other of its set and when it is left out; the changed texts are read as any text is, so the beginnings
of a term count too. A neutral mention then weighs like any other and does not raise the score.

Texts stay in the tasks: words are counted there, and of each labelled text only the numbers of the features it has, and
of those that its changes add or take, go to the driver, at most two bytes a feature for each text and change.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from gatherline.llm.blocks import LOWER, blocks, letter_words, span_hashes
from gatherline.llm.training import adam, fold, sample, sigmoid
from gatherline.plans.scratch import Scratch

#: Labelled documents of each class that training sees at most.
SAMPLE_PER_CLASS = 2500
#: A word is a feature if at least MIN_DOCUMENTS have it and its log-odds, for either class, reach ODDS_LEAST and Z_LEAST
#: standard errors; of each class at most MOST_FEATURES are.
MIN_DOCUMENTS, ODDS_LEAST, Z_LEAST, MOST_FEATURES = 5, 2.5, 3.2, 4096
THRESHOLD = 0.3
#: Bytes of the beginnings that longer words also count by, and how much more a toxic text weighs in training.
STEMS = range(6, 11)
TOXIC_WEIGHT = 2.0
#: The highest bit of a feature's hash tells beginnings from whole words.
STEM = np.uint64(1 << 63)
#: Terms that name groups, in sets whose members may stand for each other; English, Spanish, German, French.
IDENTITY = [
    ["women", "men"],
    ["woman", "man"],
    ["girls", "boys"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino", "arab"],
    ["african", "american", "european", "mexican", "chinese"],
    ["gay", "lesbian", "straight", "bisexual", "transgender"],
    ["immigrants", "refugees", "natives", "citizens"],
    ["disabled", "blind", "deaf"],
    ["old", "young", "elderly"],
    ["mujeres", "hombres"],
    ["mujer", "hombre"],
    ["niñas", "niños"],
    ["musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"],
    ["negros", "blancos", "asiáticos", "latinos", "árabes"],
    ["africanos", "americanos", "europeos", "mexicanos", "chinos"],
    ["gays", "lesbianas", "heterosexuales", "transexuales"],
    ["inmigrantes", "refugiados", "nativos", "ciudadanos"],
    ["discapacitados", "ciegos", "sordos"],
    ["ancianos", "jóvenes"],
    ["frauen", "männer"],
    ["frau", "mann"],
    ["mädchen", "jungen"],
    ["muslime", "christen", "juden", "buddhisten", "atheisten"],
    ["schwarze", "weiße", "asiaten", "araber"],
    ["afrikaner", "amerikaner", "europäer", "mexikaner", "chinesen"],
    ["schwule", "lesben", "heterosexuelle"],
    ["einwanderer", "flüchtlinge", "einheimische", "bürger"],
    ["behinderte", "blinde", "gehörlose"],
    ["alte", "junge"],
    ["femmes", "hommes"],
    ["femme", "homme"],
    ["filles", "garçons"],
    ["musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"],
    ["noirs", "blancs", "asiatiques", "arabes"],
    ["africains", "américains", "européens", "mexicains", "chinois"],
    ["homosexuels", "lesbiennes", "hétérosexuels"],
    ["immigrés", "réfugiés", "citoyens"],
    ["handicapés", "aveugles", "sourds"],
    ["vieux", "jeunes"],
]


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with the capitals of A-Z and of Latin-1 (À to Þ) made small."""
    out = LOWER[data]
    capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[capital] += 32
    return out


def _hash_words(texts: list[str]) -> np.ndarray:
    joined = "\n".join(texts).encode()
    data = np.frombuffer(joined, np.uint8)
    starts, ends, _ = letter_words(data, np.array([0, len(data)]))
    return span_hashes(data, starts, ends) & ~STEM


def presence(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a block and of their beginnings, lower-cased, and each one's document."""
    data = lowered(data)
    starts, ends, firsts = letter_words(data, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    hashes, docs = [span_hashes(data, starts, ends) & ~STEM], [doc]
    for size in STEMS:
        long = ends - starts > size
        hashes.append(span_hashes(data, starts[long], starts[long] + size) | STEM)
        docs.append(doc[long])
    return np.concatenate(hashes), np.concatenate(docs)


def counterfactuals(text: str, identity: list[list[str]]) -> Iterator[str]:
    """The text with each identity term in it swapped for each other of its set, and left out."""
    others = {a.encode(): [b.encode() for b in g if b != a] for g in identity for a in g}
    parts = re.split(rb"([a-z\x80-\xff]+)", lowered(np.frombuffer(text.encode(), np.uint8)).tobytes())
    for term in sorted(others.keys() & set(parts[1::2])):
        for new in (*others[term], b""):
            yield b"".join(new if p == term else p for p in parts).decode(errors="replace")


class Model:
    """Sorted word hashes, their weights, and the bias."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, bias: float):
        self.hashes, self.weights, self.bias = hashes, weights, bias
        self.near = np.zeros(1 << 20, bool)
        self.near[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def found(self, hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, feature) pairs present, each once."""
        if len(self.hashes) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        some = np.flatnonzero(self.near[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[some]
        pairs = np.unique(doc[some][hit] * len(self.hashes) + at[hit])
        return pairs // len(self.hashes), pairs % len(self.hashes)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, feature = self.found(*presence(data, offsets))
        return sigmoid(self.bias + np.bincount(doc, self.weights[feature], len(offsets) - 1))


def tally(texts: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the words and beginnings in the texts, and how many texts of label 1 and of label 0 have each."""
    found = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for low, _, data, offsets in blocks(texts):
        hashes, doc = presence(data, offsets)
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        found[0].append(hashes[new])
        found[1].append(labels[low + doc[new]])
    unique, place = np.unique(np.concatenate(found[0]), return_inverse=True)
    y = np.concatenate(found[1])
    return unique, np.stack([np.bincount(place, y == k, len(unique)) for k in (1, 0)], axis=1).astype(np.int64)


def strength(have: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Log-odds in standard errors for each row of (texts of label 1, of label 0) that have a word, 0 where it is no feature."""
    a, n = have + 0.5, texts - have + 0.5
    odds = np.log(a[:, 0] / n[:, 0]) - np.log(a[:, 1] / n[:, 1])
    z = odds / np.sqrt((1 / a + 1 / n).sum(axis=1))
    return np.where((have.sum(axis=1) >= MIN_DOCUMENTS) & (np.abs(odds) >= ODDS_LEAST) & (np.abs(z) >= Z_LEAST), z, 0.0)


def shape(picked: np.ndarray, identity: list[list[str]]) -> Model:
    """A model without weights: the picked features, and all identity terms."""
    hashes = np.unique(np.concatenate([np.asarray(picked, np.uint64), *(_hash_words(g) for g in identity)]))
    return Model(hashes, np.zeros(len(hashes)), 0.0)


def read(model: Model, texts: list[str], identity: list[list[str]]) -> list[tuple[bytes, list[bytes], list[bytes]]]:
    """Of each text the features it has, and for each of its changes those taken and those added (numbers, two bytes each)."""
    out = []
    for text in texts:
        some = [text, *counterfactuals(text, identity)]
        sets = [np.zeros(0, np.int64)] * len(some)
        for low, high, data, offsets in blocks(pa.array(some, pa.string())):
            doc, feature = model.found(*presence(data, offsets))
            for i, part in enumerate(np.split(feature, np.searchsorted(doc, np.arange(1, high - low)))):
                sets[low + i] = part
        pack = lambda x: x.astype("<u2").tobytes()
        out.append((pack(sets[0]), [pack(np.setdiff1d(sets[0], x)) for x in sets[1:]], [pack(np.setdiff1d(x, sets[0])) for x in sets[1:]]))
    return out


def solve(model: Model, rows: list[tuple[bytes, list[bytes], list[bytes]]], labels: np.ndarray, identity: list[list[str]] = IDENTITY, penalty: float = 4.0) -> Model:
    """The weights that fit the labels of the texts in ``rows`` and keep their changes, and those of bare terms, small."""
    numbers = lambda packed: [np.frombuffer(x, "<u2").astype(np.int64) for x in packed]
    spread = lambda parts: (np.repeat(np.arange(len(parts)), [len(x) for x in parts]), np.concatenate([np.zeros(0, np.int64), *parts]))
    doc, feature = spread(numbers(r[0] for r in rows))
    changes = [*rows, *read(model, [term for g in identity for term in g], identity)]
    taken, added = (spread(numbers(x for r in changes for x in r[k])) for k in (1, 2))
    change, changed = (np.concatenate([taken[k], added[k]]) for k in (0, 1))
    sign = np.concatenate([np.ones(len(taken[0])), -np.ones(len(added[0]))])
    n_changes = sum(len(r[1]) for r in changes)
    balance = np.where(labels == 1, TOXIC_WEIGHT, 1.0)
    balance /= balance.sum()

    def gradient(w: np.ndarray) -> np.ndarray:
        error = (sigmoid(w[-1] + np.bincount(doc, w[feature], len(rows))) - labels) * balance
        g = np.append(np.bincount(feature, error[doc], len(model.hashes)), error.sum())
        g[:-1] += 2e-4 * w[:-1]
        gap = np.bincount(change, sign * w[changed], n_changes)
        g[:-1] += penalty / len(rows) * np.bincount(changed, sign * gap[change], len(model.hashes))
        return g

    weights = adam(gradient, np.zeros(len(model.hashes) + 1), 400, 0.05)
    return Model(model.hashes, weights[:-1], float(weights[-1]))


def constant(labels: np.ndarray) -> Model | None:
    """The model of a sample that lacks a class: every text has that of the other; None where both are there."""
    if len(labels) and len(set(labels.tolist())) == 2:
        return None
    return Model(np.zeros(0, np.uint64), np.zeros(0), -3.0 if len(labels) == 0 or not labels[0] else 3.0)


def train(texts: list[str], labels: np.ndarray, identity: list[list[str]] = IDENTITY, penalty: float = 4.0) -> Model:
    """Learns from texts at hand; labels are 0 or 1. Without both classes the score is that class's for every text."""
    if only := constant(labels):
        return only
    hashes, have = tally(pa.array(texts), labels)
    z = strength(have, np.array([(labels == 1).sum(), (labels == 0).sum()]))
    order = np.lexsort((hashes, -np.abs(z)))
    picked = np.concatenate([hashes[order][s[order]][:MOST_FEATURES] for s in (z > 0, z < 0)])
    model = shape(picked, identity)
    return solve(model, read(model, texts, identity), labels, identity, penalty)


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Learns from at most SAMPLE_PER_CLASS documents a class outside the held-out fold."""
    scratch = Scratch(documents.sparkSession, "toxicity")
    known = scratch.table(sample(documents, labels, "toxic", 4, 2, SAMPLE_PER_CLASS), "sample")
    sizes = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    if only := constant(np.array([*sizes])):
        return only
    texts = np.array([sizes[1], sizes[0]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, have = tally(batch.column(0), batch.column(1).to_numpy())
            yield pa.record_batch([pa.array(hashes.view(np.int64)), pa.array(have[:, 0]), pa.array(have[:, 1])], ["h", "one", "none"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = strength(np.stack([batch.column(1).to_numpy(), batch.column(2).to_numpy()], axis=1), texts)
            some = pa.array(np.flatnonzero(z))
            yield pa.record_batch([batch.column(0).take(some), pa.array(z[z != 0])], ["h", "z"])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                ((has, taken, added),) = read(model, [batch.column(0)[i].as_py()], IDENTITY)
                lists = pa.list_(pa.binary())
                yield pa.record_batch([batch.column(1).slice(i, 1), pa.array([has], pa.binary()), pa.array([taken], lists), pa.array([added], lists)], ["y", "has", "taken", "added"])

    counted = known.mapInArrow(count, "h long, one long, none long").groupBy("h").agg(F.sum("one").alias("one"), F.sum("none").alias("none"))
    judged = counted.mapInArrow(judge, "h long, z double")
    picked = [r.h for side in ("z > 0", "z < 0") for r in judged.where(side).orderBy(F.desc(F.abs("z")), "h").limit(MOST_FEATURES).select("h").collect()]
    model = shape(np.array(picked, np.int64).view(np.uint64), IDENTITY)
    rows = known.mapInArrow(features, "y int, has binary, taken array<binary>, added array<binary>").collect()
    rows = sorted((r.y, bytes(r.has), [*map(bytes, r.taken)], [*map(bytes, r.added)]) for r in rows)
    return solve(model, [r[1:] for r in rows], np.array([r[0] for r in rows], np.int64))


def score(documents: DataFrame, model: Model, column: str = "toxic_score") -> DataFrame:
    """All columns of ``documents`` and ``column`` (double).

    Null and empty texts have no words and score as the bias alone. Rows are kept one for one. A column of
    that name is replaced.
    """
    documents = documents.drop(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            got = [model.score(data, offsets) for _, _, data, offsets in blocks(text)]
            yield batch.append_column(column, pa.array(np.concatenate(got) if got else np.zeros(0)))

    return documents.mapInArrow(run, StructType([*documents.schema.fields, StructField(column, DoubleType())]))


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents``, one for one.

    Null, empty and very long texts are scored as in score(); repeated rows score alike; a null id counts as the empty
    text when the fold is told. A score at the threshold is predicted 1. Other columns are not read. With no labels, or
    labels of one class, every text has one score.
    """
    source = documents.select("doc_id", documents["text"].cast("string").alias("text"))
    return score(source, fit(documents, labels)).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted")
    )
