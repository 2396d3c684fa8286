"""Quality classifier: supervised subword embeddings.

Words and the character n-grams in them are hashed to vectors; a document is the mean of its vectors, and a softmax
over two classes stands on it. Vectors and output weights are learned together by stochastic gradient descent in numpy
on a bounded labelled sample. After training each vector counts only by its product with the output weights, so a text
is scored by one table look-up for each of its words and n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from gatherline.llm.blocks import SPACE, U64, blocks, span_hashes, words
from gatherline.llm.training import fold, sample, sigmoid

#: Labelled documents of each class that training sees at most.
SAMPLE_PER_CLASS = 1500
WORD_BUCKETS = 1 << 15
GRAM_BUCKETS = 1 << 15
GRAM = 3
WIDTH = 8
EPOCHS = 12
RATE = 40.0
#: Neutral features added to each document, so that a few words alone decide little.
PRIOR = 40


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of a block, and each one's document: words, n-grams, and one for every word said twice in a row.

    An n-gram lies in a word; its ends may reach the white space before and after it, which counts as a blank.
    """
    n = len(offsets) - 1
    starts, ends, firsts = words(data, offsets)
    hashes, doc = span_hashes(data, starts, ends), np.repeat(np.arange(n), np.diff(firsts))
    word = (hashes % U64(WORD_BUCKETS - 1)).astype(np.int32)
    # Word bigrams of a word with itself have a bucket of their own, beside the word's.
    again = doc[1:][(hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])]
    found, owner = [word, np.full(len(again), WORD_BUCKETS - 1, np.int32)], [doc, again]
    if len(data) >= GRAM:
        blank = SPACE[data]
        wide = np.where(blank, np.uint32(32), data)
        m = len(data) - GRAM + 1
        gram, inside = wide[:m].copy(), np.ones(m, bool)
        for k in range(1, GRAM):
            gram |= wide[k : m + k] << np.uint32(8 * k)
            inside &= ~blank[k : m + k] if k < GRAM - 1 else True
        of = np.repeat(np.arange(n), np.diff(offsets))
        inside &= of[:m] == of[GRAM - 1 :]
        found.append(((gram[inside] * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int32) + WORD_BUCKETS)
        owner.append(of[:m][inside])
    return np.concatenate(found), np.concatenate(owner)


def shares(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each document of a block its buckets, each once, and how often each was found."""
    found, owner = features(data, offsets)
    keys, times = np.unique(owner * (WORD_BUCKETS + GRAM_BUCKETS) + found, return_counts=True)
    cut = np.searchsorted(keys // (WORD_BUCKETS + GRAM_BUCKETS), np.arange(len(offsets)))
    return [(keys[a:b] % (WORD_BUCKETS + GRAM_BUCKETS), times[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def train(documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> np.ndarray:
    """One number for each bucket (its share of the log-odds) and, last, the bias. documents: as shares() has them."""
    size = WORD_BUCKETS + GRAM_BUCKETS
    table = np.zeros(size + 1, np.float32)
    if len(documents) == 0 or len(set(labels.tolist())) < 2:
        table[-1] = 0 if len(labels) == 0 else (3.0 if labels[0] else -3.0)
        return table
    rows = [(found.astype(np.int64), (times / (times.sum() + PRIOR)).astype(np.float32)) for found, times in documents]
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1 / WIDTH, (size, WIDTH)).astype(np.float32)
    output, bias = rng.normal(0, 0.5, (WIDTH, 2)).astype(np.float32), np.zeros(2, np.float32)
    share = np.array([(labels == 0).mean(), (labels == 1).mean()])
    balance = 0.5 / np.maximum(share, 1e-3)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(rows)):
            found, part = rows[i]
            if len(found) == 0:
                continue
            mean = part @ vectors[found]
            score = mean @ output + bias
            chance = np.exp(score - score.max())
            chance /= chance.sum()
            chance[labels[i]] -= 1
            error = chance * np.float32(balance[labels[i]])
            back = output @ error
            output -= np.float32(rate * 0.002) * np.outer(mean, error)
            bias -= np.float32(rate * 0.0005) * error
            vectors[found] -= np.float32(rate) * part[:, None] * back
    table[:-1] = vectors @ (output[:, 1] - output[:, 0])
    table[-1] = bias[1] - bias[0]
    return table


def score_block(table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of class 1 for each document of a block."""
    found, owner = features(data, offsets)
    n = len(offsets) - 1
    return sigmoid(np.bincount(owner, table[found], n) / (np.bincount(owner, minlength=n) + PRIOR) + table[-1])


def fit(documents: DataFrame, labels: DataFrame) -> np.ndarray:
    """Learns from at most SAMPLE_PER_CLASS documents a class outside the held-out fold.

    Texts stay in the tasks; of each its buckets and their numbers go to the driver, six bytes for each of at most
    WORD_BUCKETS + GRAM_BUCKETS.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in blocks(batch.column(0)):
                found, times = zip(*shares(data, offsets), strict=True)
                yield pa.record_batch([batch.column(1).slice(low, high - low), pa.array([f.astype("<u2").tobytes() for f in found], pa.binary()), pa.array([t.astype("<u4").tobytes() for t in times], pa.binary())], ["y", "found", "times"])

    rows = sample(documents, labels, "quality", 3, 1, SAMPLE_PER_CLASS).mapInArrow(run, "y int, found binary, times binary").collect()
    rows = sorted((r.y, bytes(r.found), bytes(r.times)) for r in rows)
    return train([(np.frombuffer(f, "<u2"), np.frombuffer(t, "<u4")) for _, f, t in rows], np.array([y for y, _, _ in rows], np.int64))


def score(documents: DataFrame, table: np.ndarray, column: str = "quality_score") -> DataFrame:
    """All columns of ``documents`` and ``column`` (double).

    Null, empty and blank texts have no features and score as the bias alone. Rows are kept one for one. A column
    of that name is replaced.
    """
    documents = documents.drop(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            got = [score_block(table, data, offsets) for _, _, data, offsets in blocks(text)]
            yield batch.append_column(column, pa.array(np.concatenate(got) if got else np.zeros(0)))

    return documents.mapInArrow(run, StructType([*documents.schema.fields, StructField(column, DoubleType())]))


def classify(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents``, one for one.

    Null, empty and very long texts are scored as in score(); repeated rows score alike; a null id counts as the empty
    text when the fold is told. A score at the threshold is predicted 1. Other columns are not read. With no labels, or
    labels of one class, every text has one score.
    """
    source = documents.select("doc_id", documents["text"].cast("string").alias("text"))
    return score(source, fit(documents, labels)).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= threshold).cast("int").alias("predicted")
    )
