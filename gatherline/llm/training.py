"""What the classifiers share: folds by document id, a bounded labelled sample, and logistic training in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))) % modulus


def sample(documents: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, per_class: int) -> DataFrame:
    """At most ``per_class`` training documents of each label value: columns t (text) and y.

    Only labels of documents outside the held-out fold are read. A document with several labels takes the largest.
    The sample's ids are those with the smallest hashes, so it is the same on every run; the ids, at most per_class a
    class, are small enough to broadcast by construction.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", modulus) != held))
    known = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    picked = None
    for value in (0, 1):
        some = known.where(F.col("y") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    texts = documents.select("doc_id", F.col("text").cast("string").alias("t")).where(F.col("t").isNotNull())
    return texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("t").alias("t"), F.max("y").alias("y")).select("t", "y")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def adam(gradient, weights: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Full-batch Adam from ``weights``; gradient(weights) gives the loss's gradient."""
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, steps + 1):
        g = gradient(weights)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        weights = weights - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return weights
