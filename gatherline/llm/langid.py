"""Language identification by error-correcting output codes.

Every language has a codeword. For each bit a binary logistic classifier on hashed byte n-grams learns whether the
text's language has that bit set; a text goes to the language whose codeword has the least loss, where each bit's loss
is weighted by how well its classifier did in training. A small gap between the best two flags the text as ambiguous.
Every language of the training fold is learned, however many there are. Texts of the sample become n-gram shares in
the tasks, so that only vectors of bounded size reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from gatherline.llm.blocks import LOWER, blocks
from gatherline.llm.training import adam, fold, sigmoid
from gatherline.plans.scratch import Scratch

#: Labelled documents that training sees at most: of each language, and in all (each language has one at least).
SAMPLE_PER_LANGUAGE, SAMPLE = 900, 9_000
BUCKETS = 4096
AMBIGUOUS = 0.1
ROWS = 512
UNKNOWN = "und"


def histograms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each document of a block the shares of its hashed byte 1-, 2- and 3-grams, as BUCKETS columns."""
    n = len(offsets) - 1
    low = LOWER[data].astype(np.uint32)
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets)) * BUCKETS
    counts = np.zeros(n * BUCKETS, np.int64)
    gram = np.zeros(len(low), np.uint32)
    for size in range(1, 4):
        m = len(low) - size + 1
        if m <= 0:
            break
        gram = (gram[:m] | (low[size - 1 :] << np.uint32(8 * (size - 1)))) if size > 1 else low.copy()
        whole = doc[:m] == doc[size - 1 :]
        at = ((gram + np.uint32(size)) * np.uint32(2654435761)) >> np.uint32(20)
        counts += np.bincount(doc[:m][whole] + at[whole], minlength=n * BUCKETS)
    counts = counts.reshape(n, BUCKETS)
    return (counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def codewords(n: int) -> np.ndarray:
    """n rows of -1 and 1: all distinct splits of the languages where they are few, else random ones, far apart."""
    if n <= 5:
        columns = [[1 if (k >> i) & 1 else -1 for i in range(n)] for k in range(1, 1 << max(1, n - 1))]
        return np.array(columns, np.int64).T.reshape(n, -1)
    rng, best, apart = np.random.default_rng(11), None, -1
    for _ in range(max(1, min(200, 20_000 // n))):
        code = rng.choice([-1, 1], (n, int(np.ceil(10 * np.log2(n)))))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        alike = (code.astype(np.float32) @ code.T.astype(np.float32)) - 2 * code.shape[1] * np.eye(n, dtype=np.float32)
        gap = int((code.shape[1] - alike.max()) / 2)
        if gap > apart:
            best, apart = code, gap
    return best


class Model:
    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, bias: np.ndarray, trust: np.ndarray):
        self.languages, self.code, self.weights, self.bias, self.trust = languages, code, weights, bias, trust

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, its chance among all, and the gap to the second."""
        n = len(offsets) - 1
        if len(self.languages) == 1:
            return np.zeros(n, np.int64), np.ones(n), np.ones(n)
        margin = (histograms(data, offsets) @ self.weights + self.bias).astype(float)
        # A bit of a codeword costs log(1 + exp(-margin)) where it is set and log(1 + exp(margin)) where not.
        loss = (np.logaddexp(0, -margin) * self.trust) @ (self.code > 0).T + (np.logaddexp(0, margin) * self.trust) @ (self.code < 0).T
        chance = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        chance /= chance.sum(axis=1, keepdims=True)
        top = np.sort(chance, axis=1)
        return loss.argmin(axis=1), top[:, -1], top[:, -1] - top[:, -2]


def train(x: np.ndarray, langs: list[str]) -> Model:
    """Learns the bits' classifiers from n-gram shares, one row a text (scaled in place), and the texts' languages."""
    languages = sorted(set(langs))
    if len(languages) < 2:
        return Model(languages, np.ones((len(languages), 1), np.int64), np.zeros((BUCKETS, 1)), np.zeros(1), np.ones(1))
    spread = (x.std(axis=0) + 1e-4).astype(np.float32)
    x /= spread
    number = {g: i for i, g in enumerate(languages)}
    which = np.array([number[g] for g in langs])
    code = codewords(len(languages))
    target = code[which].astype(np.float32)
    weight = 1 / np.bincount(which, minlength=len(languages))[which].astype(np.float32)
    weight /= weight.sum()

    def gradient(w: np.ndarray) -> np.ndarray:
        error = -target * sigmoid(-target * (x @ w[:-1] + w[-1])) * weight[:, None]
        return np.vstack([x.T @ error + 1e-5 * w[:-1], error.sum(axis=0)]).astype(np.float32)

    w = adam(gradient, np.zeros((BUCKETS + 1, code.shape[1]), np.float32), 120, 0.01)
    loss = (np.logaddexp(0, -target * (x @ w[:-1] + w[-1])) * weight[:, None]).sum(axis=0)
    trust = 1 / (0.05 + loss)
    return Model(languages, code, w[:-1] / spread[:, None], w[-1], trust / trust.mean())


def sample(documents: DataFrame) -> DataFrame:
    """Labelled documents outside the held-out fold, as g (language), places and shares of the n-grams that they have.

    Of each language those whose ids have the smallest hashes: SAMPLE_PER_LANGUAGE, or as many as SAMPLE leaves for
    each, one at least. Ties in the hash go by id and text.
    """
    known = documents.select("doc_id", F.col("lang").cast("string").alias("g"), F.col("text").cast("string").alias("t"))
    known = known.where((fold("doc_id", 4) != 2) & F.col("g").isNotNull() & F.col("t").isNotNull())
    counts = known.groupBy("g").count()
    each = F.least(F.lit(SAMPLE_PER_LANGUAGE), F.greatest(F.lit(1), F.floor(F.lit(SAMPLE) / F.count("*").over(Window.partitionBy()))))
    # The hash lets through a little more than is wanted, so that what is ranked is small; a rare language passes whole.
    wanted = counts.withColumn("most", each).withColumn("share", F.when(F.col("most") * 8 >= F.col("count"), 1.0).otherwise(F.least(F.lit(1.0), (1.2 * F.col("most") + 30) / F.col("count"))))
    # Written first, so that its size is known: a small table is broadcast and no text moves.
    wanted = Scratch(documents.sparkSession, "langid").table(wanted.drop("count"), "wanted")
    hashed = known.withColumn("h", F.xxhash64("doc_id")).join(wanted, "g")
    some = hashed.where(F.pmod("h", F.lit(1_000_003)) < F.col("share") * 1_000_003)
    ranked = some.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("h", "doc_id", "t"))).where(F.col("n") <= F.col("most"))

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in blocks(batch.column(1), rows=ROWS):
                x = histograms(data, offsets)
                at = [np.flatnonzero(row) for row in x]
                yield pa.record_batch([batch.column(0).slice(low, high - low), pa.array([a.astype("<u2").tobytes() for a in at], pa.binary()), pa.array([x[i, a].tobytes() for i, a in enumerate(at)], pa.binary())], ["g", "at", "x"])

    return ranked.select("g", "t").mapInArrow(shares, "g string, at binary, x binary")


def fit(documents: DataFrame) -> Model:
    """Learns from a bounded sample of the labelled documents outside the held-out fold; without any, a model of no language."""
    rows = sorted(sample(documents).collect())
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["x"], np.float32)
    return train(x, [r["g"] for r in rows])


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and ambiguous for every row.

    Null and letterless texts, and any text when nothing could be learned, are UNKNOWN with score 0. Rows are kept one
    for one, repeated rows and null ids included; of languages at the same distance the first by name is taken. Other
    columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(1)
            names, scores, unsure = [], [], []
            for low, _, data, offsets in blocks(text, rows=ROWS):
                lettered = np.diff(np.concatenate([[0], np.cumsum(((data | 32) >= 97) & ((data | 32) <= 122) & (data < 128))])[offsets]) > 0
                for i in np.flatnonzero(~lettered):
                    lettered[i] = any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode(errors="replace")))
                if not model.languages:
                    lettered[:] = False
                    best = gap = chance = np.zeros(len(lettered))
                else:
                    best, chance, gap = model.predict(data, offsets)
                names += [model.languages[int(b)] if k else UNKNOWN for b, k in zip(best, lettered, strict=True)]
                scores.append(np.where(lettered, chance, 0.0))
                unsure.append(lettered & (gap < AMBIGUOUS))
            join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(join(scores, float)), pa.array(join(unsure, bool))], ["doc_id", "lang_pred", "score", "ambiguous"])

    source = documents.select("doc_id", F.col("text").cast("string").alias("t"))
    return source.mapInArrow(run, StructType([source.schema["doc_id"], StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("ambiguous", BooleanType())]))


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row of ``documents``; see fit() and predict()."""
    return predict(documents, fit(documents)).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")
