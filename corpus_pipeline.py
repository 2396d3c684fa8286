"""From raw documents to packed training sequences: quality, toxicity, near-duplicates, secrets, packing.

Each stage takes all that its predecessor kept and returns the columns of ``documents`` (the last returns the packed
pieces). ``run`` writes each stage's result as Parquet in the shared folder and reads it again for the next one.

All stages take whole texts, however long, keep columns that they do not know (whatever their names), and give no rows
for an empty table. Without labels of both classes nothing is learned: every document then has the score of the class
that is there, and with no labels at all the filters let everything pass.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gatherline.llm import minhash, packing, quality, secrets, toxicity
from gatherline.plans.scratch import Scratch

#: None of the classifiers, nor the tokenizer, can be expressed in SQL.
ORACLE_SQL = None
#: Column of a filter's scores while it filters; no column of the documents has that name.
SCORE = "__pipeline_score__"


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches one half.

    Null, empty and blank texts have no features: the bias alone decides on them, alike for all. Rows with a null id are
    scored as others are; repeated rows share their fate. A score of exactly one half stays.
    """
    scored = quality.score(docs, quality.fit(docs, _labels(spark, sf_dir)), SCORE)
    return scored.where(scored[SCORE] >= 0.5).select(*docs.columns)


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold.

    Null and empty texts score as the bias alone; null ids and repeated rows as in keep_quality. A score equal to the
    threshold goes.
    """
    scored = toxicity.score(docs, toxicity.fit(docs, _labels(spark, sf_dir)), SCORE)
    return scored.where(scored[SCORE] < toxicity.THRESHOLD).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8).

    Of a group the row with the smallest id stays, of rows equal in id and text one. Texts without words (null, empty,
    blank) all stay. Different texts under one id are different documents; rows without an id are compared as well and
    give way to rows with one.
    """
    return minhash.deduplicate(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced, n_chars set anew.

    Rows are kept one for one; null and empty texts stay as they are.
    """
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences.

    A null or empty text is the end token alone; each of repeated rows is packed; a null id is carried as it is.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", keep_quality), ("toxicity", keep_civil), ("near_duplicates", keep_one_of_each), ("secrets", redact_secrets), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
