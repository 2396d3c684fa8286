"""Thin queries over the operators, as they are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gatherline.llm import ann, bestfit, bpe, embdedup, fim, langid, lm, minhash, packing, quality, secrets, toxicity, veccodes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents, on sets of two-word shingles. Odd rows: see ``minhash.group``."""
    return minhash.group(_table(spark, sf_dir, "documents"), width=2)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by the word vocabulary, decoded again; digests of both. Odd rows: see ``bpe.digests``."""
    return bpe.digests(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model of all documents outside the held-out fold. Odd rows: see ``lm.score``."""
    return lm.score(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored for toxicity by a classifier of labelled documents outside the held-out fold. Odd rows: see ``toxicity.classify``."""
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document. Odd rows: see ``secrets.report``."""
    return secrets.report(_table(spark, sf_dir, "documents"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document. Odd rows: see ``langid.identify``."""
    return langid.identify(_table(spark, sf_dir, "documents"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector, among all others. Odd rows: see ``ann.search``."""
    return ann.search(_table(spark, sf_dir, "embeddings"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored for quality by a classifier of labelled documents outside the held-out fold. Odd rows: see ``quality.classify``."""
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_embdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all embeddings of equal label. Odd rows: see ``embdedup.link``."""
    return embdedup.link(_table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids. Odd rows: see ``packing.pack``."""
    return packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op11_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into as few sequences of 2048 ids as the method finds. Odd rows: see ``bestfit.pack``."""
    packed = bestfit.pack(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "doc_tokens")


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged for fill-in-middle; digests of the output and of what is restored from it. Odd rows: see ``fim.transform``."""
    return fim.digests(_table(spark, sf_dir, "documents"))


def op13_veccodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all embeddings by codebooks of all. Odd rows: see ``veccodes.compress``."""
    return veccodes.report(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    all_ = (op1_minhash, op2_bpe, op3_lm, op4_toxicity, op5_secrets, op6_langid, op7_ann, op8_quality, op9_embdedup, op10_packing, op11_bestfit, op12_fim, op13_veccodes)
    return {f.__name__: f for f in all_}


def oracle_sql() -> dict[str, str]:
    return {"op12_fim": fim.DIGESTS_SQL, "op13_veccodes": veccodes.report_sql()}
