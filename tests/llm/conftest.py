from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns beside those of documents whose names the operators use themselves.
CLASHES = {n: f"'{n}'" for n in ("score", "label", "component", "shingles", "block", "size", "rank", "rep", "digest", "base", "found", "runs", "quality_score", "toxic_score", "key", "node")}

ODD_ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", None, 0),
    (3, " \t\n", None, "a", 3),
    (4, "one", "en", "a", 3),
    (5, "the same words stand here again and again in this text", "en", "a", 54),
    (6, "the same words stand here again and again in this text", "en", "b", 54),
    (6, "the same words stand here again and again in this text", "en", "b", 54),
    (7, "password = 'abcdEFGH12345678' café Ünïcode ✓ 東京 don't <|endoftext|> 12345", "de", "a", 70),
    (8, "x" * 50_000, "en", "a", 50_000),
    (9, "Lorem ipsum dolor " * 6_000, "fr", "c", 108_000),
    (10, "ends with blanks   \n\n  ", "en", "a", 24),
    (None, "a row without an id has a text", "en", "a", 30),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank, short, repeated, very long and id-less rows, with columns whose names clash."""
    return spark.createDataFrame(ODD_ROWS, SCHEMA).selectExpr("*", *[f"{v} AS {k}" for k, v in CLASHES.items()])


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
