"""Every query that has SQL must give the SQL's rows; the others must give rows of a stable schema."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from gatherline.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def shown(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    sql = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert sorted(sql.columns) == columns
    want = duck.sql("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({ORACLES[name]})").fetchall()
    got = [tuple(shown(x) for x in r) for r in df.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted((tuple(shown(x) for x in r) for r in want), key=repr)
    assert got


def test_titles_with_entities_and_without_text(spark, tmp_path):
    con = duckdb.connect()
    titles = ["a &quot;b&quot;", "it&#39;s&nbsp;on", "x &ndash; y &mdash; z", "&amp;lt;", " ", "&nbsp;", "", "plain"]
    con.execute("CREATE TABLE pages AS SELECT i AS page_id, '<html><TITLE x>' || t || '</title>' AS html FROM (SELECT unnest(range(8)) AS i, unnest($1) AS t)", [titles])
    con.execute(f"COPY pages TO '{tmp_path}/pages.parquet'")
    want = con.execute(ORACLES["src_25_titles"]).fetchall()
    assert sorted(want) == sorted(tuple(r) for r in QUERIES["src_25_titles"](spark, str(tmp_path)).collect())
    assert sorted(t for _, t in want) == sorted(['a "b"', "it's on", "x – y — z", "&lt;", "plain"])


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns == QUERIES[name](spark, SF).columns and df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["id", "town", "st", "start_date", "team_count"]
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


def test_entry_without_the_subpackage():
    """The contract holds where the training-data operators and their pipeline are not there at all."""
    block = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name == "gatherline.llm" or name.startswith("gatherline.llm."):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
names = entry.queries()
assert "pipeline" not in names and not any(n.startswith("op") for n in names), names
assert len(names) > 150 and set(entry.oracle_sql()) <= set(names)
"""
    root = Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", block], cwd=root, check=True, timeout=120)
