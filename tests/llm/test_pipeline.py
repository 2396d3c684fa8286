from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.test_minhash import brute
from tests.llm.test_secrets import brute as secret_spans

SF = "/root/testdata/sf0.01"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes), name
        assert 0 < after.count() <= before.count(), name
        if name == "near_duplicates":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            want = {i for i, (_, c) in brute(rows, 5).items() if i == c}
            assert {r.doc_id for r in after.collect()} == want
        if name == "secrets":
            assert after.count() == before.count()
            assert not any(secret_spans(r.text) for r in after.collect())
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in before.collect()}


def test_run_is_the_stages_in_turn(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "secrets", "packing"]
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, odd, none, name, stage):
    """Null, empty, blank, very long and repeated rows, null ids, clashing names, an empty table."""
    out = stage(spark, odd, "/root/testdata/sf0.001")
    rows = out.collect()
    assert stage(spark, none, "/root/testdata/sf0.001").count() == 0
    if name == "packing":
        assert {r.doc_id for r in rows} == {r.doc_id for r in odd.select("doc_id").collect()}
        return
    assert out.columns == odd.columns and dict(out.dtypes) == dict(odd.dtypes)
    left = sorted(str(r.doc_id) for r in rows)
    every = sorted(str(r.doc_id) for r in odd.collect())
    if name == "secrets":
        assert left == every
        assert {r.text for r in rows if r.doc_id in (1, 2)} == {None, ""} and all(r.score == "score" for r in rows)
    elif name == "near_duplicates":
        assert left == sorted(map(str, [1, 2, 3, 4, 5, 7, 8, 9, 10, None]))
    else:
        assert set(left) <= set(every)
        by_id = {i: left.count(i) for i in left}
        assert by_id.get("6", 2) == 2  # repeated rows share their fate
        assert len({str(i) in left for i in (1, 2)}) == 1  # null and empty texts as well


def test_filters_without_labels_let_all_pass(spark, odd, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, odd, str(tmp_path)).count() == odd.count()
