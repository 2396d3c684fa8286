from __future__ import annotations

import random

from gatherline.sources.exports import export_chain

SCHEMA = "table string, after long, next_after long, low long, high long, rows long"


def chain(spark, rows, schema=SCHEMA):
    out = export_chain(spark.createDataFrame(rows, schema)).collect()
    return sorted(((r.table, r.after, r.next_after, r.page, r.fault) for r in out), key=repr)


def whole(table, n):
    return [(table, i * 10 if i else None, (i + 1) * 10 if i < n - 1 else None, i * 10 + 1, i * 10 + 10, 10) for i in range(n)]


def test_whole_chain_of_any_length(spark):
    for n in (1, 2, 3, 33):
        rows = whole("a", n)
        random.Random(n).shuffle(rows)
        got = chain(spark, rows)
        assert sorted(p for *_, p, _ in got) == list(range(1, n + 1)) and all(f == "" for *_, f in got)


def test_each_break_is_told_with_its_place(spark):
    gap = [r for r in whole("gap", 6) if r[1] != 30]
    loop = [(t, a, 10 if a == 40 else n, lo, hi, k) for t, a, n, lo, hi, k in whole("loop", 7)]
    headless = [r for r in whole("headless", 3) if r[1] is not None]
    fork = [*whole("fork", 4), ("fork", 10, 30, 11, 30, 20)]
    overlap = [(t, a, n, lo - 5 if a == 20 else lo, hi + 1 if a == 30 else hi, k) for t, a, n, lo, hi, k in whole("overlap", 6)]
    got = {(t, a, n): (p, f) for t, a, n, p, f in chain(spark, [*gap, *loop, *headless, *fork, *overlap])}
    assert got["gap", 20, 30] == (3, "stops") and got["gap", 10, 20] == (2, "") and got["gap", 40, 50] == (None, "unreached")
    assert got["loop", 40, 10] == (5, "loop,order") and got["loop", 50, 60] == (None, "unreached")
    assert got["headless", 10, 20] == (None, "unreached")
    assert got["fork", 10, 20] == (2, "fork") and got["fork", 10, 30] == (2, "fork") and got["fork", 20, 30] == (3, "") and got["fork", 30, None] == (4, "")
    assert got["overlap", 20, 30] == (3, "order") and got["overlap", 30, 40] == (4, "order") and got["overlap", 40, 50] == (5, "")


def test_odd_pages(spark):
    assert chain(spark, []) == []
    twice = chain(spark, [*whole("a", 2), whole("a", 2)[1]])
    assert sorted((p, f) for *_, p, f in twice) == [(1, ""), (2, ""), (2, "")]
    # Blank cursors are none, as are nulls; a page without rows has no keys to be out of order.
    blank = chain(spark, [("a", "", "k", "b", "k", 2), ("a", "k", "", None, None, 0)], "table string, after string, next_after string, low string, high string, rows long")
    assert sorted((p, f) for *_, p, f in blank) == [(1, ""), (2, "")]
    assert chain(spark, [(None, None, None, 1, 2, 2)])[0][3:] == (None, "unreached")


def test_extra_columns_are_kept(spark):
    rows = [(*r, "x") for r in whole("a", 2)]
    out = export_chain(spark.createDataFrame(rows, SCHEMA + ", note string"))
    assert out.columns == ["table", "after", "next_after", "low", "high", "rows", "note", "page", "fault"] and {r.note for r in out.collect()} == {"x"}
