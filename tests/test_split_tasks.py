"""Small splits share tasks and files, and a scan takes groups batch by batch."""

import pytest
from pyspark.sql import functions as F

from scanloom.operators import ordered as O


def test_small_splits_share_files(spark):
    df = spark.range(20_000).selectExpr("id % 3 AS k", "floor(id / 2) AS t")
    sp, n = O.add_split(df, ["k"], ["t"], 10)
    tasks = max(spark.sparkContext.defaultParallelism, 1)
    assert n == 2000 and len(sp.inputFiles()) <= 4 * tasks
    per = sp.groupBy("k", "_split").agg(F.min("t").alias("a"), F.max("t").alias("b"), F.count("*").alias("c")).collect()
    assert sum(r.c for r in per) == 20_000 and max(r.c for r in per) <= 20 and len({r._split for r in per}) <= n
    for k in range(3):
        of = sorted((r._split, r.a, r.b) for r in per if r.k == k)
        assert all(x[2] < y[1] for x, y in zip(of, of[1:]))  # rising, equal rows together


@pytest.mark.parametrize("size", [None, 400])
def test_scan_takes_batches(spark, size):
    """No piece is longer than a batch, and rows equal in the order are in one piece."""
    def scan(pdf, state):
        seen = state or 0
        return pdf.assign(piece=len(pdf), before=seen), seen + len(pdf)

    rows = [(None if i % 4 == 3 else i % 4, None if i % 50 == 0 else i // 8) for i in range(2000)]
    df, key = spark.createDataFrame(rows, "k int, t int"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(key)
    spark.conf.set(key, "64")
    try:
        got = O.carried_scan(df, ["k"], ["t"], scan, "k int, t int, piece bigint, before bigint", size).collect()
    finally:
        spark.conf.set(key, usual)
    assert len(got) == len(rows) and max(r.piece for r in got) <= 128
    for k in (None, 0, 1, 2):
        of = [r for r in got if r.k == k]
        starts = sorted({(r.before, r.piece) for r in of})
        assert [b for b, _ in starts] == [sum(p for _, p in starts[:i]) for i in range(len(starts))] and sum(p for _, p in starts) == len(of)
        for t in {r.t for r in of}:
            assert len({r.before for r in of if r.t == t}) == 1
