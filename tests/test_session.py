"""Lineage cuts: real sizes, clean-up, and loops that stay level over many rounds."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from scanloom import session
from scanloom.operators import features, spatial, vectors


def bits(df):
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length()


def test_estimates_stay_level(spark):
    df = session.cut(spark.range(50).withColumn("v", F.col("id") % 7))
    first, took = bits(df), []
    for _ in range(12):
        t0 = time.time()
        nxt = session.cut(df.join(df.select("id", F.col("v").alias("w")), "id").select("id", F.col("w").alias("v")))
        took.append(time.time() - t0)
        session.drop(df)
        df = nxt
    assert bits(df) <= first + 2 and max(took[6:]) < 3 * max(took[:6]) + 1 and session.table_bytes(df) > 0


def test_dropped_tables_are_gone(spark):
    df = session.cut(spark.range(10))
    session.drop(df)
    with pytest.raises(Exception):
        df.count()


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"
        def getCheckpointDir(self):
            return None
    class Session:
        sparkContext, conf = Context(), spark.conf
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.checkpoint_root(Session())


def test_long_chain_of_components(spark):
    n = 20000
    ids = random.Random(1).sample(range(10 * n), n)
    edges = spark.createDataFrame(list(zip(ids, ids[1:])), "a bigint, b bigint")
    got = spatial.label_components(edges).agg(F.count("*").alias("n"), F.min("root").alias("a"), F.max("root").alias("b")).first()
    assert (got.n, got.a, got.b) == (n, min(ids), min(ids))


def test_serpentine_ring(spark):
    """One ring around a snake of cells; its edges are followed in log2 rounds."""
    w, h = 100, 40
    cells = spark.range(w * (2 * h - 1)).select((F.col("id") % w).alias("ix"), F.floor(F.col("id") / w).alias("iy"))
    even = F.col("iy") % 2 == 0
    turn = F.when(F.floor(F.col("iy") / 2) % 2 == 0, w - 1).otherwise(0)
    cells = cells.filter(even | (F.col("ix") == turn)).withColumn("k", F.lit(0))
    v = vectors.trace_rings(cells, ["k"])
    # around h rows of w cells that are joined by h - 1 cells
    assert v.count() == 2 * (h * w + h - 1) + 2 and v.select("ring_id").distinct().count() == 1


def test_polygon_of_many_edges(spark):
    """A circle of 100,000 edges over 100 by 100 cells."""
    n, r = 100_000, 400.0
    a = spark.range(n).select((F.col("id") * 2 * math.pi / n).alias("a"), ((F.col("id") + 1) * 2 * math.pi / n).alias("b"))
    edges = a.select(F.lit(1).alias("poly_id"), (F.cos("a") * r).alias("x1"), (F.sin("a") * r).alias("y1"), (F.cos("b") * r).alias("x2"), (F.sin("b") * r).alias("y2"))
    rnd = random.Random(4)
    pts = [(i, rnd.uniform(-r, r), rnd.uniform(-r, r)) for i in range(2000)]
    got = {x.point_id for x in vectors.within(spark.createDataFrame(pts, "point_id bigint, x double, y double"), edges, 8.0).collect()}
    assert got == {i for i, x, y in pts if math.hypot(x, y) < r}


def test_ring_labels_of_a_corner(spark):
    """Two walls that meet: planes on both, an edge between planes at the corner, a jump where a wall ends."""
    pts = [(4.0, -1 + i / 16, 0.0) for i in range(17)] + [(4.0 + i / 16, 0.0, 0.0) for i in range(1, 17)]
    rows = [(0, 0, i, *p) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "frame_id int, ring int, i int, x double, y double, z double")
    for size in (None, 9):
        got = {r.i: r.label for r in features.point_labels(df, ["i"], rows_per_split=size).collect()}
        assert got[16] == "edge_plane" and all(got[i] == "plane" for i in (*range(1, 16), *range(17, 24)))
    blind = features.point_labels(df.withColumns({"x": F.lit(0.1), "y": F.lit(0.1)}), ["i"]).select("label").distinct().collect()
    assert [r.label for r in blind] == ["blind"]


def test_exploded_rows_are_not_broadcast_by_estimate(spark, tmp_path):
    """A small file whose rows are exploded is no small side: only measured sizes make broadcasts."""
    from pyspark.sql import functions as F

    from scanloom.plans import registry
    from scanloom.session import tune
    spark.range(2000).selectExpr("id", "id * 2 AS o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    registry.query("zz_exploded")(lambda t: t.orders.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(50)))).join(t.orders.select("id", F.col("id").alias("k")), "k"))
    try:
        df = registry.queries()["zz_exploded"](spark, str(tmp_path))
        assert "BroadcastExchange" not in df._jdf.queryExecution().sparkPlan().toString() and "BroadcastHashJoin" not in df._jdf.queryExecution().sparkPlan().toString()
    finally:
        del registry._QUERIES["zz_exploded"]
        tune(spark)
