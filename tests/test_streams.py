"""Event-time automata: files out of order, late rows, end marks."""

import random

from pyspark.sql import functions as F

from scanloom.operators import objects as B
from scanloom.operators import trajectory as J
from scanloom.streaming import operators as ST


def poses(spark, n=160):
    rnd, x, rows = random.Random(6), 0.0, []
    for i in range(n):
        x += rnd.random()
        rows.append((i % 2, i, i * 0.25, x, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0))
    return spark.createDataFrame(rows, "run int, frame_id bigint, ts double, tx double, ty double, tz double, qx double, qy double, qz double, qw double")


def write(df, src, parts):
    for ok in parts:
        df.filter(ok).coalesce(1).write.mode("append").parquet(src)


def test_files_out_of_order(spark, tmp_path):
    p = poses(spark)
    marked = p.withColumn(ST.END, F.lit(False))
    src = str(tmp_path / "in")
    swapped = F.floor(F.col("ts") / 4) + F.when(F.col("frame_id") % 3 == 0, 1).otherwise(0)
    write(marked, src, [swapped == k for k in range(12)])
    spark.createDataFrame([(r, None, 1e6, *[None] * 7, True) for r in (0, 1)], marked.schema).write.mode("append").parquet(src)
    out = ST.drain(ST.select_keyframes(ST.read_table(spark, src, "*.parquet", marked.schema, 1), delay=6.0), "kf").collect()
    assert not any(r.late for r in out)
    assert sorted(r.frame_id for r in out) == sorted(r.frame_id for r in J.keyframes(p, ["run"], ["ts"]).collect())


def test_late_rows_go_aside(spark, tmp_path):
    p = poses(spark).withColumn(ST.END, F.lit(False))
    src = str(tmp_path / "in")
    late = F.col("frame_id").isin(4, 9)
    write(p, src, [(F.col("ts") < 20) & ~late, F.col("ts") >= 20, late])
    out = ST.drain(ST.select_keyframes(ST.read_table(spark, src, "*.parquet", p.schema, 1), delay=1.0), "kf").collect()
    assert sorted(r.frame_id for r in out if r.late) == [4, 9]
    assert {r.frame_id for r in out if not r.late} <= {r.frame_id for r in J.keyframes(p.drop(ST.END).filter(~late), ["run"], ["ts"]).collect()}


def test_motion_window_crosses_batches(spark, tmp_path):
    rnd = random.Random(9)
    rows = [(i, i * 10 + k, i * 0.25, k * 9.0 + i * (0.1 if k else 0.5) + rnd.random() / 9, 0.0, 0) for i in range(60) for k in range(2)]
    b = spark.createDataFrame(rows, "frame_id bigint, box_id bigint, ts double, x double, y double, class int").withColumn(ST.END, F.lit(False))
    src = str(tmp_path / "in")
    write(b, src, [(F.col("ts") >= 3 * k) & (F.col("ts") < 3 * k + 3) for k in range(5)])
    spark.createDataFrame([(None, None, 1e6, None, None, 0, True)], b.schema).write.mode("append").parquet(src)
    got = ST.drain(ST.track_motion(ST.read_table(spark, src, "*.parquet", b.schema, 1), delay=2.0), "motion").select("box_id", "observations", "motion")
    want = B.motion_states(B.track_boxes(b.drop(ST.END))).select("box_id", "observations", "motion")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.select("motion").distinct().count() > 1


def test_slices_are_written_in_files_of_bounded_rows(spark, monkeypatch):
    from glob import glob
    from types import SimpleNamespace

    from scanloom.plans import streams
    from scanloom.session import scratch
    made = []
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 50, raising=False)
    monkeypatch.setattr(streams, "scratch", lambda s, name: made.append(scratch(s, name)) or made[-1])
    t = SimpleNamespace(spark=spark)
    got = ST.drain_batches(streams.stream_of(t, spark.range(600).selectExpr("id", "id * 1.0D AS ts"), "slices", "ts", files=3), "slices-out", lambda df, _: df)
    assert len(glob(made[0].removeprefix("file:") + "/part-*.parquet")) == 12
    spans = {r.batch_id: (r.n, r.a, r.b) for r in got.groupBy("batch_id").agg(F.count("id").alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).collect()}
    assert spans == {0: (200, 0, 199), 1: (200, 200, 399), 2: (200, 400, 599)}
