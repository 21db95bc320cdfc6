"""Boundary cases by hand: ties, gaps, non-finite values, formats, streams."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.functions import columns as C
from scanloom.operators import audit as A
from scanloom.operators import boundaries as B
from scanloom.operators import evidence as E
from scanloom.operators import ordered as O
from scanloom.operators import points as P
from scanloom.operators import terrain as T
from scanloom.operators import trajectory as J
from scanloom.session import tune
from scanloom.sources import files as S
from scanloom.streaming import operators as ST


def test_asof_bracket_semantics(spark):
    right = spark.createDataFrame([(10, 0.0, 0.0), (20, 10.0, 5.0), (40, 30.0, 5.0)], "t bigint, x double, y double")
    left = spark.createDataFrame([(5,), (10,), (15,), (20,), (25,), (40,), (41,)], "t bigint")
    m = {r.t: (r.matched, r.ref_x) for r in J.asof_interp(left, right, "t", 10).collect()}
    assert m == {5: (False, None), 10: (True, 0.0), 15: (True, 5.0), 20: (True, 10.0), 25: (False, None), 40: (True, 30.0), 41: (False, None)}
    assert {r.t: r.matched for r in J.asof_interp(left, right, "t", 20).collect()}[25] is True


def test_three_tiers(spark):
    poses = spark.createDataFrame([(10, 0.0, 0.0, 0.0), (20, 10.0, 0.0, 0.0)], "t bigint, x double, y double, z double")
    left = spark.createDataFrame([(7,), (10,), (13,), (15,), (18,), (25,)], "t bigint")
    tier = {r.t: r.tier for r in J.position_at(left, poses, "t", 4).collect()}
    assert tier == {7: "next", 10: "next", 13: "prev", 15: None, 18: "next", 25: None}
    assert {r.t: r.at_x for r in J.position_at(left.filter("t = 15"), poses, "t", 5).collect()} == {15: 0.0}


def test_slerp_branches(spark):
    s = math.sqrt(0.5)
    d = spark.createDataFrame([(1, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, s, s), (2, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, -s, -s), (3, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 1e-5, 1.0), (4, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, -1.0)],
                              "id int, ax double, ay double, az double, aw double, bx double, by double, bz double, bw double").withColumn("u", F.lit(0.5))
    got = {r.id: math.degrees(2 * math.atan2(r.qz, r.qw)) for r in C.with_slerp(d, "a", "b", "u").collect()}
    assert got[1] == pytest.approx(45) and got[2] == pytest.approx(45) and abs(got[3]) < 1e-2 and got[4] == pytest.approx(0)


def test_non_finite(spark):
    d = spark.createDataFrame([(1.0, 0.0, 0.0), (float("nan"), 0.0, 0.0), (0.0, float("inf"), 0.0), (None, 0.0, 0.0)], "x double, y double, z double")
    assert P.finite(d).count() == 1
    with pytest.raises(Exception, match="not finite"):
        P.finite(d, on_bad="fail").collect()


def test_negative_grid_keys(spark):
    d = spark.createDataFrame([(-0.5,), (-1.0,), (-1e-9,), (0.0,), (1.0,)], "v double")
    assert [r[0] for r in d.select(C.cell("v", 0.5)).collect()] == [-1, -2, -1, 0, 2]
    assert [r[0] for r in d.select(C.cell_trunc("v", 0.5)).collect()] == [-2, -3, -1, 0, 2]


def test_ground_seed_rank(spark):
    rows = [(float(c), 0.25, k / 100.0, 5.0) for c, n in ((0, 11), (1, 12), (2, 13)) for k in range(n)]
    s = T.ground_seeds(spark.createDataFrame(rows, "x double, y double, z double, tz double"), 1.0)
    assert {r.ix: (r.n, r.ground_z) for r in s.collect()} == {1: (12, 0.02), 2: (13, 0.02)}


def test_height_filter_equality_and_label(spark):
    p = spark.createDataFrame([(0.1, 0.1, 0.0), (0.2, 0.2, 0.25), (0.3, 0.3, 0.5000001)], "x double, y double, z double")
    rows = P.height_filter(p, 0.5, (0.25, 0.5)).groupBy("layer").count().collect()
    assert {r["layer"]: r["count"] for r in rows} == {"0p25": 2, "0p5": 2}
    assert spark.range(1).select(C.height_label(F.lit(1.5)), C.height_label(F.lit(2.0))).first()[:] == ("1p5", "2")


def test_run_with_one_missing(spark):
    d = spark.createDataFrame([(0, i) for i in (1, 2, 4, 7, 8, 8)], "k int, i bigint")
    assert [(r.longest_run, r.samples) for r in B.longest_run(d, ["k"], "i").collect()] == [(3, 5)]


def test_step_edges(spark):
    cells = [(x, y, 0.0 if x < 5 else 0.12) for x in range(10) for y in range(10)] + [(20 + x, y, 0.5 * (x > 2)) for x in range(6) for y in range(6)]
    e = E.step_edges(spark.createDataFrame(cells, "ix bigint, iy bigint, mean_z double"))
    assert e.count() == 10 and e.filter("orientation = 0 AND cell_ix = 4").count() == 10
    c = E.edge_components(e, tile=4)
    assert c.select("root_u", "root_v").distinct().count() == 1 and c.count() == 10


def test_planes_of_many_cells_at_once():
    """A batch of cells with as many samples each gives what every cell gives alone."""
    r = np.random.default_rng(3)
    for n in (2, 6, 20):
        s = np.stack([np.c_[r.choice([-1.0, -0.5, 0.0, 0.5, 1.0], (n, 2)), r.choice([0.0, 0.1, 0.6], n)] for _ in range(60)])
        many = T.robust_planes(s, 0.15, 6, 30.0, 0.2)
        one = [T.robust_plane(v, 0.15, 6, 30.0, 0.2) for v in s]
        assert [f is None for f in many] == [f is None for f in one] and all(np.allclose(a, b, rtol=0, atol=1e-9) for a, b in zip(many, one) if a)
        assert n != 20 or sum(f is not None for f in many) > 5


def test_robust_plane_ignores_wall():
    rng = np.random.default_rng(0)
    g = np.c_[rng.uniform(-1, 1, (40, 2)), np.zeros(40)]
    g[:, 2] = 0.1 * g[:, 0] + 0.3
    wall = np.c_[np.full(10, 0.9), rng.uniform(-1, 1, 10), rng.uniform(1, 3, 10)]
    fit = T.robust_plane(np.r_[g, wall], 0.15, 6, 30.0, 0.2)
    assert fit[0] == pytest.approx(0.1) and fit[2] == pytest.approx(0.3) and fit[4] == 40
    assert T.robust_plane(g[:5], 0.15, 6, 30.0, 0.2) is None
    t = T.triples(7)
    assert len(t) == 35 and all(len(set(r)) == 3 for r in t.tolist())


def test_open_continuation(spark):
    rows = []
    for i in range(30):
        left = None if 10 <= i < 15 or 20 <= i < 24 else 2.0
        right = None if 8 <= i < 26 else 1.5
        rows.append((i, i * 0.5, 0.0, 1.0, 0.0, left, right))
    x = spark.createDataFrame(rows, "sample_id bigint, x double, y double, tx double, ty double, left_inner_m double, right_inner_m double")
    x = x.withColumn("road_width", F.col("left_inner_m") + F.col("right_inner_m")).withColumn("road_valid", F.col("road_width").isNotNull())
    got = {r.sample_id: (round(r.lo, 6), r.hi) for r in B.open_continuations(x).collect()}
    assert got == {i: (-1.5, 2.0) for i in [*range(10, 15), *range(20, 24)]}
    assert {r.sample_id for r in B.one_sided(x, min_run=5).collect()} == set(range(15, 20))


def test_ordered_subset_with_copies(spark):
    full = [(1, 0, "a"), (1, 1, "b"), (1, 2, "a"), (1, 3, "c"), (2, 0, "a"), (2, 1, "b"), (3, 0, "a")]
    kept = [(1, 0, "b"), (1, 1, "a"), (2, 0, "b"), (2, 1, "a"), (3, 0, "z")]
    df = lambda r: spark.createDataFrame(r, "f int, pos bigint, v string")
    got = {r.f: r.is_subset for r in A.ordered_subset(df(kept), df(full), ["f"], "pos", ["v"]).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_frame_files(spark, tmp_path):
    rec = np.zeros(3, np.dtype([("x", "<f4"), ("y", "<f4"), ("z", "<f4"), ("rgb", "<u4")]))
    rec["x"], rec["rgb"] = [1, 2, 3], [0x010203, 255, 0]
    head = b"# c\nVERSION 0.7\nFIELDS x y z rgb\nSIZE 4 4 4 4\nTYPE F F F U\nCOUNT 1 1 1 1\nWIDTH 3\nHEIGHT 1\nDATA binary\n"
    (tmp_path / "frame_000042.pcd").write_bytes(head + rec.tobytes())
    rows = S.ingest_frames(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r.frame_id, r.seq, r.x, r.rgb) for r in rows] == [(42, 0, 1.0, 0x010203), (42, 1, 2.0, 255), (42, 2, 3.0, 0)]
    with pytest.raises(ValueError, match="payload"):
        S.decode_frame("cut", head + rec.tobytes()[:-1])
    with pytest.raises(ValueError, match="unsupported"):
        S.decode_frame("odd", head.replace(b"TYPE F F F U", b"TYPE F F F X") + rec.tobytes())


def test_pose_text_and_contracts(spark, tmp_path):
    good = tmp_path / "poses.txt"
    good.write_text("# id ts ...\n1 0.5 1 2 3 0 0 0 2\n\n2 1.0 1 2 3 0 0 1 0\n")
    rows = S.read_poses(spark, str(good)).orderBy("id").collect()
    assert [(r.id, r.qw) for r in rows] == [(1, 1.0), (2, 0.0)]
    bad = tmp_path / "twice.txt"
    bad.write_text("1 0 0 0 0 0 0 0 1\n1 1 0 0 0 0 0 0 1\n")
    with pytest.raises(Exception, match="repeated pose id"):
        S.read_poses(spark, str(bad)).collect()
    csv = tmp_path / "m.csv"
    csv.write_text("frame_id,timestamp,point_count,pcd_path\n7,0.5,3,a/frame_000008.pcd\n")
    with pytest.raises(Exception, match="manifest name"):
        S.read_manifest(spark, str(csv)).collect()
    csv.write_text("frame,timestamp,point_count,pcd_path\n7,0.5,3,a/frame_000007.pcd\n")
    with pytest.raises(Exception):
        S.read_manifest(spark, str(csv)).collect()


def test_line_numbers_and_refusal(spark, tmp_path):
    log = tmp_path / "a.log"
    log.write_text("\n".join(f"line {i} {'error' if i % 7 == 0 else ''}" for i in range(1, 2001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {r.line_no: r.value for r in S.log_matches(spark, str(log), "error").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 285 and all(v.split()[1] == str(k) for k, v in got.items())
    out = str(tmp_path / "layers")
    d = spark.range(2).withColumn("layer", F.lit("a"))
    S.write_points(d, out)
    with pytest.raises(Exception, match="(?i)exists"):
        S.write_points(d, out)


def test_freeze(spark, tmp_path):
    for n in "abc":
        (tmp_path / n).write_text(n)
    before = A.freeze_manifest(spark, str(tmp_path)).collect()
    frozen = spark.createDataFrame(before)
    assert A.verify_freeze(frozen, A.freeze_manifest(spark, str(tmp_path))).count() == 0
    digest = A.tree_digest(frozen).first().tree_sha256
    (tmp_path / "a").write_text("changed")
    os.rename(tmp_path / "b", tmp_path / "d")
    now = A.freeze_manifest(spark, str(tmp_path))
    assert {(r.path, r.state) for r in A.verify_freeze(frozen, now).collect()} == {("a", "changed"), ("b", "missing"), ("d", "added")}
    assert A.tree_digest(now).first().tree_sha256 != digest


def test_stream_batches_equal_batch(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(0, i, i * 0.25, float(x), 0.0, 0.0, 0.0, 0.0, 0.0, 1.0) for i, x in enumerate(np.cumsum(rng.uniform(0, 1, 120)))]
    p = spark.createDataFrame(rows, "run int, frame_id bigint, ts double, tx double, ty double, tz double, qx double, qy double, qz double, qw double").drop("frame_id")
    src = str(tmp_path / "in")
    for k in range(3):
        p.filter((F.col("ts") >= k * 10) & (F.col("ts") < (k + 1) * 10)).coalesce(1).write.mode("append").parquet(src)
    stream = ST.read_table(spark, src, "*.parquet", p.schema, 1)
    got = sorted(r.ts for r in ST.drain(ST.select_keyframes(stream), "kf").select("ts").collect())
    assert got == sorted(r.ts for r in J.keyframes(p, ["run"], ["ts"]).select("ts").collect())


def test_revisit_stream_waits_for_enough(spark, tmp_path):
    kf = [(i, float(i), (i % 40) * 0.5, 0.0, 0.0) for i in range(100)]
    df = spark.createDataFrame(kf, "id bigint, ts double, x double, y double, z double")
    src = str(tmp_path / "kf")
    for lo, hi in ((0, 60), (60, 63), (63, 100)):
        df.filter((F.col("id") >= lo) & (F.col("id") < hi)).coalesce(1).write.mode("append").parquet(src)
    out = ST.revisit_batches(ST.read_table(spark, src, "*.parquet", df.schema, 1), "rv")
    want = {(r.q_id, r.p_id) for r in J.revisit_candidates(df).collect()}
    assert {(r.q_id, r.p_id) for r in out.collect()} == want


def test_permutation_changes_nothing(spark):
    rng = np.random.default_rng(2)
    rows = [(int(f), s, float(x), float(y), float(z)) for s, (f, x, y, z) in enumerate(zip(rng.integers(0, 8, 600), *rng.uniform(0, 3, (3, 600))))]
    d = spark.createDataFrame(rows, "frame_id bigint, seq bigint, x double, y double, z double").withColumns({"support": F.lit("interpolated"), "rgb": F.lit(0), "tx": F.lit(0.0), "ty": F.lit(0.0)})
    make = lambda p: sorted(map(tuple, E.ground_layers(E.frame_ground(p, 0.5)).select("ix", "iy", "layer", "frame_count", F.round("mean_z", 9)).collect()))
    assert make(d) == make(d.orderBy(F.rand(3)).repartition(5))


def test_frame_planes_over_many_tasks(spark, monkeypatch):
    """Frames fitted in runs of whole frames: a plane a frame, none where too few points are low."""
    monkeypatch.setattr(O, "ROWS_PER_TASK", 100)
    rnd = random.Random(4)
    pts = []
    for f in range(8):
        for _ in range(6 if f == 5 else 400):
            x, y = rnd.uniform(-12, 12), rnd.uniform(-12, 12)
            pts.append((f, x, y, 0.01 * f * x - 0.02 * y - 0.8))
    rnd.shuffle(pts)
    d = spark.createDataFrame(pts, "frame_id bigint, lx double, ly double, lz double")
    got = {r.frame_id: r for r in E.frame_planes(d).filter("rank = 1").collect()}
    assert set(got) == set(range(8)) - {5}
    for f, r in got.items():
        assert (r.a, r.b, r.c) == pytest.approx((0.01 * f, -0.02, -0.8), abs=1e-9) and r.inliers >= 20


def test_many_frame_files_in_few_tasks(spark, tmp_path):
    rec = np.zeros(2, np.dtype([("x", "<f4"), ("y", "<f4"), ("z", "<f4"), ("rgb", "<u4")]))
    head = b"FIELDS x y z rgb\nSIZE 4 4 4 4\nTYPE F F F U\nCOUNT 1 1 1 1\nWIDTH 2\nHEIGHT 1\nDATA binary\n"
    for f in range(600):
        rec["x"], rec["z"] = f, np.nan if f == 7 else 1.0
        (tmp_path / f"frame_{f:06d}.pcd").write_bytes(head + rec.tobytes())
    d = S.ingest_frames(tune(spark, False), str(tmp_path))
    try:
        assert d.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism + 1
        assert sorted((r.frame_id, r.seq, r.x, r.z is None) for r in d.collect()) == [(f, i, float(f), f == 7) for f in range(600) for i in range(2)]
    finally:
        tune(spark)
        spark.conf.unset("spark.sql.files.openCostInBytes")
