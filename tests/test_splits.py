"""Order-dependent operators: many splits and a hot key give the plain result."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from scanloom.operators import boundaries as B
from scanloom.operators import ordered as O
from scanloom.operators import points as P
from scanloom.operators import trajectory as J


@pytest.fixture(scope="module")
def hot(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(4)}", i, rnd.randrange(40) / 4.0, rnd.random() < 0.3) for i in rnd.sample(range(5000), 700)]
    return pd.DataFrame(rows, columns=["k", "t", "v", "b"]).sort_values(["k", "t"]).reset_index(drop=True)


def frame(spark, pdf):
    return spark.createDataFrame(pdf.sample(frac=1, random_state=1))


def same(df, want, cols):
    got = df.select(*cols).toPandas().sort_values(cols[:2]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want[cols].sort_values(cols[:2]).reset_index(drop=True), check_dtype=False)


def test_running_and_index(spark, hot):
    df = frame(spark, hot)
    out = O.running(df, ["k"], ["t"], {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "l": ("min", F.col("v"))}, 50)
    g = hot.groupby("k")["v"]
    same(out, hot.assign(s=g.cumsum(), m=g.cummax(), l=g.cummin()), ["k", "t", "s", "m", "l"])
    same(O.row_index(df, ["k"], ["t"], "idx", 50), hot.assign(idx=hot.groupby("k").cumcount() + 1), ["k", "t", "idx"])


def test_neighbour_and_sessions(spark, hot):
    df = frame(spark, hot)
    same(O.neighbour(df, ["k"], ["t"], {"p": F.col("v")}, rows_per_split=50), hot.assign(p=hot.groupby("k")["v"].shift(1)), ["k", "t", "p"])
    same(O.neighbour(df, ["k"], ["t"], {"p": F.col("v")}, True, 50), hot.assign(p=hot.groupby("k")["v"].shift(-1)), ["k", "t", "p"])
    s = O.sessionize(df, ["k"], ["t"], {"t": F.col("t")}, lambda p: F.col("t") - p["t"] > 20, rows_per_split=50)
    gap = hot.groupby("k")["t"].diff().gt(20).astype(int)
    same(s, hot.assign(session_id=gap.groupby(hot["k"]).cumsum() + 1), ["k", "t", "session_id"])


@pytest.mark.parametrize("size", [None, 40])
def test_order_statistic(spark, hot, size):
    out = O.order_statistic(frame(spark, hot), ["k"], "v", {"p95": O.nearest_rank(0.95), **O.median_ranks()}, size).toPandas().set_index("k")
    for k, g in hot.groupby("k")["v"]:
        v = sorted(g)
        assert out.loc[k, "n"] == len(v)
        assert out.loc[k, "p95"] == v[max(0, math.ceil(0.95 * len(v)) - 1)]
        assert (out.loc[k, "med_lo"] + out.loc[k, "med_hi"]) / 2 == g.median()


@pytest.mark.parametrize("size", [None, 30])
@pytest.mark.parametrize("strict", [False, True])
def test_asof(spark, hot, size, strict):
    left, right = hot[~hot["b"]], hot[hot["b"]]
    right = pd.concat([right, left.iloc[::17].assign(v=-1.0)])
    out = O.asof(frame(spark, left[["k", "t"]]), frame(spark, right[["k", "t", "v"]]), "t", ["k"], ["v"], size, strict, strict).toPandas()
    assert len(out) == len(left)
    for _, r in out.iterrows():
        c = right[right["k"] == r["k"]]
        lo, hi = c[c["t"] < r["t"]] if strict else c[c["t"] <= r["t"]], c[c["t"] > r["t"]] if strict else c[c["t"] >= r["t"]]
        assert (pd.isna(r["prev_t"]) and lo.empty) or r["prev_v"] == lo.sort_values("t")["v"].iloc[-1]
        assert (pd.isna(r["next_t"]) and hi.empty) or r["next_v"] == hi.sort_values("t")["v"].iloc[0]


def test_carried_scan(spark, hot):
    def step(pdf, state):
        acc, out = state or 0.0, []
        for v in pdf["v"]:
            acc = 0.0 if acc + v > 30 else acc + v
            out.append(acc)
        return pdf.assign(acc=out)[["k", "t", "acc"]], acc

    want = pd.concat([step(g, None)[0] for _, g in hot.groupby("k")])
    for size in (None, 60):
        same(O.carried_scan(frame(spark, hot), ["k"], ["t"], step, "k string, t bigint, acc double", size), want, ["k", "t", "acc"])


def test_halo_chunks(spark, hot):
    from pyspark.sql import Window as W
    idx = O.row_index(frame(spark, hot), ["k"], ["t"], "idx", 50)
    h = O.halo_chunks(idx, ["k"], "idx", 3, 3, 10)
    w = W.partitionBy("k", "_chunk").orderBy("idx").rowsBetween(-3, 3)
    out = h.select("*", F.sum("v").over(w).alias("s")).filter("_core")
    want = hot.assign(s=hot.groupby("k")["v"].transform(lambda g: g.rolling(7, center=True, min_periods=1).sum()))
    same(out, want, ["k", "t", "s"])


def scan_points(spark):
    rnd = random.Random(5)
    rows = [(0 if i % 3 else 1, i, rnd.random(), rnd.random(), rnd.random(), rnd.randrange(4), 16 * rnd.randrange(4), rnd.randrange(1 << 24), rnd.randrange(60) / 16.0) for i in range(400)]
    return spark.createDataFrame(rows, "frame_id bigint, seq bigint, x double, y double, z double, ring int, tag int, rgb int, time double")


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("make", [
    lambda p, n: P.drop_repeats(p, 3, rows_per_split=n).select("frame_id", "seq"),
    lambda p, n: P.normalise(p, "avia", 3, 2, 0.1, n).select("frame_id", "seq", "offset_ms"),
    lambda p, n: P.yaw_time(p, n).select("frame_id", "ring", "seq", "offset_ms"),
])
def test_normalisers(spark, make):
    p = scan_points(spark)
    assert rows(make(p, None)) == rows(make(p, 40))


def test_keyframes_and_resample(spark):
    rnd = random.Random(9)
    pose, x = [], 0.0
    for i in range(300):
        x += rnd.random()
        a = rnd.random() * 0.2
        pose.append((0, i * 0.25, x, 0.0, 0.0, 0.0, 0.0, math.sin(a), math.cos(a)))
    p = spark.createDataFrame(pose, "run int, ts double, tx double, ty double, tz double, qx double, qy double, qz double, qw double")
    assert rows(J.keyframes(p, ["run"], ["ts"])) == rows(J.keyframes(p, ["run"], ["ts"], rows_per_split=40))
    t = p.select("run", "ts", F.col("tx").alias("x"), F.col("ty").alias("y"))
    a, b = J.resample(t, ["run"], ["ts"], 2.0), J.resample(t, ["run"], ["ts"], 2.0, rows_per_split=40)
    assert rows(a.select("ts", F.round("tangent_x", 9))) == rows(b.select("ts", F.round("tangent_x", 9)))


def test_edge_tracks(spark):
    rnd = random.Random(2)
    rows_ = [(i, 1, k + 1, (k + 1) * 1.5 + rnd.random() * 0.6, float(i), 0.0, 0.0, 1) for i in range(120) if i % 11 for k in range(rnd.randrange(4))]
    c = spark.createDataFrame(rows_, "sample_id bigint, side int, cluster bigint, lateral double, px double, py double, pz double, raw_count bigint")
    assert rows(B.edge_tracks(c).select("sample_id", "cluster", "track")) == rows(B.edge_tracks(c, rows_per_split=25).select("sample_id", "cluster", "track"))


def test_groups_lie_in_few_splits(spark):
    """Splits follow the group first, so pairs of group and split do not multiply."""
    df = spark.range(1000).selectExpr("id % 50 AS k", "id AS t")
    sp, n = O.add_split(df, ["k"], ["t"], 100)
    assert n == 10 and sp.select("k", "_split").distinct().count() <= 50 + n
    assert sp.groupBy("k", "_split").agg(F.min("t").alias("a"), F.max("t").alias("b")).count() == sp.select("k", "_split").distinct().count()


def test_scan_of_a_null_group_over_splits(spark):
    def scan(pdf, state):
        total = state or 0
        out = []
        for v in pdf["v"]:
            total += int(v)
            out.append(total)
        return pdf.assign(s=out), total

    rows = [(None if i % 2 else i % 6, i, i % 3) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    got = {(r.t, r.s) for r in O.carried_scan(df, ["k"], ["t"], scan, "k int, t int, v int, s bigint", 10).collect()}
    sums, want = {}, set()
    for k, t, v in rows:
        sums[k] = sums.get(k, 0) + v
        want.add((t, sums[k]))
    assert got == want
