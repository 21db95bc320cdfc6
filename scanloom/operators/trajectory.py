"""Trajectory matching, corrections, error metrics and revisit search."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from scanloom.functions import columns as C
from scanloom.operators import ordered as O
from scanloom.operators import spatial as S
from scanloom.session import cut


def dedupe_stamps(df: DataFrame, t: str, tie: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Last record of every stamp (partial aggregation, no window)."""
    rest = [c for c in df.columns if c not in (*keys, t)]
    return (df.groupBy(*keys, t).agg(F.max_by(F.struct(*rest), F.struct(*tie)).alias("_r"))
            .select(*keys, t, "_r.*").select(*df.columns))


def lerp(name: str, ratio: Column) -> Column:
    a, b = F.col(f"prev_{name}"), F.col(f"next_{name}")
    return a + ratio * (b - a)


def asof_interp(left: DataFrame, right: DataFrame, t: str, max_gap, cols: Sequence[str] = ("x", "y"), keys: Sequence[str] = (),
                rows_per_split: int | None = None) -> DataFrame:
    """Linear interpolation between the bracketing right rows; an equal stamp
    takes that row (ratio 0).  ``matched`` is false outside the right range and
    across gaps above ``max_gap``."""
    m = O.asof(left, right, t, keys, cols, rows_per_split)
    gap = F.col(f"next_{t}") - F.col(f"prev_{t}")
    exact = F.col(f"next_{t}") == F.col(t)
    ok = F.coalesce(exact | ((gap > 0) & (gap <= max_gap)), F.lit(False))
    ratio = F.when(exact, 0.0).otherwise((F.col(t) - F.col(f"prev_{t}")) / gap)
    m = m.withColumn("matched", ok).withColumn("ratio", F.when(ok, ratio))
    return m.withColumns({f"ref_{c}": F.when(ok, F.when(exact, F.col(f"next_{c}")).otherwise(lerp(c, F.col("ratio")))) for c in cols})


def pose_at(df: DataFrame, poses: DataFrame, t: str, max_gap, rows_per_split: int | None = None) -> DataFrame:
    """Interpolated pose (lerp + slerp); before the first and after the last
    pose that pose is used while it is within ``max_gap``."""
    pay = ["tx", "ty", "tz", "qx", "qy", "qz", "qw"]
    m = O.asof(df, poses, t, (), pay, rows_per_split, prev_strict=True)
    p, n = F.col(f"prev_{t}"), F.col(f"next_{t}")
    ok = F.when(p.isNull(), n - F.col(t) <= max_gap).when(n.isNull(), F.col(t) - p <= max_gap).otherwise(n - p <= max_gap)
    ratio = F.when(p.isNull(), 1.0).when(n.isNull(), 0.0).otherwise((F.col(t) - p) / (n - p))
    m = m.withColumns({"matched": ok, "ratio": ratio, **{f"prev_{c}": F.coalesce(f"prev_{c}", f"next_{c}") for c in pay},
                       **{f"next_{c}": F.coalesce(f"next_{c}", f"prev_{c}") for c in pay}})
    m = C.with_slerp(m, "prev_q", "next_q", "ratio")
    m = m.withColumns({f"t{a}": F.when(F.col("matched"), lerp(f"t{a}", F.col("ratio"))) for a in "xyz"})
    return m.withColumns({f"q{a}": F.when(F.col("matched"), F.col(f"q{a}")) for a in "xyzw"})


def position_at(df: DataFrame, poses: DataFrame, t: str, max_gap, cols: Sequence[str] = ("x", "y", "z"), rows_per_split: int | None = None) -> DataFrame:
    """Earlier pose within the gap, else the later one, else interpolation over
    a bracket of at most twice the gap."""
    m = O.asof(df, poses, t, (), cols, rows_per_split, prev_strict=True)
    p, n = F.col(f"prev_{t}"), F.col(f"next_{t}")
    tier = (F.when(p.isNotNull() & (F.col(t) - p <= max_gap), "prev").when(n.isNotNull() & (n - F.col(t) <= max_gap), "next")
            .when(n - p <= 2 * max_gap, "lerp"))
    m = m.withColumn("tier", tier)
    ratio = (F.col(t) - p) / (n - p)
    return m.withColumns({f"at_{c}": F.when(F.col("tier") == "prev", F.col(f"prev_{c}")).when(F.col("tier") == "next", F.col(f"next_{c}"))
                         .when(F.col("tier") == "lerp", lerp(c, ratio)) for c in cols})


def usable(df: DataFrame, poses: DataFrame, t: str, nearest, bracket, rows_per_split: int | None = None) -> DataFrame:
    m = O.asof(df, poses, t, (), (), rows_per_split)
    before, after = F.col(t) - F.col(f"prev_{t}"), F.col(f"next_{t}") - F.col(t)
    near = F.coalesce(before <= nearest, F.lit(False)) | F.coalesce(after <= nearest, F.lit(False))
    both = F.coalesce((before <= bracket) & (after <= bracket), F.lit(False))
    return m.withColumn("usable", near | both)


def nearest_pose(df: DataFrame, poses: DataFrame, t: str, payload: Sequence[str], rows_per_split: int | None = None) -> DataFrame:
    """Nearest stamp without a limit; the earlier one wins a tie."""
    m = O.asof(df, poses, t, (), payload, rows_per_split)
    before, after = F.col(t) - F.col(f"prev_{t}"), F.col(f"next_{t}") - F.col(t)
    take_prev = after.isNull() | (before <= after)
    return m.withColumn("gap", F.when(take_prev, before).otherwise(after)).withColumns(
        {f"near_{c}": F.when(take_prev, F.col(f"prev_{c}")).otherwise(F.col(f"next_{c}")) for c in payload})


POSE = ("tx", "ty", "tz", "qx", "qy", "qz", "qw")


def pose_pairs(raw: DataFrame, opt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(corrections T_opt * T_raw^-1 per keyframe, violations of the pairing)."""
    o = opt.select("id", F.col("ts").alias("opt_ts"), *[F.col(c).alias(f"o_{c}") for c in POSE])
    both = raw.select("id", "ts", *POSE).join(o, "id", "full")
    why = (F.when(F.col("opt_ts").isNull(), "missing optimised").when(F.col("ts").isNull(), "missing raw")
           .when(F.abs(F.col("ts") - F.col("opt_ts")) > 1e-6, "stamp differs"))
    bad = both.withColumn("violation", why).filter(F.col("violation").isNotNull()).select("id", "violation")
    # in time order stamps rise strictly unless one repeats: all but the first id of a stamp are out of order
    at = raw.groupBy("ts").agg(F.min("id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    again = raw.select("id", "ts").join(at, "ts").filter(F.col("id") > F.col("_first")).select("id", F.lit("stamp not increasing").alias("violation"))
    bad = bad.unionByName(again)
    qi, ti = C.inverse(C.q_normalise(C.quat()), C.vec())
    pairs = both.filter(F.col("ts").isNotNull() & F.col("opt_ts").isNotNull()).select(
        "id", "ts", *POSE, *[f"o_{c}" for c in POSE], *[v.alias(f"i_{c}") for c, v in zip(POSE, (*ti, *qi))])
    q, t = C.compose(C.q_normalise(C.quat("o_q")), C.vec("o_t"), C.quat("i_q"), C.vec("i_t"))
    return pairs.select("id", "ts", *POSE, *[f"o_{c}" for c in POSE], *[v.alias(f"c_{c}") for c, v in zip(POSE, (*t, *C.q_normalise(q)))]), bad


def round_trip(pairs: DataFrame) -> DataFrame:
    """Residual of correction * raw against the optimised pose."""
    q, t = C.compose(C.quat("c_q"), C.vec("c_t"), C.q_normalise(C.quat()), C.vec())
    p = pairs.select("*", *[v.alias(f"r_{c}") for c, v in zip(POSE, (*t, *C.q_normalise(q)))])
    dist = C.hypot(*[F.col(f"r_t{a}") - F.col(f"o_t{a}") for a in "xyz"])
    return p.select("id", dist.alias("translation_residual_m"), F.radians(C.rotation_angle_deg(C.quat("r_q"), C.q_normalise(C.quat("o_q")))).alias("rotation_residual_rad"))


def correct(frames: DataFrame, corrections: DataFrame, t: str = "ts", rows_per_split: int | None = None) -> DataFrame:
    """Map correction at each frame: interpolated between keyframes, clamped
    (with a support label) outside them.  ``corrections``: id, ts, c_*."""
    pay = ["id", *[f"c_{c}" for c in POSE]]
    m = O.asof(frames, corrections, t, (), pay, rows_per_split, next_strict=True)
    p, n = F.col(f"prev_{t}"), F.col(f"next_{t}")
    support = (F.when(p.isNull(), "clamped_before_first_keyframe").when(n.isNull(), "clamped_after_last_keyframe").otherwise("interpolated"))
    m = m.withColumns({"support": support, "alpha": F.when(p.isNull() | n.isNull(), 0.0).otherwise((F.col(t) - p) / (n - p)),
                       "nearest_dt": F.least(F.col(t) - p, n - F.col(t))})
    m = m.withColumns({f"_a_{c}": F.coalesce(f"prev_{c}", f"next_{c}") for c in pay}).withColumns({f"_b_{c}": F.coalesce(f"next_{c}", f"prev_{c}") for c in pay})
    u = F.col("alpha")
    m = m.withColumns({f"map_odom_t{a}": F.col(f"_a_c_t{a}") + u * (F.col(f"_b_c_t{a}") - F.col(f"_a_c_t{a}")) for a in "xyz"})
    m = C.with_slerp(m, "_a_c_q", "_b_c_q", "alpha", "map_odom_q")
    return m.select(*frames.columns, *[f"map_odom_{c}" for c in POSE], "support", F.col("_a_id").alias("lower_keyframe_id"),
                    F.col("_b_id").alias("upper_keyframe_id"), "alpha", "nearest_dt")


def latest_correction(pairs: DataFrame) -> DataFrame:
    cols = ["id", *[f"c_{c}" for c in POSE]]
    return pairs.agg(F.max_by(F.struct(*cols), "id").alias("_l")).select("_l.*")


# --- metrics ------------------------------------------------------------------
def error_metrics(pairs: DataFrame, keys: Sequence[str] = (), err: str = "error", rows_per_split: int | None = None) -> DataFrame:
    base = pairs.groupBy(*keys).agg(F.count(err).alias("count"), F.avg(err).alias("mae_m"), F.sqrt(F.avg(F.col(err) * F.col(err))).alias("rmse_m"))
    p95 = O.order_statistic(pairs.select(*keys, err), keys, err, {"p95_m": O.nearest_rank(0.95)}, rows_per_split).drop("n")
    if keys:
        return base.join(p95, list(keys))
    return base.crossJoin(F.broadcast(p95))  # one row each


def component_metrics(pairs: DataFrame, rows_per_split: int | None = None) -> DataFrame:
    """Signed means and absolute statistics of dx and dy, one row."""
    long = pairs.select(F.explode(F.array(F.struct(F.lit("dx").alias("axis"), F.col("dx").alias("v")), F.struct(F.lit("dy").alias("axis"), F.col("dy").alias("v")))).alias("_e"))
    long = long.select("_e.axis", "_e.v", F.abs("_e.v").alias("error"))
    m = error_metrics(long, ["axis"], rows_per_split=rows_per_split).join(long.groupBy("axis").agg(F.avg("v").alias("signed")), "axis")
    pick = lambda a, c: F.max(F.when(F.col("axis") == a, F.col(c)))
    out = [pick(a, "signed").alias(f"signed_mean_{a}_m") for a in ("dx", "dy")]
    out += [pick(a, f"{k}_m").alias(f"abs_{a}_{k}_m") for a in ("dx", "dy") for k in ("mae", "rmse", "p95")]
    return m.agg(*out)


def metrics_report(pairs: DataFrame, rows_per_split: int | None = None) -> DataFrame:
    """Error, dx and dy statistics over all pairs, by ``segment`` and by cell, in one pass.

    ``pairs``: ``error, dx, dy, segment, cell_ix, cell_iy``.  Values are counted once by
    (segment, cell, kind, value); the grouping sets are sums of these counts, and the
    P95 of all sets is read from the same counts by rank, so no set reads the pairs again.
    ``grouping``: 0 all, 1 segment, 2 cell."""
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("v")) for k in ("error", "dx", "dy")])).alias("_e")
    each = pairs.select("segment", "cell_ix", "cell_iy", kinds).select("segment", "cell_ix", "cell_iy", "_e.kind", "_e.v")
    counts = cut(each.filter(F.col("v").isNotNull()).groupBy("segment", "cell_ix", "cell_iy", "kind", "v").agg(F.count(F.lit(1)).alias("_n")), "histogram")
    # The value is in every set here, so a set's histogram is as exact as the first.
    sets = [["kind", "v"], ["kind", "v", "segment"], ["kind", "v", "cell_ix", "cell_iy"]]
    hist = counts.groupingSets(sets, "kind", "v", "segment", "cell_ix", "cell_iy").agg(F.sum("_n").alias("_n"), F.grouping_id().alias("_g"))
    hist = hist.withColumn("grouping", F.when(F.col("_g") == 7, 0).when(F.col("_g") == 3, 1).otherwise(2))
    # Nulls are values of their own and must meet in the join.
    name = F.concat_ws(",", "kind", "grouping", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("segment", "cell_ix", "cell_iy")])
    hist = cut(hist.select(name.alias("_set"), "grouping", "kind", "segment", "cell_ix", "cell_iy", "v", F.abs("v").alias("_a"), "_n"), "sets")
    n = F.sum("_n")
    base = hist.groupBy("_set", "grouping", "kind", "segment", "cell_ix", "cell_iy").agg(n.alias("count"), (F.sum(F.col("v") * F.col("_n")) / n).alias("signed_mean_m"), (F.sum(F.col("_a") * F.col("_n")) / n).alias("mae_m"), F.sqrt(F.sum(F.col("v") * F.col("v") * F.col("_n")) / n).alias("rmse_m"))
    p95 = O.order_statistic(hist.select("_set", "_a", "_n"), ["_set"], "_a", {"p95_m": O.nearest_rank(0.95)}, rows_per_split, "_n").drop("n")
    return base.join(p95, "_set").drop("_set")


def matched_pairs(left: DataFrame, right: DataFrame, t: str, max_gap, rows_per_split: int | None = None) -> DataFrame:
    m = asof_interp(left, right, t, max_gap, rows_per_split=rows_per_split).filter("matched")
    m = m.withColumns({"dx": F.col("x") - F.col("ref_x"), "dy": F.col("y") - F.col("ref_y")})
    return m.withColumn("error", C.hypot("dx", "dy"))


def path_length(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str] = ("x", "y", "z"), rows_per_split: int | None = None) -> DataFrame:
    return with_steps(df, keys, order, cols, rows_per_split).groupBy(*keys).agg(F.coalesce(F.sum("step_m"), F.lit(0.0)).alias("path_length_m"))


def with_steps(df: DataFrame, keys, order, cols=("x", "y", "z"), rows_per_split=None) -> DataFrame:
    nb = O.neighbour(df, keys, order, {f"_p{c}": F.col(c) for c in cols}, rows_per_split=rows_per_split)
    return nb.withColumn("step_m", C.hypot(*[F.col(c) - F.col(f"_p{c}") for c in cols])).drop(*[f"_p{c}" for c in cols])


def cumulative_length(df: DataFrame, keys, order, cols=("x", "y"), rows_per_split=None) -> DataFrame:
    s = with_steps(df, keys, order, cols, rows_per_split)
    return O.running(s, keys, order, {"arc_m": ("sum", F.coalesce("step_m", F.lit(0.0)))}, rows_per_split).drop("step_m")


def monotonicity(df: DataFrame, keys, arrival: Sequence[str], t: str, rows_per_split=None) -> DataFrame:
    """Strict failures (later <= earlier) and backward steps (later < earlier)."""
    nb = O.neighbour(df, keys, arrival, {"_pt": F.col(t)}, rows_per_split=rows_per_split)
    return nb.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(t) <= F.col("_pt")).alias("not_increasing"),
                                 F.count_if(F.col(t) < F.col("_pt")).alias("backward"))


def origin_normalise(df: DataFrame, keys, order, cols=("x", "y", "z")) -> DataFrame:
    f = O.first_per(df, keys, order, {f"_o{c}": F.col(c) for c in cols})
    return f.withColumns({c: F.col(c) - F.col(f"_o{c}") for c in cols}).drop(*[f"_o{c}" for c in cols])


def trajectory_delta(stamps: DataFrame, a: DataFrame, b: DataFrame, t: str, max_gap, rows_per_split=None) -> DataFrame:
    """Distance between two runs, each relative to its first position."""
    cols = ("x", "y", "z")
    rel = []
    for name, run in (("a", a), ("b", b)):
        first = run.agg(F.min_by(F.struct(*cols), t).alias("f")).select(*[F.col(f"f.{c}").alias(f"o_{c}") for c in cols])
        m = position_at(stamps.select(t), run, t, max_gap, cols, rows_per_split).filter(F.col("tier").isNotNull())
        rel.append(m.crossJoin(F.broadcast(first)).select(t, *[(F.col(f"at_{c}") - F.col(f"o_{c}")).alias(f"{name}_{c}") for c in cols]))
    d = rel[0].join(rel[1], t).withColumn("error", C.hypot(*[F.col(f"a_{c}") - F.col(f"b_{c}") for c in cols]))
    stats = error_metrics(d, rows_per_split=rows_per_split)
    rest = d.agg(F.max("error").alias("max_m"), F.max_by("error", t).alias("last_m"))
    lens = [path_length(r, [], [t], cols, rows_per_split).withColumnRenamed("path_length_m", n) for r, n in ((a, "len_a"), (b, "len_b"))]
    out = stats.select("count", F.col("mae_m").alias("mean_m"), "p95_m")
    for part in (rest, *lens):
        out = out.crossJoin(F.broadcast(part))  # one row each
    return out.withColumn("length_ratio", F.when(F.col("len_a") > 1e-9, F.col("len_b") / F.col("len_a")))


def run_summary(messages: DataFrame, arrival: Sequence[str], rows_per_split=None) -> DataFrame:
    """Per topic: count, span, order failures and path length."""
    mono = monotonicity(messages, ["topic"], arrival, "ts_ns", rows_per_split)
    span = messages.groupBy("topic").agg(((F.max("ts_ns") - F.min("ts_ns")) / 1e9).alias("duration_s"))
    length = path_length(messages, ["topic"], ["ts_ns", "event_id"], ("x", "y"), rows_per_split)
    return mono.join(span, "topic").join(length, "topic")


# --- bundles and keyframes ------------------------------------------------------
def bundle(records: DataFrame, images: DataFrame, t: str, inclusive: bool, rows_per_split=None) -> DataFrame:
    """Bundle of each record: the first capture at or after it (inertial rows,
    ``inclusive``) or strictly after it (scan points); ``rebased`` counts from
    the previous capture.  Records after the last capture stay pending (null)."""
    m = O.asof(records, images, t, (), ("image_id",), rows_per_split, prev_strict=inclusive, next_strict=not inclusive)
    return m.select(*records.columns, F.col("next_image_id").alias("bundle_id"), (F.col(t) - F.col(f"prev_{t}")).alias("rebased"))


def revisit_candidates(kf: DataFrame, min_gap: int = 20, min_dt: float = 30.0, radius: float = 10.0, cap: int = S.NEAREST_CAP, points: DataFrame | None = None) -> DataFrame:
    """Nearest earlier keyframe, far enough in index and time, among ``points`` (else
    among the keyframes themselves).  kf: id, ts, x, y, z."""
    ok = (F.col("q.id") - F.col("p.id") >= min_gap) & (F.abs(F.col("q.ts") - F.col("p.ts")) >= min_dt)
    # A cell surely holds an allowed point when its earliest keyframe is allowed.
    surely = lambda _: (F.col("id") - F.col("_min_id") >= min_gap) & (F.col("ts") - F.col("_ts_of_min") >= min_dt)
    return S.nearest_within(kf, kf if points is None else points, ["x", "y", "z"], radius, "id", "id", {"_min_id": F.min("id"), "_ts_of_min": F.min_by("ts", "id")},
                            surely, ok, ["ts"], ["ts"], cap)


def submap(kf_points: DataFrame, centres: DataFrame, k: int = 20, leaf: float = 0.4) -> DataFrame:
    """Voxel centroids of the frames within +-k of each centre.  The points are
    thinned per frame and voxel first; a frame serves at most 2k+1 centres."""
    thin = kf_points.groupBy("frame_id", C.cell("x", leaf).alias("ix"), C.cell("y", leaf).alias("iy"), C.cell("z", leaf).alias("iz")).agg(
        *[F.sum(c).alias(c) for c in "xyz"], F.count(F.lit(1)).alias("n"))
    span = centres.select(F.col("frame_id").alias("centre_id"), F.explode(F.sequence(F.col("frame_id") - k, F.col("frame_id") + k)).alias("frame_id"))
    g = thin.join(span, "frame_id").groupBy("centre_id", "ix", "iy", "iz").agg(*[F.sum(c).alias(c) for c in "xyz"], F.sum("n").alias("n"))
    return g.select("centre_id", "ix", "iy", "iz", *[(F.col(c) / F.col("n")).alias(c) for c in "xyz"], "n")


def crossings(samples: DataFrame, min_ids: int = 15, radius: float = 3.0, max_cos: float = 0.82, cell_m: float = 2.0) -> DataFrame:
    """Samples passed by a differently oriented part of the trajectory.  The 3x3
    stencil of 2 m cells is part of the definition.

    Samples are summarised per quarter cell and heading sector first.  Most are
    settled by a summary (whole box near enough, whole sector turned enough, an
    id far enough); only the undecided ones meet the samples of the summaries
    that leave room for doubt."""
    sub, sector = cell_m / 4, math.pi / 24
    s = samples.select("id", "x", "y", "tx", "ty")
    keyed = s.withColumns({"ix": C.cell("x", cell_m), "iy": C.cell("y", cell_m), "sx": C.cell("x", sub), "sy": C.cell("y", sub),
                           "ang": C.half_turn(F.atan2("ty", "tx"))}).withColumn("sec", C.cell("ang", sector))
    group = ["ix", "iy", "sx", "sy", "sec"]
    sums = keyed.groupBy(*group).agg(F.min("id").alias("lo"), F.max("id").alias("hi"), *[f(c).alias(f"{n}_{c}") for c in ("x", "y", "ang") for n, f in (("a", F.min), ("b", F.max))])
    m = S.with_offsets(keyed.select("id", "x", "y", "tx", "ty", "ang", "ix", "iy"), ["ix", "iy"], S.square(1)).join(sums, ["ix", "iy"])
    far_id = (F.col("lo") < F.col("id") - min_ids) | (F.col("hi") > F.col("id") + min_ids)
    far = C.hypot(F.greatest(F.abs(F.col("a_x") - F.col("x")), F.abs(F.col("b_x") - F.col("x"))), F.greatest(F.abs(F.col("a_y") - F.col("y")), F.abs(F.col("b_y") - F.col("y"))))
    near = C.hypot(F.greatest(F.col("a_x") - F.col("x"), F.col("x") - F.col("b_x"), F.lit(0.0)), F.greatest(F.col("a_y") - F.col("y"), F.col("y") - F.col("b_y"), F.lit(0.0)))
    slack = 1e-9
    # |cos| of the angle to both sector ends; its extremes lie at the ends
    # unless the sector contains the heading itself or its normal.
    c1, c2 = F.abs(F.cos(F.col("ang") - F.col("a_ang"))), F.abs(F.cos(F.col("ang") - F.col("b_ang")))
    d1, d2 = F.cos(F.col("ang") - F.col("a_ang")), F.cos(F.col("ang") - F.col("b_ang"))
    holds = (F.col("ang") >= F.col("a_ang") - slack) & (F.col("ang") <= F.col("b_ang") + slack)
    most = F.when(holds, 1.0).otherwise(F.greatest(c1, c2))
    least = F.when(d1 * d2 <= 0, 0.0).otherwise(F.least(c1, c2))
    m = m.withColumn("sure", far_id & (far <= radius - slack) & (most < max_cos - slack)).withColumn("maybe", far_id & (near <= radius + slack) & (least < max_cos + slack))
    state = m.filter("maybe").groupBy("id").agg(F.max("sure").alias("sure"))
    open_ = m.filter("maybe").join(state.filter(~F.col("sure")).select("id"), "id")
    pair = open_.select("id", "x", "y", "tx", "ty", *group).alias("a").join(keyed.alias("b"), group).filter(
        (F.abs(F.col("a.id") - F.col("b.id")) > min_ids) & (C.hypot(F.col("a.x") - F.col("b.x"), F.col("a.y") - F.col("b.y")) <= radius)
        & (F.abs(F.col("a.tx") * F.col("b.tx") + F.col("a.ty") * F.col("b.ty")) < max_cos))
    return state.filter("sure").select("id").union(pair.select(F.col("a.id").alias("id"))).distinct()


def imu_static(imu: DataFrame, n: int, order: Sequence[str], acc=("ax", "ay", "az"), gyro=("gx", "gy", "gz"), g: float = 9.81) -> DataFrame:
    """Mean of the first n samples; gravity opposes the mean acceleration."""
    head = imu.orderBy(*order).limit(n)
    m = head.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in (*acc, *gyro)])
    norm = C.hypot(*[f"mean_{c}" for c in acc])
    return m.withColumns({f"gravity_{a}": -F.col(f"mean_{c}") / norm * g for a, c in zip("xyz", acc)})


def resample(df: DataFrame, keys: Sequence[str], order: Sequence[str], spacing: float, reach: int = 12, rows_per_split=None) -> DataFrame:
    """Arc-length down-sampling with the tangent over +-reach rows; first and
    last rows stay, tangents shorter than 0.05 drop."""
    s = with_steps(df, keys, order, ("x", "y"), rows_per_split)
    s = O.row_index(s, keys, order, "idx", rows_per_split)
    ends = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min_by(F.struct("x", "y"), F.struct(*order)).alias("_f"), F.max_by(F.struct("x", "y"), F.struct(*order)).alias("_l"))
    s = s.join(ends, list(keys))
    h = O.halo_chunks(s, keys, "idx", reach, reach)
    w = W.partitionBy(*keys, "_chunk").orderBy("idx")
    at = F.struct("x", "y")
    h = h.select("*", F.coalesce(F.lag(at, reach).over(w), F.col("_f")).alias("_b"), F.coalesce(F.lead(at, reach).over(w), F.col("_l")).alias("_e")).filter("_core")
    h = h.withColumns({"_tx": F.col("_e.x") - F.col("_b.x"), "_ty": F.col("_e.y") - F.col("_b.y")}).withColumn("_norm", C.hypot("_tx", "_ty"))
    keep = h.select(*keys, *order, *[c for c in ("x", "y") if c not in order], F.coalesce("step_m", F.lit(0.0)).alias("step_m"), "idx", "_n", "_tx", "_ty", "_norm")

    def scan(pdf: pd.DataFrame, state):
        acc, flags = state or 0.0, []
        for step, i, n in zip(pdf["step_m"], pdf["idx"], pdf["_n"]):
            acc += step
            hit = i == 1 or i == n or acc >= spacing
            flags.append(hit)
            if hit:
                acc = 0.0
        return pdf[flags], acc

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep.schema.fields)
    out = O.carried_scan(keep, keys, ["idx"], scan, ddl, rows_per_split).filter(F.col("_norm") >= 0.05)
    return out.withColumns({"tangent_x": F.col("_tx") / F.col("_norm"), "tangent_y": F.col("_ty") / F.col("_norm")}).drop("_tx", "_ty", "_norm", "_n", "step_m")


def keyframes(df: DataFrame, keys: Sequence[str], order: Sequence[str], warm_up: float = 5.0, min_dt: float = 0.5, min_move: float = 1.5,
              min_turn_deg: float = 10.0, rows_per_split=None) -> DataFrame:
    """Poses selected against the last *selected* one: after the warm-up, at
    least ``min_dt`` later and moved or turned enough."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    first = df.groupBy(*keys).agg(F.min("ts").alias("_t0"))
    return O.carried_scan(df.join(first, list(keys)), keys, order, keyframe_step(warm_up, min_dt, min_move, min_turn_deg, list(df.columns)), ddl, rows_per_split)


def keyframe_step(warm_up, min_dt, min_move, min_turn_deg, columns):
    """The selection automaton, shared by the batch and the streaming form."""
    def scan(pdf: pd.DataFrame, state):
        last, flags = state, []
        cols = [pdf[c].to_numpy() for c in ("ts", "tx", "ty", "tz", "qx", "qy", "qz", "qw", "_t0")]
        for ts, x, y, z, qx, qy, qz, qw, t0 in zip(*cols):
            hit = ts - t0 >= warm_up
            if hit and last is not None:
                lt, lx, ly, lz, a, b, c, d = last
                turn = math.degrees(2 * math.acos(min(1.0, abs(a * qx + b * qy + c * qz + d * qw))))
                move = math.sqrt((x - lx) ** 2 + (y - ly) ** 2 + (z - lz) ** 2)
                hit = ts - lt >= min_dt and (move >= min_move or turn >= min_turn_deg)
            if hit:
                last = [float(v) for v in (ts, x, y, z, qx, qy, qz, qw)]
            flags.append(bool(hit))
        return pdf[flags][columns], last

    return scan
