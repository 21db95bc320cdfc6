"""Lines, boundary bands, corridors, curbs and sidewalks."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from scanloom.functions import columns as C
from scanloom.operators import ordered as O
from scanloom.operators import spatial as S

COS = lambda deg: math.cos(math.radians(deg))


# --- lines --------------------------------------------------------------------
def linear_support(points: DataFrame, r: float = 1.5, min_n: int = 5, min_major: float = 0.12, min_ratio: float = 0.72) -> DataFrame:
    """Tangent of points whose neighbourhood (self included) is elongated.
    ``points``: unique positions (x, y) with an id, such as grid edge centres."""
    m = S.neighbours(points, r).select("id", (F.col("o_x") - F.col("x")).alias("u"), (F.col("o_y") - F.col("y")).alias("v"))
    g = m.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("u").alias("su"), F.sum("v").alias("sv"), *[F.sum(F.col(a) * F.col(b)).alias(a + b) for a, b in ("uu", "uv", "vv")])
    g = g.filter(F.col("n") >= min_n).select("id", "n", (F.col("uu") - F.col("su") * F.col("su") / F.col("n")).alias("xx"), (F.col("uv") - F.col("su") * F.col("sv") / F.col("n")).alias("xy"), (F.col("vv") - F.col("sv") * F.col("sv") / F.col("n")).alias("yy"))
    hi, lo = C.eig2(F.col("xx"), F.col("xy"), F.col("yy"))
    g = g.withColumns({"hi": hi, "lo": lo}).filter((F.col("hi") >= min_major) & ((F.col("hi") - F.col("lo")) / F.col("hi") >= min_ratio))
    return with_tangent(g, "xx", "xy", "hi").select("id", "tx", "ty").join(points, "id")


def with_tangent(df: DataFrame, xx: str, xy: str, hi: str, signed: bool = False) -> DataFrame:
    """Unit eigenvector (xy, hi - xx); ``signed`` turns it into the half plane x > 0."""
    d = df.withColumns({"_tx": F.col(xy), "_ty": F.col(hi) - F.col(xx)}).withColumn("_n", C.hypot("_tx", "_ty"))
    ok = F.col("_n") >= 1e-9
    d = d.withColumns({"tx": F.when(ok, F.col("_tx") / F.col("_n")).otherwise(1.0), "ty": F.when(ok, F.col("_ty") / F.col("_n")).otherwise(0.0)})
    if signed:
        flip = (F.col("tx") < 0) | ((F.abs("tx") < 1e-9) & (F.col("ty") < 0))
        d = d.withColumn("_f", F.when(flip, -1.0).otherwise(1.0)).withColumns({"tx": F.col("tx") * F.col("_f"), "ty": F.col("ty") * F.col("_f")}).drop("_f")
    return d.drop("_tx", "_ty", "_n")


def fit_lines(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total-least-squares line per group: tangent, normal, rho, mean, count."""
    x0 = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"), F.avg(F.col("x") * F.col("x")).alias("_xx"), F.avg(F.col("x") * F.col("y")).alias("_xy"), F.avg(F.col("y") * F.col("y")).alias("_yy"))
    g = x0.withColumns({"xx": F.col("_xx") - F.col("mx") * F.col("mx"), "xy": F.col("_xy") - F.col("mx") * F.col("my"), "yy": F.col("_yy") - F.col("my") * F.col("my")})
    g = g.withColumn("hi", C.eig2(F.col("xx"), F.col("xy"), F.col("yy"))[0])
    g = with_tangent(g, "xx", "xy", "hi", True).withColumns({"nx": -F.col("ty"), "ny": F.col("tx")})
    return g.withColumn("rho", F.col("nx") * F.col("mx") + F.col("ny") * F.col("my")).select(*keys, "n", "tx", "ty", "nx", "ny", "rho", "mx", "my")


ANGLE_BINS, RHO_M = 180, 0.20
#: Voters that a peak without a line gives up, so that the next one can win.
RETIRED = 8


def hough_votes(points: DataFrame) -> DataFrame:
    """Each point votes for seven normal directions around its own."""
    angle = C.half_turn(F.atan2("ty", "tx") + math.pi / 2)
    centre = F.pmod(F.bround(angle / math.pi * ANGLE_BINS).cast("long"), F.lit(ANGLE_BINS))
    v = points.select("x", "y", F.explode(F.transform(F.sequence(F.lit(-3), F.lit(3)), lambda o: F.pmod(centre + o, F.lit(ANGLE_BINS)))).alias("theta_bin"))
    th = F.col("theta_bin") * math.pi / ANGLE_BINS
    return v.groupBy("theta_bin", F.bround((F.col("x") * F.cos(th) + F.col("y") * F.sin(th)) / RHO_M).cast("long").alias("rho_bin")).agg(F.count(F.lit(1)).alias("votes"))


def hough_peak(points: DataFrame) -> DataFrame:
    return hough_votes(points).orderBy(F.desc("votes"), "theta_bin", "rho_bin").limit(1)


def near_line(line: dict, cos_min: float, dist: float) -> Column:
    return (F.abs(F.col("tx") * line["tx"] + F.col("ty") * line["ty"]) >= cos_min) & (F.abs(F.col("x") * line["nx"] + F.col("y") * line["ny"] - line["rho"]) <= dist)


def refine_peak(points: DataFrame, peak, min_inliers: int = 8):
    """Line (a one-row summary) refined three times from a vote peak."""
    th = peak["theta_bin"] * math.pi / ANGLE_BINS
    line = {"nx": math.cos(th), "ny": math.sin(th), "tx": math.sin(th), "ty": -math.cos(th), "rho": peak["rho_bin"] * RHO_M}
    keep = near_line(line, 0.75, 0.30)
    for _ in range(3):
        fit = fit_lines(points.filter(keep).select("x", "y", F.lit(0).alias("k")), ["k"]).first()
        if fit is None or fit["n"] < min_inliers:
            return None
        line = {k: fit[k] for k in ("tx", "ty", "nx", "ny", "rho")}
        keep = near_line(line, 0.70, 0.18)
    return line, keep


def extract_lines(points: DataFrame, tile: float = 20.0, max_lines: int | None = None, gap: float = 3.0, min_length: float = 2.0, min_inliers: int = 8) -> DataFrame:
    """Lines of every tile at once.  A tile holds unique lattice positions, so
    its size is bounded; inside it the strongest line is taken, its inliers are
    removed, and so on, until too few points are left (or ``max_lines``, if
    given).  Lines running across tiles are rejoined by
    ``mutual_best`` and ``join_fragments``.  Input: id, x, y, tx, ty."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["x", "y", "id"], kind="stable")
        p, t, ids = pdf[["x", "y"]].to_numpy(), pdf[["tx", "ty"]].to_numpy(), pdf["id"].to_numpy()
        live, out, tile_id, n = np.ones(len(p), bool), [], (pdf["_tx"].iloc[0], pdf["_ty"].iloc[0]), 0
        centre = np.rint(np.mod(np.arctan2(t[:, 1], t[:, 0]) + math.pi / 2, math.pi) / math.pi * ANGLE_BINS).astype(int) % ANGLE_BINS
        bins = (centre[:, None] + np.arange(-3, 4)) % ANGLE_BINS
        rho = np.rint((p[:, :1] * np.cos(bins * math.pi / ANGLE_BINS) + p[:, 1:] * np.sin(bins * math.pi / ANGLE_BINS)) / RHO_M).astype(int)
        code = bins.astype(np.int64) * 10_000_000 + rho + 5_000_000
        while live.sum() >= min_inliers and (max_lines is None or n < max_lines):
            keys, votes = np.unique(code[live], return_counts=True)
            k = keys[np.argmax(votes)]
            th, r = (k // 10_000_000) * math.pi / ANGLE_BINS, (k % 10_000_000 - 5_000_000) * RHO_M
            nx, ny = math.cos(th), math.sin(th)

            def close(cos_min, dist):
                return live & (np.abs(t[:, 0] * ny - t[:, 1] * nx) >= cos_min) & (np.abs(p[:, 0] * nx + p[:, 1] * ny - r) <= dist)

            first = sel = close(0.75, 0.30)
            for _ in range(3):
                if sel.sum() < min_inliers:
                    break
                mean = p[sel].mean(0)
                vals, vecs = np.linalg.eigh(np.cov((p[sel] - mean).T, bias=True))
                tx, ty = vecs[:, 1]
                if tx < 0 or (abs(tx) < 1e-9 and ty < 0):
                    tx, ty = -tx, -ty
                nx, ny = -ty, tx
                r = float(nx * mean[0] + ny * mean[1])
                new = close(0.70, 0.18)
                if (new == sel).all():
                    break
                sel = new
            if sel.sum() < min_inliers:
                drop = np.flatnonzero(first)[:RETIRED]
                live[drop if len(drop) else np.flatnonzero(live)[:1]] = False
                continue
            proj = p @ np.array([tx, ty])
            order = np.flatnonzero(sel)[np.argsort(proj[sel], kind="stable")]
            for part in np.split(order, np.flatnonzero(np.diff(proj[order]) > gap) + 1):
                if len(part) >= min_inliers and proj[part[-1]] - proj[part[0]] >= min_length:
                    out.append([*map(int, tile_id), n, len(part), tx, ty, nx, ny, r, proj[part[0]], proj[part[-1]], *p[part].mean(0), [int(i) for i in ids[part]]])
                    n += 1
            live &= ~sel
        return pd.DataFrame(out, columns=["tile_x", "tile_y", "seq", "n", "tx", "ty", "nx", "ny", "rho", "s0", "s1", "mx", "my", "members"])

    t = points.select("id", "x", "y", "tx", "ty", C.cell("x", tile).alias("_tx"), C.cell("y", tile).alias("_ty"))
    return t.groupBy("_tx", "_ty").applyInPandas(run, "tile_x bigint, tile_y bigint, seq bigint, n bigint, tx double, ty double, nx double, ny double, rho double, s0 double, s1 double, mx double, my double, members array<bigint>")


def end_point(prefix: str, s: str) -> tuple[Column, Column]:
    c = lambda n: F.col(f"{prefix}{n}")
    return c("tx") * c(s) + c("nx") * c("rho"), c("ty") * c(s) + c("ny") * c("rho")


def mutual_best(bands: DataFrame, cos_min: float = COS(5.0), max_offset: float = 0.22, max_gap: float = 5.0) -> DataFrame:
    """Successor pairs (a, b): the start of b follows the end of a, and each is
    the other's best by gap + 2 offset + 5 (1 - cos).  Ties go to the lower id.

    A successor's near end lies within ``max_gap`` of a's end, so both ends are
    bucketed by cells of that size and met through the 3x3 stencil."""
    g = max_gap + 1.0
    cols = ["id", "tx", "ty", "nx", "ny", "rho", "s0", "s1", "mx", "my"]
    a = bands.select(*[F.col(c).alias(f"a_{c}") for c in cols])
    ex, ey = end_point("a_", "s1")
    a = a.withColumns({"_ex": ex, "_ey": ey}).withColumns({"ix": C.cell("_ex", g), "iy": C.cell("_ey", g)})
    b = bands.select(*[F.col(c).alias(f"b_{c}") for c in cols])
    ends = [end_point("b_", s) for s in ("s0", "s1")]
    b = b.withColumn("_e", F.explode(F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ends]))).withColumns({"ix": C.cell("_e.x", g), "iy": C.cell("_e.y", g)}).drop("_e").distinct()
    m = S.with_offsets(a, ["ix", "iy"], S.square(1)).join(b, ["ix", "iy"]).filter(F.col("a_id") != F.col("b_id"))
    dot = F.abs(F.col("a_tx") * F.col("b_tx") + F.col("a_ty") * F.col("b_ty"))
    off = F.abs(F.col("a_nx") * F.col("b_mx") + F.col("a_ny") * F.col("b_my") - F.col("a_rho"))
    pr = [x * F.col("a_tx") + y * F.col("a_ty") for x, y in ends]
    gap = F.least(*pr) - F.col("a_s1")
    m = m.withColumns({"dot": dot, "off": off, "gap": gap}).filter((F.col("dot") >= cos_min) & (F.col("off") <= max_offset) & (F.col("gap") >= -0.25) & (F.col("gap") <= max_gap))
    m = m.select("a_id", "b_id", (F.col("gap") + F.col("off") * 2.0 + (1.0 - F.col("dot")) * 5.0).alias("score")).distinct()
    nxt = m.groupBy("a_id").agg(F.min(F.struct("score", "b_id")).alias("_n")).select("a_id", F.col("_n.b_id").alias("b_id"), F.col("_n.score").alias("score"))
    prv = m.groupBy("b_id").agg(F.min(F.struct("score", "a_id")).alias("_p")).select("b_id", F.col("_p.a_id").alias("a_id"))
    return nxt.join(prv, ["a_id", "b_id"])


def join_fragments(links: DataFrame, members: DataFrame) -> DataFrame:
    """Chains of linked fragments refitted as one band.  ``members``: id, x, y."""
    roots = S.label_components(links.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")))
    m = members.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("band_id", F.coalesce("root", "id"))
    line = fit_lines(m, ["band_id"])
    s = m.join(line, "band_id").withColumn("_s", F.col("x") * F.col("tx") + F.col("y") * F.col("ty"))
    span = s.groupBy("band_id").agg(F.min("_s").alias("s0"), F.max("_s").alias("s1"), F.count_distinct("id").alias("fragments"),
                                    F.avg(F.abs(F.col("x") * F.col("nx") + F.col("y") * F.col("ny") - F.col("rho"))).alias("residual"))
    return line.join(span, "band_id").withColumn("length", F.col("s1") - F.col("s0"))


def band_polyline(bands: DataFrame, step: float = 0.10) -> DataFrame:
    k = F.explode(F.sequence(F.lit(0), F.floor((F.col("s1") - F.col("s0")) / step).cast("int")))
    b = bands.withColumn("k", k).withColumn("_s", F.col("s0") + F.col("k") * step)
    return b.select("id", "k", (F.col("tx") * F.col("_s") + F.col("nx") * F.col("rho")).alias("x"), (F.col("ty") * F.col("_s") + F.col("ny") * F.col("rho")).alias("y"))


# --- cross sections -------------------------------------------------------------
def band_candidates(samples: DataFrame, bands: DataFrame, max_lateral: float = 10.0, pad: float = 0.5, cos_min: float = COS(35.0)) -> DataFrame:
    """Compatible bands of every sample and side.  Bands are laid over cells of
    a little more than the search distance along their length; a sample looks
    at the 3x3 cells around it."""
    g = max_lateral + pad + 2.0
    b = bands.select(F.col("id").alias("band_id"), *[F.col(c).alias(f"b_{c}") for c in ("tx", "ty", "nx", "ny", "rho", "s0", "s1")])
    n = F.ceil((F.col("b_s1") - F.col("b_s0")) / 2.0).cast("int")
    b = b.withColumn("_k", F.explode(F.sequence(F.lit(0), n))).withColumn("_s", F.least(F.col("b_s0") + 2.0 * F.col("_k"), F.col("b_s1")))
    b = b.withColumns({"ix": C.cell(F.col("b_tx") * F.col("_s") + F.col("b_nx") * F.col("b_rho"), g), "iy": C.cell(F.col("b_ty") * F.col("_s") + F.col("b_ny") * F.col("b_rho"), g)}).drop("_k", "_s").distinct()
    s = samples.select(F.col("id").alias("sample_id"), "x", "y", "tx", "ty").withColumns({"ix": C.cell("x", g), "iy": C.cell("y", g)})
    m = S.with_offsets(s, ["ix", "iy"], S.square(1)).join(b, ["ix", "iy"])
    along = F.col("x") * F.col("b_tx") + F.col("y") * F.col("b_ty")
    signed = F.col("b_nx") * F.col("x") + F.col("b_ny") * F.col("y") - F.col("b_rho")
    m = m.withColumns({"dot": F.abs(F.col("tx") * F.col("b_tx") + F.col("ty") * F.col("b_ty")), "along": along, "signed": signed})
    m = m.filter((F.col("dot") >= cos_min) & (F.col("along") >= F.col("b_s0") - pad) & (F.col("along") <= F.col("b_s1") + pad))
    m = m.withColumn("lateral", -F.col("signed") * (F.col("b_nx") * -F.col("ty") + F.col("b_ny") * F.col("tx")))
    m = m.filter((F.col("lateral") != 0) & (F.abs("lateral") <= max_lateral))
    return m.select("sample_id", F.when(F.col("lateral") > 0, 1).otherwise(-1).alias("side"), "band_id", F.abs("lateral").alias("distance"), "lateral", "along",
                    (F.col("x") - F.col("signed") * F.col("b_nx")).alias("px"), (F.col("y") - F.col("signed") * F.col("b_ny")).alias("py"), "b_tx", "b_ty").distinct()


def nearest_ranked(cands: DataFrame, k: int) -> DataFrame:
    """The k nearest per sample and side; the rank limit is applied before the
    shuffle, so a sample with very many bands does not gather in one task."""
    w = W.partitionBy("sample_id", "side").orderBy("distance", "band_id")
    return cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def longest_run(df: DataFrame, keys: Sequence[str], id_col: str, step: int = 2, rows_per_split=None) -> DataFrame:
    """Longest run of distinct ids whose neighbours differ by at most ``step``."""
    d = df.select(*keys, id_col).distinct()
    s = O.sessionize(d, keys, [id_col], {"i": F.col(id_col)}, lambda p: F.col(id_col) - p["i"] > step, "_run", rows_per_split)
    return s.groupBy(*keys, "_run").count().groupBy(*keys).agg(F.max("count").alias("longest_run"), F.sum("count").alias("samples"))


def band_roles(cands: DataFrame, bands: DataFrame, low: float = 0.45, high: float = 6.0, min_run: int = 6, rows_per_split=None) -> DataFrame:
    """Primary (nearest) and secondary (next, 0.45-6 m further out) roles."""
    top = S.cut(nearest_ranked(cands, 2))
    first = top.filter("rank = 1").select("sample_id", "side", F.col("distance").alias("d1"), F.col("band_id").alias("b1"))
    second = top.filter("rank = 2").join(first, ["sample_id", "side"]).filter((F.col("distance") - F.col("d1") >= low) & (F.col("distance") - F.col("d1") <= high))
    p = longest_run(first.select(F.col("b1").alias("id"), "sample_id"), ["id"], "sample_id", rows_per_split=rows_per_split).select("id", F.col("longest_run").alias("primary_longest_run"), F.col("samples").alias("primary_support_samples"))
    s = longest_run(second.select(F.col("band_id").alias("id"), "sample_id"), ["id"], "sample_id", rows_per_split=rows_per_split).select("id", F.col("longest_run").alias("secondary_longest_run"), F.col("samples").alias("secondary_support_samples"))
    out = bands.select("id").join(p, "id", "left").join(s, "id", "left").fillna(0)
    role = F.when(F.col("primary_longest_run") >= min_run, "primary_road_side_candidate").when(F.col("secondary_longest_run") >= min_run, "secondary_sidewalk_outer_candidate").otherwise("unassociated_boundary_geometry")
    return out.withColumn("role", role)


def band_pairs(cands: DataFrame, cos_min: float = COS(5.0), low: float = 1.2, high: float = 12.0, min_run: int = 6, rows_per_split=None) -> DataFrame:
    """Left/right band pairs with enough and contiguous common samples."""
    top = S.cut(nearest_ranked(cands, 1).select("sample_id", "side", "band_id", "px", "py", "b_tx", "b_ty"))
    l, r = top.filter("side = 1").alias("l"), top.filter("side = -1").alias("r")
    m = l.join(r, "sample_id").filter(F.col("l.band_id") != F.col("r.band_id"))
    m = m.filter(F.abs(F.col("l.b_tx") * F.col("r.b_tx") + F.col("l.b_ty") * F.col("r.b_ty")) >= cos_min)
    m = m.select("sample_id", F.col("l.band_id").alias("left_band_id"), F.col("r.band_id").alias("right_band_id"), C.hypot(F.col("l.px") - F.col("r.px"), F.col("l.py") - F.col("r.py")).alias("width")).filter((F.col("width") >= low) & (F.col("width") <= high))
    m, keys = S.cut(m), ["left_band_id", "right_band_id"]
    run = longest_run(m, keys, "sample_id", rows_per_split=rows_per_split).filter((F.col("samples") >= min_run) & (F.col("longest_run") >= min_run))
    return run.join(m.groupBy(*keys).agg(F.avg("width").alias("mean_width")), keys)


def cross_sections(samples: DataFrame, cands: DataFrame, low: float = 1.2, high: float = 9.0, out_low: float = 0.45, out_high: float = 6.0) -> DataFrame:
    """Inner and outer boundary of both sides per sample."""
    inner = cands.groupBy("sample_id", "side").agg(F.min(F.struct("distance", "band_id")).alias("i"))
    out = cands.join(inner, ["sample_id", "side"]).filter((F.col("distance") - F.col("i.distance") >= out_low) & (F.col("distance") - F.col("i.distance") <= out_high))
    outer = out.groupBy("sample_id", "side").agg(F.min(F.struct("distance", "band_id")).alias("o"))
    both = inner.join(outer, ["sample_id", "side"], "left")
    wide = both.groupBy("sample_id").agg(*[F.max(F.when(F.col("side") == s, F.col(f"{k}.{c}"))).alias(f"{name}_{kind}_{a}")
                                           for s, name in ((1, "left"), (-1, "right")) for k, kind in (("i", "inner"), ("o", "outer")) for c, a in (("distance", "m"), ("band_id", "id"))])
    x = samples.select(F.col("id").alias("sample_id"), "x", "y", "tx", "ty").join(wide, "sample_id", "left")
    x = x.withColumn("road_width", F.col("left_inner_m") + F.col("right_inner_m"))
    valid = F.coalesce((F.col("road_width") >= low) & (F.col("road_width") <= high), F.lit(False))
    x = x.withColumn("road_valid", valid)
    return x.withColumns({f"{s}_outer_{k}": F.when(F.col("road_valid"), F.col(f"{s}_outer_{k}")) for s in ("left", "right") for k in ("m", "id")})


def side_state() -> Column:
    l, r = F.col("left_inner_m").isNotNull(), F.col("right_inner_m").isNotNull()
    return (F.when(F.col("road_valid"), "road").when(l & ~r, "left").when(r & ~l, "right").when(~l & ~r, "none").otherwise("other"))


def state_runs(xs: DataFrame, rows_per_split=None) -> DataFrame:
    """Maximal runs of equal side state with the states around them."""
    d = xs.select("sample_id", side_state().alias("state"))
    s = O.sessionize(d, [], ["sample_id"], {"s": F.col("state"), "i": F.col("sample_id")}, lambda p: (p["s"] != F.col("state")) | (F.col("sample_id") != p["i"] + 1), "run_id", rows_per_split)
    runs = s.groupBy("run_id").agg(F.min("sample_id").alias("first_id"), F.max("sample_id").alias("last_id"), F.count(F.lit(1)).alias("samples"), F.first("state").alias("state"))
    runs = O.neighbour(runs, [], ["run_id"], {"before": F.col("state")}, rows_per_split=rows_per_split)
    return O.neighbour(runs, [], ["run_id"], {"after": F.col("state")}, lead=True, rows_per_split=rows_per_split)


def gap_bridges(xs: DataFrame, crossing_ids: DataFrame, rows_per_split=None) -> DataFrame:
    """Bridges between consecutive valid sections: regular, turn or long corridor."""
    from scanloom.operators.trajectory import cumulative_length
    d = cumulative_length(xs, [], ["sample_id"], ("x", "y"), rows_per_split).join(crossing_ids.select(F.col("id").alias("sample_id"), F.lit(1).alias("crossing")), "sample_id", "left")
    d = O.running(d, [], ["sample_id"], {"c_left": ("sum", F.col("left_inner_m").isNotNull().cast("long")), "c_right": ("sum", F.col("right_inner_m").isNotNull().cast("long")),
                                         "c_cross": ("sum", F.coalesce("crossing", F.lit(0)).cast("long"))}, rows_per_split)
    cols = ["sample_id", "left_inner_m", "right_inner_m", "arc_m", "c_left", "c_right", "c_cross", "tx", "ty"]
    v = O.neighbour(d.filter("road_valid").select(*cols, F.coalesce("crossing", F.lit(0)).alias("here")), [], ["sample_id"], {f"n_{c}": F.col(c) for c in cols}, lead=True, rows_per_split=rows_per_split)
    v = v.filter(F.col("n_sample_id") > F.col("sample_id") + 1)
    gap = F.col("n_sample_id") - F.col("sample_id") - 1
    v = v.withColumns({"gap_samples": gap, "path_m": F.col("n_arc_m") - F.col("arc_m"),
                       "turn_deg": F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("tx") * F.col("n_tx") + F.col("ty") * F.col("n_ty"))))),
                       "left_change": F.abs(F.col("left_inner_m") - F.col("n_left_inner_m")), "right_change": F.abs(F.col("right_inner_m") - F.col("n_right_inner_m")),
                       # Both ends are valid, so the closing end is taken off again.
                       "left_fraction": (F.col("n_c_left") - F.col("c_left") - 1) / gap, "right_fraction": (F.col("n_c_right") - F.col("c_right") - 1) / gap,
                       "intersection": (F.col("n_c_cross") - F.col("c_cross") + F.col("here")) > 0})
    strong, weak = F.greatest("left_fraction", "right_fraction"), F.least("left_fraction", "right_fraction")
    side = lambda m: (F.col("left_change") <= m) & (F.col("right_change") <= m)
    kind = (F.when(side(2.5) & (F.col("path_m") <= 20.0), "regular_continuity")
            .when((F.col("turn_deg") >= 40.0) & (F.col("turn_deg") <= 135.0) & (F.col("path_m") <= 12.0) & (strong >= 0.5), "turn_continuity")
            .when((F.col("turn_deg") <= 12.0) & (F.col("path_m") <= 40.0) & side(1.0) & (strong >= 0.60) & (weak >= 0.25), "long_corridor_evidence"))
    return v.withColumn("bridge_kind", kind).filter(F.col("bridge_kind").isNotNull()).select(
        F.col("sample_id").alias("first_id"), F.col("n_sample_id").alias("second_id"), "gap_samples", "path_m", "bridge_kind", "intersection", "turn_deg",
        F.col("left_inner_m").alias("first_left"), F.col("right_inner_m").alias("first_right"), F.col("n_left_inner_m").alias("second_left"), F.col("n_right_inner_m").alias("second_right"))


def bridge_samples(bridges: DataFrame) -> DataFrame:
    """One row per bridged sample with interpolated side distances."""
    b = bridges.withColumn("sample_id", F.explode(F.sequence(F.col("first_id") + 1, F.col("second_id") - 1)))
    a = (F.col("sample_id") - F.col("first_id")) / (F.col("second_id") - F.col("first_id"))
    return b.select("sample_id", "bridge_kind", *[(F.col(f"first_{s}") * (1 - a) + F.col(f"second_{s}") * a).alias(f"bridge_{s}") for s in ("left", "right")])


def nearest_width(wanted: DataFrame, xs: DataFrame, reach: int = 40, cos_min: float = COS(30.0)) -> DataFrame:
    """Width of the nearest valid section of like direction, within +-reach ids."""
    w = wanted.select("sample_id", "tx", "ty").withColumn("ref_id", F.explode(F.sequence(F.col("sample_id") - reach, F.col("sample_id") + reach)))
    v = xs.filter("road_valid").select(F.col("sample_id").alias("ref_id"), F.col("tx").alias("r_tx"), F.col("ty").alias("r_ty"), "road_width")
    m = w.join(v, "ref_id").filter(F.col("tx") * F.col("r_tx") + F.col("ty") * F.col("r_ty") >= cos_min)
    best = m.groupBy("sample_id").agg(F.min(F.struct(F.abs(F.col("ref_id") - F.col("sample_id")).alias("d"), "ref_id", "road_width")).alias("_b"))
    return best.select("sample_id", F.col("_b.ref_id").alias("reference_id"), F.col("_b.road_width").alias("reference_width"))


def one_sided(xs: DataFrame, min_run: int = 6, min_half: float = 0.60, rows_per_split=None) -> DataFrame:
    """Ribbons of long one-sided stretches, the other side from a near width."""
    runs = state_runs(xs, rows_per_split).filter(F.col("state").isin("left", "right") & (F.col("samples") >= min_run))
    s = runs.withColumn("sample_id", F.explode(F.sequence("first_id", "last_id"))).select("sample_id", "state").join(xs, "sample_id")
    s = s.join(nearest_width(s, xs), "sample_id")
    known = F.when(F.col("state") == "left", F.col("left_inner_m")).otherwise(F.col("right_inner_m"))
    s = s.withColumn("inferred", F.col("reference_width") - known).filter(F.col("inferred") >= min_half)
    left = F.col("state") == "left"
    return s.select("sample_id", "x", "y", "tx", "ty", F.col("state").alias("kind"), F.when(left, -F.col("inferred")).otherwise(-known).alias("lo"), F.when(left, known).otherwise(F.col("inferred")).alias("hi"))


def open_continuations(xs: DataFrame, max_path: float = 15.0, max_change: float = 1.5, min_half: float = 0.60, rows_per_split=None) -> DataFrame:
    """Ribbons across boundary-free gaps between two one-sided stretches."""
    from scanloom.operators.trajectory import cumulative_length
    one = ("left", "right")
    runs = state_runs(xs, rows_per_split).filter((F.col("state") == "none") & F.col("before").isin(*one) & F.col("after").isin(*one))
    arc = cumulative_length(xs, [], ["sample_id"], ("x", "y"), rows_per_split).select("sample_id", "arc_m", F.coalesce("left_inner_m", "right_inner_m").alias("known"))
    ends = runs.select("run_id", F.explode(F.array(F.struct((F.col("first_id") - 1).alias("sample_id"), F.lit("a").alias("e")), F.struct((F.col("last_id") + 1).alias("sample_id"), F.lit("b").alias("e")))).alias("_e")).select("run_id", "_e.*")
    full = ends.join(xs.select("sample_id", "tx", "ty"), "sample_id")
    full = full.join(nearest_width(full, xs), "sample_id", "left").join(arc, "sample_id")
    at = lambda e, c: F.max(F.when(F.col("e") == e, F.col(c))).alias(f"{e}_{c}")
    ab = full.groupBy("run_id").agg(*[at(e, c) for e in "ab" for c in ("reference_width", "arc_m", "known")])
    r = runs.join(ab, "run_id").filter((F.col("b_arc_m") - F.col("a_arc_m") <= max_path) & (F.abs(F.col("a_reference_width") - F.col("b_reference_width")) <= max_change))
    s = r.withColumn("sample_id", F.explode(F.sequence("first_id", "last_id")))
    a = (F.col("sample_id") - F.col("first_id") + 1) / (F.col("last_id") - F.col("first_id") + 2)
    mix = lambda c: F.col(f"a_{c}") * (1 - a) + F.col(f"b_{c}") * a
    s = s.withColumns({"width": mix("reference_width"), "known": mix("known")}).withColumn("inferred", F.col("width") - F.col("known"))
    same = F.col("before") == F.col("after")
    s = s.filter(~same | (F.col("inferred") >= min_half))
    lo = F.when(~same, -F.col("width") / 2).when(F.col("before") == "left", -F.col("inferred")).otherwise(-F.col("known"))
    hi = F.when(~same, F.col("width") / 2).when(F.col("before") == "left", F.col("known")).otherwise(F.col("inferred"))
    return s.select("sample_id", F.lit("open").alias("kind"), lo.alias("lo"), hi.alias("hi")).join(xs.select("sample_id", "x", "y", "tx", "ty"), "sample_id")


def default_corridor(xs: DataFrame, bridged: DataFrame, width: float = 3.5) -> DataFrame:
    """Fixed-width ribbons where neither a valid section nor a bridge exists."""
    s = xs.filter(~F.col("road_valid")).join(bridged.select("sample_id"), "sample_id", "left_anti")
    st = side_state()
    kind = F.when(st.isin("left", "right"), "one_side_default_width").when(st == "none", "no_boundary_default_width").otherwise("two_side_abnormal_default_width")
    return s.select("sample_id", "x", "y", "tx", "ty", kind.alias("kind"), F.lit(-width / 2).alias("lo"), F.lit(width / 2).alias("hi"))


def rect_cells(ribbons: DataFrame, half_long: float, g: float, margin: float = 0.0) -> DataFrame:
    """Cells met by each rectangle (lateral lo..hi, +-half_long along the tangent).
    Sampled at half a cell: with ``margin`` 0 every cell with its centre inside
    is found, with ``margin`` g every cell that touches the rectangle."""
    h = g / 2
    lo, hi = F.col("lo") - margin, F.col("hi") + margin
    a = half_long + margin
    nl = F.ceil((hi - lo) / h).cast("int")
    na = math.ceil(2 * a / h)
    r = ribbons.filter(F.col("hi") >= F.col("lo")).withColumn("_i", F.explode(F.sequence(F.lit(0), nl))).withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(na))))
    lat, lon = F.least(lo + F.col("_i") * h, hi), F.least(F.lit(-a) + F.col("_j") * h, F.lit(a))
    r = r.withColumns({"ix": C.cell(F.col("x") + F.col("tx") * lon - F.col("ty") * lat, g), "iy": C.cell(F.col("y") + F.col("ty") * lon + F.col("tx") * lat, g)})
    return r.drop("_i", "_j").distinct()


def ribbon_fill(ribbons: DataFrame, ground: DataFrame, g: float = 0.2, half_long: float = 0.35) -> DataFrame:
    """Existing ground cells whose centre lies in a ribbon, per (sample, cell).
    Never makes a cell: cells without ground do not join."""
    c = rect_cells(ribbons, half_long, g)
    rx, ry = C.cell_centre("ix", g) - F.col("x"), C.cell_centre("iy", g) - F.col("y")
    lon, lat = rx * F.col("tx") + ry * F.col("ty"), ry * F.col("tx") - rx * F.col("ty")
    return c.filter((F.abs(lon) <= half_long) & (lat >= F.col("lo")) & (lat <= F.col("hi"))).join(ground.select("ix", "iy"), ["ix", "iy"])


def ribbon_support(ribbons: DataFrame, ground: DataFrame, g: float = 0.2, half_long: float = 0.35) -> DataFrame:
    return ribbon_fill(ribbons, ground, g, half_long).groupBy("ix", "iy").agg(F.count(F.lit(1)).alias("support"))


def classify_sections(xs: DataFrame, bridged: DataFrame) -> DataFrame:
    """Class, confidence and use flags of every cross section (ordered rules)."""
    j = xs.join(bridged, "sample_id", "left")
    l, r, b = F.col("left_inner_m").isNotNull(), F.col("right_inner_m").isNotNull(), F.col("bridge_kind").isNotNull()
    pick = lambda *v: F.when(F.col("road_valid"), v[0]).when(b, v[1]).when(l != r, v[2]).when(l & r, v[3]).otherwise(v[4])
    return j.withColumns({
        "class": pick("two_sided_measured_road_core", "two_sided_continuity_bridge", "one_sided_measured_boundary", "two_sided_abnormal_width_open_candidate", "no_boundary_default_width_candidate"),
        "confidence": pick("high", "medium", "medium", "low", "low"), "use_centerline": pick(True, True, True, False, False), "true_width": F.col("road_valid"),
        "width": pick(F.col("road_width"), F.col("bridge_left") + F.col("bridge_right"), F.lit(None), F.lit(None), F.lit(None)),
        "left_m": F.when(~F.col("road_valid") & b, F.col("bridge_left")).otherwise(F.col("left_inner_m")),
        "right_m": F.when(~F.col("road_valid") & b, F.col("bridge_right")).otherwise(F.col("right_inner_m"))})


#: The source of bands that were fitted to tracked edges.
LOCAL_FIT = "local_edge_fit"
TWO_SIDED = ("two_sided_measured_road_core", "two_sided_continuity_bridge")


def centreline_points(rows: DataFrame, ground: DataFrame, g: float, k: int = 2, complete: bool = False) -> DataFrame:
    """Centre points with the height of the nearest ground; rows without drop."""
    d = rows if complete else rows.filter("use_centerline")
    shift = F.when(F.col("class").isin(*TWO_SIDED), (F.col("left_m") - F.col("right_m")) / 2).otherwise(0.0)
    d = d.select(F.col("sample_id").alias("q_id"), "confidence", (F.col("x") - F.col("ty") * shift).alias("x"), (F.col("y") + F.col("tx") * shift).alias("y"))
    near = S.nearest_cell(d, ground.withColumnRenamed("mean_z", "_z"), g, k, ["_z"])
    return d.join(near.select("q_id", (F.col("_z") + (0.06 if complete else 0.05)).alias("z")), "q_id").withColumnRenamed("q_id", "sample_id")


#: Strength of a road-cell source.
SOURCE_RANK = {"fixed_width_fallback": 1, "two_sided_continuity_bridge": 2, "two_sided_measured": 3}


def merge_candidates(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per cell: the strongest source is primary, all sources are kept."""
    all_ = None
    for name, df in layers.items():
        d = df.select("ix", "iy", "support", F.lit(name).alias("source"), F.lit(SOURCE_RANK[name]).alias("rank"))
        all_ = d if all_ is None else all_.unionByName(d)
    m = all_.groupBy("ix", "iy").agg(F.max(F.struct("rank", "source", "support")).alias("_p"), F.array_join(F.array_sort(F.collect_set("source")), "|").alias("all_sources"))
    return m.select("ix", "iy", F.col("_p.source").alias("primary_source"), F.col("_p.support").alias("support"), "all_sources", (F.col("_p.rank") == 3).alias("observed"))


# --- curbs ----------------------------------------------------------------------
def medians(df: DataFrame, keys: Sequence[str], cols: Sequence[str], rows_per_split=None) -> DataFrame:
    """Exact medians (mean of the two middle values) of several columns."""
    long = df.select(*keys, F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in cols])).alias("_e")).select(*keys, "_e.*").filter(F.col("v").isNotNull())
    s = O.order_statistic(long, [*keys, "name"], "v", O.median_ranks(), rows_per_split)
    return s.groupBy(*keys).agg(*[F.max(F.when(F.col("name") == c, (F.col("med_lo") + F.col("med_hi")) / 2)).alias(c) for c in cols])


def slice_clusters(samples: DataFrame, points: DataFrame, half_long: float = 0.45, max_lateral: float = 10.0, gap: float = 0.35, cell_m: float = 1.0, rows_per_split=None) -> DataFrame:
    """Edge points in a thin slice across the trajectory, clustered by distance."""
    rect = samples.select(F.col("id").alias("sample_id"), "x", "y", "tx", "ty", F.lit(-max_lateral).alias("lo"), F.lit(max_lateral).alias("hi"))
    c = rect_cells(rect, half_long, cell_m, cell_m)
    p = points.select(F.col("x").alias("px"), F.col("y").alias("py"), F.col("z").alias("pz")).withColumns({"ix": C.cell("px", cell_m), "iy": C.cell("py", cell_m)})
    m = c.join(p, ["ix", "iy"])
    dx, dy = F.col("px") - F.col("x"), F.col("py") - F.col("y")
    m = m.withColumns({"lon": dx * F.col("tx") + dy * F.col("ty"), "lateral": dy * F.col("tx") - dx * F.col("ty")})
    m = m.filter((F.abs("lon") <= half_long) & (F.abs("lateral") >= 0.10) & (F.abs("lateral") <= max_lateral))
    m = m.select("sample_id", F.when(F.col("lateral") > 0, 1).otherwise(-1).alias("side"), F.abs("lateral").alias("dist"), "lateral", "px", "py", "pz")
    s = O.sessionize(m, ["sample_id", "side"], ["dist", "px", "py", "pz"], {"d": F.col("dist")}, lambda p: F.col("dist") - p["d"] > gap, "cluster", rows_per_split)
    s = S.cut(s)
    keys = ["sample_id", "side", "cluster"]
    return medians(s, keys, ["lateral", "px", "py", "pz"], rows_per_split).join(s.groupBy(*keys).agg(F.count(F.lit(1)).alias("raw_count")), keys)


def edge_tracks(clusters: DataFrame, max_lateral_gap: float = 0.55, max_gap: int = 3, rows_per_split=None) -> DataFrame:
    """Greedy tracking of slice clusters along the samples, near before far.
    The state is the short list of tracks seen in the last few samples."""
    def scan(pdf: pd.DataFrame, state):
        live, sample, used = state or [[], None, []]  # a split may end inside a sample
        live, used, out = [list(s) for s in live], set(used), []
        for i, lat, k in zip(pdf["sample_id"], pdf["lateral"], pdf["cluster"]):
            if i != sample:
                live, sample, used = [t for t in live if i <= t[1] + max_gap], i, set()
            best = None
            for n, (_, last, l) in enumerate(live):
                d = abs(lat - l)
                if n not in used and i <= last + max_gap and d <= max_lateral_gap and (best is None or d < best[0]):
                    best = (d, n)
            if best is None:
                live.append([f"{int(i)}:{int(k)}", int(i), float(lat)])
                out.append(live[-1][0])
            else:
                t = live[best[1]]
                t[1], t[2] = int(i), float(lat)
                used.add(best[1])
                out.append(t[0])
        return pdf.assign(track=out), [live, None if sample is None else int(sample), sorted(used)]

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in clusters.schema.fields) + ", track string"
    return O.carried_scan(clusters, ["side"], ["sample_id", "cluster"], scan, ddl, rows_per_split)


def uncovered(track: DataFrame, curbs: DataFrame, tol: float = 0.45) -> DataFrame:
    """Track points with no accepted curb at the same sample, side and lateral."""
    c = curbs.select("sample_id", "side", F.col("lateral").alias("c_lateral"))
    return track.join(c, (track.sample_id == c.sample_id) & (track.side == c.side) & (F.abs(track.lateral - c.c_lateral) <= tol), "left_anti")


def local_bands(tracks: DataFrame, max_gap: int = 3, min_samples: int = 5, min_length: float = 2.0, rows_per_split=None) -> DataFrame:
    """Tracks cut at sample gaps and turned into bands by their end points."""
    keys = ["side", "track"]
    s = O.sessionize(tracks, keys, ["sample_id", "cluster"], {"i": F.col("sample_id")}, lambda p: F.col("sample_id") > p["i"] + max_gap, "piece", rows_per_split)
    keys = [*keys, "piece"]
    at = F.struct("px", "py")
    g = s.groupBy(*keys).agg(F.count(F.lit(1)).alias("samples"), F.min_by(at, F.struct("sample_id", "cluster")).alias("f"), F.max_by(at, F.struct("sample_id", "cluster")).alias("l"), F.sum("raw_count").alias("observed_inliers"))
    g = g.withColumns({"dx": F.col("l.px") - F.col("f.px"), "dy": F.col("l.py") - F.col("f.py")}).withColumn("length", C.hypot("dx", "dy")).filter((F.col("samples") >= min_samples) & (F.col("length") >= min_length))
    g = g.withColumns({"tx": F.col("dx") / F.col("length"), "ty": F.col("dy") / F.col("length")}).withColumns({"nx": -F.col("ty"), "ny": F.col("tx")})
    g = g.withColumn("rho", F.col("nx") * F.col("f.px") + F.col("ny") * F.col("f.py")).drop("f", "l", "dx", "dy")
    sp = s.join(g.select(*keys, "tx", "ty"), keys).groupBy(*keys).agg(F.min(F.col("px") * F.col("tx") + F.col("py") * F.col("ty")).alias("s0"), F.max(F.col("px") * F.col("tx") + F.col("py") * F.col("ty")).alias("s1"))
    return g.join(sp, keys)


def longest_path(links: DataFrame, keys: Sequence[str], max_step: int = 3, rows_per_split=None) -> DataFrame:
    """Length of the longest piece of a sample chain without a jump of ids."""
    d = links.select(*keys, "sample_id", "x", "y").distinct()
    nb = O.neighbour(d, keys, ["sample_id"], {"_i": F.col("sample_id"), "_x": F.col("x"), "_y": F.col("y")}, rows_per_split=rows_per_split)
    brk = F.col("_i").isNull() | (F.col("sample_id") > F.col("_i") + max_step)
    nb = nb.withColumns({"_b": brk.cast("long"), "_d": F.when(brk, 0.0).otherwise(C.hypot(F.col("x") - F.col("_x"), F.col("y") - F.col("_y")))})
    r = O.running(nb, keys, ["sample_id"], {"_run": ("sum", F.col("_b"))}, rows_per_split)
    return r.groupBy(*keys, "_run").agg(F.sum("_d").alias("len")).groupBy(*keys).agg(F.max("len").alias("continuity"))


def last_road_support(samples: DataFrame, road: DataFrame, g: float = 0.2, max_lateral: float = 10.0, misses: int = 3) -> DataFrame:
    """Outermost supported step per (sample, side), stopping after three misses
    beyond the last hit; a step is supported by an observed cell within one cell.
    The window runs over the few dozen steps of one sample."""
    n = int(max_lateral / g)
    st = samples.select("id", "x", "y", "tx", "ty").withColumn("side", F.explode(F.array(F.lit(1), F.lit(-1)))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    d = F.col("step") * g * F.col("side")
    st = st.select("id", "side", "step", C.cell(F.col("x") - F.col("ty") * d, g).alias("ix"), C.cell(F.col("y") + F.col("tx") * d, g).alias("iy"))
    hit = S.with_offsets(st, ["ix", "iy"], S.square(1)).join(road.filter("observed").select("ix", "iy"), ["ix", "iy"], "left_semi").select("id", "side", "step").distinct()
    w = W.partitionBy("id", "side").orderBy("step")
    h = hit.withColumn("_gap", F.col("step") - F.lag("step").over(w))
    h = h.withColumn("_cut", F.sum(F.when(F.col("_gap") > misses, 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return h.filter("_cut = 0").groupBy("id", "side").agg((F.max("step") * g).alias("road_edge_m"))


def link_evidence(links: DataFrame, ground: DataFrame, road: DataFrame, edges: DataFrame, g: float, edge_r: float = 0.45) -> DataFrame:
    """Evidence around each link (link_id, px, py, side, nx, ny): ground inside
    and outside, road membership, raw edge height."""
    links = S.cut(links)

    def probe(off):
        sgn = F.col("side") * off
        return links.select(F.col("link_id").alias("q_id"), (F.col("px") + F.col("nx") * sgn).alias("x"), (F.col("py") + F.col("ny") * sgn).alias("y"))
    gz = S.cut(ground.select("ix", "iy", F.col("mean_z").alias("gz")))
    ins = S.nearest_cell(probe(-0.25), gz, g, 2, ["gz"], halo=True).select(F.col("q_id").alias("link_id"), F.col("gz").alias("inside_z"))
    out = S.nearest_cell(probe(0.35), gz, g, 2, ["gz"], halo=True).select(F.col("q_id").alias("link_id"), F.col("gz").alias("outside_z"))
    rd = probe(-0.25).withColumns({"ix": C.cell("x", g), "iy": C.cell("y", g)})
    near = S.with_offsets(road.select("ix", "iy", "observed"), ["ix", "iy"], S.square(1)).groupBy("ix", "iy").agg(F.max("observed").alias("observed"))
    rd = rd.select("q_id", "ix", "iy").join(near, ["ix", "iy"]).groupBy(F.col("q_id").alias("link_id")).agg(F.max("observed").alias("road_observed"), F.lit(True).alias("road"))
    at = links.select("link_id", F.col("px").alias("x"), F.col("py").alias("y"))
    ez = S.nearest_within(at, edges, ["x", "y"], edge_r, "link_id", "id", p_keep=["z"]).select(F.col("q_id").alias("link_id"), F.col("z").alias("edge_z"))
    e = links.join(ins, "link_id", "left").join(out, "link_id", "left").join(rd, "link_id", "left").join(ez, "link_id", "left")
    return e.fillna(False, ["road", "road_observed"]).withColumn("height_delta", F.coalesce(F.col("outside_z") - F.col("inside_z"), F.col("edge_z") - F.col("inside_z")))


def boundary_support(checked: DataFrame, keys: Sequence[str] = ("band_id", "side"), rows_per_split=None) -> DataFrame:
    """Support fractions, median height step and continuity per band side."""
    keys, own = list(keys), [c for c in ("local_road_edge_match",) if c in checked.columns]
    checked = S.cut(checked.select(*keys, "edge_z", "road", "road_observed", "use_centerline", "inside_z", "outside_z", "inner_match", "height_delta", "sample_id", "x", "y", *own))
    frac = lambda c: F.avg(c.cast("double"))
    g = checked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("links"), frac(F.col("edge_z").isNotNull()).alias("edge_support"), frac(F.col("road")).alias("road_support"), frac(F.col("road_observed")).alias("observed_road_support"),
        frac(F.col("use_centerline")).alias("topology_support"), frac(F.col("inside_z").isNotNull()).alias("inside_support"), frac(F.col("outside_z").isNotNull()).alias("outside_support"), frac(F.coalesce(F.col("inner_match"), F.lit(False))).alias("inner_match"),
        *([frac(F.coalesce(F.col("local_road_edge_match"), F.lit(False))).alias("local_road_edge_match")] if "local_road_edge_match" in checked.columns else []))
    med = medians(checked, keys, ["height_delta"], rows_per_split)
    return g.join(med, keys, "left").join(longest_path(checked, keys, rows_per_split=rows_per_split), keys, "left")


def classify_boundaries(b: DataFrame) -> DataFrame:
    """Curb, step, wall-or-green or unknown, with state, confidence and reasons.
    Bands fitted to local edges (``source`` ``LOCAL_FIT``) match the road by the
    larger of ``inner_match`` and ``local_road_edge_match``, where given."""
    c = F.col
    match = c("inner_match")
    if {"source", "local_road_edge_match"} <= set(b.columns):
        match = F.when(c("source") == LOCAL_FIT, F.greatest("inner_match", "local_road_edge_match")).otherwise(match)
    h = F.abs(c("height_delta"))
    run = F.least(F.lit(1.0), c("continuity") / 8.0)
    basic = (c("links") >= 5) & (c("continuity") >= 2.0) & (c("edge_support") >= 0.50) & (c("road_support") >= 0.60) & (c("inside_support") >= 0.45)
    curb = F.coalesce(basic & (c("topology_support") >= 0.60) & (c("continuity") >= 3.0) & (match >= 0.50) & (h >= 0.035) & (h <= 0.30), F.lit(False))
    step = F.coalesce(basic & (h >= 0.25) & (c("outside_support") >= 0.35), F.lit(False))
    wall = basic & (c("outside_support") < 0.35)
    seen = c("observed_road_support") >= 0.60
    b = b.withColumns({"_basic": basic, "_curb": curb, "_step": step, "_wall": wall})
    curb_conf = F.least(F.when(seen, 1.0).otherwise(0.74), 0.20 * run + 0.20 * c("edge_support") + 0.15 * c("road_support") + 0.10 * c("observed_road_support") + 0.15 * c("topology_support") + 0.10 * c("inside_support") + 0.10 * c("inner_match"))
    step_conf = F.least(F.lit(1.0), 0.25 * run + 0.25 * c("edge_support") + 0.25 * c("road_support") + 0.25 * F.least(F.lit(1.0), h / 0.5))
    wall_conf = F.least(F.lit(0.85), 0.30 * run + 0.30 * c("edge_support") + 0.25 * c("road_support") + 0.15 * (1.0 - c("outside_support")))
    weak_conf = F.least(F.lit(0.49), 0.2 * c("edge_support") + 0.2 * c("road_support") + 0.1 * c("inside_support"))
    k = lambda a, b_, d, e, f: F.when(c("_curb"), a).when(c("_step"), b_).when(c("_wall"), d).when(c("_basic"), e).otherwise(f)
    out = b.withColumns({
        "semantic": k("curb_candidate", "step_candidate", "wall_or_green_boundary_candidate", "unknown_boundary", "unknown_boundary"),
        "state": k(F.when(seen, "observed").otherwise("inferred"), "observed", F.when(c("edge_support") >= 0.65, "observed").otherwise("inferred"), "inferred", "unknown"),
        "confidence": k(curb_conf, step_conf, wall_conf, weak_conf, 0.0),
        "reasons": C.reasons(few_links=c("links") < 5, short_run=c("continuity") < 2.0, weak_edge=c("edge_support") < 0.50, weak_road=c("road_support") < 0.60, weak_observed_road=c("observed_road_support") < 0.60,
                             weak_topology=c("topology_support") < 0.60, weak_inside_ground=c("inside_support") < 0.45,
                             inferred_continuation=c("_curb") & ~seen, basic_but_undecided=c("_basic") & ~c("_curb") & ~c("_step") & ~c("_wall"))})
    return out.drop("_basic", "_curb", "_step", "_wall")


def low_road_review(b: DataFrame) -> DataFrame:
    """Clear local steps that only lack road support."""
    return b.filter((F.col("continuity") >= 3.0) & (F.col("edge_support") >= 0.50) & (F.col("inside_support") >= 0.45) & (F.abs("height_delta") >= 0.035) & (F.col("road_support") < 0.60))


def sidewalk_options(links: DataFrame, bands: DataFrame, low: float = 0.45, high: float = 6.0, cos_min: float = 0.94) -> DataFrame:
    """Best outer boundary per curb link.  links: band_id, side, sample_id,
    lateral; bands: band_id, side, tx, ty, semantic, edge_support."""
    b = bands.select("band_id", "side", F.col("tx").alias("b_tx"), F.col("ty").alias("b_ty"), "semantic", "edge_support")
    l = links.select("band_id", "side", "sample_id", "lateral").join(b, ["band_id", "side"])
    inner = l.filter("semantic = 'curb_candidate'").alias("i")
    outer = l.filter("edge_support >= 0.35").alias("o")
    m = inner.join(outer, ["side", "sample_id"]).filter(F.col("i.band_id") != F.col("o.band_id"))
    width = F.abs("o.lateral") - F.abs("i.lateral")
    par = F.abs(F.col("i.b_tx") * F.col("o.b_tx") + F.col("i.b_ty") * F.col("o.b_ty"))
    m = m.select("side", "sample_id", F.col("i.band_id").alias("inner_id"), F.col("o.band_id").alias("outer_id"), F.col("i.lateral").alias("inner_lateral"), F.col("o.lateral").alias("outer_lateral"), width.alias("width"), par.alias("parallel"), F.col("o.edge_support").alias("outer_support"))
    m = m.filter((F.col("width") >= low) & (F.col("width") <= high) & (F.col("parallel") >= cos_min))
    pref = 1.0 - F.least(F.abs(F.col("width") - 1.80), F.lit(1.80)) / 1.80
    score = F.struct((F.col("width") >= 0.90).alias("ok"), pref.alias("pref"), "outer_support", "parallel", (-F.col("outer_id")).alias("tie"))
    cols = ["outer_id", "inner_lateral", "outer_lateral", "width", "parallel", "outer_support"]
    best = m.groupBy("side", "inner_id", "sample_id").agg(F.max_by(F.struct(*cols), score).alias("_b"))
    return best.select("side", "inner_id", "sample_id", "_b.*")


def sidewalk_runs(options: DataFrame, max_step: int = 3, max_jump: float = 0.75, rows_per_split=None) -> DataFrame:
    """Runs broken at sample gaps or jumps of the outer boundary."""
    return O.sessionize(options, ["side", "inner_id"], ["sample_id"], {"i": F.col("sample_id"), "l": F.col("outer_lateral")},
                        lambda p: (F.col("sample_id") > p["i"] + max_step) | (F.abs(F.col("outer_lateral") - p["l"]) > max_jump), "run", rows_per_split)


def sidewalk_surfaces(options: DataFrame, samples: DataFrame, ground: DataFrame, curbs: DataFrame, g: float = 0.2, rows_per_split=None) -> DataFrame:
    """Confirmed or possible sidewalk surfaces per run.  ``curbs``: inner_id,
    side, curb_confidence."""
    keys = ["side", "inner_id", "run"]
    r = sidewalk_runs(options, rows_per_split=rows_per_split).join(samples.select(F.col("id").alias("sample_id"), "x", "y", "tx", "ty"), "sample_id")
    r = S.cut(r.withColumns({"lo": F.least("inner_lateral", "outer_lateral"), "hi": F.greatest("inner_lateral", "outer_lateral")}))
    rk = [*keys, "sample_id"]
    pr = r.select(*rk, "x", "y", "tx", "ty", "lo", "hi", F.explode(F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("a")).withColumn("_lat", F.col("lo") * (1 - F.col("a")) + F.col("hi") * F.col("a"))
    pr = pr.select(F.struct(*rk, "a").alias("q_id"), (F.col("x") - F.col("ty") * F.col("_lat")).alias("x"), (F.col("y") + F.col("tx") * F.col("_lat")).alias("y"))
    hit = S.nearest_cell(pr, ground.select("ix", "iy"), g, 2, [], halo=True).groupBy(*[F.col(f"q_id.{k}").alias(k) for k in rk]).agg(F.count(F.lit(1)).alias("_h"))
    sup = r.join(hit, rk, "left").groupBy(*keys).agg(F.avg(F.coalesce(F.col("_h") == 3, F.lit(False)).cast("double")).alias("ground_support"), F.array_join(F.array_sort(F.collect_set(F.col("outer_id").cast("string"))), "|").alias("outer_ids"))
    cells = ribbon_fill(r.select(*keys, "x", "y", "tx", "ty", "lo", "hi"), ground, g).select(*keys, "ix", "iy").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("cells"))
    s = sup.join(medians(r, keys, ["width", "parallel", "outer_support"], rows_per_split), keys).join(longest_path(r, keys, rows_per_split=rows_per_split), keys).join(cells, keys, "left").fillna(0, ["cells"]).join(curbs, ["side", "inner_id"], "left")
    ok = (F.col("width") >= 0.90) & (F.col("continuity") >= 3.0) & (F.col("ground_support") >= 0.60) & (F.col("cells") >= 12)
    run = F.least(F.lit(1.0), F.col("continuity") / 8.0)
    conf = F.when(ok, F.least(F.lit(1.0), 0.25 * F.col("ground_support") + 0.25 * run + 0.20 * F.col("parallel") + 0.15 * F.coalesce("curb_confidence", F.lit(0.0)) + 0.15 * F.col("outer_support"))).otherwise(
        F.least(F.lit(0.49), 0.25 * F.col("ground_support") + 0.20 * run + 0.15 * F.col("parallel")))
    return s.withColumns({"classification": F.when(ok, "confirmed_sidewalk_or_shoulder").otherwise("possible_sidewalk_or_shoulder"), "evidence_state": F.when(ok, "observed").otherwise("inferred"), "confidence": conf,
                          "reason": C.reasons(short_run=F.col("continuity") < 3.0, narrow=F.col("width") < 0.90, weak_ground=F.col("ground_support") < 0.60, few_cells=F.col("cells") < 12)})


# --- constraints -------------------------------------------------------------------
def parallel_pairs(segs: DataFrame, max_angle: float = 12.0, min_overlap: float = 0.50, max_sep: float = 5.0, ambiguous: float = 0.45) -> DataFrame:
    """Same-side segment pairs, inner nearer to the road.  segs: id, side,
    road_distance, ax, ay, bx, by.  Overlapping pairs at most ``max_sep`` apart
    share a cell of that size (plus margin) along the outer segment."""
    g = max_sep + 3.0
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    s = segs.withColumn("len", C.hypot(dx, dy)).filter(F.col("len") > 0).withColumns({"tx": dx / F.col("len"), "ty": dy / F.col("len")})
    n = F.ceil(F.col("len") / 2.0).cast("int")
    laid = s.withColumn("_k", F.explode(F.sequence(F.lit(0), n))).withColumns({"ix": C.cell(F.col("ax") + dx * F.col("_k") / n, g), "iy": C.cell(F.col("ay") + dy * F.col("_k") / n, g)}).drop("_k").distinct()
    i = S.with_offsets(laid, ["ix", "iy"], S.square(1)).alias("i")
    m = i.join(laid.alias("o"), ["ix", "iy", "side"]).filter((F.col("i.id") != F.col("o.id")) & (F.col("i.road_distance") < F.col("o.road_distance")))
    c = F.col
    dot = F.abs(c("i.tx") * c("o.tx") + c("i.ty") * c("o.ty"))
    m = m.select(c("i.id").alias("inner_id"), c("o.id").alias("outer_id"), "side", c("i.road_distance").alias("inner_distance"), dot.alias("dot"),
                 c("i.len").alias("il"), c("o.len").alias("ol"), *[c(f"i.{k}").alias(k) for k in ("tx", "ty")],
                 *[(c(f"o.{e}") - c(f"i.{b}")).alias(f"d{e}") for e, b in (("ax", "ax"), ("ay", "ay"), ("bx", "ax"), ("by", "ay"))]).distinct()
    m = m.withColumns({"pa": c("dax") * c("tx") + c("day") * c("ty"), "pb": c("dbx") * c("tx") + c("dby") * c("ty"),
                       "separation": F.abs((c("day") + c("dby")) / 2 * c("tx") - (c("dax") + c("dbx")) / 2 * c("ty"))})
    m = m.withColumns({"lo": F.greatest(F.lit(0.0), F.least("pa", "pb")), "hi": F.least("il", F.greatest("pa", "pb"))})
    m = m.withColumn("overlap", F.greatest(F.lit(0.0), c("hi") - c("lo")) / F.least("il", "ol")).select("inner_id", "outer_id", "side", "inner_distance", "dot", "overlap", "separation")
    m = m.filter((F.col("dot") >= COS(max_angle)) & (F.col("overlap") >= min_overlap) & (F.col("separation") <= max_sep))
    return m.drop("dot").withColumn("ambiguous", F.col("separation") < ambiguous)


def constraint_status(records: DataFrame, pairs: DataFrame) -> DataFrame:
    """Six ordered outcomes; only the last keeps a (capped) confidence.
    records: id, road_distance, direction_deg, junction_m, continuity and supports."""
    amb = pairs.filter("ambiguous").select(F.explode(F.array("inner_id", "outer_id")).alias("id")).distinct().withColumn("_amb", F.lit(True))
    near = pairs.groupBy(F.col("outer_id").alias("id")).agg(F.min_by("inner_id", F.struct("inner_distance", -F.col("overlap"), "inner_id")).alias("nearer_id"))
    r = records.join(amb, "id", "left").join(near, "id", "left")
    st = (F.when(F.col("_amb"), "parallel_ambiguous_context_review").when(F.col("nearer_id").isNotNull(), "outer_context_edge").when(F.col("road_distance") > 5.0, "far_context_edge")
          .when(F.col("direction_deg") > 15.0, "direction_context_review").when(F.col("junction_m") < 6.0, "junction_context_review").otherwise("inferred_road_edge_constraint"))
    conf = F.least(F.lit(0.49), 0.12 * F.least(F.lit(1.0), F.col("continuity") / 10.0) + 0.16 * F.col("edge_support") + 0.16 * F.col("inside_support")
                   + 0.16 * F.greatest(F.lit(0.0), 1.0 - F.col("direction_deg") / 15.0) + 0.10 * F.col("topology_support"))
    r = r.withColumn("status", st)
    kept = F.col("status") == "inferred_road_edge_constraint"
    return r.withColumns({"evidence_state": F.when(kept, "inferred").otherwise("unknown"), "confidence": F.when(kept, conf).otherwise(0.0)}).drop("_amb")
