"""Multi-frame evidence: votes per frame, stable voxels and ground, rays, step edges."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scanloom.functions import columns as C
from scanloom.operators import ordered as O
from scanloom.operators import points as P
from scanloom.operators import spatial as S


def frame_weight() -> Column:
    """An interpolated frame counts fully, a clamped one half."""
    return F.when(F.col("support") == "interpolated", 1.0).otherwise(0.5)


def stable_voxels(points: DataFrame, leaf: float = 0.2, min_frames: int = 3, min_weight: float = 2.0) -> DataFrame:
    """Voxels with counts, distinct frames, frame weight, colour and direction
    sums.  One row per (voxel, frame) first, so a frame votes once."""
    per = points.groupBy("frame_id", "support", *P.voxel_keys(leaf)).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(fn("rgb")).alias(k) for k, fn in (("r", C.red), ("g", C.green), ("b", C.blue))],
        F.sum(F.col("tx") - F.col("x")).alias("dx"), F.sum(F.col("ty") - F.col("y")).alias("dy"))
    v = per.groupBy("ix", "iy", "iz").agg(
        F.sum("n").alias("point_count"), F.count(F.lit(1)).alias("frame_count"), F.sum(frame_weight()).alias("frame_weight"),
        *[F.sum(c).alias(f"{k}_sum") for c, k in (("r", "red"), ("g", "green"), ("b", "blue"), ("dx", "to_sensor_x"), ("dy", "to_sensor_y"))])
    return v.withColumn("stable", (F.col("frame_count") >= min_frames) & (F.col("frame_weight") >= min_weight))


def columns_of(voxels: DataFrame, leaf: float, min_voxels: int = 4, min_span: float = 1.0) -> DataFrame:
    """Stable voxels per (ix, iy) with the vertical candidate flag."""
    z = C.cell_centre("iz", leaf)
    c = voxels.filter("stable").groupBy("ix", "iy").agg(
        F.count(F.lit(1)).alias("stable_voxels"), F.sum("frame_count").alias("frame_support_sum"), F.min(z).alias("min_z"), F.max(z).alias("max_z"),
        *[F.sum(f"{k}_sum").alias(f"{k}_sum") for k in ("red", "green", "blue")], F.sum("point_count").alias("color_weight"))
    return c.withColumn("candidate", (F.col("stable_voxels") >= min_voxels) & (F.col("max_z") - F.col("min_z") >= min_span))


def vertical_evidence(points: DataFrame, g: float = 0.2, r_min: float = 1.0, r_max: float = 30.0, min_points: int = 4,
                      min_span: float = 0.8, min_frames: int = 5, jitter: float = 0.25) -> DataFrame:
    """Columns seen in one frame, then their agreement across frames."""
    p = P.range_band(points, r_min, r_max)
    per = p.groupBy("frame_id", C.cell("x", g).alias("ix"), C.cell("y", g).alias("iy")).agg(
        F.count(F.lit(1)).alias("n"), F.min("z").alias("lo"), F.max("z").alias("hi")).filter((F.col("n") >= min_points) & (F.col("hi") - F.col("lo") >= min_span))
    v = per.groupBy("ix", "iy").agg(F.count(F.lit(1)).alias("vertical_frame_count"), *[f(c).alias(f"{name}_{k}") for name, c in (("lower", "lo"), ("upper", "hi")) for k, f in (("min", F.min), ("max", F.max), ("mean", F.avg))])
    return v.withColumn("persistent", (F.col("vertical_frame_count") >= min_frames) & (F.col("upper_max") - F.col("lower_min") >= min_span)
                        & (F.col("lower_max") - F.col("lower_min") <= jitter) & (F.col("upper_max") - F.col("upper_min") <= jitter))


def frame_ground(points: DataFrame, g: float) -> DataFrame:
    return points.groupBy("frame_id", "support", C.cell("x", g).alias("ix"), C.cell("y", g).alias("iy")).agg(
        F.avg("z").alias("z"), F.count(F.lit(1)).alias("n"))


def ground_layers(per_frame: DataFrame, gap: float = 0.08, rows_per_split=None) -> DataFrame:
    """Height layers of a cell: sorted frame means, a new layer after a gap.
    (Independent of the frame order, unlike a greedy assignment.)"""
    s = O.sessionize(per_frame, ["ix", "iy"], ["z", "frame_id"], {"z": F.col("z")}, lambda p: F.col("z") - p["z"] > gap, "layer", rows_per_split)
    return s.groupBy("ix", "iy", "layer").agg(
        F.sum("n").alias("point_count"), F.count_distinct("frame_id").alias("frame_count"), F.sum(frame_weight()).alias("effective_weight"),
        F.min("z").alias("z_min"), F.max("z").alias("z_max"), F.avg("z").alias("mean_z"))


def stable_ground(layers: DataFrame, min_frames: int = 3, min_weight: float = 2.0, max_span: float = 0.15) -> DataFrame:
    ok = (F.col("frame_count") >= min_frames) & (F.col("effective_weight") >= min_weight) & (F.col("z_max") - F.col("z_min") <= max_span)
    cols = ["mean_z", "point_count", "frame_count", "effective_weight", "z_min", "z_max"]
    best = layers.filter(ok).groupBy("ix", "iy").agg(F.max_by(F.struct(*cols), F.struct("frame_count", "effective_weight", -F.col("layer"))).alias("_b"))
    return best.select("ix", "iy", "_b.*")


def free_rays(points: DataFrame, g: float = 0.2, step: float = 0.4, r_max: float = 20.0, stride: int = 64) -> DataFrame:
    """Samples along every stride-th ray: count and distinct frames per cell."""
    p = P.decimate(points, stride).withColumns({"_dx": F.col("x") - F.col("tx"), "_dy": F.col("y") - F.col("ty")}).withColumn("_d", C.hypot("_dx", "_dy"))
    limit = F.least(F.lit(float(r_max)), F.col("_d") - 0.20)
    p = p.withColumn("_last", F.ceil(limit / step).cast("int") - 1).filter((F.col("_d") >= step) & (F.col("_last") >= 1))
    k = p.select("frame_id", "tx", "ty", "_dx", "_dy", "_d", F.explode(F.sequence(F.lit(1), F.col("_last"))).alias("k"))
    t = F.col("k") * F.lit(float(step))
    at = k.select("frame_id", F.floor((F.col("tx") + F.col("_dx") * t / F.col("_d")) / g).alias("ix"), F.floor((F.col("ty") + F.col("_dy") * t / F.col("_d")) / g).alias("iy"))
    per = at.groupBy("frame_id", "ix", "iy").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("ix", "iy").agg(F.sum("n").alias("free_ray_samples"), F.count(F.lit(1)).alias("free_frame_count"))


def evidence_grid(points: DataFrame, ground: DataFrame, vertical: DataFrame, free: DataFrame, g: float) -> DataFrame:
    """The evidence row of every touched cell."""
    per = points.groupBy("frame_id", "support", C.cell("x", g).alias("ix"), C.cell("y", g).alias("iy")).agg(F.count(F.lit(1)).alias("n"))
    raw = per.groupBy("ix", "iy").agg(F.sum("n").alias("raw_point_count"), F.count(F.lit(1)).alias("raw_point_frame_count"), F.sum(frame_weight()).alias("effective_frame_weight"))
    gr = ground.select("ix", "iy", F.col("mean_z").alias("ground_mean_z"), (F.col("z_max") - F.col("z_min")).alias("ground_z_span_m"), F.col("frame_count").alias("ground_frame_count"), F.lit(1).alias("stable_ground"))
    ve = vertical.select("ix", "iy", "vertical_frame_count", F.col("persistent").cast("int").alias("persistent_vertical"))
    out = raw.join(free, ["ix", "iy"], "full").join(gr, ["ix", "iy"], "left").join(ve, ["ix", "iy"], "left")
    zero = ["raw_point_count", "raw_point_frame_count", "effective_frame_weight", "free_ray_samples", "free_frame_count", "ground_frame_count", "stable_ground", "vertical_frame_count", "persistent_vertical"]
    out = out.fillna(0, subset=zero)
    return out.withColumns({"x": C.cell_centre("ix", g), "y": C.cell_centre("iy", g), "observation_confidence": F.least(F.lit(1.0), F.col("effective_frame_weight") / 4.0)})


def step_edges(ground: DataFrame, low: float = 0.06, high: float = 0.35) -> DataFrame:
    """Height steps between +x and +y neighbours; (u, v) is the half-grid centre."""
    a = S.with_offsets(ground.select("ix", "iy", F.col("mean_z").alias("za")).withColumns({"ex": F.col("ix"), "ey": F.col("iy")}), ["ix", "iy"], [(1, 0), (0, 1)])
    m = a.join(ground.select("ix", "iy", F.col("mean_z").alias("zb")), ["ix", "iy"])
    m = m.withColumn("delta", F.abs(F.col("za") - F.col("zb"))).filter((F.col("delta") >= low) & (F.col("delta") <= high))
    axis = F.when(F.col("ix") > F.col("ex"), 0).otherwise(1)
    return m.select(F.col("ex").alias("cell_ix"), F.col("ey").alias("cell_iy"), axis.alias("orientation"), ((F.col("za") + F.col("zb")) / 2).alias("z"),
                    (2 * F.col("ex") + F.when(axis == 0, 2).otherwise(1)).alias("u"), (2 * F.col("ey") + F.when(axis == 1, 2).otherwise(1)).alias("v"))


EDGE_REACH = [(u, v) for u in range(-3, 4) for v in range(-3, 4) if 0 < u * u + v * v <= 12]


def edge_components(edges: DataFrame, max_dz: float = 0.15, min_size: int = 4, tile: int = 256) -> DataFrame:
    """Connected step edges (half-grid distance^2 <= 12, similar height)."""
    nodes = edges.select(F.col("u").alias("ix"), F.col("v").alias("iy"), "z")
    lab = S.grid_components(nodes, EDGE_REACH, tile, lambda a, b: (a - b <= max_dz) & (b - a <= max_dz), "z")
    big = lab.groupBy("root_ix", "root_iy").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= min_size)
    return lab.join(big, ["root_ix", "root_iy"]).select(F.col("ix").alias("u"), F.col("iy").alias("v"), "z", F.col("root_ix").alias("root_u"), F.col("root_iy").alias("root_v"), "size")


# --- local ground planes --------------------------------------------------------
def _lowest(points: DataFrame, keys: Sequence[str], grid: float, cols=("lx", "ly", "lz")) -> DataFrame:
    """Lowest point per (group, local cell); bounded per frame by its range."""
    x, y, z = cols
    return points.groupBy(*keys, C.cell(x, grid).alias("ix"), C.cell(y, grid).alias("iy")).agg(F.min(F.struct(z, x, y)).alias("_m")).select(*keys, "ix", "iy", F.col(f"_m.{x}").alias("px"), F.col(f"_m.{y}").alias("py"), F.col(f"_m.{z}").alias("pz"))


def _plane_hypotheses(p: np.ndarray, seed: Sequence[int], tries: int, residual: float, min_nz: float, c_low: float, c_high: float):
    pick = np.random.default_rng(seed).integers(0, len(p), (tries, 3))
    a, b, c = (p[pick[:, i]] for i in range(3))
    n = np.cross(b - a, c - a)
    size = np.linalg.norm(n, axis=1)
    ok = size > 1e-9
    a, n = a[ok], n[ok] / size[ok, None]
    n[n[:, 2] < 0] *= -1
    ok = n[:, 2] >= min_nz
    a, n = a[ok], n[ok]
    sx, sy = -n[:, 0] / n[:, 2], -n[:, 1] / n[:, 2]
    c0 = (n * a).sum(1) / n[:, 2]
    ok = (c0 >= c_low) & (c0 <= c_high)
    sx, sy, c0 = sx[ok], sy[ok], c0[ok]
    if not len(c0):
        return None
    res = np.abs(p[:, 2] - (sx[:, None] * p[:, 0] + sy[:, None] * p[:, 1] + c0[:, None]))
    hits = (res <= residual).sum(1)
    i = int(np.argmax(hits))
    return float(sx[i]), float(sy[i]), float(c0[i]), int(hits[i])


def frame_planes(points: DataFrame, grid: float = 0.75, residual: float = 0.08, min_candidates: int = 24, min_inliers: int = 20,
                 separation: float = 0.13) -> DataFrame:
    """Primary and secondary local ground plane z = a x + b y + c per frame.

    The candidates (lowest point per local cell within 30 m) are found in Spark
    and number at most about 6,400 per frame; hypotheses are seeded by the frame
    and candidates ordered by cell, so the result is repeatable."""
    near = P.range_band(points, 1.5, 30.0, -1.5, 0.25)

    def fit(rank):
        def run(batches):
            for t in O.whole_groups(batches, "frame_id"):
                ids, p, out = t.column("frame_id").to_pylist(), np.stack([t.column(c).to_numpy() for c in ("px", "py", "pz")], 1), []
                code = O.group_codes(t.column("frame_id"))
                first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]).tolist()
                for i, j in zip(first, [*first[1:], len(code)]):
                    if j - i < min_candidates:
                        continue
                    best = _plane_hypotheses(p[i:j], [ids[i], rank], min(240, max(80, (j - i) // 2)), residual, 0.9, -1.5, -0.05)
                    if best is not None and best[3] >= min_inliers:
                        out.append((ids[i], *best, rank))
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, o)) for o in out], schema)
        return run

    def planes(candidates, rank):
        return O.by_group(candidates, "frame_id", ["ix", "iy"]).mapInArrow(fit(rank), "frame_id bigint, a double, b double, c double, inliers bigint, rank int")

    schema = pa.schema([("frame_id", pa.int64()), *((c, pa.float64()) for c in "abc"), ("inliers", pa.int64()), ("rank", pa.int32())])
    first = S.cut(planes(_lowest(near, ["frame_id"], grid), 1))
    rest = near.join(first.select("frame_id", "a", "b", "c"), "frame_id").filter(F.abs(F.col("lz") - (F.col("a") * F.col("lx") + F.col("b") * F.col("ly") + F.col("c"))) > separation)
    return first.unionByName(planes(_lowest(rest, ["frame_id"], grid), 2))


def on_plane(points: DataFrame, planes: DataFrame, residual: float = 0.08) -> DataFrame:
    """Points within the residual of either plane of their frame (1.5-30 m)."""
    wide = planes.groupBy("frame_id").agg(*[F.max(F.when(F.col("rank") == r, F.col(c))).alias(f"{c}{r}") for r in (1, 2) for c in ("a", "b", "c")])
    j = P.range_band(points, 1.5, 30.0).join(wide, "frame_id")
    off = lambda r: F.coalesce(F.abs(F.col("lz") - (F.col(f"a{r}") * F.col("lx") + F.col(f"b{r}") * F.col("ly") + F.col(f"c{r}"))) <= residual, F.lit(False))
    return j.filter(off(1) | off(2)).select(*points.columns)
