"""Point cleaning, sensor normalisation, transforms and voxel aggregation."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from scanloom.functions import columns as C
from scanloom.operators import ordered as O
from scanloom.session import cut

#: Record order inside a frame; rows equal in all of these are interchangeable.
ORDER = ("seq", "x", "y", "z", "ring", "rgb")


def finite(df: DataFrame, cols: Sequence[str] = ("x", "y", "z"), on_bad: str = "skip") -> DataFrame:
    ok = C.is_finite(*cols)
    if on_bad == "skip":
        return df.filter(ok)
    first = cols[0]
    return df.withColumn(first, F.when(ok, F.col(first)).otherwise(F.raise_error(F.lit(f"not finite: {', '.join(cols)}"))))


def square_range() -> Column:
    return F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z")


def blind(df: DataFrame, r: float = 0.8, strict: bool = False) -> DataFrame:
    return df.filter(square_range() > r * r if strict else square_range() >= r * r)


def decimate(df: DataFrame, n: int, index: str = "seq") -> DataFrame:
    return df.filter(F.col(index) % n == 0)


def on_lines(n: int, tagged: bool = True) -> Column:
    ok = F.col("ring") < n
    return ok & (F.col("tag").bitwiseAND(0x30) == 0x10) if tagged else ok


def lines(df: DataFrame, n: int, tagged: bool = True) -> DataFrame:
    return df.filter(on_lines(n, tagged))


def drop_repeats(df: DataFrame, n: int, keys: Sequence[str] = ("frame_id",), order: Sequence[str] = ORDER,
                 rows_per_split: int | None = None) -> DataFrame:
    """Accepted records that differ from the record before them in the raw
    frame; a rejected predecessor counts as the origin, the first record goes."""
    ok = on_lines(n)
    nb = O.neighbour(df, keys, order, {"_has": F.lit(True), **{f"_p{c}": F.when(ok, F.col(c)).otherwise(0.0) for c in "xyz"}},
                     rows_per_split=rows_per_split)
    moved = F.lit(False)
    for c in "xyz":
        moved = moved | (F.abs(F.col(c) - F.col(f"_p{c}")) > 1e-7)
    return nb.filter(ok & F.col("_has") & moved).drop("_has", "_px", "_py", "_pz")


#: Fixed value: gap between two records of a 24,000-point, 100 ms scan, ms.
LIVOX_STEP_MS = 0.004166667


def repair_livox_times(df: DataFrame, n: int, rows_per_split: int | None = None) -> DataFrame:
    """Offsets (ms) of records on lines < n; a jump of 1 ms or more against the
    repaired previous offset is replaced by that offset plus one step.  A record
    rejected by its line leaves offset 0 behind."""
    def scan(pdf: pd.DataFrame, state):
        prev = state
        t, ok, out = pdf["time_ms"].to_numpy(), (pdf["ring"] < n).to_numpy(), []
        for v, keep in zip(t, ok):
            if not keep:
                prev = 0.0
            elif prev is None:
                prev = float(v) if abs(v) < 1.0 else 0.0
            else:
                prev = float(v) if abs(v - prev) < 1.0 else prev + LIVOX_STEP_MS
            out.append(prev)
        return pdf.assign(offset_ms=out)[ok], prev

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields) + ", offset_ms double"
    return O.carried_scan(df, ["frame_id"], list(ORDER), scan, ddl, rows_per_split)


def yaw_deg(per_rad: float = 57.2957) -> Column:
    return F.atan2("y", "x") * per_rad


#: Fixed value: degrees swept per millisecond.
SPIN_DEG_PER_MS = 3.61


def yaw_time(df: DataFrame, rows_per_split: int | None = None) -> DataFrame:
    """Offset (ms) from the angle swept since the first record of (frame, ring);
    after a step backwards one full turn is added from there on.  The first
    record of each ring is dropped."""
    keys = ["frame_id", "ring"]
    y = df.withColumn("_yaw", yaw_deg())
    y = O.first_per(y, keys, ORDER, {"_fp": F.col("_yaw")})
    swept = F.col("_fp") - F.col("_yaw")
    y = y.withColumn("_raw", F.when(F.col("_yaw") <= F.col("_fp"), swept).otherwise(swept + 360.0) / SPIN_DEG_PER_MS)
    y = O.neighbour(y, keys, ORDER, {"_last": F.col("_raw")}, rows_per_split=rows_per_split)
    back = F.coalesce(F.col("_raw") < F.col("_last"), F.lit(False)).cast("int")
    y = O.running(y.withColumn("_back", back), keys, ORDER, {"_turned": ("max", F.col("_back"))}, rows_per_split)
    return (y.filter(F.col("_last").isNotNull())
            .withColumn("offset_ms", F.col("_raw") + F.when(F.col("_turned") == 1, 360.0 / SPIN_DEG_PER_MS).otherwise(0.0))
            .drop("_yaw", "_fp", "_raw", "_last", "_back", "_turned"))


def normalise(df: DataFrame, sensor: str, n_scans: int = 128, every: int = 1, blind_m: float = 0.8,
              rows_per_split: int | None = None, timed: bool = True) -> DataFrame:
    """One table shape for every sensor: vendor ``time`` becomes ``offset_ms``.

    Time units: ouster and ns_offset ns, velodyne us (or none: from yaw),
    pandar128 / xt32 / robosense s stamps, avia ms, l515 none.  xt32_rings is the
    form of xt32 that features are taken from: all points of the first ``n_scans``
    rings with at least two points, times from the stamp or (not ``timed``) from the
    yaw, with the differences along the ring."""
    if sensor == "xt32_rings":
        from scanloom.operators.features import ring_differences
        out = df.filter(F.col("ring") < n_scans)
        out = out.withColumn("offset_ms", F.col("time") / 1000.0) if timed else yaw_time(out, rows_per_split)
        two = out.groupBy("frame_id", "ring").count().filter("count >= 2").select("frame_id", "ring")
        return ring_differences(out.join(two, ["frame_id", "ring"], "left_semi"), ORDER, rows_per_split)
    if sensor == "avia":
        out = repair_livox_times(df.withColumn("time_ms", F.col("time")), n_scans, rows_per_split).drop("time_ms")
        out = O.row_index(out, ["frame_id"], ORDER, "_valid", rows_per_split)
        return blind(out.filter(F.col("_valid") % every == 0).drop("_valid"), blind_m)
    if sensor == "l515":
        return decimate(df, every).withColumn("offset_ms", F.lit(0.0)).withColumns(
            {"red": C.red("rgb"), "green": C.green("rgb"), "blue": C.blue("rgb")})
    if sensor == "ouster":
        yaw = F.atan2("y", "x") * 57.3
        wrapped = F.when(yaw >= 180.0, yaw - 360.0).when(yaw <= -180.0, yaw + 360.0).otherwise(yaw)
        return blind(decimate(df, every), blind_m).withColumns({"offset_ms": F.col("time") / 1e6, "yaw": wrapped})
    if sensor == "velodyne":
        return blind(decimate(df.withColumn("offset_ms", F.col("time") / 1000.0), every), blind_m, True)
    if sensor == "velodyne_untimed":
        return blind(decimate(yaw_time(df, rows_per_split), every), blind_m, True)
    if sensor in ("pandar128", "xt32", "robosense"):
        out = O.first_per(df, ["frame_id"], ORDER, {"_head": F.col("time")})
        out = out.withColumn("offset_ms", (F.col("time") - F.col("_head")) * 1000.0).drop("_head")
        if sensor == "pandar128":
            out = out.withColumn("intensity", F.col("intensity") / 255.0)
        return blind(decimate(out, every), blind_m, True)
    if sensor == "ns_offset":
        out = finite(blind(decimate(df, every), blind_m), ("x", "y", "z", "time"))
        return out.filter((F.col("time") >= 0) & (F.col("ring") < n_scans)).withColumn("offset_ms", F.col("time") / 1e6)
    raise ValueError(f"unknown sensor: {sensor}")


def to_scan_records(df: DataFrame, stamp_ns: str = "stamp_ns") -> DataFrame:
    """Clamp reflectivity to a byte and the offset to 32 bits; absolute time is
    the scan stamp plus the offset."""
    off = F.least(F.greatest(F.col("offset_ns"), F.lit(0)), F.lit(4294967295)).cast("long")
    return df.withColumns({"reflectivity": F.least(F.greatest(F.col("intensity"), F.lit(0)), F.lit(255)).cast("int"), "offset_ns": off,
                           "t_ns": F.col(stamp_ns) + off})


def transform(df: DataFrame, q="q", t="t", out: Sequence[str] = ("mx", "my", "mz"), invert: bool = False) -> DataFrame:
    """Rigid transform by the row's own pose columns."""
    fn = C.apply_inverse if invert else C.apply_pose
    v = fn(C.quat(q), C.vec(t), (F.col("x"), F.col("y"), F.col("z")))
    return df.withColumns(dict(zip(out, v)))


def with_pose(points: DataFrame, poses: DataFrame, cols: Sequence[str] = ("tx", "ty", "tz", "qx", "qy", "qz", "qw")) -> DataFrame:
    """Equi-join on the frame.  The pose side has one row per frame; AQE turns it
    into a broadcast when its measured size allows and splits hot frames."""
    return points.join(poses.select("frame_id", *cols), "frame_id")


def range_band(df: DataFrame, r_min: float, r_max: float, z_min: float | None = None, z_max: float | None = None,
               cols: Sequence[str] = ("lx", "ly", "lz")) -> DataFrame:
    r = C.hypot(cols[0], cols[1])
    ok = (r >= r_min) & (r <= r_max)
    if z_min is not None:
        ok = ok & (F.col(cols[2]) >= z_min) & (F.col(cols[2]) <= z_max)
    return df.filter(ok)


# --- boxes ------------------------------------------------------------------
#: Lowest accepted score per detector class.
CLASS_SCORES = {0: 0.5, 6: 0.75, 8: 0.30}


def gate_boxes(df: DataFrame, scores: dict[int, float] | None = None) -> DataFrame:
    ok = F.lit(False)
    for cls, low in (scores or CLASS_SCORES).items():
        ok = ok | ((F.col("class") == cls) & (F.col("score") >= low))
    return df.filter(ok)


# --- geodetic ---------------------------------------------------------------
def rtk_quality(df: DataFrame) -> DataFrame:
    cols = ["latitude_deg", "longitude_deg", "altitude_m", "lat_std", "lon_std", "hgt_std", "diff_age_s", "heading_deg", "heading_std"]
    c = F.col
    return df.filter(C.is_finite(*cols) & (c("p_sol_status") == 0) & (c("pos_type") >= 34) & (c("lat_std") < 0.5) & (c("lon_std") < 0.5)
                     & (c("hgt_std") < 1.0) & (c("diff_age_s") < 5.0) & (c("heading_type") >= 40) & (c("heading_std") < 5.0))


EARTH_RADIUS_M = 6378137.0


def to_map(df: DataFrame, lat0: float, lon0: float, affine: Sequence[float], z_offset: float = 0.0) -> DataFrame:
    """Local east/north on a sphere at the anchor, then x = a e + b n + c, y = d e + e n + f."""
    east = F.radians(F.col("longitude_deg") - lon0) * F.cos(F.radians(F.lit(lat0))) * EARTH_RADIUS_M
    north = F.radians(F.col("latitude_deg") - lat0) * EARTH_RADIUS_M
    a, b, c, d, e, f = affine
    return df.withColumns({"map_x": a * east + b * north + c, "map_y": d * east + e * north + f, "map_z": F.col("altitude_m") + z_offset})


def map_yaw(heading, shift: float = 0.0) -> Column:
    full = F.lit(360.0)
    return F.pmod(F.lit(90.0) - F.pmod(C.col(heading) + F.lit(shift), full), full)


def lever_arm(df: DataFrame, lx: float, ly: float) -> DataFrame:
    yaw = F.radians("map_yaw_deg")
    return df.withColumns({"raw_map_x": F.col("map_x"), "raw_map_y": F.col("map_y"),
                           "map_x": F.col("map_x") + F.cos(yaw) * lx - F.sin(yaw) * ly,
                           "map_y": F.col("map_y") + F.sin(yaw) * lx + F.cos(yaw) * ly})


def prism(df: DataFrame, offset: Sequence[float]) -> DataFrame:
    r = C.apply_pose(C.quat(), C.vec(), tuple(F.lit(float(v)) for v in offset))
    return df.withColumns(dict(zip(("px", "py", "pz"), r)))


# --- de-skew ------------------------------------------------------------------
def deskew(points: DataFrame, imu: DataFrame, end: DataFrame, rows_per_split: int | None = None) -> DataFrame:
    """Bring each point to its scan end.  ``points``: scan_id, t, x, y, z;
    ``imu``: t, q*, t*, v*, a*, w* (pose, velocity, acceleration, rate);
    ``end``: scan_id, eq*, et*."""
    pay = [f"{p}{a}" for p in "tvaw" for a in "xyz"] + ["qx", "qy", "qz", "qw"]
    m = O.asof(points, imu, "t", payload=pay, rows_per_split=rows_per_split).filter(F.col("prev_t").isNotNull())
    dt = F.col("t") - F.col("prev_t")
    q = C.q_multiply(C.quat("prev_q"), C.so3_exp(tuple(F.col(f"prev_w{a}") * dt for a in "xyz")))
    p = tuple(F.col(f"prev_t{a}") + F.col(f"prev_v{a}") * dt + 0.5 * F.col(f"prev_a{a}") * dt * dt for a in "xyz")
    world = C.apply_pose(q, p, (F.col("x"), F.col("y"), F.col("z")))
    m = m.withColumns(dict(zip(("_wx", "_wy", "_wz"), world))).join(end, "scan_id")
    local = C.apply_inverse(C.quat("eq"), C.vec("et"), (F.col("_wx"), F.col("_wy"), F.col("_wz")))
    return m.withColumns(dict(zip(("dx", "dy", "dz"), local))).select(*points.columns, "dx", "dy", "dz")


# --- local ground -------------------------------------------------------------
def cell_min(points: DataFrame, g: float = 0.5) -> DataFrame:
    return points.groupBy(C.cell("x", g).alias("ix"), C.cell("y", g).alias("iy")).agg(F.min("z").alias("ground_z"))


def height_filter(points: DataFrame, grid_m: float = 0.5, heights: Sequence[float] = (0.25, 0.5)) -> DataFrame:
    """Points no higher than each threshold above the lowest point of their cell."""
    p = finite(points)
    ground = cell_min(p, grid_m)
    keyed = p.withColumn("ix", C.cell("x", grid_m)).withColumn("iy", C.cell("y", grid_m))
    rel = F.col("z") - F.col("ground_z")
    near = keyed.join(ground, ["ix", "iy"]).filter(rel <= max(heights))
    layer = F.array(*[F.lit(float(h)) for h in heights])
    return (near.withColumn("height_m", F.explode(F.filter(layer, lambda h: rel <= h)))
            .withColumn("layer", C.height_label("height_m")))


# --- voxels -------------------------------------------------------------------
def voxel_keys(g: float, cols: Sequence[str] = ("x", "y", "z"), names: Sequence[str] = ("ix", "iy", "iz")) -> list[Column]:
    return [C.cell(c, g).alias(n) for c, n in zip(cols, names)]


def voxel_centroid(points: DataFrame, leaf: float, keys: Sequence[str] = ()) -> DataFrame:
    return points.groupBy(*keys, *voxel_keys(leaf)).agg(
        *[F.avg(c).alias(c) for c in "xyz"], F.count(F.lit(1)).alias("n"))


def voxel_rgb(points: DataFrame, leaf: float) -> DataFrame:
    """Mean position and rounded (half away from zero), clamped mean colour;
    leaf 0 passes the points through."""
    if leaf == 0:
        return points.select("x", "y", "z", C.red("rgb").alias("r"), C.green("rgb").alias("g"), C.blue("rgb").alias("b"))
    tone = {n: F.least(F.greatest(F.round(F.avg(fn("rgb"))), F.lit(0)), F.lit(255)).cast("int").alias(n)
            for n, fn in (("r", C.red), ("g", C.green), ("b", C.blue))}
    return points.groupBy(*voxel_keys(leaf)).agg(*[F.avg(c).alias(c) for c in "xyz"], *tone.values())


def voxel_first(points: DataFrame, leaf: float, order: Sequence[str] = ORDER, keep: Sequence[str] = ORDER, keys: Sequence[str] = ()) -> DataFrame:
    first = F.min_by(F.struct(*keep), F.struct(*order)).alias("_f")
    names = [f"_v{i}" for i in range(3)]
    grouped = points.groupBy(*keys, *voxel_keys(leaf, names=names)).agg(first)
    return grouped.select(*keys, *[F.col(n).alias(m) for n, m in zip(names, ("ix", "iy", "iz"))], "_f.*")


def moments(points: DataFrame, keys: Sequence, cols: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Count, means and population covariances per group from plain sums."""
    sums = [F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{c}") for c in cols]]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    sums += [F.avg(F.col(a) * F.col(b)).alias(f"_{a}{b}") for a, b in pairs]
    g = points.groupBy(*keys).agg(*sums)
    for a, b in pairs:
        g = g.withColumn(f"s_{a}{b}", F.col(f"_{a}{b}") - F.col(f"m_{a}") * F.col(f"m_{b}")).drop(f"_{a}{b}")
    return g


def voxel_planes(points: DataFrame, size: float, threshold: float, min_points: int = 5, layer: int = 0,
                 max_layer: int = 2, compat: bool = False) -> DataFrame:
    """Planar voxels with their statistics; voxels that are not planar are split
    in eight and tried again, at most ``max_layer`` times."""
    key = C.cell_trunc if compat else C.cell
    keyed = points.withColumns({n: key(c, size) for c, n in zip("xyz", ("ix", "iy", "iz"))})
    m = moments(keyed, ["ix", "iy", "iz"]).filter(F.col("n") >= min_points)
    m = cut(C.with_eig3(m))
    # Normal: the longest cross product of two rows of (S - lam_min I).
    s = {p: F.col(f"s_{p}") for p in ("xx", "xy", "xz", "yy", "yz", "zz")}
    l = F.col("lam_min")
    rows = [(s["xx"] - l, s["xy"], s["xz"]), (s["xy"], s["yy"] - l, s["yz"]), (s["xz"], s["yz"], s["zz"] - l)]
    for i, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        m = m.withColumns({f"_c{i}{ax}": v for ax, v in zip("xyz", C.cross(rows[a], rows[b]))})
    m = m.withColumns({f"_n{i}": C.hypot(f"_c{i}x", f"_c{i}y", f"_c{i}z") for i in range(3)})
    m = m.withColumn("_top", F.greatest("_n0", "_n1", "_n2"))
    for ax in "xyz":
        m = m.withColumn(f"_u{ax}", F.when(F.col("_n0") == F.col("_top"), F.col(f"_c0{ax}")).when(F.col("_n1") == F.col("_top"), F.col(f"_c1{ax}")).otherwise(F.col(f"_c2{ax}")))
    scale = F.when(F.col("_top") > 0, F.when(F.col("_uz") < 0, -1.0).otherwise(1.0) / F.col("_top"))
    m = m.withColumns({f"normal_{ax}": F.col(f"_u{ax}") * scale for ax in "xyz"})
    m = m.drop("_top", *[f"_{k}{ax}" for k in ("c0", "c1", "c2", "u") for ax in "xyz"], "_n0", "_n1", "_n2")
    m = m.withColumns({"planar": F.col("lam_min") < threshold, "radius": F.sqrt(F.greatest(F.col("lam_max"), F.lit(0.0))),
                       "layer": F.lit(layer), "size": F.lit(float(size))})
    good = m.filter("planar").drop("planar")
    if layer >= max_layer:
        return good
    rest = cut(keyed.join(m.filter(~F.col("planar")).select("ix", "iy", "iz"), ["ix", "iy", "iz"]).select("x", "y", "z"))
    return good.unionByName(voxel_planes(rest, size / 2, threshold, min_points, layer + 1, max_layer, compat))
