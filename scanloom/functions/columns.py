"""Scalar helpers as column expressions: grid keys, colour, quaternions, eigenvalues, text."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- grid -----------------------------------------------------------------
def cell(c, g: float) -> Column:
    return F.floor(col(c) / F.lit(float(g))).cast("long")


def cell_centre(c, g: float) -> Column:
    return (col(c) + F.lit(0.5)) * F.lit(float(g))


def cell_trunc(c, g: float) -> Column:
    """Odometry variant: truncate, then step down for every negative value; it
    differs from floor exactly on negative integers."""
    v = col(c) / F.lit(float(g))
    return (v.cast("long") - F.when(v < 0, 1).otherwise(0)).cast("long")


def hypot(*cs) -> Column:
    return F.sqrt(sum((col(c) * col(c) for c in cs[1:]), col(cs[0]) * col(cs[0])))


# --- finite ---------------------------------------------------------------
def is_finite(*cs) -> Column:
    ok = F.lit(True)
    for c in cs:
        # one test rejects null, NaN (which orders above infinity) and infinity
        ok = ok & F.coalesce(F.abs(col(c)) < F.lit(float("inf")), F.lit(False))
    return ok


# --- colour ---------------------------------------------------------------
def red(c) -> Column:
    return F.shiftright(col(c), 16).bitwiseAND(255)


def green(c) -> Column:
    return F.shiftright(col(c), 8).bitwiseAND(255)


def blue(c) -> Column:
    return col(c).bitwiseAND(255)


def pack_rgb(r, g, b) -> Column:
    return (F.shiftleft(col(r).cast("int"), 16) + F.shiftleft(col(g).cast("int"), 8) + col(b).cast("int")).cast("int")


# --- quaternions as (x, y, z, w) tuples of columns --------------------------
def quat(prefix: str = "q") -> tuple[Column, ...]:
    return tuple(F.col(f"{prefix}{a}") for a in "xyzw")


def vec(prefix: str = "t") -> tuple[Column, ...]:
    return tuple(F.col(f"{prefix}{a}") for a in "xyz")


def q_normalise(q):
    n = F.sqrt(q[0] * q[0] + q[1] * q[1] + q[2] * q[2] + q[3] * q[3])
    return tuple(a / n for a in q)


def q_conjugate(q):
    return (-q[0], -q[1], -q[2], q[3])


def q_multiply(a, b):
    ax, ay, az, aw = a
    bx, by, bz, bw = b
    return (aw * bx + ax * bw + ay * bz - az * by, aw * by - ax * bz + ay * bw + az * bx,
            aw * bz + ax * by - ay * bx + az * bw, aw * bw - ax * bx - ay * by - az * bz)


def cross(a, b):
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def q_rotate(q, v):
    """v + 2w(u x v) + 2u x (u x v)"""
    u, w = q[:3], q[3]
    t = tuple(F.lit(2.0) * c for c in cross(u, v))
    s = cross(u, t)
    return tuple(v[i] + w * t[i] + s[i] for i in range(3))


def apply_pose(q, t, v):
    r = q_rotate(q, v)
    return tuple(r[i] + t[i] for i in range(3))


def apply_inverse(q, t, v):
    return q_rotate(q_conjugate(q), tuple(v[i] - t[i] for i in range(3)))


def compose(qa, ta, qb, tb):
    return q_multiply(qa, qb), apply_pose(qa, ta, tb)


def inverse(q, t):
    c = q_conjugate(q)
    r = q_rotate(c, t)
    return c, tuple(-a for a in r)


def with_slerp(df, a: str, b: str, ratio: str, out: str = "q"):
    """Shortest-path interpolation of the quaternion columns ``{a}x..w`` and
    ``{b}x..w``; near-parallel inputs are interpolated linearly.  Built in steps
    so that shared terms are computed once."""
    ax = "xyzw"
    for p in (a, b):
        df = df.withColumn(f"_n_{p}", F.sqrt(sum((F.col(f"{p}{k}") * F.col(f"{p}{k}") for k in ax), F.lit(0.0))))
        df = df.withColumns({f"_{p}{k}": F.col(f"{p}{k}") / F.col(f"_n_{p}") for k in ax})
    df = df.withColumn("_dot", sum((F.col(f"_{a}{k}") * F.col(f"_{b}{k}") for k in ax), F.lit(0.0)))
    df = df.withColumns({"_sgn": F.when(F.col("_dot") < 0, -1.0).otherwise(1.0), "_th": F.acos(F.least(F.abs("_dot"), F.lit(1.0))), "_flat": F.abs("_dot") > 0.9995})
    u = F.col(ratio)
    df = df.withColumn("_sin", F.when(F.col("_flat"), 1.0).otherwise(F.sin("_th")))
    df = df.withColumns({"_wa": F.when(F.col("_flat"), 1.0 - u).otherwise(F.sin((1.0 - u) * F.col("_th")) / F.col("_sin")),
                         "_wb": F.col("_sgn") * F.when(F.col("_flat"), u).otherwise(F.sin(u * F.col("_th")) / F.col("_sin"))})
    df = df.withColumns({f"_r{k}": F.col(f"_{a}{k}") * F.col("_wa") + F.col(f"_{b}{k}") * F.col("_wb") for k in ax})
    df = df.withColumn("_rn", F.sqrt(sum((F.col(f"_r{k}") * F.col(f"_r{k}") for k in ax), F.lit(0.0))))
    df = df.withColumns({f"{out}{k}": F.col(f"_r{k}") / F.col("_rn") for k in ax})
    return df.drop("_dot", "_sgn", "_th", "_flat", "_sin", "_wa", "_wb", "_rn", f"_n_{a}", f"_n_{b}", *[f"_{p}{k}" for p in (a, b, "r") for k in ax])


def rotation_angle_deg(a, b):
    dot = F.abs(sum((x * y for x, y in zip(a, b)), F.lit(0.0)))
    return F.degrees(2.0 * F.acos(F.least(dot, F.lit(1.0))))


# --- so(3) ----------------------------------------------------------------
def so3_exp(v):
    """Rotation vector -> quaternion."""
    n = F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
    k = F.when(n > 1e-12, F.sin(n / 2) / F.when(n > 1e-12, n).otherwise(1.0)).otherwise(0.5)
    return (v[0] * k, v[1] * k, v[2] * k, F.when(n > 1e-12, F.cos(n / 2)).otherwise(1.0))


def so3_log(q):
    n = F.sqrt(q[0] * q[0] + q[1] * q[1] + q[2] * q[2])
    k = F.when(n > 1e-12, 2.0 * F.atan2(n, q[3]) / F.when(n > 1e-12, n).otherwise(1.0)).otherwise(2.0)
    return (q[0] * k, q[1] * k, q[2] * k)


# --- eigenvalues ----------------------------------------------------------
def eig2(sxx, sxy, syy):
    """(major, minor) eigenvalues of a symmetric 2x2."""
    mid, half = (sxx + syy) / 2, F.sqrt(F.pow((sxx - syy) / 2, 2) + sxy * sxy)
    return mid + half, mid - half


def with_eig3(df, names=("s_xx", "s_xy", "s_xz", "s_yy", "s_yz", "s_zz"), out=("lam_max", "lam_mid", "lam_min")):
    """Add the eigenvalues of a symmetric 3x3, closed form, in steps so that
    shared terms are computed once."""
    xx, xy, xz, yy, yz, zz = (F.col(n) for n in names)
    df = df.withColumn("_m", (xx + yy + zz) / 3)
    m = F.col("_m")
    df = df.withColumn("_p", F.sqrt((F.pow(xx - m, 2) + F.pow(yy - m, 2) + F.pow(zz - m, 2) + 2 * (xy * xy + xz * xz + yz * yz)) / 6))
    df = df.withColumn("_s", F.when(F.col("_p") > 1e-15, F.col("_p")).otherwise(1.0))
    s = F.col("_s")
    df = df.withColumns({"_a": (xx - m) / s, "_b": (yy - m) / s, "_c": (zz - m) / s, "_d": xy / s, "_e": xz / s, "_f": yz / s})
    a, b, c, d, e, f = (F.col(f"_{k}") for k in "abcdef")
    df = df.withColumn("_det", a * (b * c - f * f) - d * (d * c - f * e) + e * (d * f - b * e))
    df = df.withColumn("_phi", F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("_det") / 2))) / 3)
    ok, phi = F.col("_p") > 1e-15, F.col("_phi")
    df = df.withColumns({out[0]: F.when(ok, m + 2 * s * F.cos(phi)).otherwise(m), out[2]: F.when(ok, m + 2 * s * F.cos(phi + 2 * math.pi / 3)).otherwise(m)})
    df = df.withColumn(out[1], 3 * m - F.col(out[0]) - F.col(out[2]))
    return df.drop("_m", "_p", "_s", "_a", "_b", "_c", "_d", "_e", "_f", "_det", "_phi")


def body_covariance(x, y, z, range_err: float, bearing_err_deg: float):
    """Point covariance from range and bearing noise: six distinct entries."""
    r2 = x * x + y * y + z * z
    s = math.sin(math.radians(bearing_err_deg)) ** 2
    rr = range_err ** 2
    # d d^T rr + r^2 s (I - d d^T), with d the unit direction.
    e = {}
    for n, (a, b, same) in {"xx": (x, x, 1), "xy": (x, y, 0), "xz": (x, z, 0), "yy": (y, y, 1), "yz": (y, z, 0), "zz": (z, z, 1)}.items():
        dd = a * b / r2
        e[n] = dd * rr + r2 * s * (F.lit(float(same)) - dd)
    return e


# --- planar geometry --------------------------------------------------------
def point_segment_distance(px, py, ax, ay, bx, by):
    dx, dy = bx - ax, by - ay
    l2 = dx * dx + dy * dy
    t = F.when(l2 > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / F.when(l2 > 0, l2).otherwise(1.0)))).otherwise(0.0)
    return hypot(px - (ax + t * dx), py - (ay + t * dy))


def orientation(ax, ay, bx, by, cx, cy):
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def segments_cross(a, b, c, d):
    """Proper or touching intersection of segments ab and cd ((x, y) pairs)."""
    o1, o2 = orientation(*a, *b, *c), orientation(*a, *b, *d)
    o3, o4 = orientation(*c, *d, *a), orientation(*c, *d, *b)

    def on(p, q, r, o):
        return (o == 0) & r[0].between(F.least(p[0], q[0]), F.greatest(p[0], q[0])) & r[1].between(F.least(p[1], q[1]), F.greatest(p[1], q[1]))

    return ((o1 * o2 < 0) & (o3 * o4 < 0)) | on(a, b, c, o1) | on(a, b, d, o2) | on(c, d, a, o3) | on(c, d, b, o4)


def segment_distance(a, b, c, d):
    gap = F.least(point_segment_distance(*a, *c, *d), point_segment_distance(*b, *c, *d),
                  point_segment_distance(*c, *a, *b), point_segment_distance(*d, *a, *b))
    return F.when(segments_cross(a, b, c, d), 0.0).otherwise(gap)


def signed_area(ring: Column) -> Column:
    """Shoelace area of array<struct<x,y>> (open or closed ring)."""
    n = F.size(ring)
    idx = F.sequence(F.lit(0), n - 1)
    terms = F.transform(idx, lambda i: F.get(ring, i)["x"] * F.get(ring, (i + 1) % n)["y"] - F.get(ring, (i + 1) % n)["x"] * F.get(ring, i)["y"])
    return F.aggregate(terms, F.lit(0.0), lambda a, v: a + v) / 2


def half_turn(angle) -> Column:
    """Angle folded into [0, pi)."""
    return F.pmod(angle, F.lit(math.pi))


# --- text -------------------------------------------------------------------
def height_label(c) -> Column:
    """1.50 -> 1p5"""
    s = F.regexp_replace(F.format_string("%.2f", col(c)), "0+$", "")
    return F.regexp_replace(F.regexp_replace(s, r"\.$", ""), r"\.", "p")


def basename(c) -> Column:
    return F.element_at(F.split(col(c), "/"), -1)


def blank_to_null(c) -> Column:
    return F.nullif(F.trim(col(c)), F.lit(""))


def text_bool(c) -> Column:
    return F.lower(F.trim(col(c))).isin("1", "true")


def reasons(**flags: Column) -> Column:
    """'|'-joined names of the true flags, in the given order."""
    return F.concat_ws("|", *[F.when(v, F.lit(k)) for k, v in flags.items()])
