"""Point features along a scan ring: differences, planes, edges and wires."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from scanloom.operators import ordered as O

#: Points of a group, smallest square ratio of its length to its width, largest ratio of its spacings.
GROUP, FLAT_RATIO, SPACING_RATIO = 8, 225.0, 3.24
#: Limits of the angles to the neighbours, of jumps and of small planes.
COS_BACK, COS_SIGHT, COS_BENT = math.cos(math.radians(170.0)), math.cos(math.radians(8.0)), math.cos(math.radians(160.0))
COS_STRAIGHT, SMALL_RATIO, JUMP_M2, JUMP_TIMES, STEADY_TIMES, STEADY_M = math.cos(math.radians(172.5)), 1.2, 0.0225, 4.0, 2.0, 0.1
#: Fixed value: cosine between which two planes that meet form an edge.
EDGE_COS = 0.707


def ring_differences(df: DataFrame, order: Sequence[str], rows_per_split: int | None = None) -> DataFrame:
    """``range2`` (square of the distance in the plane) and ``dist2`` (square of the
    distance to the next point of the ring; null for the last)."""
    nb = O.neighbour(df, ["frame_id", "ring"], order, {f"_n{c}": F.col(c) for c in "xyz"}, lead=True, rows_per_split=rows_per_split)
    d2 = sum((F.pow(F.col(f"_n{c}") - F.col(c), 2) for c in "xyz"), F.lit(0.0))
    return nb.withColumns({"range2": F.col("x") * F.col("x") + F.col("y") * F.col("y"), "dist2": d2}).drop("_nx", "_ny", "_nz")


def _sub(a, b):
    return tuple(p - q for p, q in zip(a, b))


def _dot(a, b) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def _cross2(a, b) -> Column:
    """Square length of the cross product."""
    c = (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])
    return _dot(c, c)


def point_labels(df: DataFrame, order: Sequence[str], blind_m: float = 0.8, rows_per_split: int | None = None) -> DataFrame:
    """``label`` of each point of a ring: blind, edge_plane, plane, edge_jump, wire,
    possible_plane or none.

    A group is a point with the ``GROUP`` points after it.  It is flat when it is long
    against its width and its spacings are alike (the smallest one set aside).  Points
    inside a flat group are planar, its two ends possibly so; where one flat group
    ends and another begins in a different direction is an edge between planes.
    Of the rest, a point that keeps its distance on one side and whose other
    neighbour lies far off along the line of sight is a jump edge, one with no
    ordinary neighbour a wire, and a straight, evenly spaced one a small plane.

    Groups have a fixed number of points, so all windows are row frames of fixed
    width and a ring of any length is cut into chunks."""
    keys = ["frame_id", "ring"]
    h = O.halo_chunks(O.row_index(df, keys, order, "_i", rows_per_split), keys, "_i", 2 * GROUP + 2, 2 * GROUP + 2)
    w = W.partitionBy(*keys, "_chunk").orderBy("_i")
    here = F.struct("x", "y", "z")
    h = h.select("*", *[F.lead(here, k).over(w).alias(f"_f{k}") for k in range(1, GROUP + 1)], *[F.lag(here, k).over(w).alias(f"_b{k}") for k in (1, 2)])
    at = lambda s: tuple(F.col(f"{s}.{c}") for c in "xyz")
    p = tuple(F.col(c) for c in "xyz")
    seen = lambda v: v[0] * v[0] + v[1] * v[1] >= blind_m * blind_m
    f = [p, *(at(f"_f{k}") for k in range(1, GROUP + 1))]
    v = _sub(f[GROUP], p)
    # one array per row: widths and spacings of the group
    h = h.withColumn("_w", F.array_max(F.array(*[_cross2(_sub(f[k], p), v) for k in range(1, GROUP)])))
    h = h.withColumn("_s", F.array_sort(F.array(*[_dot(_sub(f[k + 1], f[k]), _sub(f[k + 1], f[k])) for k in range(GROUP)])))
    two = _dot(v, v)
    whole = F.col(f"_f{GROUP}").isNotNull()
    for q in f:
        whole = whole & seen(q)
    flat = whole & (two * two >= FLAT_RATIO * F.col("_w")) & (F.col("_s")[1] >= 1e-16) & (F.col("_s")[GROUP - 1] < SPACING_RATIO * F.col("_s")[1])
    n = F.sqrt(two)
    h = h.withColumn("_flat", F.coalesce(flat, F.lit(False))).withColumn("_dir", F.when(F.col("_flat"), F.struct(*[(c / n).alias(a) for a, c in zip("xyz", v)])))
    inner = w.rowsBetween(-(GROUP - 1), -1)
    h = h.select("*", F.coalesce(F.max("_flat").over(inner), F.lit(False)).alias("_in"), F.coalesce(F.lag("_flat", GROUP).over(w), F.lit(False)).alias("_ends"), F.lag("_dir", GROUP).over(w).alias("_last"))
    h = h.filter("_core")
    bend = F.abs(_dot(at("_dir"), at("_last")))
    a, b, aa, bb = at("_b1"), at("_f1"), at("_b2"), at("_f2")
    va, vb = _sub(a, p), _sub(b, p)
    da, db = _dot(va, va), _dot(vb, vb)
    cos = lambda u, d: _dot(p, u) / F.sqrt(_dot(p, p)) / F.sqrt(d)
    ca, cb = cos(va, da), cos(vb, db)
    known = seen(a) & seen(b) & (da >= 1e-16) & (db >= 1e-16)
    usual = lambda c: (c >= COS_BACK) & (c <= COS_SIGHT)
    meet = _dot(va, vb) / F.sqrt(da) / F.sqrt(db)

    def steady(d, near, far):
        e = F.sqrt(_dot(_sub(far, near), _sub(far, near)))
        d = F.sqrt(d)
        return seen(near) & seen(far) & (F.greatest(d, e) <= STEADY_TIMES * F.least(d, e)) & (F.abs(d - e) <= STEADY_M)

    jump = known & (meet > COS_BENT) & ((usual(ca) & (cb > COS_SIGHT) & (db > JUMP_M2) & (db > JUMP_TIMES * da) & steady(da, a, aa))
                                        | (usual(cb) & (ca > COS_SIGHT) & (da > JUMP_M2) & (da > JUMP_TIMES * db) & steady(db, b, bb)))
    wire = known & ~usual(ca) & ~usual(cb)
    small = known & (meet < COS_STRAIGHT) & (F.greatest(da, db) < SMALL_RATIO * F.least(da, db)) & (F.least(da, db) >= 1e-8)
    border = F.col("_flat") | F.col("_ends")
    label = (F.when(~seen(p), "blind").when(F.col("_flat") & F.col("_ends") & (bend < EDGE_COS), "edge_plane")
             .when(F.col("_in") | (F.col("_flat") & F.col("_ends")), "plane").when(F.coalesce(jump, F.lit(False)), "edge_jump")
             .when(~border & F.coalesce(wire, F.lit(False)), "wire").when(~border & F.coalesce(small, F.lit(False)), "plane")
             .when(border, "possible_plane").otherwise("none"))
    return h.select(*df.columns, label.alias("label"))
