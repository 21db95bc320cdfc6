"""Nearest searches, components, rings, simplification, containment by brute force."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scanloom.operators import objects as B
from scanloom.operators import ordered as O
from scanloom.operators import spatial as S
from scanloom.operators import trajectory as J
from scanloom.operators import vectors as V


def test_nearest_within_hot_cell(spark):
    rnd = random.Random(1)
    pts = [(i, rnd.random() * 0.3, rnd.random() * 0.3) if i % 3 else (i, rnd.random() * 9 - 4, rnd.random() * 9 - 4) for i in range(400)] + [(900 + i, 0.125, 0.125) for i in range(50)]
    qs = [(i, rnd.random() * 2 - 0.5, rnd.random() * 2 - 0.5) for i in range(150)]
    p, q = spark.createDataFrame(pts, "pid bigint, x double, y double"), spark.createDataFrame(qs, "qid bigint, x double, y double")
    want = {}
    for i, x, y in qs:
        d, j = min((math.hypot(a - x, b - y), k) for k, a, b in pts)
        if d <= 0.5:
            want[i] = (j, round(d, 9))
    for cap in (4096, 8):
        got = {r["q_id"]: (r["p_id"], round(r["distance"], 9)) for r in S.nearest_within(q, p, ["x", "y"], 0.5, "qid", "pid", cap=cap).collect()}
        assert got == want


def test_revisits_hot_place(spark):
    rnd = random.Random(4)
    kf = [(i, float(i), rnd.random() * (1 if i % 2 else 40), rnd.random(), 0.0) for i in range(300)]
    df = spark.createDataFrame(kf, "id bigint, ts double, x double, y double, z double")
    want = {}
    for i, t, x, y, z in kf:
        c = [(math.dist((x, y, z), (a, b, e)), j) for j, u, a, b, e in kf if i - j >= 20 and abs(t - u) >= 30]
        c = [v for v in c if v[0] <= 10]
        if c:
            want[i] = min(c)[1]
    for cap in (4096, 10):
        assert {r["q_id"]: r["p_id"] for r in J.revisit_candidates(df, cap=cap).collect()} == want


def test_crossings(spark):
    rnd = random.Random(6)
    s = []
    for i in range(240):
        a = rnd.choice([0.0, 0.3, 1.2, 1.5]) + rnd.random() * 0.1
        s.append((i, rnd.random() * 12, rnd.random() * 12, math.cos(a), math.sin(a)))
    cell = lambda v: math.floor(v / 2.0)
    want = {i for i, x, y, a, b in s for j, u, v, c, d in s
            if abs(i - j) > 15 and abs(cell(x) - cell(u)) <= 1 and abs(cell(y) - cell(v)) <= 1 and math.hypot(x - u, y - v) <= 3 and abs(a * c + b * d) < 0.82}
    got = {r["id"] for r in J.crossings(spark.createDataFrame(s, "id bigint, x double, y double, tx double, ty double")).collect()}
    assert got == want


def brute_components(cells, offsets):
    left, out = set(cells), {}
    while left:
        start = min(left)
        stack, comp = [start], []
        left.discard(start)
        while stack:
            c = stack.pop()
            comp.append(c)
            for dx, dy in offsets:
                n = (c[0] + dx, c[1] + dy)
                if n in left:
                    left.discard(n)
                    stack.append(n)
        out.update({c: min(comp) for c in comp})
    return out


FOUR = [(1, 0), (0, 1), (-1, 0), (0, -1)]


@pytest.mark.parametrize("tile", [3, 7, 256])
def test_grid_components(spark, tile):
    rnd = random.Random(8)
    cells = list({(rnd.randrange(-15, 15), rnd.randrange(-15, 15)) for _ in range(520)})
    df = spark.createDataFrame(cells, "ix bigint, iy bigint")
    got = {(r.ix, r.iy): (r.root_ix, r.root_iy) for r in S.grid_components(df, FOUR, tile).collect()}
    assert got == brute_components(cells, FOUR)


def test_label_components_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101)]
    got = {r.node: r.root for r in S.label_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[103] == 100


def rings_of(spark, cells):
    df = spark.createDataFrame(cells, "ix bigint, iy bigint")
    lab = S.grid_components(df, FOUR, 4)
    v = V.trace_rings(lab, ["root_ix", "root_iy"])
    return v, V.ring_summary(v, ["root_ix", "root_iy"], 1.0)


def test_rings_over_tiles(spark, monkeypatch):
    """Chains of small tiles give the rings that one tile gives, and a table is written a level, not a doubling of the longest ring."""
    rnd = random.Random(11)
    cells = [(i, x - 9, y - 4) for i, g in enumerate((0.6, 0.8)) for x in range(18) for y in range(18) if rnd.random() < g or x == 9]
    df = spark.createDataFrame(cells, "k int, ix bigint, iy bigint").distinct()
    written, cut = [], V.cut
    monkeypatch.setattr(V, "cut", lambda d, *a: written.append(1) or cut(d, *a))
    order = ["k", "ring_id", "pos"]
    small, n = V.trace_rings(df, ["k"], 3).toPandas(), len(written)
    one = V.trace_rings(df, ["k"]).toPandas()
    assert n <= 4 and len(written) - n <= 3
    pd.testing.assert_frame_equal(small.sort_values(order, ignore_index=True), one.sort_values(order, ignore_index=True))
    for (_, name), g in one.sort_values("pos").groupby(["k", "ring_id"]):
        v = list(zip(g.x, g.y, g.d))
        assert g.pos.tolist() == list(range(len(v))) and (g.ring_size == len(v)).all()
        assert name == ":".join(map(str, min(v))) == ":".join(map(str, v[0]))
        assert all((x + V.DX[d], y + V.DY[d]) == (a, b) for (x, y, d), (a, b, _) in zip(v, v[1:] + v[:1]))


def test_ring_with_hole(spark):
    cells = [(x, y) for x in range(4) for y in range(4) if (x, y) not in ((1, 1), (2, 1))]
    v, s = rings_of(spark, cells)
    rows = sorted((r.area, r.ring_size, r.is_hole, r.outer_id is not None) for r in s.collect())
    assert rows == [(-2.0, 6, True, True), (16.0, 16, False, False)]
    for _, g in v.toPandas().groupby("ring_id"):
        g = g.sort_values("pos")
        assert g["pos"].tolist() == list(range(len(g)))
        step = (g["x"].shift(-1, fill_value=g["x"].iloc[0]) - g["x"]).abs() + (g["y"].shift(-1, fill_value=g["y"].iloc[0]) - g["y"]).abs()
        assert (step == 1).all()


def test_corner_touch_and_two_holes(spark):
    _, s = rings_of(spark, [(0, 0), (1, 1)])
    assert sorted(r.area for r in s.collect()) == [1.0, 1.0]
    cells = [(x, y) for x in range(7) for y in range(3) if (x, y) not in ((1, 1), (5, 1))]
    _, s = rings_of(spark, cells)
    assert sorted(r.area for r in s.collect()) == [-1.0, -1.0, 21.0]
    assert s.filter("is_hole AND outer_id IS NULL").count() == 0


def rdp(pts, tol):
    def far(a, b):
        (x1, y1), (x2, y2), best = pts[a], pts[b], (tol, None)
        n = math.hypot(x2 - x1, y2 - y1)
        for i in range(a + 1, b):
            x, y = pts[i]
            d = abs((y2 - y1) * x - (x2 - x1) * y + x2 * y1 - y2 * x1) / n if n >= 1e-12 else math.hypot(x - x1, y - y1)
            if d > best[0]:
                best = (d, i)
        return best[1]
    keep, stack = {0, len(pts) - 1}, [(0, len(pts) - 1)]
    while stack:
        a, b = stack.pop()
        i = far(a, b)
        if i is not None:
            keep.add(i)
            stack += [(a, i), (i, b)]
    return keep


def test_simplify(spark):
    rnd = random.Random(11)
    lines = {k: [(i * 0.5, rnd.random() * (0.05 if k == 0 else 2.0)) for i in range(40)] for k in range(3)}
    df = spark.createDataFrame([(k, i, x, y) for k, v in lines.items() for i, (x, y) in enumerate(v)], "k int, idx bigint, x double, y double")
    got = pd.DataFrame(V.simplify(df, ["k"]).collect(), columns=["k", "i"]).drop_duplicates().groupby("k")["i"].apply(set).to_dict()
    assert got == {k: rdp(v, 0.10) for k, v in lines.items()}


def below(plan, mark):
    """The lines of a printed plan under each line that holds ``mark``."""
    lines = plan.splitlines()
    depth = [len(v) - len(v.lstrip(" :+-")) for v in lines]
    for i, v in enumerate(lines):
        if mark in v:
            j = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            yield " ".join(lines[i + 1:j])


def test_pairs_of_points_and_polygons_are_not_moved(spark):
    """Points move by their cell alone, and pairs of lines and segments not before their distance is taken."""
    e = spark.range(800).selectExpr("id div 4 AS poly_id", "cast(id % 7 AS double) AS x1", "cast(id % 5 AS double) AS y1", "cast(id % 3 AS double) AS x2", "cast(id % 11 AS double) AS y2")
    p = spark.range(90).selectExpr("id AS point_id", "cast(id % 9 AS double) AS x", "cast(id % 13 AS double) AS y")
    plan = V.within(p, e, 4.0)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") and all("point_id" not in " ".join(below(plan, m)) for m in ("Join [poly_id",))
    lines = spark.range(90).selectExpr("id AS line_id", "cast(id % 9 AS double) AS x1", "cast(id % 13 AS double) AS y1", "cast(id % 9 AS double) + 1 AS x2", "cast(id % 13 AS double) AS y2")
    levels = V.R.build(e.selectExpr("x1", "y1", "least(x1, x2) bx1", "least(y1, y2) by1", "greatest(x1, x2) bx2", "greatest(y1, y2) by2"))
    found = V.R.search(lines.selectExpr("line_id", "x1 qx1", "y1 qy1", "x2 qx2", "y2 qy2"), levels, "line_id", 1.0)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert len(levels) == 2 and plan.count("Window [") == 1


def test_within_and_distance(spark):
    rnd = random.Random(12)
    polys = {}
    for k in range(12):
        cx, cy = rnd.random() * 20, rnd.random() * 20
        ang = sorted(rnd.random() * 2 * math.pi for _ in range(6))
        polys[k] = [(cx + 3 * math.cos(a), cy + 3 * math.sin(a)) for a in ang]
    edges = [(k, *v[i], *v[(i + 1) % 6]) for k, v in polys.items() for i in range(6)]
    pts = [(i, rnd.random() * 24 - 2, rnd.random() * 24 - 2) for i in range(300)]

    def inside(x, y, v):
        hit = False
        for (x1, y1), (x2, y2) in zip(v, v[1:] + v[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                hit = not hit
        return hit

    e = spark.createDataFrame(edges, "poly_id int, x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame(pts, "point_id bigint, x double, y double")
    assert {(r.point_id, r.poly_id) for r in V.within(p, e, 4.0).collect()} == {(i, k) for i, x, y in pts for k, v in polys.items() if inside(x, y, v)}

    lines = [(i, x, y, x + rnd.random() * 2, y + rnd.random()) for i, x, y in pts[:80]]

    def seg(p, a, b):
        l2 = (b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2
        u = max(0.0, min(1.0, ((p[0] - a[0]) * (b[0] - a[0]) + (p[1] - a[1]) * (b[1] - a[1])) / l2))
        return math.hypot(p[0] - a[0] - u * (b[0] - a[0]), p[1] - a[1] - u * (b[1] - a[1]))

    def cross(a, b, c, d):
        o = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
        return o(a, b, c) * o(a, b, d) < 0 and o(c, d, a) * o(c, d, b) < 0

    want = {}
    for i, x1, y1, x2, y2 in lines:
        a, b = (x1, y1), (x2, y2)
        best = 0.0 if any(inside(*q, v) for q in (a, b) for v in polys.values()) else min(
            0.0 if cross(a, b, (e[1], e[2]), (e[3], e[4])) else min(seg(a, (e[1], e[2]), (e[3], e[4])), seg(b, (e[1], e[2]), (e[3], e[4])), seg((e[1], e[2]), a, b), seg((e[3], e[4]), a, b)) for e in edges)
        if best <= 1.5:
            want[i] = round(best, 9)
    l = spark.createDataFrame(lines, "line_id bigint, x1 double, y1 double, x2 double, y2 double")
    assert {r.line_id: round(r.distance, 9) for r in V.min_distance(l, e, 1.5, e).collect()} == want


def test_coast_boxes_greedy(spark):
    rnd = random.Random(13)
    poses = [(f, f * 0.5, f * 0.1, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0) for f in range(6)]
    boxes = [(f, f * 100 + k, f * 0.5, rnd.random() * 3, rnd.random() * 3, 0.0, 2.0, 1.0, 1.0, 0.0, 1, 0.9) for f in range(6) for k in range(6)]
    p = spark.createDataFrame(poses, "frame_id bigint, ts double, tx double, ty double, tz double, qx double, qy double, qz double, qw double")
    b = spark.createDataFrame(boxes, "frame_id bigint, box_id bigint, ts double, x double, y double, z double, l double, w double, h double, yaw double, class int, score double")
    got = {(r.frame_id, r.box_id) for r in B.coast_boxes(b, p, 2.0, 3).collect()}
    want = set()
    for f in range(6):
        now = [(x[3], x[4]) for x in boxes if x[0] == f]
        for age in (1, 2, 3):
            for x in boxes:
                if x[0] == f - age:
                    c = (x[3] + age * 0.1, x[4])
                    if all((c[0] - u) ** 2 + (c[1] - v) ** 2 >= 0.25 for u, v in now):
                        now.append(c)
                        want.add((f, x[1]))
    assert got == want


def test_nearest_cell_ties_and_negatives(spark):
    cells = spark.createDataFrame([(-1, 0), (0, 0), (3, 3)], "ix bigint, iy bigint")
    q = spark.createDataFrame([(1, 0.0, 0.25), (2, -1e-9, 0.25), (3, 9.0, 9.0)], "q_id bigint, x double, y double")
    got = {r.q_id: (r.ix, r.iy) for r in S.nearest_cell(q, cells, 0.5, 2, []).collect()}
    assert got == {1: (-1, 0), 2: (-1, 0)}


def test_nearest_cell_repeats_no_query_for_each_offset(spark, monkeypatch):
    monkeypatch.setattr(S, "with_offsets", None)
    q = spark.createDataFrame([(1, -0.3, 0.2), (2, 2.4, 2.4), (3, None, 1.0), (4, 90.0, 90.0), (None, 0.1, 0.1)], "q_id int, x double, y double")
    cells = spark.createDataFrame([(x, y, float(x - y)) for x in range(-4, 8) for y in range(-4, 8) if (x * 5 + y * 3) % 7 == 0], "ix long, iy long, z double")
    got = {r.q_id: (r.ix, r.iy, r.z) for r in S.nearest_cell(q, cells, 0.5, 2, ["z"]).collect()}
    want = {}
    for i, x, y in ((1, -0.3, 0.2), (2, 2.4, 2.4), (None, 0.1, 0.1)):
        a, b = int(x // 0.5), int(y // 0.5)
        near = [(((c.ix + 0.5) * 0.5 - x) ** 2 + ((c.iy + 0.5) * 0.5 - y) ** 2, c.ix, c.iy, c.z) for c in cells.collect() if abs(c.ix - a) <= 2 and abs(c.iy - b) <= 2]
        want[i] = min(near)[1:]
    assert got == want


def test_coast_boxes_over_many_tasks(spark, monkeypatch):
    """Crowded frames, copies and boxes without position or id, over several tasks."""
    monkeypatch.setattr(O, "ROWS_PER_TASK", 40)
    rnd = random.Random(17)
    poses = [(f, f * 0.5, f * 0.1, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0) for f in range(9)]
    boxes = [(f, f * 100 + k, f * 0.5, rnd.random() * 2 - 1, rnd.random() * 2 - 1, 0.0, 2.0, 1.0, 1.0, 0.0, 1, 0.9) for f in range(9) for k in range(12)]
    boxes += boxes[:30] + [(3, 999, 1.5, None, 0.5, 0.0, 2.0, 1.0, 1.0, 0.0, 1, 0.9), (None, 5, 1.5, 0.0, 0.5, 0.0, 2.0, 1.0, 1.0, 0.0, 1, 0.9)]
    p = spark.createDataFrame(poses, "frame_id bigint, ts double, tx double, ty double, tz double, qx double, qy double, qz double, qw double")
    b = spark.createDataFrame(boxes, "frame_id bigint, box_id bigint, ts double, x double, y double, z double, l double, w double, h double, yaw double, class int, score double")
    got = sorted((r.frame_id, r.box_id) for r in B.coast_boxes(b, p, 2.0, 3).collect())
    want = []
    for f in range(9):
        now = [(x[3], x[4]) for x in boxes if x[0] == f and x[3] is not None]
        for age in (1, 2, 3):
            for x in sorted({x for x in boxes if x[0] == f - age}, key=lambda x: x[1]):
                if x[3] is None:
                    want.append((f, x[1]))
                    continue
                c = (x[3] + age * 0.1, x[4])
                if all((c[0] - u) ** 2 + (c[1] - v) ** 2 >= 0.25 for u, v in now):
                    now.append(c)
                    want += [(f, x[1])] * boxes.count(x)
    assert got == sorted(want)


def test_near_pairs_in_blocks():
    rnd = np.random.default_rng(3)
    frame, x, y = np.sort(rnd.integers(0, 4, 300)), rnd.uniform(-2, 2, 300), rnd.uniform(-2, 2, 300)
    x[:5] = np.nan
    got = sorted((i, j) for a, b in B.near_pairs(frame, x, y, 0.5, 50) for i, j in zip(a.tolist(), b.tolist()))
    assert got == [(i, j) for i in range(300) for j in range(300) if frame[i] == frame[j] and (x[i] - x[j]) ** 2 + (y[i] - y[j]) ** 2 < 0.25]
