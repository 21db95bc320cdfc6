"""Packed R-tree: structure and nearest things against all pairs."""

import math
import random

import pytest

from scanloom.operators import rtree as R
from scanloom.operators import vectors as V


def point_segment(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    n = dx * dx + dy * dy
    u = 0 if n <= 1e-12 else max(0, min(1, ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / n))
    return math.hypot(p[0] - a[0] - u * dx, p[1] - a[1] - u * dy)


def segments(a, b, c, d):
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    if turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0:
        return 0.0
    return min(point_segment(a, c, d), point_segment(b, c, d), point_segment(c, a, b), point_segment(d, a, b))


@pytest.mark.parametrize("n,limit", [(700, 1.5), (700, 1e6), (1, 1e6), (0, 5.0)])
def test_distances(spark, n, limit):
    rnd = random.Random(n)
    at = lambda: (rnd.uniform(0, 40), rnd.choice([rnd.uniform(0, 40), 7.0]))
    some = []
    for _ in range(n):
        a = at()
        some.append((*a, *rnd.choice([a, (a[0] + rnd.uniform(-2, 2), a[1] + rnd.uniform(-2, 2)), (a[0] + 30, a[1])])))
    some += some[:1] * 50  # copies
    lines = []
    for i in range(120):
        a = at()
        lines.append((i // 2, *a, a[0] + rnd.uniform(-3, 3), a[1] + rnd.uniform(-3, 3)))
    want = {}
    for i, *s in lines:
        for t in some:
            d = segments(s[:2], s[2:], t[:2], t[2:])
            if d <= limit:
                want[i] = min(want.get(i, math.inf), d)
    xy = "x1 double, y1 double, x2 double, y2 double"
    got = {r.line_id: r.distance for r in V.min_distance(spark.createDataFrame(lines, "line_id bigint, " + xy), spark.createDataFrame(some, xy), limit).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_every_item_is_below_the_root_once(spark):
    rnd = random.Random(2)
    rows = [(i, x := rnd.uniform(0, 9), y := rnd.choice([rnd.uniform(0, 9), 4.0]), x + rnd.random(), y) for i in range(3000)]
    levels = R.build(spark.createDataFrame(rows, "id bigint, bx1 double, by1 double, bx2 double, by2 double"))
    assert len(levels) == 2
    above = {0: (-math.inf, -math.inf, math.inf, math.inf)}
    for k, level in enumerate(levels):
        found, here = level.collect(), {}
        count = {}
        for r in found:
            box = above[r.node]
            assert box[0] <= r.bx1 and box[1] <= r.by1 and box[2] >= r.bx2 and box[3] >= r.by2
            count[r.node] = count.get(r.node, 0) + 1
            if k < 1:
                here[r.entry] = (r.bx1, r.by1, r.bx2, r.by2)
        assert max(count.values()) <= (R.FAN_OUT if k else 10 ** 9) and set(count) == set(above)
        above = here
    assert sorted(r.id for r in found) == list(range(3000))
