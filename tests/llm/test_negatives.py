"""Hard negatives against all pairs, and the curve and the bounds by themselves."""

import math
import random

import numpy as np

from scanloom.llm import negatives as N


def slow(rows):
    """Rows of (vec_id, vector, label) by the definition."""
    own = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = ((label + 1) % 10 if i % 7 == 0 else label, [max(-N.LARGEST, min(N.LARGEST, math.floor(256 * x))) for x in v])
        own[i] = min(own.get(i, row), row)
    out = []
    for a, (label, v) in own.items():
        if a % 50:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in own.items()}
        by = sorted((i for i in own if i != a), key=lambda i: (-score[i], i))
        for p in [i for i in by if own[i][0] == label][:5]:
            found = [i for i in by if own[i][0] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]][:3]
            out += [(a, p, k, i, score[p], score[i]) for k, i in enumerate(found, 1)]
    return sorted(out)


def run(df):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[c] for c in names) for r in N.hard_negatives(df).collect())


SCHEMA = "vec_id bigint, embedding array<float>, label int"


def test_curve_visits_neighbours():
    for axes, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes), -1).reshape(-1, axes)
        key = N.hilbert(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_score():
    rnd = np.random.default_rng(2)
    for size in (9, 10 ** 4, N.LARGEST):
        a, m = rnd.integers(-size, size, (20, 6)), rnd.integers(-size, size, (300, 6))
        low, high = N.bounds(a, m.min(axis=0)[None], m.max(axis=0)[None])
        exact = a.astype(object) @ m.astype(object).T
        assert all(low[i, 0] <= float(min(exact[i])) and high[i, 0] >= float(max(exact[i])) for i in range(20))
        want = np.array([[max(N.LEAST, min(N.MOST, int(x))) for x in row] for row in exact])
        assert (N._dots(a, m) == want).all()


def test_against_all_pairs_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 40)
    monkeypatch.setattr(N, "ZONES", 3)
    rnd = random.Random(5)
    middle = {k: [rnd.gauss(0, 0.3) for _ in range(6)] for k in range(4)}
    rows = []
    for i in range(900):
        k = rnd.choice([0, 0, 0, 1, 2, 3])  # one label has half of the rows
        rows.append((i, [x + rnd.gauss(0, 0.15) for x in middle[k]], k))
    rows += [(1000 + i, rows[0][1], rnd.choice([0, 1])) for i in range(60)]  # ties
    rows = [(i, np.array(v, np.float32).tolist(), k) for i, v, k in rows]
    want = slow(rows)
    assert len(want) > 100 and run(spark.createDataFrame(rows, SCHEMA)) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (0, [2.0, 0.5], 3), (1, [1.0, 0.5], 2), (2, [0.9], 1), (3, [], 2), (4, None, 1), (5, [None, 1.0], 1), (6, [nan, 1.0], 2), (8, [1.0, -inf], 2), (9, [1.0, 1.0], None), (None, [1.0, 1.0], 1),
            (7, [0.7, 0.3], 1), (11, [0.6, 0.2, 9.0], 2), (50, [1e30, -1e30], 1), (51, [3e38, 1.0], 1), (52, [1e9, 1.0], 2), (-50, [-1.0, -1.0], 2), (10, [0.7, 0.3], 4)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", id int, block string")
    assert run(df) == slow(rows)
    assert run(df.filter("false")) == []
    assert run(spark.createDataFrame([(0, [], 1), (1, [], 1), (2, [], 2)], SCHEMA)) == slow([(0, [], 1), (1, [], 1), (2, [], 2)])
