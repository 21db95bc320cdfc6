"""Grid-bucketed joins, nearest searches and connected regions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from scanloom.functions.columns import cell
from scanloom.session import cut, drop

NEAREST_CAP = 4096


def with_offsets(df: DataFrame, names: Sequence[str], offsets: Sequence[Sequence[int]]) -> DataFrame:
    """Repeat each row once per integer offset of its key columns."""
    boxes = [F.struct(*[(F.col(n) + F.lit(int(d))).alias(n) for n, d in zip(names, off)]) for off in offsets]
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.explode(F.array(*boxes)).alias("_k")).select(*rest, "_k.*")


def square(k: int, dims: int = 2) -> list[tuple[int, ...]]:
    """All integer offsets with every |component| <= k."""
    out = [()]
    for _ in range(dims):
        out = [(*o, d) for o in out for d in range(-k, k + 1)]
    return out


def neighbours(points: DataFrame, r: float, dims: Sequence[str] = ("x", "y"), keep: Sequence[str] = ()) -> DataFrame:
    """All pairs (id, other_id) of points at most ``r`` apart, each point with
    itself too: id, other_id, distance, the coordinates of both (``o_`` for the
    other) and the ``keep`` columns of the other.

    The result has as many rows as there are pairs, which is what is asked for;
    cells of size r only meet their neighbours.  Summaries over a radius should
    be taken from cells where points can lie on one spot."""
    d = list(dims)
    ks = [f"_k{i}" for i in range(len(d))]
    keyed = points.select("id", *d, *keep, *[cell(c, r).alias(k) for c, k in zip(d, ks)])
    other = keyed.select(*ks, F.col("id").alias("other_id"), *[F.col(c).alias(f"o_{c}") for c in (*d, *keep)])
    m = with_offsets(keyed.select("id", *d, *ks), ks, square(1, len(d))).join(other, ks)
    d2 = sum((F.pow(F.col(f"o_{c}") - F.col(c), 2) for c in d), F.lit(0.0))
    m = m.withColumn("_d2", d2).filter(F.col("_d2") <= r * r)
    return m.select("id", "other_id", F.sqrt("_d2").alias("distance"), *d, *[f"o_{c}" for c in (*d, *keep)])


def nearest_cell(queries: DataFrame, cells: DataFrame, grid: float, k: int, keep: Sequence[str], id_col: str = "q_id", halo: bool = False) -> DataFrame:
    """For each query (``id_col``, x, y) the occupied cell with the closest centre
    among the (2k+1)^2 cells around it; ties go to the lower (ix, iy).

    Cells are unique per (ix, iy) and gathered in blocks of (2k+1)^2, so the cells
    around a query lie in four blocks at most and it is repeated that often.  With
    ``halo`` a block has the ``k`` cells beyond its border too and cells are repeated
    instead, for queries that outnumber them."""
    n = 2 * k + 1
    block = lambda c: F.floor(c / n)
    reach = lambda c: F.explode(F.sequence(block(F.col(c) - k), block(F.col(c) + k)))
    own = lambda c: block(F.col(c))
    laid, sought = (reach, own) if halo else (own, reach)
    held = cells.select("ix", "iy", *keep).withColumn("_bx", laid("ix")).withColumn("_by", laid("iy")).groupBy("_bx", "_by").agg(F.collect_list(F.struct("ix", "iy", *keep)).alias("_cells"))
    q = queries.select(id_col, "x", "y", cell("x", grid).alias("_ix"), cell("y", grid).alias("_iy"))
    q = q.withColumn("_bx", sought("_ix")).withColumn("_by", sought("_iy"))
    off = lambda c: F.pow((c["ix"] + 0.5) * grid - F.col("x"), 2) + F.pow((c["iy"] + 0.5) * grid - F.col("y"), 2)
    near = F.filter("_cells", lambda c: (F.abs(c["ix"] - F.col("_ix")) <= k) & (F.abs(c["iy"] - F.col("_iy")) <= k))
    first = F.array_min(F.transform(near, lambda c: F.struct(off(c).alias("d2"), c["ix"].alias("ix"), c["iy"].alias("iy"), *[c[x].alias(x) for x in keep])))
    met = q.join(held, ["_bx", "_by"]).select(id_col, first.alias("_b")).filter(F.col("_b").isNotNull())
    return met.groupBy(id_col).agg(F.min("_b").alias("_b")).select(id_col, "_b.*")


def nearest_within(queries: DataFrame, points: DataFrame, dims: Sequence[str], r: float, q_id: str, p_id: str,
                   summary: dict[str, Column] | None = None,
                   cell_ok: Callable[[str], Column] | None = None, pair_ok: Column | None = None,
                   q_keep: Sequence[str] = (), p_keep: Sequence[str] = (), cap: int = NEAREST_CAP,
                   keys: Sequence[str] = ()) -> DataFrame:
    """Nearest point no further than ``r`` for each query, ties to the lower id.

    Points fall into cells of size r; a query looks at the 3^d around it.  When
    some cell holds more than ``cap`` points, cells are quartered level by level
    and only those that can still hold the nearest point stay (lower bound of
    the cell <= smallest upper bound), so a hot cell is never paired with all
    its queries.  ``pair_ok`` restricts pairs; ``cell_ok`` must then say, from
    the ``summary`` aggregates of a cell, that it surely holds an allowed point.
    Query and point columns are read as ``q.<name>`` and ``p.<name>``."""
    d = list(dims)
    p = points.select(*keys, p_id, *d, *p_keep)
    if pair_ok is None:
        # Copies of one position: only the lowest id can win.
        p = p.groupBy(*keys, *d).agg(F.min(F.struct(p_id, *p_keep)).alias("_m")).select(*keys, *d, "_m.*")
    size, level = float(r), 0
    ks = [f"_k{i}" for i in range(len(d))]

    def keyed(df, s):
        return df.select("*", *[cell(c, s).alias(k) for c, k in zip(d, ks)])

    while level < 12:
        top = keyed(p, size / 4 ** level).groupBy(*keys, *ks).count().agg(F.max("count")).first()[0]
        if top is None or top <= cap:
            break
        level += 1
    q = queries.select(*keys, q_id, *d, *q_keep)
    cand = with_offsets(keyed(q, size), ks, square(1, len(d)))
    for lv in range(level):
        s = size / 4 ** lv
        aggs = [F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(f"_lo_{c}") for c in d], *[F.max(c).alias(f"_hi_{c}") for c in d],
                *[c.alias(n) for n, c in (summary or {}).items()]]
        cells_at = keyed(p, s).groupBy(*keys, *ks).agg(*aggs)
        m = cand.alias("q").join(cells_at.alias("p"), [*keys, *ks])
        lo = sum((F.pow(F.greatest(F.col(f"_lo_{c}") - F.col(c), F.col(c) - F.col(f"_hi_{c}"), F.lit(0.0)), 2) for c in d), F.lit(0.0))
        hi = sum((F.pow(F.greatest(F.abs(F.col(f"_lo_{c}") - F.col(c)), F.abs(F.col(f"_hi_{c}") - F.col(c))), 2) for c in d), F.lit(0.0))
        sure = F.lit(True) if pair_ok is None else cell_ok("p")
        m = m.select(*keys, q_id, *d, *q_keep, *ks, lo.alias("_lb"), F.when(sure, hi).alias("_ub")).filter(F.col("_lb") <= r * r)
        bound = m.groupBy(*keys, q_id).agg(F.min("_ub").alias("_best"))
        # Upper bounds get a hair of slack against rounding.
        m = m.join(bound, [*keys, q_id]).filter(F.col("_best").isNull() | (F.col("_lb") <= F.col("_best") * (1 + 1e-12) + 1e-18))
        child = m.select(*keys, q_id, *d, *q_keep, *[(F.col(k) * 4).alias(k) for k in ks])
        cand = cut(with_offsets(child, ks, [tuple(o) for o in np.ndindex(*([4] * len(d)))]))
    m = cand.alias("q").join(keyed(p, size / 4 ** level).alias("p"), [*keys, *ks])
    d2 = sum((F.pow(F.col(f"q.{c}") - F.col(f"p.{c}"), 2) for c in d), F.lit(0.0))
    m = m.withColumn("_d2", d2).filter(F.col("_d2") <= r * r)
    if pair_ok is not None:
        m = m.filter(pair_ok)
    best = m.groupBy(*keys, F.col(f"q.{q_id}").alias("q_id")).agg(
        F.min(F.struct(F.col("_d2").alias("d2"), F.col(f"p.{p_id}").alias("p_id"), *[F.col(f"p.{c}").alias(c) for c in p_keep])).alias("_b"))
    return best.select(*keys, "q_id", F.sqrt("_b.d2").alias("distance"), F.col("_b.p_id").alias("p_id"), *[F.col(f"_b.{c}").alias(c) for c in p_keep])


def grid_components(nodes: DataFrame, offsets: Sequence[tuple[int, int]], tile: int = 256,
                    link: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
                    link_col: str | None = None, extra_key: str | None = None) -> DataFrame:
    """Connected regions of unique grid nodes (ix, iy).

    ``offsets`` is the neighbourhood; ``link(a, b)`` may restrict links by
    ``link_col``.  Regions inside one tile (at most tile^2 nodes) are found
    locally; only links across tile borders enter ``label_components``.  The
    label is the smallest (ix, iy) of the region, as ``root_ix, root_iy``."""
    half = [o for o in offsets if o > (0, 0)]
    cols = ["ix", "iy", *([link_col] if link_col else [])]
    base = nodes.select(*cols).withColumn("_tx", F.floor(F.col("ix") / tile)).withColumn("_ty", F.floor(F.col("iy") / tile))

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ix", "iy"], kind="stable").reset_index(drop=True)
        x, y = pdf["ix"].to_numpy(), pdf["iy"].to_numpy()
        pos = {k: i for i, k in enumerate(zip(x.tolist(), y.tolist()))}
        parent = list(range(len(pdf)))

        def find(a):
            while parent[a] != a:
                parent[a] = parent[parent[a]]
                a = parent[a]
            return a

        v = pdf[link_col].to_numpy() if link_col else None
        for (dx, dy) in half:
            for (cx, cy), i in pos.items():
                j = pos.get((cx + dx, cy + dy))
                if j is None or (link is not None and not link(v[i], v[j])):
                    continue
                a, b = find(i), find(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        root = np.array([find(i) for i in range(len(pdf))])
        return pd.DataFrame({**{c: pdf[c] for c in cols}, "l_ix": x[root], "l_iy": y[root]})

    types = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    ddl = ", ".join(f"{c} {types[c]}" for c in cols) + ", l_ix bigint, l_iy bigint"
    done = cut(base.groupBy("_tx", "_ty").applyInPandas(local, ddl))
    inside = lambda c: F.pmod(F.col(c), F.lit(tile))
    reach = max(max(abs(a), abs(b)) for a, b in offsets)
    near = F.lit(False)
    for c in ("ix", "iy"):
        near = near | (inside(c) < reach) | (inside(c) >= tile - reach)
    rim = done.filter(near)
    a = with_offsets(rim.select("ix", "iy", F.col("l_ix").alias("a_ix"), F.col("l_iy").alias("a_iy"), *([F.col(link_col).alias("va")] if link_col else [])), ["ix", "iy"], half)
    b = rim.select("ix", "iy", F.col("l_ix").alias("b_ix"), F.col("l_iy").alias("b_iy"), *([F.col(link_col).alias("vb")] if link_col else []))
    cross = a.join(b, ["ix", "iy"])
    if link is not None:
        cross = cross.filter(link(F.col("va"), F.col("vb")))
    edges = (cross.filter((F.col("a_ix") != F.col("b_ix")) | (F.col("a_iy") != F.col("b_iy")))
             .select(F.struct(F.col("a_ix").alias("ix"), F.col("a_iy").alias("iy")).alias("a"),
                     F.struct(F.col("b_ix").alias("ix"), F.col("b_iy").alias("iy")).alias("b")).distinct())
    roots = label_components(edges)
    return (done.withColumn("node", F.struct(F.col("l_ix").alias("ix"), F.col("l_iy").alias("iy")))
            .join(roots, "node", "left")
            .select(*cols, F.coalesce("root.ix", "l_ix").alias("root_ix"), F.coalesce("root.iy", "l_iy").alias("root_iy")))


def label_components(edges: DataFrame) -> DataFrame:
    """Smallest node of every connected component, for the nodes of ``edges(a, b)``.

    Each round hooks every node to its smallest neighbour, follows the pointers
    to their roots and replaces the edges by the distinct edges between roots,
    so the graph shrinks until no edge is left.  Every round is written to the
    shared folder and the tables of the round before are deleted."""
    live = cut(edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct())
    labels = cut(live.select(F.col("a").alias("node")).union(live.select("b")).distinct().withColumn("root", F.col("node")))
    while not live.isEmpty():
        both = live.union(live.select("b", "a"))
        ptr = held = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to")))
        while True:
            nxt = ptr.join(ptr.select(F.col("node").alias("to"), F.col("to").alias("far")), "to", "left")
            nxt = cut(nxt.select("node", F.coalesce("far", "to").alias("new"), F.col("to").alias("old")))
            drop(held)
            held, ptr = nxt, nxt.select("node", F.col("new").alias("to"))
            if nxt.filter(F.col("new") != F.col("old")).isEmpty():
                break
        up = ptr.select(F.col("node").alias("root"), F.col("to").alias("_r"))
        named = cut(labels.join(up, "root", "left").select("node", F.coalesce("_r", "root").alias("root")))
        ea = live.join(ptr.select(F.col("node").alias("a"), F.col("to").alias("ra")), "a")
        rest = cut(ea.join(ptr.select(F.col("node").alias("b"), F.col("to").alias("rb")), "b")
                   .filter(F.col("ra") != F.col("rb")).select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
        drop(labels, live, held)
        labels, live = named, rest
    return labels
