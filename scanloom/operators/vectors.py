"""Vector features: rings, simplification, containment, distances, layers, export."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from scanloom.functions import columns as C
from scanloom.operators import ordered as O
from scanloom.operators import rtree as R
from scanloom.operators import spatial as S
from scanloom.session import cut, drop

#: Unit steps of the four edge directions, counter-clockwise.
DX, DY = (1, 0, -1, 0), (0, 1, 0, -1)
#: Largest block of whole cells is 2 to this power.
BLOCK_LEVELS = 20


def _by_dir(d: Column, values: Sequence[int]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), d + 1).cast("long")


def cell_edges(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Directed counter-clockwise edges (x, y, d) of every cell."""
    corner = [(0, 0, 0), (1, 0, 1), (1, 1, 2), (0, 1, 3)]
    e = F.explode(F.array(*[F.struct((F.col("ix") + a).alias("x"), (F.col("iy") + b).alias("y"), F.lit(d).alias("d")) for a, b, d in corner]))
    return cells.select(*keys, e.alias("_e")).select(*keys, "_e.*")


def cancel_edges(edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Directed edges whose reverse does not exist."""
    rev = edges.select(*keys, (F.col("x") + _by_dir(F.col("d"), DX)).alias("x"), (F.col("y") + _by_dir(F.col("d"), DY)).alias("y"), ((F.col("d") + 2) % 4).alias("d"))
    return edges.join(rev, [*keys, "x", "y", "d"], "left_anti")


def _walk(keys: Sequence[str]):
    """Follow the pieces of one tile (``trace_rings``): whatever a piece leads to inside the tile is
    appended to it.  What comes back are the pieces with the chain they are part of."""
    pts = ("x", "y", "d")

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.reset_index(drop=True)
        group = pdf.groupby(list(keys), sort=False).ngroup().tolist() if keys else [0] * len(pdf)
        ids = {k: i for i, k in enumerate(zip(group, *(pdf[c].tolist() for c in pts)))}
        to = [ids.get(k, -1) for k in zip(group, *(pdf["n" + c].tolist() for c in pts))]
        labs, size, at = list(zip(*(pdf["l" + c].tolist() for c in pts))), pdf["len"].tolist(), pdf["l_off"].tolist()
        first = np.ones(len(pdf), bool)
        first[[j for j in to if j >= 0]] = False
        head, off, chain = [-1] * len(pdf), [0] * len(pdf), {}
        # What no chain reaches is a ring inside the tile; it starts where its label is.
        for i in [*np.flatnonzero(first).tolist(), *sorted(np.flatnonzero(~first).tolist(), key=labs.__getitem__)]:
            if head[i] >= 0:
                continue
            j, n, best = i, 0, None
            while j >= 0 and head[j] < 0:
                head[j], off[j] = i, n
                if best is None or labs[j] < best[0]:
                    best = (labs[j], n + at[j])
                n, last, j = n + size[j], j, to[j]
            chain[i] = (n, *best[0], best[1], last, j >= 0)
        out = pdf[[*keys, *pts]].copy()
        for c in pts:
            out["h" + c] = pdf[c].to_numpy()[head]
        out["off"] = off
        info = list(zip(*(chain[i] for i in head)))
        for c, v in zip(("len", "lx", "ly", "ld", "l_off"), info):
            out[c] = v
        for c in pts:
            out["n" + c] = pdf["n" + c].to_numpy()[list(info[5])]
        out["closed"] = info[6]
        return out
    return walk


def trace_rings(cells: DataFrame, keys: Sequence[str], tile: int = 128) -> DataFrame:
    """Closed boundary rings of labelled cells, one row per vertex in order.

    Every boundary edge has one successor (left-most turn at corners), so rings
    are the cycles of a pointer table.  Edges of a tile are strung into chains, these
    into longer ones in tiles of 16 times the side, until every chain is closed; a
    tile only holds the chains that cross the borders of the tiles below.  On the way
    back every piece takes its place from the chain it is part of."""
    k, pts = list(keys), ("x", "y", "d")
    c = F.col
    e = cut(cancel_edges(cell_edges(cells, k), k))
    ends = e.select(*k, *[c(p).alias(f"e{p}") for p in pts], (c("x") + _by_dir(c("d"), DX)).alias("x"), (c("y") + _by_dir(c("d"), DY)).alias("y"))
    turn = F.pmod(c("d") - c("ed"), F.lit(4))
    pref = F.when(turn == 1, 0).when(turn == 0, 1).otherwise(2)
    nxt = ends.join(e, [*k, "x", "y"]).filter(turn != 2).groupBy(*k, "ex", "ey", "ed").agg(F.min_by(F.struct(*pts), pref).alias("o"))
    nodes = nxt.select(*k, *[c(f"e{p}").alias(p) for p in pts], *[c(f"o.{p}").alias(f"n{p}") for p in pts], F.lit(1).cast("long").alias("len"),
                       *[c(f"e{p}").alias(f"l{p}") for p in pts], F.lit(0).cast("long").alias("l_off"))
    x0, y0 = e.agg(F.min("x"), F.min("y")).first()
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.select(*k, *pts).schema.fields)
    ddl += ", hx bigint, hy bigint, hd int, off bigint, len bigint, lx bigint, ly bigint, ld int, l_off bigint, nx bigint, ny bigint, nd int, closed boolean"
    levels = []
    while True:
        in_tile = [F.floor((c(p) - F.lit(o or 0)) / tile).alias(f"_t{p}") for p, o in (("x", x0), ("y", y0))]
        done = cut(nodes.groupBy(*in_tile).applyInPandas(_walk(k), ddl))
        levels.append(done)
        rest = done.filter("NOT closed AND x = hx AND y = hy AND d = hd")
        if rest.isEmpty():
            break
        nodes, tile = rest.select(*nodes.columns), tile * 16
    ring = None
    for done in reversed(levels):
        whole = done.filter("closed").select(*k, *pts, "lx", "ly", "ld", c("len").alias("ring_size"), F.pmod(c("off") - c("l_off"), c("len")).alias("pos"))
        if ring is not None:
            part = done.filter("NOT closed").select(*k, *pts, "hx", "hy", "hd", "off")
            up = ring.withColumnsRenamed({p: f"h{p}" for p in pts})
            whole = whole.unionByName(part.join(up, [*k, "hx", "hy", "hd"]).select(*k, *pts, "lx", "ly", "ld", "ring_size", ((c("pos") + c("off")) % c("ring_size")).alias("pos")))
        ring = whole
    return ring.select(*k, F.concat_ws(":", "lx", "ly", "ld").alias("ring_id"), "pos", "ring_size", *pts)


def ring_summary(vertices: DataFrame, keys: Sequence[str], g: float) -> DataFrame:
    """Area and role of each ring; a hole names the outer ring that contains it.

    With one outer ring per region that is the answer; otherwise the crossings
    of the hole's own row with the outer rings' vertical edges decide."""
    k = list(keys)
    ex, ey = F.col("x") + _by_dir(F.col("d"), DX), F.col("y") + _by_dir(F.col("d"), DY)
    r = vertices.groupBy(*k, "ring_id").agg((F.sum(F.col("x") * ey - ex * F.col("y")) / 2 * g * g).alias("area"), F.first("ring_size").alias("ring_size"),
                                            F.min_by(F.struct("x", "y"), "pos").alias("_s"), F.min(F.when(F.col("d") == 3, F.struct("x", "y"))).alias("_l"))
    r = cut(r.withColumn("is_hole", F.col("area") < 0))
    outer = r.filter(~F.col("is_hole"))
    single = outer.groupBy(*k).agg(F.count(F.lit(1)).alias("_n"), F.min("ring_id").alias("_only"))
    # A hole's left-most downward edge starts at (x, y); the hole cell right below it is in row y - 1, column x - 1.
    h = r.filter("is_hole").join(single, k, "left")
    many = h.filter("_n > 1").select(*k, "ring_id", (F.col("_l.y") - 1).alias("row"), F.col("_l.x").alias("hx"))
    up = vertices.filter("d in (1, 3)").join(outer.select(*k, "ring_id"), [*k, "ring_id"]).select(*k, F.col("ring_id").alias("outer_id"), F.when(F.col("d") == 1, F.col("y")).otherwise(F.col("y") - 1).alias("row"), F.col("x").alias("ox"))
    hit = many.join(up, [*k, "row"]).filter(F.col("ox") >= F.col("hx")).groupBy(*k, "ring_id", "outer_id").agg((F.count(F.lit(1)) % 2).alias("odd")).filter("odd = 1").groupBy(*k, "ring_id").agg(F.min("outer_id").alias("_hit"))
    h = h.join(hit, [*k, "ring_id"], "left").select(*k, "ring_id", F.when(F.col("_n") == 1, F.col("_only")).otherwise(F.col("_hit")).alias("outer_id"))
    return r.select(*k, "ring_id", "area", "ring_size", "is_hole").join(h, [*k, "ring_id"], "left")


def simplify(points: DataFrame, keys: Sequence[str], idx: str = "idx", tol: float = 0.10) -> DataFrame:
    """Vertices kept by maximum-deviation splitting, level by level: all open
    intervals of all lines are split at once by partial ``max_by``."""
    k = list(keys)
    e = points.groupBy(*k).agg(F.min(idx).alias("lo"), F.max(idx).alias("hi"))
    p = cut(points.select(*k, F.col(idx).alias("i"), "x", "y").join(e, k))
    kept = cut(e.select(*k, F.explode(F.array("lo", "hi")).alias("i")).distinct())
    while True:
        ends = [p.filter(F.col("i") == F.col(c)).select(*k, "lo", "hi", F.col("x").alias(f"{c}x"), F.col("y").alias(f"{c}y")).distinct() for c in ("lo", "hi")]
        j = p.filter((F.col("i") > F.col("lo")) & (F.col("i") < F.col("hi"))).join(ends[0].join(ends[1], [*k, "lo", "hi"]), [*k, "lo", "hi"])
        dx, dy = F.col("hix") - F.col("lox"), F.col("hiy") - F.col("loy")
        n = C.hypot(dx, dy)
        off = F.when(n < 1e-12, C.hypot(F.col("x") - F.col("lox"), F.col("y") - F.col("loy"))).otherwise(F.abs(dy * F.col("x") - dx * F.col("y") + F.col("hix") * F.col("loy") - F.col("hiy") * F.col("lox")) / F.when(n < 1e-12, 1.0).otherwise(n))
        far = cut(j.withColumn("_d", off).groupBy(*k, "lo", "hi").agg(F.max(F.struct("_d", -F.col("i"))).alias("_m")).filter(F.col("_m._d") > tol).select(*k, "lo", "hi", (-F.col("_m.col2")).alias("cut_i")))
        if far.isEmpty():
            drop(p, far)
            return kept
        more = cut(kept.unionByName(far.select(*k, F.col("cut_i").alias("i"))))
        # Only intervals that are split go on; the split vertex closes one and opens the other.
        q = p.join(far, [*k, "lo", "hi"])
        left = q.filter(F.col("i") <= F.col("cut_i")).withColumn("hi", F.col("cut_i")).drop("cut_i")
        right = q.filter(F.col("i") >= F.col("cut_i")).withColumn("lo", F.col("cut_i")).drop("cut_i")
        rest = cut(left.unionByName(right))
        drop(p, kept, far)
        p, kept = rest, more


# --- containment and distance ------------------------------------------------------
def within(points: DataFrame, edges: DataFrame, g: float = 8.0) -> DataFrame:
    """(point_id, poly_id) with the point inside (holes excluded).  ``edges``:
    poly_id, x1, y1, x2, y2 of all rings.

    Cells that an edge passes are border cells; only their points are tested against
    the edges of their row.  All other cells of a row lie wholly in or out: the cells
    between the crossings of the row's centre line, taken in pairs, are in.  These
    stretches are cut into blocks of 1, 2, 4, ... cells, so that a wide polygon has a
    few blocks a row, and a point meets them by its cell at each block size."""
    c = F.col
    row = edges.withColumn("iy", F.explode(F.sequence(C.cell(F.least("y1", "y2"), g), C.cell(F.greatest("y1", "y2"), g))))
    x_at = lambda y: c("x1") + (c("x2") - c("x1")) * (y - c("y1")) / (c("y2") - c("y1"))
    clip = lambda y: F.least(F.greatest(y, F.least("y1", "y2")), F.greatest("y1", "y2"))
    ends = [F.when(c("y1") == c("y2"), c(f"x{i}")).otherwise(x_at(clip((c("iy") + k) * F.lit(g)))) for i, k in ((1, 0), (2, 1))]
    pad = 1e-9 * g
    border = row.withColumn("ix", F.explode(F.sequence(C.cell(F.least(*ends) - pad, g), C.cell(F.greatest(*ends) + pad, g)))).select("poly_id", "ix", "iy").distinct()
    mid = (c("iy") + 0.5) * F.lit(g)
    cross = row.filter((c("y1") > mid) != (c("y2") > mid)).select("poly_id", "iy", x_at(mid).alias("at"))
    w = W.partitionBy("poly_id", "iy").orderBy("at")
    span = cross.select("poly_id", "iy", F.row_number().over(w).alias("k"), (C.cell("at", g) + 1).alias("a"), C.cell(F.lead("at").over(w), g).alias("b")).filter("k % 2 = 1 AND b > a")
    lo, hi = (lambda l: F.expr(f"a + shiftleft(1L, {l}) - 1 >> {l}")), (lambda l: F.expr(f"b >> {l}"))
    lv = span.withColumn("l", F.explode(F.sequence(F.lit(0), F.lit(BLOCK_LEVELS))))
    lv = lv.withColumns({"p": lo("l"), "q": hi("l"), "pp": lo("l + 1"), "qq": hi("l + 1")}).filter("p < q")
    top = (c("l") == BLOCK_LEVELS) | (c("pp") >= c("qq"))
    parts = F.when(top, F.sequence("p", c("q") - 1)).otherwise(F.array_compact(F.array(F.when(c("p") < 2 * c("pp"), c("p")), F.when(c("q") > 2 * c("qq"), c("q") - 1))))
    blocks = cut(lv.select("poly_id", "iy", "l", F.explode(parts).alias("block")))
    levels = [r.l for r in blocks.select("l").distinct().collect()]
    p = points.select("point_id", "x", "y", C.cell("x", g).alias("ix"), C.cell("y", g).alias("iy"))
    # Edges meet their border cells first, so points move once, by cell, and are tested and counted there;
    # level edges are never crossed, nor those that end a cell or more to the left.
    sides = border.join(row.filter("y1 <> y2"), ["poly_id", "iy"]).filter(F.greatest("x1", "x2") > (c("ix") - 1) * F.lit(g))
    near = p.join(sides, ["ix", "iy"]).filter(((c("y1") > c("y")) != (c("y2") > c("y"))) & (c("x") < x_at(c("y"))))
    tested = near.groupBy("ix", "iy", "point_id", "x", "y", "poly_id").count().filter(c("count") % 2 == 1).select("point_id", "poly_id")
    if not levels:
        return tested.distinct()
    at = p.withColumn("l", F.explode(F.array(*map(F.lit, levels)))).withColumn("block", F.expr("ix >> l"))
    whole = at.join(blocks, ["iy", "l", "block"]).select("point_id", "poly_id", "ix", "iy").join(border, ["poly_id", "ix", "iy"], "left_anti")
    return tested.union(whole.select("point_id", "poly_id")).distinct()


def _distances(pairs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``d``, the distance of the segments (x1, y1)-(x2, y2) and (s_x1, s_y1)-(s_x2, s_y2):
    0 where they cross or touch within 1e-10, else the least distance of an end to the other segment.

    Steps are columns of their own and free of nulls and divisions, so that the generated
    code stays below the size that the JVM compiles."""
    c = lambda n: F.coalesce(F.col(n), F.lit(0.0))
    keep = list(keep)
    m = pairs.select(*keep, *[(c(f"{a}2") - c(f"{a}1")).alias(f"d{a[-1]}" if a in "xy" else f"e{a[-1]}") for a in ("x", "y", "s_x", "s_y")], *[(c(f"s_{a}1") - c(f"{a}1")).alias(f"r{a}") for a in "xy"])
    f = F.col
    cross = lambda a, b: f(f"{a}x") * f(f"{b}y") - f(f"{a}y") * f(f"{b}x")
    dot = lambda a, b: f(f"{a}x") * f(f"{b}x") + f(f"{a}y") * f(f"{b}y")
    m = m.select("*", cross("d", "e").alias("de_"), cross("d", "r").alias("dr_"), cross("e", "r").alias("er_"), dot("d", "e").alias("de"), dot("d", "r").alias("dr"), dot("e", "r").alias("er"),
                 *[F.when(dot(k, k) > 1e-12, F.coalesce(F.try_divide(F.lit(1.0), dot(k, k)), F.lit(0.0))).otherwise(0.0).alias(f"i{k}") for k in "de"])
    clamp = lambda u: F.greatest(F.lit(0.0), F.least(F.lit(1.0), u))
    m = m.select("*", clamp(f("dr") * f("id")).alias("u1"), clamp((f("dr") + f("de")) * f("id")).alias("u2"), clamp(-f("er") * f("ie")).alias("u3"), clamp((f("de") - f("er")) * f("ie")).alias("u4"))
    off = {"1": lambda a: f(f"r{a}") - f("u1") * f(f"d{a}"), "2": lambda a: f(f"r{a}") + f(f"e{a}") - f("u2") * f(f"d{a}"), "3": lambda a: f(f"r{a}") + f("u3") * f(f"e{a}"), "4": lambda a: f(f"d{a}") - f(f"r{a}") - f("u4") * f(f"e{a}")}
    m = m.select(*keep, *[g(a).alias(f"o{k}{a}") for k, g in off.items() for a in "xy"], ((f("dr_") * (f("dr_") + f("de_")) < 0) & (f("er_") * (f("er_") + f("de_")) < 0)).alias("x"))
    m = m.select(*keep, "x", F.least(*[f(f"o{k}x") * f(f"o{k}x") + f(f"o{k}y") * f(f"o{k}y") for k in "1234"]).alias("q"))
    return m.select(*keep, F.when(f("x") | (f("q") <= 1e-20), 0.0).otherwise(F.sqrt("q")).alias("d"))


def min_distance(lines: DataFrame, segments: DataFrame, max_d: float, polygons: DataFrame | None = None) -> DataFrame:
    """Smallest distance of each line to the segments, up to ``max_d`` (lines
    further away are absent); 0 where it touches or lies inside a polygon.
    lines: line_id, x1, y1, x2, y2 (rows of one id are one line); segments: x1, y1, x2, y2.

    The segments are packed into an R-tree; a line meets those whose boxes can hold its
    nearest one.  Distances are taken where the pairs are made; only the least of a line
    and part of the pairs moves."""
    low, high = (lambda c: F.least(f"{c}1", f"{c}2")), (lambda c: F.greatest(f"{c}1", f"{c}2"))
    items = segments.select("x1", "y1", "x2", "y2").distinct().select(*[F.col(c).alias(f"s_{c}") for c in ("x1", "y1", "x2", "y2")], low("x").alias("bx1"), low("y").alias("by1"), high("x").alias("bx2"), high("y").alias("by2"))
    levels = R.build(items)
    each = lines.select("line_id", "x1", "y1", "x2", "y2", low("x").alias("qx1"), low("y").alias("qy1"), high("x").alias("qx2"), high("y").alias("qy2"))
    if not levels:
        m = each.limit(0).select("*", *[F.lit(0.0).alias(f"s_{c}") for c in ("x1", "y1", "x2", "y2")])
    else:
        m = R.search(each, levels, "line_id", max_d)
    m = _distances(m, ["line_id"])
    if polygons is not None:
        ends = lines.select("line_id", F.explode(F.array(*[F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in (1, 2)])).alias("_e")).select(F.col("line_id").alias("point_id"), "_e.*")
        m = m.unionByName(within(ends, polygons).select(F.col("point_id").alias("line_id"), F.lit(0.0).alias("d")))
    # A filter before the sum would be pushed below all steps of the distance, as one large expression.
    return m.groupBy("line_id").agg(F.min("d").alias("distance")).filter(F.col("distance") <= max_d)


# --- states and layers -----------------------------------------------------------------
def cell_states() -> dict[str, Column]:
    src = F.col("primary_source")
    return {"geometry_evidence_state": F.lit("observed"),
            "semantic_evidence_state": F.when((src == "two_sided_measured") & F.col("observed"), "observed").when(src.isin("two_sided_continuity_bridge", "fixed_width_fallback"), "inferred").otherwise("unknown"),
            "layer": F.when((src == "two_sided_measured") & F.col("observed"), "road_surface_observed").when(src == "two_sided_continuity_bridge", "road_search_surface_continuity")
            .when(src == "fixed_width_fallback", "road_search_surface_fixed_width").otherwise("road_search_surface_unknown")}


def section_states() -> dict[str, Column]:
    k = F.col("class")
    pick = lambda a, b, c, d: F.when(k == "two_sided_measured_road_core", a).when(k == "two_sided_continuity_bridge", b).when(k == "one_sided_measured_boundary", c).otherwise(d)
    return {"geometry_evidence_state": F.lit("observed"), "semantic_evidence_state": pick("observed", "inferred", "unknown", "unknown"),
            "layer": pick("road_centerline_observed", "road_centerline_continuity", "trajectory_reference_direction_candidate", "junction_or_open_area_candidate")}


def road_axis(rows: DataFrame) -> DataFrame:
    ok = F.col("class").isin("two_sided_measured_road_core", "two_sided_continuity_bridge") & F.col("left_m").isNotNull() & F.col("right_m").isNotNull()
    off = F.when(ok, (F.col("left_m") - F.col("right_m")) / 2)
    d = rows.withColumn("axis_offset", off)
    o = F.coalesce("axis_offset", F.lit(0.0))
    return d.withColumns({"axis_x": F.col("x") - F.col("ty") * o, "axis_y": F.col("y") + F.col("tx") * o})


def section_segments(rows: DataFrame, keys: Sequence[str], rows_per_split=None) -> DataFrame:
    """Runs of consecutive samples that agree in all key columns."""
    return O.sessionize(rows, [], ["sample_id"], {"i": F.col("sample_id"), "k": F.struct(*keys)}, lambda p: (F.col("sample_id") != p["i"] + 1) | ~F.struct(*keys).eqNullSafe(p["k"]), "segment_id", rows_per_split)


def width_profile(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment_id").agg(F.first("layer").alias("layer"), F.min("sample_id").alias("first_id"), F.max("sample_id").alias("last_id"), F.min("width").alias("width_min_m"), F.max("width").alias("width_max_m"), F.avg("width").alias("width_mean_m"))


def route_boundary() -> Column:
    return F.when(F.col("semantic") == "curb_candidate", "curb_candidates").otherwise("boundary_unknown")


def route_constraint() -> Column:
    return F.when(F.col("status") == "inferred_road_edge_constraint", "road_edge_constraints").otherwise("road_edge_context")


def route_sidewalk() -> Column:
    return F.when(F.col("classification") == "confirmed_sidewalk_or_shoulder", "sidewalk_or_shoulder_confirmed").otherwise("sidewalk_or_shoulder_context")


#: Classes of cross sections that stay open areas.
OPEN_CLASSES = ("two_sided_abnormal_width_open_candidate", "no_boundary_default_width_candidate")


def open_areas(segments: DataFrame) -> DataFrame:
    """One candidate line (a point for a lone sample) of each segment without road evidence."""
    s = segments.filter(F.col("class").isin(*OPEN_CLASSES)).groupBy("segment_id").agg(F.count(F.lit(1)).alias("samples"), F.min("sample_id").alias("first_id"), F.max("sample_id").alias("last_id"))
    return s.withColumns({"layer": F.lit("junction_or_open_area_candidate"), "geometry_type": F.when(F.col("samples") == 1, "Point").otherwise("LineString")})


def open_support(cells: DataFrame, tile: int = 256) -> DataFrame:
    """Four-connected support surfaces of open-area cells (ix, iy)."""
    return S.grid_components(cells, [(1, 0), (0, 1), (-1, 0), (0, -1)], tile).withColumn("layer", F.lit("junction_or_open_area_support"))


def route_object() -> Column:
    c = F.col("final_class")
    return F.when(c == "building_marker_candidate", "building_marker_candidates").when(c.isin("building_marker_possible", "building_marker_possible_recovered"), "building_marker_possible").otherwise("scene_object_context")


def object_lines(objects: DataFrame) -> DataFrame:
    h = F.col("length") / 2
    return objects.withColumns({"layer": route_object(), "x1": F.col("center_x") - F.col("tangent_x") * h, "y1": F.col("center_y") - F.col("tangent_y") * h, "x2": F.col("center_x") + F.col("tangent_x") * h, "y2": F.col("center_y") + F.col("tangent_y") * h})


AUDIT = ("feature_id", "layer", "geometry_type", "geometry_evidence_state", "semantic_evidence_state", "confidence", "source_id", "note")


def layer_audit(features: Sequence[DataFrame], names: dict[str, Sequence[str]]) -> DataFrame:
    """One audit row per feature: the first non-null of several columns."""
    out = None
    for df in features:
        cols = []
        for name in AUDIT:
            have = [F.col(c).cast("string") for c in names.get(name, (name,)) if c in df.columns]
            cols.append((F.coalesce(*have) if have else F.lit(None).cast("string")).alias(name))
        d = df.select(*cols)
        out = d if out is None else out.unionByName(d)
    return out


def extent(points: DataFrame, pad: float = 8.0) -> DataFrame:
    return points.agg((F.min("x") - pad).alias("x_min"), (F.min("y") - pad).alias("y_min"), (F.max("x") + pad).alias("x_max"), (F.max("y") + pad).alias("y_max"))


def keep_roads(regions: DataFrame, min_cells: int = 50) -> DataFrame:
    return regions.filter(F.col("cell_count") >= min_cells)


def keep_buildings(objects: DataFrame, road_edges: DataFrame, surface_edges: DataFrame, curb_segments: DataFrame, clearance: float = 2.0,
                   min_length: float = 6.0, min_points: int = 200, min_coverage: float = 0.85, max_above: float = 0.0) -> DataFrame:
    """Strict marker gates, then no marker whose middle lies on observed road or
    whose line comes within the clearance of a surface or edge."""
    o = object_lines(objects).filter((F.col("length") >= min_length) & (F.col("support_points") >= min_points) & (F.col("coverage") >= min_coverage) & (F.col("road_overlap") <= max_above) & (F.col("road_above") <= max_above))
    return clear_of_surfaces(o, road_edges, surface_edges, curb_segments, clearance)


def clear_of_surfaces(o: DataFrame, road_edges: DataFrame, surface_edges: DataFrame, curb_segments: DataFrame, clearance: float) -> DataFrame:
    mid = o.select(F.col("object_id").alias("point_id"), ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))
    on_road = within(mid, road_edges).select(F.col("point_id").alias("object_id")).distinct()
    lines = o.select(F.col("object_id").alias("line_id"), "x1", "y1", "x2", "y2")
    seg = surface_edges.select("x1", "y1", "x2", "y2").unionByName(curb_segments.select("x1", "y1", "x2", "y2"))
    near = min_distance(lines, seg, clearance, surface_edges).filter(F.col("distance") < clearance).select(F.col("line_id").alias("object_id"))
    return o.join(on_road, "object_id", "left_anti").join(near, "object_id", "left_anti")


def features_json(df: DataFrame, geometry_type: str, coordinates: Column, properties: Sequence[str], id_col: str) -> DataFrame:
    """One GeoJSON Feature per row."""
    f = F.struct(F.lit("Feature").alias("type"), F.col(id_col).cast("string").alias("id"), F.struct(F.lit(geometry_type).alias("type"), coordinates.alias("coordinates")).alias("geometry"), F.struct(*properties).alias("properties"))
    return df.select(F.to_json(f).alias("value"))


def split_layers(base: DataFrame, recovered: DataFrame, key: Sequence[str]) -> DataFrame:
    """A layer without its recovered rows, plus the recovered layer."""
    return base.join(recovered.select(*key), list(key), "left_anti").withColumn("layer", F.lit("remaining")).unionByName(recovered.withColumn("layer", F.lit("recovered")), allowMissingColumns=True)
