"""Registered queries: vector features, containment, layers, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanloom.functions import columns as C
from scanloom.operators import boundaries as R
from scanloom.operators import objects as B
from scanloom.operators import spatial as S
from scanloom.operators import vectors as V
from scanloom.plans import boundaries as PB
from scanloom.plans import objects as PO
from scanloom.plans.evidence import CELLS, ground
from scanloom.plans.points import r6
from scanloom.plans.registry import query
from scanloom.session import cut

D = lambda s: s.replace("D0", "::double")
EDGE = f"""c AS MATERIALIZED ({CELLS}), ed AS (SELECT ix x, iy y, 0 d, ix+1 ex, iy ey FROM c UNION ALL SELECT ix+1, iy, 1, ix+1, iy+1 FROM c UNION ALL SELECT ix+1, iy+1, 2, ix, iy+1 FROM c UNION ALL SELECT ix, iy+1, 3, ix, iy FROM c),
 bnd AS MATERIALIZED (SELECT * FROM ed a WHERE NOT EXISTS (SELECT 1 FROM ed b WHERE b.x=a.ex AND b.y=a.ey AND b.ex=a.x AND b.ey=a.y))"""


@query("u04_edge_cancellation", f"WITH {EDGE} SELECT x, y, CAST(d AS INT) AS d FROM bnd")
def _(t):
    return V.cancel_edges(V.cell_edges(t.sql(CELLS)))


def rings(t):
    lab = S.grid_components(t.sql(CELLS), [(1, 0), (0, 1), (-1, 0), (0, -1)], 32)
    return V.trace_rings(lab, ["root_ix", "root_iy"])


@query("g06_polygon_rings")
def _(t):
    return V.ring_summary(rings(t), ["root_ix", "root_iy"], 0.25)


@query("g06_ring_totals", f"WITH {EDGE} SELECT count(*) AS vertices, (SELECT count(*) * 0.0625::double FROM c) AS area FROM bnd")
def _(t):
    return V.ring_summary(rings(t), ["root_ix", "root_iy"], 0.25).agg(F.sum("ring_size").alias("vertices"), F.sum("area").alias("area"))


@query("g07_line_simplification", """WITH RECURSIVE q AS MATERIALIZED (SELECT topic, event_id i, x, y FROM traj), iv AS (SELECT topic, min(i) lo, max(i) hi FROM q GROUP BY 1
 UNION ALL SELECT topic, unnest([lo, ci]), unnest([ci, hi]) FROM (SELECT topic, lo, hi, arg_max(i, (d, -i)) ci, max(d) md FROM (
  SELECT iv.topic, lo, hi, q.i, CASE WHEN sqrt(power(b.x-a.x,2)+power(b.y-a.y,2)) < 1e-12 THEN sqrt(power(q.x-a.x,2)+power(q.y-a.y,2)) ELSE abs((b.y-a.y)*q.x-(b.x-a.x)*q.y+b.x*a.y-b.y*a.x)/sqrt(power(b.x-a.x,2)+power(b.y-a.y,2)) END d
  FROM iv JOIN q a ON a.topic=iv.topic AND a.i=lo JOIN q b ON b.topic=iv.topic AND b.i=hi JOIN q ON q.topic=iv.topic AND q.i > lo AND q.i < hi) GROUP BY ALL) WHERE md > 8.0)
SELECT topic, lo AS i FROM iv UNION SELECT topic, hi FROM iv""")
def _(t):
    p = t.traj.select("topic", F.col("event_id").alias("idx"), "x", "y")
    return V.simplify(p, ["topic"], tol=8.0)


# --- containment ---------------------------------------------------------------------
SQ = "SELECT c_custkey AS poly_id, (c_custkey * 37 % 512) / 8.0D0 AS cx, CAST(FLOOR(c_custkey / 410) AS BIGINT) * 8.0D0 + (c_custkey * 11 % 64) / 8.0D0 AS cy, 0.5D0 + (c_custkey % 4) / 4.0D0 AS h FROM customer"
RING = "SELECT poly_id, cx + sx1 * k * h AS x1, cy + sy1 * k * h AS y1, cx + sx2 * k * h AS x2, cy + sy2 * k * h AS y2"
SIDES = [(-1, -1, 1, -1), (1, -1, 1, 1), (1, 1, -1, 1), (-1, 1, -1, -1)]
POLYS = " UNION ALL ".join(f"SELECT poly_id, cx + ({a * k}) * h AS x1, cy + ({b * k}) * h AS y1, cx + ({c * k}) * h AS x2, cy + ({d * k}) * h AS y2 FROM ({SQ}) s" for k in (1, 0.5) for a, b, c, d in SIDES)
QP = "SELECT o_orderkey AS point_id, (CAST(FLOOR(o_orderkey / 512) AS BIGINT) % 8) * 8.0D0 + (o_custkey * 7 % 128) / 16.0D0 + 0.0078125D0 AS x, CAST(FLOOR(o_orderkey / 4096) AS BIGINT) * 8.0D0 + (o_custkey * 11 % 128) / 16.0D0 + 0.00390625D0 AS y FROM orders"


@query("j24_point_in_polygon", f"SELECT point_id, poly_id FROM ({D(QP)}) p JOIN ({D(SQ)}) s ON abs(x-cx) < h AND abs(y-cy) < h AND NOT (abs(x-cx) < h/2 AND abs(y-cy) < h/2)")
def _(t):
    return V.within(t.sql(QP), t.sql(POLYS))


LINES = "SELECT o_orderkey AS line_id, (CAST(FLOOR(o_orderkey / 512) AS BIGINT) % 8) * 8.0D0 + (o_custkey * 7 % 128) / 16.0D0 + 0.0078125D0 AS x1, CAST(FLOOR(o_orderkey / 4096) AS BIGINT) * 8.0D0 + (o_custkey * 11 % 128) / 16.0D0 + 0.00390625D0 AS y1, (CAST(FLOOR(o_orderkey / 512) AS BIGINT) % 8) * 8.0D0 + (o_custkey * 7 % 128) / 16.0D0 + 1.0078125D0 AS x2, CAST(FLOOR(o_orderkey / 4096) AS BIGINT) * 8.0D0 + (o_custkey * 11 % 128) / 16.0D0 + 0.00390625D0 AS y2 FROM orders"


@query("j25_line_feature_distance", f"""WITH l AS MATERIALIZED ({D(LINES)}), s AS MATERIALIZED ({D(SQ)}), b AS (SELECT line_id, greatest(cx-x2, x1-cx, 0) o, x1, x2, y1, cx, cy, h, abs(y1-cy) v FROM l JOIN s ON x2 >= cx-h-1 AND x1 <= cx+h+1 AND abs(y1-cy) <= h+1),
 d AS (SELECT line_id, sqrt(power(greatest(cx-h-x2, x1-cx-h, 0),2)+power(greatest(v-h,0),2)) outer_d, CASE WHEN v < h/2 AND x1 > cx-h/2 AND x2 < cx+h/2 THEN least(h/2-v, x1-cx+h/2, cx+h/2-x2) ELSE 0 END inner_d FROM b)
SELECT line_id, round(min(greatest(outer_d, inner_d)),6) AS distance FROM d WHERE greatest(outer_d, inner_d) <= 1 GROUP BY 1""")
def _(t):
    p = t.sql(POLYS)
    return V.min_distance(t.sql(LINES), p, 1.0, p).select("line_id", r6("distance").alias("distance"))


# --- states, layers ---------------------------------------------------------------------
def merged(t):
    layers = {"two_sided_measured": PB.road(t), "two_sided_continuity_bridge": R.ribbon_support(PB.bridged_ribbons(t), ground(t), 0.5)}
    return R.merge_candidates(layers)


@query("c10_road_cell_states", """SELECT ix, iy, CASE WHEN src='two_sided_measured' AND obs THEN 'observed' WHEN src IN ('two_sided_continuity_bridge','fixed_width_fallback') THEN 'inferred' ELSE 'unknown' END AS semantic_evidence_state,
 CASE WHEN src='two_sided_measured' AND obs THEN 'road_surface_observed' WHEN src='two_sided_continuity_bridge' THEN 'road_search_surface_continuity' WHEN src='fixed_width_fallback' THEN 'road_search_surface_fixed_width' ELSE 'road_search_surface_unknown' END AS layer FROM (
 SELECT CAST(floor(x/0.5) AS BIGINT) ix, CAST(floor(y/0.5) AS BIGINT) iy, CASE min(ring) WHEN 0 THEN 'two_sided_measured' WHEN 1 THEN 'two_sided_continuity_bridge' ELSE 'fixed_width_fallback' END src, count(*) % 2 = 0 obs FROM points GROUP BY 1,2)""")
def _(t):
    c = t.points.groupBy(C.cell("x", 0.5).alias("ix"), C.cell("y", 0.5).alias("iy")).agg(F.min("ring").alias("r"), (F.count(F.lit(1)) % 2 == 0).alias("observed"))
    c = c.withColumn("primary_source", F.when(F.col("r") == 0, "two_sided_measured").when(F.col("r") == 1, "two_sided_continuity_bridge").otherwise("fixed_width_fallback"))
    st = V.cell_states()
    return c.select("ix", "iy", st["semantic_evidence_state"].alias("semantic_evidence_state"), st["layer"].alias("layer"))


LAY = "CASE class WHEN 'two_sided_measured_road_core' THEN 'road_centerline_observed' WHEN 'two_sided_continuity_bridge' THEN 'road_centerline_continuity' WHEN 'one_sided_measured_boundary' THEN 'trajectory_reference_direction_candidate' ELSE 'junction_or_open_area_candidate' END"


@query("c11_road_axis", f"WITH {PB.CLS} SELECT sample_id, round(diff/2,6) AS axis_offset, round(x - ty*coalesce(diff,0)/2,6) AS axis_x, round(y + tx*coalesce(diff,0)/2,6) AS axis_y FROM cl")
def _(t):
    return V.road_axis(PB.classes(t)).select("sample_id", *[r6(c).alias(c) for c in ("axis_offset", "axis_x", "axis_y")])


SEG = f"""{PB.CLS}, sgk AS (SELECT *, {LAY} layer, CASE WHEN road_valid THEN road_width WHEN bkind IS NOT NULL THEN NULL END w0, (class, confidence, bkind) kk FROM cl), sgb AS (SELECT *, CASE WHEN kk IS DISTINCT FROM lag(kk) OVER w OR sample_id IS DISTINCT FROM lag(sample_id) OVER w + 1 THEN 1 ELSE 0 END b FROM sgk WINDOW w AS (ORDER BY sample_id)),
 sgs AS MATERIALIZED (SELECT *, CAST(sum(b) OVER (ORDER BY sample_id) AS BIGINT) segment_id FROM sgb)"""


def segments(t):
    c = PB.classes(t)
    return V.section_segments(c.withColumns(V.section_states()), ["class", "confidence", "bridge_kind"])


@query("w09_section_segments", f"WITH {SEG} SELECT sample_id, segment_id, layer FROM sgs")
def _(t):
    return segments(t).select("sample_id", "segment_id", "layer")


@query("a36_width_profile", f"WITH {SEG} SELECT segment_id, any_value(layer) AS layer, min(sample_id) AS first_id, max(sample_id) AS last_id, round(min(w0),6) AS width_min_m, round(max(w0),6) AS width_max_m FROM sgs GROUP BY 1")
def _(t):
    s = segments(t).withColumn("width", F.when(F.col("road_valid"), F.col("road_width")))
    return V.width_profile(s).select("segment_id", "layer", "first_id", "last_id", r6("width_min_m").alias("width_min_m"), r6("width_max_m").alias("width_max_m"))


@query("a37_extent", f"SELECT min(x)-8 AS x_min, min(y)-8 AS y_min, max(x)+8 AS x_max, max(y)+8 AS y_max FROM points")
def _(t):
    return V.extent(t.points)


@query("c12_layer_routing", f"""WITH {PB.PAIRS}, am AS (SELECT inner_id id FROM pp WHERE amb UNION SELECT outer_id FROM pp WHERE amb), nr AS (SELECT DISTINCT outer_id id FROM pp), {PO.FINAL}
SELECT 'constraint' AS kind, id AS source_id, CASE WHEN id IN (SELECT id FROM am) OR id IN (SELECT id FROM nr) OR road_distance > 5 OR direction_deg > 15 OR junction_m < 6 THEN 'road_edge_context' ELSE 'road_edge_constraints' END AS layer FROM sg
UNION ALL SELECT 'object', object_id, CASE final_class WHEN 'building_marker_candidate' THEN 'building_marker_candidates' WHEN 'building_marker_possible' THEN 'building_marker_possible' ELSE 'scene_object_context' END FROM fin""")
def _(t):
    s = PB.segs(t)
    c = R.constraint_status(s, R.parallel_pairs(s)).select(F.lit("constraint").alias("kind"), F.col("id").alias("source_id"), V.route_constraint().alias("layer"))
    o = PO.final(t).select(F.lit("object").alias("kind"), F.col("object_id").alias("source_id"), V.route_object().alias("layer"))
    return c.unionByName(o)


#: Small surfaces, so that some markers keep clear of all of them.
TINY = SQ.replace("0.5D0 + (c_custkey % 4) / 4.0D0 AS h", "0.0625D0 + (c_custkey % 4) / 32.0D0 AS h")


@query("c13_product_suppression", f"""WITH {PO.FINAL}, l AS (SELECT object_id line_id, center_x-length/2 x1, center_x+length/2 x2, center_y y1, final_class FROM fin WHERE length >= 4 AND coverage >= 0.6 AND road_above <= 0.5 AND road_overlap <= 0.5 AND support_points >= 0), s AS MATERIALIZED ({D(TINY)}), b AS (SELECT line_id, x1, x2, cx, h, abs(y1-cy) v FROM l JOIN s ON x2 >= cx-h-1 AND x1 <= cx+h+1 AND abs(y1-cy) <= h+1),
 d AS (SELECT line_id, sqrt(power(greatest(cx-h-x2, x1-cx-h, 0),2)+power(greatest(v-h,0),2)) outer_d, CASE WHEN v < h/2 AND x1 > cx-h/2 AND x2 < cx+h/2 THEN least(h/2-v, x1-cx+h/2, cx+h/2-x2) ELSE 0 END inner_d FROM b)
SELECT line_id AS object_id, CASE final_class WHEN 'building_marker_candidate' THEN 'building_marker_candidates' WHEN 'building_marker_possible' THEN 'building_marker_possible' ELSE 'scene_object_context' END AS layer FROM l WHERE line_id NOT IN (SELECT line_id FROM d WHERE greatest(outer_d, inner_d) < 0.0625)""")
def _(t):
    p = cut(t.sql(POLYS.replace(SQ, TINY)))
    return V.keep_buildings(PO.final(t), p, p, p, 0.0625, 4.0, 0, 0.6, 0.5).select("object_id", "layer")


@query("c12_sidewalk_and_open_routing", f"""WITH {SEG}, op AS (SELECT segment_id, count(*) n FROM sgs WHERE class IN ('two_sided_abnormal_width_open_candidate', 'no_boundary_default_width_candidate') GROUP BY 1)
SELECT 'open' AS kind, segment_id AS source_id, 'junction_or_open_area_candidate' AS layer, CASE WHEN n = 1 THEN 'Point' ELSE 'LineString' END AS geometry_type FROM op
UNION ALL SELECT 'sidewalk', c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'sidewalk_or_shoulder_confirmed' ELSE 'sidewalk_or_shoulder_context' END, 'Polygon' FROM customer
UNION ALL SELECT 'boundary', c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'curb_candidates' ELSE 'boundary_unknown' END, 'LineString' FROM customer""")
def _(t):
    k = t.customer.select(F.col("c_custkey").alias("source_id"))
    walk = k.withColumn("classification", F.when(F.col("source_id") % 3 == 0, "confirmed_sidewalk_or_shoulder").otherwise("possible_sidewalk_or_shoulder"))
    edge = k.withColumn("semantic", F.when(F.col("source_id") % 3 == 0, "curb_candidate").otherwise("wall_or_green_boundary_candidate"))
    out = V.open_areas(segments(t)).select(F.lit("open").alias("kind"), F.col("segment_id").alias("source_id"), "layer", "geometry_type")
    out = out.unionByName(walk.select(F.lit("sidewalk").alias("kind"), "source_id", V.route_sidewalk().alias("layer"), F.lit("Polygon").alias("geometry_type")))
    return out.unionByName(edge.select(F.lit("boundary").alias("kind"), "source_id", V.route_boundary().alias("layer"), F.lit("LineString").alias("geometry_type")))


@query("c13_road_fragments", f"""WITH c AS MATERIALIZED ({CELLS}), nb AS MATERIALIZED (SELECT a.ix, a.iy, b.ix bx, b.iy byy FROM c a JOIN c b ON (a.ix=b.ix AND abs(a.iy-b.iy)=1) OR (a.iy=b.iy AND abs(a.ix-b.ix)=1)),
 r AS (SELECT ix, iy, ix sx, iy sy FROM c UNION SELECT nb.bx, nb.byy, r.sx, r.sy FROM r JOIN nb ON nb.ix=r.ix AND nb.iy=r.iy WHERE (r.sx, r.sy) < (nb.bx, nb.byy)), m AS (SELECT ix, iy, min((sx, sy)) root FROM r GROUP BY 1,2)
SELECT root[1] AS root_ix, root[2] AS root_iy, count(*) AS cell_count FROM m GROUP BY 1,2 HAVING count(*) >= 5""")
def _(t):
    lab = S.grid_components(t.sql(CELLS), [(1, 0), (0, 1), (-1, 0), (0, -1)], 32)
    return V.keep_roads(lab.groupBy("root_ix", "root_iy").agg(F.count(F.lit(1)).alias("cell_count")), 5)


@query("a46_layer_audit", f"""WITH {PB.PAIRS} SELECT CAST(id AS VARCHAR) AS feature_id, 'LineString' AS geometry_type, CAST(CASE WHEN id % 2 = 0 THEN edge_support ELSE inside_support END AS VARCHAR) AS confidence, 'constraint' AS layer FROM sg
UNION ALL SELECT CAST(object_id AS VARCHAR), 'LineString', CAST(confidence AS VARCHAR), object_type FROM ({D(PO.OBJ)})""")
def _(t):
    s = PB.segs(t).withColumns({"constraint_confidence": F.when(F.col("id") % 2 == 0, F.col("edge_support")), "membership_confidence": F.col("inside_support"), "layer": F.lit("constraint"), "geometry_type": F.lit("LineString")})
    o = t.sql(PO.OBJ).withColumns({"layer": F.col("object_type"), "geometry_type": F.lit("LineString")})
    a = V.layer_audit([s, o], {"feature_id": ("id", "object_id"), "confidence": ("constraint_confidence", "membership_confidence", "confidence")})
    return a.select("feature_id", "geometry_type", "confidence", "layer")


@query("s09_feature_json", f"""SELECT '{{"type":"Feature","id":"' || c_custkey || '","geometry":{{"type":"LineString","coordinates":[[' || a || ',0],[' || b || ',1]]}},"properties":{{"kind":"' || kind || '","score":' || s || '}}}}' AS value
FROM (SELECT c_custkey, c_custkey * 3 a, c_custkey * 5 b, c_mktsegment kind, c_custkey % 7 s FROM customer)""")
def _(t):
    c = t.customer.select("c_custkey", F.col("c_mktsegment").alias("kind"), (F.col("c_custkey") % 7).alias("score"))
    line = F.array(F.array(F.col("c_custkey") * 3, F.lit(0).cast("long")), F.array(F.col("c_custkey") * 5, F.lit(1).cast("long")))
    return V.features_json(c, "LineString", line, ["kind", "score"], "c_custkey")


# --- set operations -----------------------------------------------------------------------
CA, CB = "SELECT DISTINCT CAST(FLOOR(x / 0.5D0) AS BIGINT) AS ix, CAST(FLOOR(y / 0.5D0) AS BIGINT) AS iy FROM points WHERE ring = 1", "SELECT DISTINCT CAST(FLOOR(x / 0.5D0) AS BIGINT) AS ix, CAST(FLOOR(y / 0.5D0) AS BIGINT) AS iy FROM points WHERE ring = 2"


@query("u01_layer_union", f"SELECT ix, iy, 'a' AS layer FROM ({D(CA)}) UNION ALL SELECT ix, iy, 'b' FROM ({D(CB)})")
def _(t):
    return t.sql(CA).withColumn("layer", F.lit("a")).unionByName(t.sql(CB).withColumn("layer", F.lit("b")))


@query("u02_key_difference", f"SELECT * FROM ({D(CA)}) EXCEPT SELECT * FROM ({D(CB)})")
def _(t):
    return t.sql(CA).subtract(t.sql(CB))


@query("u03_key_intersection", f"SELECT * FROM ({D(CA)}) INTERSECT SELECT * FROM ({D(CB)})")
def _(t):
    return t.sql(CA).intersect(t.sql(CB))


@query("u05_layer_split_and_recover", f"WITH a AS ({D(CA)}), b AS ({D(CB)}) SELECT ix, iy, 'remaining' AS layer FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.ix=b.ix AND a.iy=b.iy) UNION ALL SELECT ix, iy, 'recovered' FROM b")
def _(t):
    return V.split_layers(t.sql(CA), t.sql(CB), ["ix", "iy"])
