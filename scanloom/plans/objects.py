"""Registered queries: boxes, tracking, removal, vertical objects."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanloom.functions import columns as C
from scanloom.operators import objects as B
from scanloom.operators import points as P
from scanloom.plans.evidence import LAYERS, ground
from scanloom.plans.points import r6
from scanloom.plans.registry import query

KEY = ["frame_id", *P.ORDER]
BOXP = """bp AS MATERIALIZED (SELECT *, cos(-yaw-pi()/2) bc, sin(-yaw-pi()/2) bs, 0.5*l*1.2+0.35 hx, 0.5*w*1.2+0.35 hy, 0.5*h*1.05+0.4 hz FROM boxes),
 pib AS MATERIALIZED (SELECT p.*, b.box_id, b.l bl FROM points p JOIN bp b ON p.frame_id=b.frame_id WHERE (p.x-b.x)*(p.x-b.x)+(p.y-b.y)*(p.y-b.y) <= hx*hx+hy*hy AND abs(p.z-b.z) <= hz AND abs((p.x-b.x)*bc+(p.y-b.y)*bs) <= hx AND abs((p.y-b.y)*bc-(p.x-b.x)*bs) <= hy)"""


@query("j14_points_in_boxes", f"WITH {BOXP} SELECT frame_id, seq, x, y, box_id FROM pib")
def _(t):
    return B.points_in_boxes(t.points, t.boxes).select("frame_id", "seq", "x", "y", F.col("b_box_id").alias("box_id"))


@query("a44_static_map", f"""WITH {BOXP}, rest AS (SELECT p.* FROM points p WHERE NOT EXISTS (SELECT 1 FROM pib i WHERE i.frame_id=p.frame_id AND i.seq=p.seq AND i.x=p.x AND i.y=p.y AND i.z=p.z AND i.ring=p.ring AND i.rgb=p.rgb)),
 w AS (SELECT x*cos(a)-y*sin(a)+tx gx, x*sin(a)+y*cos(a)+ty gy, z+tz gz FROM rest p JOIN (SELECT *, 2*atan2(qz,qw) a FROM poses) f ON f.frame_id=p.frame_id)
SELECT CAST(floor(gz/1.0) AS BIGINT) AS iz, count(*) AS n, round(sum(gx),3) AS sum_x FROM w GROUP BY 1""")
def _(t):
    m = B.static_map(t.points, t.boxes, t.poses, KEY, 1.0)
    return m.groupBy("iz").agg(F.sum("n").alias("n"), F.round(F.sum(F.col("x") * F.col("n")), 3).alias("sum_x"))


@query("j28_coasting_boxes", """WITH fr AS (SELECT *, row_number() OVER (ORDER BY ts, frame_id) i, 2*atan2(qz,qw) a FROM poses), pr AS (SELECT n.frame_id, p.frame_id from_frame, n.i-p.i age, p.tx ptx, p.ty pty, p.a pa, n.tx, n.ty, n.a FROM fr p JOIN fr n ON n.i-p.i BETWEEN 1 AND 5 AND n.ts-p.ts <= 2),
 cb AS MATERIALIZED (SELECT pr.frame_id, from_frame, box_id, age, cos(a-pa)*(b.x-ptx)-sin(a-pa)*(b.y-pty)+tx AS x, sin(a-pa)*(b.x-ptx)+cos(a-pa)*(b.y-pty)+ty AS y, l*1.1+0.2 AS l, yaw+(a-pa) AS yaw FROM boxes b JOIN pr ON b.frame_id=pr.from_frame),
 lv AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY age, box_id) rn FROM cb WHERE NOT EXISTS (SELECT 1 FROM boxes c WHERE c.frame_id=cb.frame_id AND power(c.x-cb.x,2)+power(c.y-cb.y,2) < 0.25)),
 g AS (SELECT frame_id, rn, from_frame, box_id, age, x, y, l, yaw, true AS kept, [{'x': x, 'y': y}] AS k FROM lv WHERE rn=1 UNION ALL SELECT frame_id, rn, from_frame, box_id, age, x, y, l, yaw, ok, CASE WHEN ok THEN list_append(k, {'x': x, 'y': y}) ELSE k END FROM (SELECT lv.*, g.k, len(list_filter(g.k, lambda e: power(e.x-lv.x,2)+power(e.y-lv.y,2) < 0.25)) = 0 AS ok FROM g JOIN lv ON lv.frame_id=g.frame_id AND lv.rn=g.rn+1))
SELECT frame_id, from_frame, box_id, age, round(x,6) AS x, round(y,6) AS y, round(l,6) AS l, round(yaw,6)+0.0 AS yaw FROM g WHERE kept""")
def _(t):
    return B.coast_boxes(t.boxes, t.poses).select("frame_id", "from_frame", "box_id", "age", *[(r6(c) + 0.0).alias(c) for c in ("x", "y", "l", "yaw")])


def tracks(t):
    return B.track_boxes(t.boxes, 1.0, 2.0)


TRACKED = """WITH RECURSIVE b AS (SELECT frame_id, box_id, ts, x, y, class, row_number() OVER (PARTITION BY class ORDER BY ts, box_id) rn FROM boxes), st AS (
 SELECT class, rn, [{'id': frame_id || ':' || box_id, 'ts': ts, 'x': x, 'y': y}] live, frame_id, box_id, frame_id || ':' || box_id track_id FROM b WHERE rn=1
 UNION ALL SELECT class, rn, CASE WHEN m IS NULL THEN list_append(lv, {'id': frame_id || ':' || box_id, 'ts': ts, 'x': x, 'y': y}) ELSE list_transform(lv, lambda e: CASE WHEN e.id = m.id THEN {'id': e.id, 'ts': ts, 'x': x, 'y': y} ELSE e END) END, frame_id, box_id, coalesce(m.id, frame_id || ':' || box_id) FROM (
  SELECT *, list_sort(list_filter(list_transform(lv, lambda e, i: {'d': sqrt(power(x-e.x,2)+power(y-e.y,2)), 'i': i, 'id': e.id}), lambda e: e.d < 2.0))[1] m FROM (SELECT b.*, list_filter(s.live, lambda e: b.ts - e.ts <= 1.0) lv FROM st s JOIN b ON b.class=s.class AND b.rn=s.rn+1)))
SELECT frame_id, box_id, class, track_id FROM st"""


@query("st07_object_tracks_batch", TRACKED)
def _(t):
    return tracks(t).select("frame_id", "box_id", "class", "track_id")


OBS = "SELECT frame_id, box_id, ts, x, y, CAST(class AS VARCHAR(20)) AS track_id FROM boxes"


def obs(t):
    return t.boxes.select("frame_id", "box_id", "ts", "x", "y", F.col("class").cast("string").alias("track_id"))


@query("w13_motion_states", """WITH o AS (SELECT box_id, ts, x, y, class FROM boxes), m AS (SELECT a.box_id, a.class, a.ts, count(*) n, min({'ts': b.ts, 'b': b.box_id, 'x': b.x, 'y': b.y}) f, max({'ts': b.ts, 'b': b.box_id, 'x': b.x, 'y': b.y}) l FROM o a JOIN o b ON a.class=b.class AND b.ts <= a.ts AND b.ts >= a.ts-1.5 GROUP BY 1,2,3),
 s AS (SELECT *, l.ts-f.ts d, sqrt(power(l.x-f.x,2)+power(l.y-f.y,2)) e FROM m) SELECT box_id, n AS observations, d AS duration, CASE WHEN n < 6 OR d < 0.6 THEN 'UNKNOWN' WHEN e/d <= 3 THEN 'STATIC' WHEN e/d >= 4 THEN 'MOVING' ELSE 'UNKNOWN' END AS motion FROM s""")
def _(t):
    return B.motion_states(obs(t), static_max=3.0, moving_min=4.0).select("box_id", "observations", "duration", "motion")


def box_ground(t):
    return B.box_ground(t.points.filter("is_ground"), t.boxes, margin=2.0, min_points=5, distance=0.2, below=2.0, above=2.0)


@query("g16_box_ground_planes")
def _(t):
    return box_ground(t).select("frame_id", "box_id", "ring", "inliers", "status", F.round("c", 3).alias("c"))


@query("g16_ring_counts", """WITH b AS (SELECT *, cos(-yaw-pi()/2) bc, sin(-yaw-pi()/2) bs FROM boxes), r AS (SELECT b.frame_id, box_id, (p.x-b.x)*bc+(p.y-b.y)*bs u, (p.y-b.y)*bc-(p.x-b.x)*bs v, (p.x-b.x)*(p.x-b.x)+(p.y-b.y)*(p.y-b.y) d2, abs(p.z-b.z) dz FROM points p JOIN b ON b.frame_id=p.frame_id AND p.is_ground)
SELECT b.frame_id, b.box_id, count(r.u) AS ring FROM boxes b LEFT JOIN r ON r.frame_id=b.frame_id AND r.box_id=b.box_id AND dz <= 0.5 AND abs(u) <= 3.0 AND abs(v) <= 2.5 AND NOT (abs(u) <= 1.0 AND abs(v) <= 0.5) GROUP BY 1,2""")
def _(t):
    return box_ground(t).select("frame_id", "box_id", "ring")


@query("st08_safe_removal_batch")
def _(t):
    motion = B.motion_states(obs(t), static_max=3.0, moving_min=4.0)
    out = B.safe_removal(t.points, t.boxes, motion, box_ground(t), KEY)
    return out.groupBy("frame_id", "fate").agg(F.count(F.lit(1)).alias("n"))


# --- vertical objects ---------------------------------------------------------------
WALL = """SELECT o_orderkey AS point_id, (CAST(FLOOR(o_orderkey / 512) AS BIGINT) % 8) * 8.0D0 + (o_custkey % 64) / 8.0D0 AS x,
 CAST(FLOOR(o_orderkey / 4096) AS BIGINT) * 8.0D0 + CASE WHEN o_custkey % 5 = 0 THEN (o_custkey % 61) / 8.0D0 WHEN o_custkey % 2 = 0 THEN 2.0D0 + (o_custkey % 3) / 64.0D0 ELSE 6.0D0 + (o_custkey % 3) / 64.0D0 END AS y,
 (o_custkey % 29) / 8.0D0 AS z, CAST((o_custkey % 256) * 65536 + (o_custkey * 3 % 256) * 256 + o_custkey * 7 % 256 AS INT) AS rgb, o_custkey FROM orders"""
COLS = f"""SELECT CAST(FLOOR(x / 0.25D0) AS BIGINT) AS ix, CAST(FLOOR(y / 0.25D0) AS BIGINT) AS iy, COUNT(*) AS stable_voxels, SUM(o_custkey % 5 + 1) AS frame_support_sum, MIN(z) AS min_z, MAX(z) AS max_z, COUNT(*) >= 2 AND MAX(z) - MIN(z) >= 1 AS candidate FROM ({WALL}) w GROUP BY 1, 2"""


def comps(t):
    return B.tile_components(t.sql(COLS), 0.25)


@query("g04_tile_components", f"""WITH c AS MATERIALIZED (SELECT ix, iy, CAST(floor(ix/40) AS BIGINT) tx, CAST(floor(iy/40) AS BIGINT) ty FROM ({COLS.replace('D0', '::double')}) WHERE candidate), nb AS MATERIALIZED (SELECT a.ix, a.iy, b.ix bx, b.iy byy FROM c a JOIN c b ON a.tx=b.tx AND a.ty=b.ty AND abs(a.ix-b.ix) <= 1 AND abs(a.iy-b.iy) <= 1),
 r AS (SELECT ix, iy, ix sx, iy sy FROM c UNION SELECT nb.bx, nb.byy, r.sx, r.sy FROM r JOIN nb ON nb.ix=r.ix AND nb.iy=r.iy WHERE (r.sx, r.sy) < (nb.bx, nb.byy)), m AS (SELECT ix, iy, min((sx, sy)) root FROM r GROUP BY 1,2)
SELECT ix, iy, root[1] AS root_ix, root[2] AS root_iy, count(*) OVER (PARTITION BY root) AS size FROM m""")
def _(t):
    return comps(t).select("ix", "iy", "root_ix", "root_iy", "size")


def segs(t):
    return B.vertical_segments(comps(t), 0.25)


@query("g09_vertical_segments")
def _(t):
    return segs(t).groupBy("object_key", "planar").agg(F.count(F.lit(1)).alias("columns"))


@query("c07_vertical_objects")
def _(t):
    o = B.build_objects(segs(t), t.sql(COLS), 0.25)
    return o.select("object_key", "object_type", "semantic_evidence_state", "completeness", "n", *[F.round(c, 5).alias(c) for c in ("length", "width_rms", "coverage", "height", "confidence")])


@query("a19_footprint_fit", f"""WITH c AS (SELECT CAST(floor(ix/40) AS BIGINT) tile_x, CAST(floor(iy/40) AS BIGINT) tile_y, (ix+0.5)*0.25::double x, (iy+0.5)*0.25::double y FROM ({COLS.replace('D0', '::double')})), m AS (SELECT tile_x, tile_y, count(*) n, avg(x) mx, avg(y) my, 0.5*atan2(2*(avg(x*y)-avg(x)*avg(y)), avg(x*x)-avg(x)*avg(x)-avg(y*y)+avg(y)*avg(y)) a FROM c GROUP BY 1,2),
 p AS (SELECT tile_x, tile_y, n, (x-mx)*cos(a)+(y-my)*sin(a) u, (y-my)*cos(a)-(x-mx)*sin(a) v FROM c JOIN m USING (tile_x, tile_y))
SELECT tile_x, tile_y, any_value(n) AS n, round(max(u)-min(u)+0.25,4) AS length, round(sqrt(avg(v*v)),4) AS width_rms FROM p GROUP BY 1,2""")
def _(t):
    c = t.sql(COLS).withColumns({"tile_x": F.floor(F.col("ix") / 40), "tile_y": F.floor(F.col("iy") / 40)})
    return B.fit_footprint(c, ["tile_x", "tile_y"], 0.25).select("tile_x", "tile_y", "n", F.round("length", 4).alias("length"), F.round("width_rms", 4).alias("width_rms"))


KINDS = "CASE {0} % 5 WHEN 0 THEN 'visible_facade_candidate' WHEN 1 THEN 'wall_candidate' WHEN 2 THEN 'uncertain_vertical_structure' WHEN 3 THEN 'pole_or_trunk_candidate' ELSE 'vegetation_or_nonplanar' END"
OBJ = f"""SELECT c_custkey AS object_id, {KINDS.format('c_custkey')} AS object_type, (c_custkey * 37 % 512) / 8.0D0 + 0.0078125D0 AS center_x, CAST(FLOOR(c_custkey / 410) AS BIGINT) * 8.0D0 + CASE WHEN c_custkey % 2 = 0 THEN 2.0D0 ELSE 6.0D0 END AS center_y,
 1.0D0 AS tangent_x, 0.0D0 AS tangent_y, 2.0D0 + c_custkey % 5 AS length, (c_custkey % 7) / 32.0D0 AS width_rms, 0.0D0 AS base_z, 3.0D0 AS top_z, 3.0D0 AS height, 0.5D0 + (c_custkey % 6) / 10.0D0 AS coverage, (c_custkey % 10) / 10.0D0 AS confidence,
 c_custkey % 15 AS n, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE (c_custkey % 4) / 2.0D0 - 1.5D0 END AS ground_z FROM customer"""
PTY = f"SELECT point_id, {KINDS.format('o_custkey')} AS object_type, x, y, z, rgb FROM ({WALL}) w"
D = lambda s: s.replace("D0", "::double")
ASSIGN = f"""ob AS MATERIALIZED (SELECT *, greatest(0.45, least(1.5, 3*width_rms+0.25)) pad, length/2+0.45 half FROM ({D(OBJ)})), pt AS MATERIALIZED ({D(PTY)}), ca AS (SELECT point_id, object_id, p.x-center_x along, p.y-center_y across, abs(p.y-center_y)/pad + greatest(0, abs(p.x-center_x)-length/2)/0.45 sc FROM pt p JOIN ob o ON o.object_type=p.object_type AND abs(p.x-center_x) <= half AND abs(p.y-center_y) <= pad AND z BETWEEN base_z-0.45 AND top_z+0.45),
 best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY sc, object_id) rn FROM ca) WHERE rn=1), asg AS MATERIALIZED (SELECT pt.*, b.object_id, along, across FROM pt LEFT JOIN best b USING (point_id))"""


def assigned(t):
    return B.assign_points(t.sql(PTY), t.sql(OBJ))


@query("j15_point_object_assignment", f"WITH {ASSIGN} SELECT point_id, object_id, round(across,6)+0.0 AS across FROM asg")
def _(t):
    return assigned(t).select("point_id", "object_id", (r6("across") + 0.0).alias("across"))


FEAT = f"""{ASSIGN}, fj AS (SELECT a.*, o.length, o.height FROM asg a JOIN ob o USING (object_id)), ff AS (SELECT object_id, count(*) support_points, (stddev_pop((rgb>>16)&255)+stddev_pop((rgb>>8)&255)+stddev_pop(rgb&255))/3 rgb_std_mean, list_sort(list(abs(across)))[CAST(round_even((count(*)-1)*0.9,0) AS BIGINT)+1] cross_p90, count(DISTINCT (floor((along+length/2)/0.25), floor(z/0.25))) occ FROM fj GROUP BY 1),
 fo AS MATERIALIZED (SELECT ob.*, coalesce(support_points,0) support_points, rgb_std_mean, cross_p90, least(1.0, coalesce(occ,0)/((ceil(length/0.25)+1)*(ceil(height/0.25)+1))) grid_fill_ratio, base_z-ground_z base_above_ground FROM ob LEFT JOIN ff USING (object_id))"""


def features(t):
    return B.object_features(t.sql(OBJ), assigned(t))


@query("a33_object_features", f"WITH {FEAT} SELECT object_id, support_points, round(rgb_std_mean,5) AS rgb_std_mean, cross_p90, round(grid_fill_ratio,6) AS grid_fill_ratio, base_above_ground FROM fo")
def _(t):
    return features(t).select("object_id", "support_points", F.round("rgb_std_mean", 5).alias("rgb_std_mean"), "cross_p90", r6("grid_fill_ratio").alias("grid_fill_ratio"), "base_above_ground")


NAVC = f"""{FEAT}, nv AS (SELECT *, CASE WHEN object_type='vegetation_or_nonplanar' THEN 'vegetation_or_nonplanar' WHEN object_type='pole_or_trunk_candidate' THEN 'pole_or_trunk_context' WHEN support_points=0 OR (base_above_ground > 1.2 AND grid_fill_ratio < 0.36) IS TRUE OR (cross_p90 > 0.29 AND rgb_std_mean > 38 AND grid_fill_ratio < 0.2) IS TRUE THEN 'vegetation_like_rejected'
 WHEN object_type='visible_facade_candidate' THEN 'building_marker_candidate' WHEN object_type='wall_candidate' THEN CASE WHEN length >= 2 AND height >= 2.5 AND width_rms <= 0.22 AND coverage >= 0.6 AND confidence >= 0.4 THEN 'building_marker_candidate' ELSE 'vertical_structure_context' END
 WHEN length >= 1.8 AND height >= 2.5 AND width_rms <= 0.24 AND coverage >= 0.6 AND confidence >= 0.25 AND n >= 6 THEN 'building_marker_possible' ELSE 'vertical_structure_context' END navigation_class FROM fo)"""


@query("c08_navigation_class", f"WITH {NAVC} SELECT object_id, navigation_class FROM nv")
def _(t):
    return B.navigation_class(features(t)).select("object_id", "navigation_class")


ROADZ = "SELECT CAST(FLOOR(x / 0.5D0) AS BIGINT) AS ix, CAST(FLOOR(y / 0.5D0) AS BIGINT) AS iy, MIN(z) AS ground_z FROM points WHERE is_ground GROUP BY 1, 2"
OVER = f"""ro AS ({D(ROADZ)}), ov AS MATERIALIZED (SELECT object_id, avg(CASE WHEN ro.ix IS NULL THEN 0.0::double ELSE 1 END) road_overlap, count(*) FILTER (z > ro.ground_z+0.6)/greatest(1, count(ro.ix)) road_above FROM asg LEFT JOIN ro ON ro.ix=CAST(floor(x/0.5) AS BIGINT) AND ro.iy=CAST(floor(y/0.5) AS BIGINT) WHERE object_id IS NOT NULL GROUP BY 1)"""


@query("a34_road_overlap", f"WITH {ASSIGN}, {OVER} SELECT object_id, round(road_overlap,6) AS road_overlap, round(road_above,6) AS road_above FROM ov")
def _(t):
    return B.road_overlap(assigned(t), t.sql(ROADZ), 0.5).select("object_id", r6("road_overlap").alias("road_overlap"), r6("road_above").alias("road_above"))


def final(t):
    return B.reject_overhead(B.navigation_class(features(t)), B.road_overlap(assigned(t), t.sql(ROADZ), 0.5))


FINAL = f"{NAVC}, {OVER}, fin AS MATERIALIZED (SELECT nv.*, coalesce(road_overlap,0) road_overlap, coalesce(road_above,0) road_above, CASE WHEN navigation_class IN ('building_marker_candidate','building_marker_possible') AND coalesce(road_overlap,0) >= 0.55 AND coalesce(road_above,0) >= 0.6 THEN 'road_overhead_or_dynamic_rejected' ELSE navigation_class END final_class FROM nv LEFT JOIN ov USING (object_id))"


@query("c09_road_overhead_rejection", f"WITH {FINAL} SELECT object_id, final_class FROM fin")
def _(t):
    return final(t).select("object_id", "final_class")


#: The walls of a row of blocks pushed together, dense enough for columns, beside a road that only one of them hangs over.
GREEN = WALL.replace("(CAST(FLOOR(o_orderkey / 512) AS BIGINT) % 8) * 8.0D0 + ", "")
LANE = ROADZ.replace("WHERE is_ground", "WHERE is_ground AND CAST(FLOOR(y / 4) AS BIGINT) % 2 = 0")


@query("g10_green_plane_recovery")
def _(t):
    m = B.recover_green(t.sql(GREEN), ground(t), t.sql(LANE), 0.25, ground_g=0.5)
    return m.select("plane_id", "n", *[F.round(c, 5).alias(c) for c in ("length", "width_rms", "coverage", "base_above_ground", "road_overlap", "road_above")])
