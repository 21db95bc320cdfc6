"""Registered queries: point cleaning, normalisation, transforms, voxels."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanloom.functions import columns as C
from scanloom.operators import features as X
from scanloom.operators import points as P
from scanloom.plans.registry import query


def r6(c):
    return F.round(C.col(c), 6)


@query("p22_height_filter", """
WITH cells AS (SELECT CAST(floor(x/0.5) AS BIGINT) ix, CAST(floor(y/0.5) AS BIGINT) iy, min(z) g FROM points GROUP BY 1,2),
     h AS (SELECT unnest([0.25::double, 0.5, 1.5]) height_m)
SELECT height_m, CASE height_m WHEN 0.25 THEN '0p25' WHEN 0.5 THEN '0p5' ELSE '1p5' END AS layer, count(*) AS kept, sum(x) AS sum_x, max(z-g) AS max_rel
FROM points p JOIN cells c ON c.ix = CAST(floor(p.x/0.5) AS BIGINT) AND c.iy = CAST(floor(p.y/0.5) AS BIGINT), h
WHERE z-g <= height_m GROUP BY 1,2""")
def _(t):
    return P.height_filter(t.points, 0.5, (0.25, 0.5, 1.5)).groupBy("height_m", "layer").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("x").alias("sum_x"), F.max(F.col("z") - F.col("ground_z")).alias("max_rel"))


@query("p01_finite_filter", """
SELECT l_orderkey, l_quantity / (CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END) AS v, l_quantity FROM lineitem WHERE l_discount <> 0""")
def _(t):
    v = F.when(F.col("l_discount") == 0, float("nan")).otherwise(F.try_divide("l_quantity", "l_discount"))
    return P.finite(t.lineitem.select("l_orderkey", v.alias("v"), "l_quantity"), ["v", "l_quantity"])


@query("p02_blind_zone", "SELECT frame_id, seq, x, y, z FROM points WHERE x*x+y*y+z*z >= 4.0")
def _(t):
    return P.blind(t.points.select("frame_id", "seq", "x", "y", "z"), 2.0)


@query("p03_decimate", "SELECT frame_id, seq, x FROM points WHERE seq % 3 = 0")
def _(t):
    return P.decimate(t.points.select("frame_id", "seq", "x"), 3)


@query("p04_scan_lines", "SELECT frame_id, seq, ring, tag FROM points WHERE ring < 3 AND (tag & 48) = 16")
def _(t):
    return P.lines(t.points, 3).select("frame_id", "seq", "ring", "tag")


@query("p05_drop_repeats", """
WITH o AS (SELECT *, (ring < 3 AND (tag & 48) = 16) ok,
  row_number() OVER w rn, lag(CASE WHEN ring < 3 AND (tag & 48) = 16 THEN x ELSE 0 END) OVER w px,
  lag(CASE WHEN ring < 3 AND (tag & 48) = 16 THEN y ELSE 0 END) OVER w py, lag(CASE WHEN ring < 3 AND (tag & 48) = 16 THEN z ELSE 0 END) OVER w pz
  FROM points WINDOW w AS (PARTITION BY frame_id ORDER BY seq,x,y,z,ring,rgb))
SELECT frame_id, seq, x, y, z FROM o WHERE ok AND rn > 1 AND (abs(x-px)>1e-7 OR abs(y-py)>1e-7 OR abs(z-pz)>1e-7)""")
def _(t):
    return P.drop_repeats(t.points, 3).select("frame_id", "seq", "x", "y", "z")


def vendor(t, time):
    return t.points.withColumn("time", time)


@query("p06_normalise_livox", """
WITH o AS (SELECT frame_id, seq, x, y, z, ring, rgb, (seq*17 % 100)/16.0 AS tm, row_number() OVER (PARTITION BY frame_id ORDER BY seq,x,y,z,ring,rgb) rn FROM points),
 rec AS (SELECT *, CASE WHEN ring >= 3 THEN 0.0::double WHEN abs(tm) < 1 THEN tm ELSE 0 END AS off FROM o WHERE rn = 1
   UNION ALL SELECT o.*, CASE WHEN o.ring >= 3 THEN 0.0::double WHEN abs(o.tm - r.off) < 1 THEN o.tm ELSE r.off + 0.004166667::double END FROM rec r JOIN o ON o.frame_id = r.frame_id AND o.rn = r.rn + 1),
 v AS (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY rn) k FROM rec WHERE ring < 3)
SELECT frame_id, seq, x, round(off, 6) AS offset_ms FROM v WHERE k % 2 = 0 AND x*x+y*y+z*z >= 0.64""")
def _(t):
    out = P.normalise(vendor(t, (F.col("seq") * 17 % 100) / 16.0), "avia", 3, 2)
    return out.select("frame_id", "seq", "x", r6("offset_ms").alias("offset_ms"))


@query("p07_normalise_rgbd", "SELECT frame_id, seq, x, 0.0::double AS offset_ms, (rgb >> 16) & 255 AS red, (rgb >> 8) & 255 AS green, rgb & 255 AS blue FROM points WHERE seq % 2 = 0")
def _(t):
    return P.normalise(t.points, "l515", every=2).select("frame_id", "seq", "x", "offset_ms", "red", "green", "blue")


@query("p08_normalise_ouster", """
SELECT frame_id, seq, x, round(seq*390625/1e6, 6) AS offset_ms, round(CASE WHEN w >= 180 THEN w-360 WHEN w <= -180 THEN w+360 ELSE w END, 5) AS yaw
FROM (SELECT *, atan2(y,x)*57.3 w FROM points) WHERE x*x+y*y+z*z >= 0.64""")
def _(t):
    return P.normalise(vendor(t, F.col("seq") * 390625), "ouster").select("frame_id", "seq", "x", r6("offset_ms").alias("offset_ms"), F.round("yaw", 5).alias("yaw"))


VELO = """
WITH y AS (SELECT *, atan2(y,x)*57.2957 yaw FROM points),
 f AS (SELECT *, first_value(yaw) OVER w fp, row_number() OVER w rn FROM y WINDOW w AS (PARTITION BY frame_id, ring ORDER BY seq,x,y,z,ring,rgb)),
 r AS (SELECT *, CASE WHEN yaw <= fp THEN (fp-yaw)/3.61 ELSE (fp-yaw+360)/3.61 END raw FROM f),
 b AS (SELECT *, CASE WHEN raw < lag(raw) OVER w THEN 1 ELSE 0 END back FROM r WINDOW w AS (PARTITION BY frame_id, ring ORDER BY rn)),
 k AS (SELECT *, max(back) OVER (PARTITION BY frame_id, ring ORDER BY rn ROWS UNBOUNDED PRECEDING) turned FROM b)
SELECT frame_id, seq, x, ring, round(raw + CASE WHEN turned=1 THEN 360/3.61 ELSE 0 END, 5) AS offset_ms FROM k WHERE rn > 1 AND x*x+y*y+z*z > 0.64"""


@query("p09_normalise_velodyne_yaw", VELO)
def _(t):
    return P.normalise(t.points, "velodyne_untimed").select("frame_id", "seq", "x", "ring", F.round("offset_ms", 5).alias("offset_ms"))


@query("p09_normalise_velodyne_timed", "SELECT frame_id, seq, x, seq*390.625/1000 AS offset_ms FROM points WHERE x*x+y*y+z*z > 0.64")
def _(t):
    return P.normalise(vendor(t, F.col("seq") * F.lit(390.625)), "velodyne").select("frame_id", "seq", "x", "offset_ms")


HEADED = """
WITH h AS (SELECT *, first_value(seq*3 % 1000 / 1024.0) OVER (PARTITION BY frame_id ORDER BY seq,x,y,z,ring,rgb) head FROM points)
SELECT frame_id, seq, x, {extra} (seq*3 % 1000 / 1024.0 - head)*1000 AS offset_ms FROM h WHERE seq % 2 = 0 AND x*x+y*y+z*z > 0.64"""


@query("p10_normalise_pandar", HEADED.format(extra="round(intensity/255.0, 6) AS intensity,"))
def _(t):
    return P.normalise(vendor(t, F.col("seq") * 3 % 1000 / 1024.0), "pandar128", every=2).select("frame_id", "seq", "x", r6("intensity").alias("intensity"), "offset_ms")


@query("p11_normalise_xt32", HEADED.format(extra=""))
def _(t):
    return P.normalise(vendor(t, F.col("seq") * 3 % 1000 / 1024.0), "xt32", every=2).select("frame_id", "seq", "x", "offset_ms")


@query("p11_normalise_xt32_rings", VELO.split("SELECT frame_id, seq, x, ring, round(raw")[0] + """, o AS (SELECT *, raw + CASE WHEN turned=1 THEN 360/3.61 ELSE 0 END AS off FROM k WHERE rn > 1), n AS (SELECT *, count(*) OVER (PARTITION BY frame_id, ring) c, x*x+y*y r2, power(lead(x) OVER w - x,2)+power(lead(y) OVER w - y,2)+power(lead(z) OVER w - z,2) d2 FROM o WINDOW w AS (PARTITION BY frame_id, ring ORDER BY rn))
SELECT frame_id, seq, x, ring, round(off,5) AS offset_ms, round(r2,6) AS range2, round(d2,6) AS dist2 FROM n WHERE ring < 3 AND c >= 2""")
def _(t):
    out = P.normalise(t.points, "xt32_rings", 3, timed=False)
    return out.select("frame_id", "seq", "x", "ring", F.round("offset_ms", 5).alias("offset_ms"), r6("range2").alias("range2"), r6("dist2").alias("dist2"))


@query("w14_ring_differences", "SELECT frame_id, seq, x, ring, round(x*x+y*y,6) AS range2, round(power(lead(x) OVER w - x,2)+power(lead(y) OVER w - y,2)+power(lead(z) OVER w - z,2),6) AS dist2 FROM points WINDOW w AS (PARTITION BY frame_id, ring ORDER BY seq,x,y,z,ring,rgb)")
def _(t):
    return X.ring_differences(t.points, P.ORDER).select("frame_id", "seq", "x", "ring", r6("range2").alias("range2"), r6("dist2").alias("dist2"))


#: Rings that run along two walls and a cross wall, made from the order of the points.
WALLS = """SELECT frame_id, ring, i, CASE WHEN s % 3 = 0 THEN 4.0D0 WHEN s % 3 = 1 THEN 6.0D0 ELSE 6.0D0 + (i % 12 + 1) / 16.0D0 END AS x, CASE WHEN s % 3 = 2 THEN (i - i % 12 - 1) / 16.0D0 - 1 ELSE i / 16.0D0 - 1 END + (seq % 3) / 4096.0D0 AS y, (seq % 3) / 1024.0D0 AS z
 FROM (SELECT frame_id, ring, seq, i, CAST(FLOOR(i / 12) AS BIGINT) AS s FROM (SELECT frame_id, ring, seq, CAST(ROW_NUMBER() OVER (PARTITION BY frame_id, ring ORDER BY seq, x, y, z, rgb) - 1 AS BIGINT) AS i FROM points) a) b"""


def _labels_sql():
    g = X.GROUP
    lead = ", ".join(f"lead({c}, {k}) OVER w {c}{k}" for k in range(1, g + 1) for c in "xyz")
    lag = ", ".join(f"lag({c}, {k}) OVER w {c}_{k}" for k in (1, 2) for c in "xyz")
    v = [f"({c}{g}-{c})" for c in "xyz"]
    two = "+".join(f"{a}*{a}" for a in v)

    def width(k):
        u = [f"({c}{k}-{c})" for c in "xyz"]
        return f"power({u[1]}*{v[2]}-{u[2]}*{v[1]},2)+power({u[2]}*{v[0]}-{u[0]}*{v[2]},2)+power({u[0]}*{v[1]}-{u[1]}*{v[0]},2)"
    step = lambda a, b: "+".join(f"power({c}{b}-{c}{a},2)" for c in "xyz")
    seen = lambda k: f"(x{k}*x{k}+y{k}*y{k} >= 0.64)"
    whole = " AND ".join(seen(k) for k in ["", *range(1, g + 1)])
    norm, dot = "sqrt(x*x+y*y+z*z)", lambda k: f"(x*(x{k}-x)+y*(y{k}-y)+z*(z{k}-z))"
    cos = lambda k, d: f"{dot(k)}/{norm}/sqrt({d})"
    usual = lambda c: f"({c} >= {X.COS_BACK!r} AND {c} <= {X.COS_SIGHT!r})"
    steady = lambda d, e, k1, k2: f"({seen(k1)} AND {seen(k2)} AND greatest(sqrt({d}),sqrt({e})) <= 2*least(sqrt({d}),sqrt({e})) AND abs(sqrt({d})-sqrt({e})) <= 0.1)"
    meet = "((x_1-x)*(x1-x)+(y_1-y)*(y1-y)+(z_1-z)*(z1-z))/sqrt(da)/sqrt(db)"
    return f"""WITH s AS ({WALLS}), n AS (SELECT *, {lead}, {lag} FROM s WINDOW w AS (PARTITION BY frame_id, ring ORDER BY i)),
 g AS (SELECT *, {two} two, list_max([{', '.join(width(k) for k in range(1, g))}]) wd, list_sort([{', '.join(step(k if k else '', k + 1) for k in range(g))}]) sp, {step('', '_1')} da, {step('', '1')} db, {step('_1', '_2')} ea, {step('1', '2')} eb FROM n),
 f AS (SELECT *, coalesce({whole} AND two*two >= 225*wd AND sp[2] >= 1e-16 AND sp[{g}] < 3.24*sp[2], false) flat FROM g),
 d AS (SELECT *, {', '.join(f'CASE WHEN flat THEN {a}/sqrt(two) END u{c}' for a, c in zip(v, 'xyz'))} FROM f),
 e AS (SELECT *, coalesce(bool_or(flat) OVER (PARTITION BY frame_id, ring ORDER BY i ROWS BETWEEN {g - 1} PRECEDING AND 1 PRECEDING), false) ins, coalesce(lag(flat, {g}) OVER w, false) ends, abs(ux*lag(ux, {g}) OVER w + uy*lag(uy, {g}) OVER w + uz*lag(uz, {g}) OVER w) bend,
  {seen('_1')} AND {seen('1')} AND da >= 1e-16 AND db >= 1e-16 kn, {cos('_1', 'da')} ca, {cos('1', 'db')} cb, {meet} mt FROM d WINDOW w AS (PARTITION BY frame_id, ring ORDER BY i))
SELECT frame_id, ring, i, CASE WHEN NOT {seen('')} THEN 'blind' WHEN flat AND ends AND bend < 0.707 THEN 'edge_plane' WHEN ins OR (flat AND ends) THEN 'plane'
 WHEN kn AND mt > {X.COS_BENT!r} AND (({usual('ca')} AND cb > {X.COS_SIGHT!r} AND db > 0.0225 AND db > 4*da AND {steady('da', 'ea', '_1', '_2')}) OR ({usual('cb')} AND ca > {X.COS_SIGHT!r} AND da > 0.0225 AND da > 4*db AND {steady('db', 'eb', '1', '2')})) THEN 'edge_jump'
 WHEN NOT (flat OR ends) AND kn AND NOT {usual('ca')} AND NOT {usual('cb')} THEN 'wire' WHEN NOT (flat OR ends) AND kn AND mt < {X.COS_STRAIGHT!r} AND greatest(da,db) < 1.2*least(da,db) AND least(da,db) >= 1e-8 THEN 'plane' WHEN flat OR ends THEN 'possible_plane' ELSE 'none' END AS label FROM e""".replace("D0", "::double")


@query("w15_point_labels", _labels_sql())
def _(t):
    return X.point_labels(t.sql(WALLS), ["i"]).select("frame_id", "ring", "i", "label")


@query("p12_normalise_robosense", HEADED.format(extra="ring,"))
def _(t):
    return P.normalise(vendor(t, F.col("seq") * 3 % 1000 / 1024.0), "robosense", every=2).select("frame_id", "seq", "x", "ring", "offset_ms")


@query("p13_normalise_ns_offset", "SELECT frame_id, seq, x, (seq-20)*390625/1e6 AS offset_ms FROM points WHERE x*x+y*y+z*z >= 0.64 AND seq >= 20 AND ring < 3")
def _(t):
    return P.normalise(vendor(t, (F.col("seq") - 20) * F.lit(390625.0)), "ns_offset", 3).select("frame_id", "seq", "x", "offset_ms")


@query("p14_rigid_transform", """
SELECT p.frame_id, seq, round(x*(1-2*qz*qz) - y*2*qz*qw + tx, 6) AS mx, round(y*(1-2*qz*qz) + x*2*qz*qw + ty, 6) AS my, round(z+tz, 6) AS mz
FROM points p JOIN poses f ON p.frame_id = f.frame_id""")
def _(t):
    return P.transform(P.with_pose(t.points, t.poses)).select("frame_id", "seq", r6("mx").alias("mx"), r6("my").alias("my"), r6("mz").alias("mz"))


@query("j08_points_with_frame_pose", """
SELECT frame_id, count(*) AS n, round(sum(lx), 4) AS sum_lx, round(sum(ly), 4) AS sum_ly, sum(lz) AS sum_lz FROM local_points GROUP BY 1""")
def _(t):
    loc = P.transform(P.with_pose(t.points, t.poses), out=("lx", "ly", "lz"), invert=True)
    return loc.groupBy("frame_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("lx"), 4).alias("sum_lx"),
                                       F.round(F.sum("ly"), 4).alias("sum_ly"), F.sum("lz").alias("sum_lz"))


@query("p15_range_height_band", "SELECT frame_id, seq, x, y FROM local_points WHERE sqrt(lx*lx+ly*ly) BETWEEN 1.5 AND 9.0 AND lz BETWEEN -1.8 AND 1.0")
def _(t):
    return P.range_band(t.local_points, 1.5, 9.0, -1.8, 1.0).select("frame_id", "seq", "x", "y")


FIXES = """
SELECT event_id, 30 + (event_id % 1000) / 8192.0D0 AS latitude_deg, 120 + (user_id % 1000) / 8192.0D0 AS longitude_deg, 5.0D0 + value / 100 AS altitude_m,
  CASE WHEN user_id % 9 = 0 THEN 1 ELSE 0 END AS p_sol_status, 30 + user_id % 20 AS pos_type, value / 50 AS lat_std, value / 80 AS lon_std,
  value / 40 AS hgt_std, value / 3 AS diff_age_s, 35 + event_id % 20 AS heading_type, event_id * 7 % 720 - 180.0D0 AS heading_deg, value / 4 AS heading_std FROM events"""
FIXES_DUCK = FIXES.replace("D0", "::double")


@query("p16_rtk_quality", f"""SELECT event_id, pos_type, heading_type FROM ({FIXES_DUCK}) WHERE p_sol_status=0 AND pos_type>=34 AND lat_std<0.5 AND lon_std<0.5
AND hgt_std<1 AND diff_age_s<5 AND heading_type>=40 AND heading_std<5""")
def _(t):
    return P.rtk_quality(t.sql(FIXES)).select("event_id", "pos_type", "heading_type")


@query("p17_geodetic_to_map", f"""
SELECT event_id, round(0.8*e - 0.6*n + 12.5, 4) AS map_x, round(0.6*e + 0.8*n - 3.25, 4) AS map_y, altitude_m + 1.5 AS map_z FROM (
 SELECT *, radians(longitude_deg - 120.0)*cos(radians(30.0))*6378137.0 e, radians(latitude_deg - 30.0)*6378137.0 n FROM ({FIXES_DUCK}))""")
def _(t):
    m = P.to_map(t.sql(FIXES), 30.0, 120.0, (0.8, -0.6, 12.5, 0.6, 0.8, -3.25), 1.5)
    return m.select("event_id", F.round("map_x", 4).alias("map_x"), F.round("map_y", 4).alias("map_y"), "map_z")


PM = "(({0}) - 360*floor(({0})/360))"


@query("p18_heading_to_map_yaw", f"SELECT event_id, {PM.format('90 - ' + PM.format('heading_deg + 7.5'))} AS map_yaw_deg FROM ({FIXES_DUCK})")
def _(t):
    return t.sql(FIXES).select("event_id", P.map_yaw("heading_deg", 7.5).alias("map_yaw_deg"))


@query("p19_lever_arm", """
SELECT event_id, x AS raw_map_x, y AS raw_map_y, round(x + cos(radians(a))*0.4 - sin(radians(a))*0.1, 8) AS map_x, round(y + sin(radians(a))*0.4 + cos(radians(a))*0.1, 8) AS map_y
FROM (SELECT *, (user_id % 360)::double a FROM traj)""")
def _(t):
    d = t.traj.select("event_id", F.col("x").alias("map_x"), F.col("y").alias("map_y"), (F.col("user_id") % 360).cast("double").alias("map_yaw_deg"))
    return P.lever_arm(d, 0.4, 0.1).select("event_id", "raw_map_x", "raw_map_y", F.round("map_x", 8).alias("map_x"), F.round("map_y", 8).alias("map_y"))


@query("p20_prism_offset", """
SELECT frame_id, round(0.25*(1-2*qz*qz) - 0.5*2*qz*qw + tx, 6) AS px, round(0.5*(1-2*qz*qz) + 0.25*2*qz*qw + ty, 6) AS py, tz - 0.125 AS pz FROM poses""")
def _(t):
    return P.prism(t.poses, (0.25, 0.5, -0.125)).select("frame_id", r6("px").alias("px"), r6("py").alias("py"), r6("pz").alias("pz"))


@query("p21_detection_gate", """SELECT frame_id, box_id, class, score FROM boxes WHERE (class=0 AND score>=0.5) OR (class=6 AND score>=0.75) OR (class=8 AND score>=0.3)""")
def _(t):
    return P.gate_boxes(t.boxes).select("frame_id", "box_id", "class", "score")


def imu(t):
    return t.poses.select(F.col("ts").alias("t"), "tx", "ty", "tz", "qx", "qy", "qz", "qw", F.lit(0.5).alias("vx"), F.lit(0.25).alias("vy"), F.lit(0.0).alias("vz"),
                          F.lit(0.0).alias("ax"), F.lit(0.5).alias("ay"), F.lit(0.0).alias("az"), F.lit(0.0).alias("wx"), F.lit(0.0).alias("wy"), F.lit(0.125).alias("wz"))


@query("p23_deskew", """
WITH m AS (SELECT p.frame_id, p.seq, x, y, z, f.ts + seq/1024.0 AS t, f.* EXCLUDE (frame_id) FROM points p JOIN poses f ON f.frame_id = p.frame_id),
 w AS (SELECT m.frame_id, seq, z, 2*atan2(qz,qw) + 0.125*(t-ts) a, t-ts dt, tx, ty, x, y FROM m),
 g AS (SELECT w.frame_id, seq, z, x*cos(a)-y*sin(a)+w.tx+0.5*dt gx, x*sin(a)+y*cos(a)+w.ty+0.25*dt+0.25*dt*dt gy FROM w)
SELECT g.frame_id, seq, round((gx-e.tx)*cos(b)+(gy-e.ty)*sin(b), 5) AS dx, round(-(gx-e.tx)*sin(b)+(gy-e.ty)*cos(b), 5) AS dy, z AS dz
FROM g JOIN (SELECT *, 2*atan2(qz,qw) b FROM poses) e ON e.frame_id = g.frame_id + 1""")
def _(t):
    pts = t.points.join(t.poses.select("frame_id", "ts"), "frame_id").select(
        (F.col("frame_id") + 1).alias("scan_id"), "seq", (F.col("ts") + F.col("seq") / 1024.0).alias("t"), "x", "y", "z")
    end = t.poses.select(F.col("frame_id").alias("scan_id"), *[F.col(f"q{a}").alias(f"eq{a}") for a in "xyzw"], *[F.col(f"t{a}").alias(f"et{a}") for a in "xyz"])
    out = P.deskew(pts, imu(t), end)
    return out.select((F.col("scan_id") - 1).alias("frame_id"), "seq", F.round("dx", 5).alias("dx"), F.round("dy", 5).alias("dy"), "dz")


@query("p24_colour_unpack_pack", """SELECT frame_id, seq, (rgb>>16)&255 AS r, (rgb>>8)&255 AS g, rgb&255 AS b, rgb AS repacked FROM points""")
def _(t):
    return t.points.select("frame_id", "seq", C.red("rgb").alias("r"), C.green("rgb").alias("g"), C.blue("rgb").alias("b"),
                           C.pack_rgb(C.red("rgb"), C.green("rgb"), C.blue("rgb")).alias("repacked"))


@query("p25_scan_records", """SELECT frame_id, seq, CAST(greatest(0, least(255, intensity)) AS INT) AS reflectivity, greatest(0, least(4294967295, (seq-5)*390625*100)) AS offset_ns,
 frame_id*500000000 + greatest(0, least(4294967295, (seq-5)*390625*100)) AS t_ns FROM points""")
def _(t):
    d = t.points.withColumns({"stamp_ns": F.col("frame_id") * 500000000, "offset_ns": (F.col("seq") - 5) * 39062500})
    return P.to_scan_records(d).select("frame_id", "seq", "reflectivity", "offset_ns", "t_ns")


# --- voxels ----------------------------------------------------------------------
@query("a01_cell_lowest_z", "SELECT CAST(floor(x/0.5) AS BIGINT) AS ix, CAST(floor(y/0.5) AS BIGINT) AS iy, min(z) AS ground_z FROM points GROUP BY 1,2")
def _(t):
    return P.cell_min(t.points, 0.5)


VOX = "CAST(floor(x/{0}) AS BIGINT) AS ix, CAST(floor(y/{0}) AS BIGINT) AS iy, CAST(floor(z/{0}) AS BIGINT) AS iz"


@query("a03_voxel_mean_rgb", f"""SELECT {VOX.format(0.5)}, avg(x) AS x, avg(y) AS y, avg(z) AS z,
 CAST(round(avg((rgb>>16)&255)) AS INT) AS r, CAST(round(avg((rgb>>8)&255)) AS INT) AS g, CAST(round(avg(rgb&255)) AS INT) AS b FROM points GROUP BY 1,2,3""")
def _(t):
    v = P.voxel_rgb(t.points, 0.5)
    return v.select("ix", "iy", "iz", "x", "y", "z", "r", "g", "b")


@query("a04_voxel_keep_first", f"""SELECT ix, iy, iz, frame_id, seq, x, y, z, ring, rgb FROM (
 SELECT *, row_number() OVER (PARTITION BY ix,iy,iz ORDER BY frame_id,seq,x,y,z,ring,rgb) rn FROM (SELECT {VOX.format(0.5)}, * FROM points)) WHERE rn=1""")
def _(t):
    o = ("frame_id", *P.ORDER)
    return P.voxel_first(t.points, 0.5, o, o)


@query("a05_voxel_centroid", f"SELECT {VOX.format(0.25)}, avg(x) AS x, avg(y) AS y, avg(z) AS z, count(*) AS n FROM points GROUP BY 1,2,3")
def _(t):
    return P.voxel_centroid(t.points, 0.25).select("ix", "iy", "iz", "x", "y", "z", "n")




@query("a21_voxel_plane_statistics", """
WITH v AS (SELECT CAST(floor(x/1.0) AS BIGINT) ix, CAST(floor(y/1.0) AS BIGINT) iy, CAST(floor(z/1.0) AS BIGINT) iz, count(*) n,
  avg(x) mx, avg(y) my, avg(z) mz, avg(x*x)-avg(x)*avg(x) a, avg(x*y)-avg(x)*avg(y) d, avg(x*z)-avg(x)*avg(z) e, avg(y*y)-avg(y)*avg(y) b, avg(y*z)-avg(y)*avg(z) f, avg(z*z)-avg(z)*avg(z) c
  FROM points GROUP BY 1,2,3 HAVING count(*) >= 5),
 q AS (SELECT *, a+b+c tr, a*b+a*c+b*c-d*d-e*e-f*f m2, a*b*c+2*d*e*f-a*f*f-b*e*e-c*d*d det FROM v),
 nt AS (SELECT *, 0.0::double lam, 0 it FROM q UNION ALL
   SELECT * EXCLUDE (lam, it), lam - (lam*lam*lam - tr*lam*lam + m2*lam - det)/(CASE WHEN abs(3*lam*lam - 2*tr*lam + m2) < 1e-30 THEN 1e-30 ELSE 3*lam*lam - 2*tr*lam + m2 END), it+1 FROM nt WHERE it < 60)
SELECT ix, iy, iz, n, mx AS m_x, my AS m_y, mz AS m_z, round(lam,4)+0.0 AS lam_min, true AS planar FROM nt WHERE it=60 AND lam < 0.0005""")
def _(t):
    v = P.voxel_planes(t.points, 1.0, 0.0005, 5, max_layer=0)
    return v.select("ix", "iy", "iz", "n", "m_x", "m_y", "m_z", (F.round("lam_min", 4) + 0.0).alias("lam_min"), F.lit(True).alias("planar"))


@query("a21_voxel_plane_octree")
def _(t):
    v = P.voxel_planes(t.points, 1.0, 0.0005, 5, max_layer=2)
    return v.groupBy("layer", "size").agg(F.count(F.lit(1)).alias("planes"), F.sum("n").alias("points"), F.round(F.avg("normal_z"), 3).alias("mean_nz"))


@query("f_body_point_covariance", """
SELECT frame_id, seq, round(lx*lx/r2*0.0004 + r2*s*(1-lx*lx/r2), 8) AS cxx, round(lx*ly/r2*0.0004 - r2*s*lx*ly/r2, 8) AS cxy, round(lz*lz/r2*0.0004 + r2*s*(1-lz*lz/r2), 8) AS czz
FROM (SELECT *, lx*lx+ly*ly+lz*lz r2, pow(sin(radians(0.05)),2) s FROM local_points) WHERE r2 > 0.01""")
def _(t):
    p = t.local_points.filter("lx*lx+ly*ly+lz*lz > 0.01")
    e = C.body_covariance(F.col("lx"), F.col("ly"), F.col("lz"), 0.02, 0.05)
    return p.select("frame_id", "seq", *[F.round(e[k], 8).alias(f"c{k}") for k in ("xx", "xy", "zz")])
