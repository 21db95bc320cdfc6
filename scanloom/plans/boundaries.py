"""Registered queries: lines, bands, corridors, curbs, sidewalks, constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanloom.functions import columns as C
from scanloom.operators import boundaries as B
from scanloom.operators import ordered as O
from scanloom.operators import spatial as S
from scanloom.operators import trajectory as J
from scanloom.plans.evidence import LAYERS, ground
from scanloom.plans.points import r6
from scanloom.plans.registry import query
from scanloom.plans.trajectories import SAMP


def duck(text):
    return text.replace("D0", "::double")


#: Candidate edge positions: two lines per block of 8 m plus scattered ones.
PTS = """SELECT ROW_NUMBER() OVER (ORDER BY x, y) AS id, x, y, 0.125D0 * (CAST(FLOOR(y * 8) AS BIGINT) % 3) AS z FROM (SELECT DISTINCT (CAST(FLOOR(o_orderkey / 512) AS BIGINT) % 8) * 8.0D0 + (o_custkey % 64) / 8.0D0 AS x,
 CAST(FLOOR(o_orderkey / 4096) AS BIGINT) * 8.0D0 + CASE WHEN o_custkey % 5 = 0 THEN (o_custkey % 61) / 8.0D0 WHEN o_custkey % 2 = 0 THEN 2.0D0 + (o_custkey % 3) / 64.0D0 ELSE 6.0D0 + (o_custkey % 3) / 64.0D0 END AS y FROM orders) d"""
#: The same without the numbering, for plans that can build the id from the position.
PTS_ID = PTS.replace("ROW_NUMBER() OVER (ORDER BY x, y)", "CAST(x * 8 AS BIGINT) * 1048576 + CAST(y * 64 AS BIGINT)")
SUPPORT = f"""pt AS MATERIALIZED ({duck(PTS_ID)}), nbh AS (SELECT a.id, a.x ax, a.y ay, b.x-a.x u, b.y-a.y v FROM pt a JOIN pt b ON b.x BETWEEN a.x-1.5 AND a.x+1.5 AND b.y BETWEEN a.y-1.5 AND a.y+1.5 WHERE (b.x-a.x)*(b.x-a.x)+(b.y-a.y)*(b.y-a.y) <= 2.25),
 nm AS (SELECT id, any_value(ax) x, any_value(ay) y, count(*) n, sum(u*u)-sum(u)*sum(u)/count(*) xx, sum(u*v)-sum(u)*sum(v)/count(*) xy, sum(v*v)-sum(v)*sum(v)/count(*) yy FROM nbh GROUP BY 1 HAVING count(*) >= 5),
 ne AS (SELECT *, (xx+yy)/2 + sqrt(power((xx-yy)/2,2)+xy*xy) hi, (xx+yy)/2 - sqrt(power((xx-yy)/2,2)+xy*xy) lo FROM nm), nt AS (SELECT *, sqrt(xy*xy+(hi-xx)*(hi-xx)) nn FROM ne WHERE hi >= 0.12 AND (hi-lo)/hi >= 0.72),
 sup AS MATERIALIZED (SELECT id, x, y, CASE WHEN nn >= 1e-9 THEN xy/nn ELSE 1 END tx, CASE WHEN nn >= 1e-9 THEN (hi-xx)/nn ELSE 0 END ty FROM nt)"""


def support(t):
    return B.linear_support(t.sql(PTS_ID), 1.5)


@query("a20_local_linearity", f"WITH {SUPPORT} SELECT id, round(abs(tx),5) AS tx, round(abs(ty),5) AS ty FROM sup")
def _(t):
    return support(t).select("id", F.round(F.abs("tx"), 5).alias("tx"), F.round(F.abs("ty"), 5).alias("ty"))


@query("j12_radius_neighbour_counts", f"WITH {SUPPORT} SELECT id, count(*) AS n FROM nbh GROUP BY 1")
def _(t):
    return S.neighbours(t.sql(PTS_ID), 1.5).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query("j12_radius_neighbours", f"WITH pt AS MATERIALIZED ({duck(PTS_ID)}) SELECT a.id, b.id AS other_id, round(sqrt(power(a.x-b.x,2)+power(a.y-b.y,2)),6) AS distance FROM pt a JOIN pt b ON b.x BETWEEN a.x-0.5 AND a.x+0.5 AND b.y BETWEEN a.y-0.5 AND a.y+0.5 AND power(a.x-b.x,2)+power(a.y-b.y,2) <= 0.25")
def _(t):
    return S.neighbours(t.sql(PTS_ID), 0.5).select("id", "other_id", r6("distance").alias("distance"))


@query("a18_tls_line_fit", f"""WITH p AS (SELECT *, CAST(floor(x/8) AS BIGINT) k FROM ({duck(PTS_ID)})), m AS (SELECT k, count(*) n, avg(x) mx, avg(y) my, avg(x*x)-avg(x)*avg(x) xx, avg(x*y)-avg(x)*avg(y) xy, avg(y*y)-avg(y)*avg(y) yy FROM p GROUP BY 1),
 e AS (SELECT *, (xx+yy)/2+sqrt(power((xx-yy)/2,2)+xy*xy) hi FROM m), t AS (SELECT *, xy/sqrt(xy*xy+(hi-xx)*(hi-xx)) a, (hi-xx)/sqrt(xy*xy+(hi-xx)*(hi-xx)) b FROM e), s AS (SELECT *, CASE WHEN a < 0 OR (abs(a) < 1e-9 AND b < 0) THEN -1 ELSE 1 END f FROM t)
SELECT k, n, round(a*f,4) AS tx, round(b*f,4) AS ty, round(-b*f*mx+a*f*my,3) AS rho FROM s""")
def _(t):
    p = t.sql(PTS_ID).withColumn("k", C.cell("x", 8.0))
    return B.fit_lines(p, ["k"]).select("k", "n", F.round("tx", 4).alias("tx"), F.round("ty", 4).alias("ty"), F.round("rho", 3).alias("rho"))


HOUGH = f"""{SUPPORT}, hc AS (SELECT x, y, CAST(round_even(((atan2(ty,tx)+pi()/2) - pi()*floor((atan2(ty,tx)+pi()/2)/pi()))/pi()*180, 0) AS BIGINT) % 180 c FROM sup),
 hv AS (SELECT x, y, (c+o+180) % 180 theta_bin FROM hc, range(-3,4) r(o)), hh AS (SELECT theta_bin, CAST(round_even((x*cos(theta_bin*pi()/180)+y*sin(theta_bin*pi()/180))/0.2, 0) AS BIGINT) rho_bin, count(*) votes FROM hv GROUP BY 1,2)"""


@query("a31_hough_votes", f"WITH {HOUGH} SELECT theta_bin, sum(votes) AS votes FROM hh GROUP BY 1")
def _(t):
    return B.hough_votes(support(t)).groupBy("theta_bin").agg(F.sum("votes").alias("votes"))


@query("t03_vote_peak", f"WITH {HOUGH} SELECT theta_bin, rho_bin, votes FROM hh ORDER BY votes DESC, theta_bin, rho_bin LIMIT 1")
def _(t):
    return B.hough_peak(support(t))


@query("g11_refined_peak_line")
def _(t):
    sup = S.cut(support(t))
    got = B.refine_peak(sup, B.hough_peak(sup).first())
    keep = got[1] if got else F.lit(False)
    return B.fit_lines(sup.filter(keep).withColumn("k", F.lit(0)), ["k"]).select("n", *[F.round(c, 5).alias(c) for c in ("tx", "ty", "rho")])


@query("t03_tile_line_extraction")
def _(t):
    return B.extract_lines(support(t)).select("tile_x", "tile_y", "seq", "n", *[F.round(c, 5).alias(c) for c in ("tx", "ty", "rho", "s0", "s1")])


@query("g05_fragment_chains")
def _(t):
    lines = S.cut(B.extract_lines(support(t)).withColumn("id", F.concat_ws(":", "tile_x", "tile_y", "seq")))
    pts = t.sql(PTS_ID).select(F.col("id").alias("pid"), "x", "y")
    members = lines.select("id", F.explode("members").alias("pid")).join(pts, "pid").select("id", "x", "y")
    return B.join_fragments(B.mutual_best(lines), members).select("band_id", "fragments", "n", *[F.round(c, 5).alias(c) for c in ("length", "residual")])


#: Boundary bands along the trajectory: a few hundred per lap of ground.
BANDS = """SELECT id, tx, ty, -ty AS nx, tx AS ny, tx * ay - ty * ax AS rho, tx * ax + ty * ay - half AS s0, tx * ax + ty * ay + half AS s1, ax AS mx, ay AS my FROM
 (SELECT c_custkey AS id, COS((c_custkey * 7 % 21 - 10) / 64.0D0) AS tx, SIN((c_custkey * 7 % 21 - 10) / 64.0D0) AS ty, (c_custkey * 37 % 1024) / 16.0D0 AS ax, 2.0D0 + (c_custkey % 7) / 2.0D0 AS half,
  CAST(FLOOR(c_custkey / 410) AS BIGINT) * 8.0D0 + 8 + (CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE -1 END) * (1.25D0 + (c_custkey * 13 % 40) / 8.0D0) AS ay FROM customer) c"""
CAND = f"""sm AS MATERIALIZED ({SAMP}), bd AS MATERIALIZED ({duck(BANDS)}), cj AS (SELECT s.id sample_id, s.x, s.y, s.tx, s.ty, b.id band_id, b.tx btx, b.ty bty, b.nx*s.x+b.ny*s.y-b.rho sg, b.nx, b.ny FROM sm s JOIN bd b ON abs(s.tx*b.tx+s.ty*b.ty) >= cos(radians(35)) AND s.x*b.tx+s.y*b.ty BETWEEN b.s0-0.5 AND b.s1+0.5),
 cd AS MATERIALIZED (SELECT *, abs(lat) distance, CASE WHEN lat > 0 THEN 1 ELSE -1 END side FROM (SELECT *, -sg*(nx*-ty+ny*tx) lat, x-sg*nx px, y-sg*ny py FROM cj) WHERE lat <> 0 AND abs(lat) <= 10),
 rk AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY sample_id, side ORDER BY distance, band_id) rank FROM cd)"""


def cands(t):
    return B.band_candidates(t.sql(SAMP), t.sql(BANDS))


@query("j13_cross_section_bands", f"WITH {CAND} SELECT sample_id, side, band_id, round(distance,6) AS distance FROM cd")
def _(t):
    return cands(t).select("sample_id", "side", "band_id", r6("distance").alias("distance"))


@query("t02_nearest_bands_ranked", f"WITH {CAND} SELECT sample_id, side, band_id, rank FROM rk WHERE rank <= 3")
def _(t):
    return B.nearest_ranked(cands(t), 3).select("sample_id", "side", "band_id", F.col("rank").cast("long").alias("rank"))


def run_sql(src, keys, id_col, step=2):
    return f"""(SELECT {keys}, max(c) longest_run, CAST(sum(c) AS BIGINT) samples FROM (SELECT {keys}, g, count(*) c FROM (SELECT *, sum(b) OVER (PARTITION BY {keys} ORDER BY {id_col}) g FROM
 (SELECT *, CASE WHEN {id_col} - lag({id_col}) OVER (PARTITION BY {keys} ORDER BY {id_col}) > {step} THEN 1 ELSE 0 END b FROM (SELECT DISTINCT {keys}, {id_col} FROM {src}))) GROUP BY ALL) GROUP BY ALL)"""


@query("a40_band_pairs", f"""WITH {CAND}, pr AS (SELECT l.sample_id, l.band_id left_band_id, r.band_id right_band_id, sqrt(power(l.px-r.px,2)+power(l.py-r.py,2)) width FROM rk l JOIN rk r ON l.sample_id=r.sample_id AND l.side=1 AND r.side=-1 AND l.rank=1 AND r.rank=1 AND l.band_id<>r.band_id WHERE abs(l.btx*r.btx+l.bty*r.bty) >= cos(radians(5))),
 pw AS (SELECT * FROM pr WHERE width BETWEEN 1.2 AND 12), rn AS {run_sql('pw', 'left_band_id, right_band_id', 'sample_id')}, mw AS (SELECT left_band_id, right_band_id, avg(width) mean_width FROM pw GROUP BY 1,2)
SELECT left_band_id, right_band_id, longest_run, samples, round(mean_width,6) AS mean_width FROM rn JOIN mw USING (left_band_id, right_band_id) WHERE longest_run >= 2 AND samples >= 2""")
def _(t):
    p = B.band_pairs(cands(t), min_run=2)
    return p.select("left_band_id", "right_band_id", "longest_run", "samples", r6("mean_width").alias("mean_width"))


@query("a41_band_roles", f"""WITH {CAND}, f1 AS (SELECT * FROM rk WHERE rank=1), s2 AS (SELECT r.* FROM rk r JOIN f1 ON f1.sample_id=r.sample_id AND f1.side=r.side WHERE r.rank=2 AND r.distance-f1.distance BETWEEN 0.45 AND 6),
 p AS {run_sql('f1', 'band_id', 'sample_id')}, s AS {run_sql('s2', 'band_id', 'sample_id')}
SELECT bd.id, coalesce(p.longest_run,0) AS primary_longest_run, coalesce(s.longest_run,0) AS secondary_longest_run, CASE WHEN coalesce(p.longest_run,0) >= 6 THEN 'primary_road_side_candidate' WHEN coalesce(s.longest_run,0) >= 6 THEN 'secondary_sidewalk_outer_candidate' ELSE 'unassociated_boundary_geometry' END AS role
FROM bd LEFT JOIN p ON p.band_id=bd.id LEFT JOIN s ON s.band_id=bd.id""")
def _(t):
    return B.band_roles(cands(t), t.sql(BANDS)).select("id", "primary_longest_run", "secondary_longest_run", "role")


@query("w04_longest_run_one_missing", f"WITH {CAND} SELECT band_id, side, longest_run, samples FROM {run_sql('cd', 'band_id, side', 'sample_id')}")
def _(t):
    return B.longest_run(cands(t), ["band_id", "side"], "sample_id")


XS = f"""{CAND}, bi AS (SELECT sample_id, side, arg_min(band_id, distance) ib, min(distance) d FROM cd GROUP BY 1,2), bo AS (SELECT c.sample_id, c.side, min(c.distance) od FROM cd c JOIN bi ON bi.sample_id=c.sample_id AND bi.side=c.side WHERE c.distance-bi.d BETWEEN 0.45 AND 6 GROUP BY 1,2),
 x0 AS (SELECT s.id sample_id, s.x, s.y, s.tx, s.ty, l.d left_inner_m, r.d right_inner_m, lo.od lom, ro.od rom, l.d+r.d road_width FROM sm s LEFT JOIN bi l ON l.sample_id=s.id AND l.side=1 LEFT JOIN bi r ON r.sample_id=s.id AND r.side=-1 LEFT JOIN bo lo ON lo.sample_id=s.id AND lo.side=1 LEFT JOIN bo ro ON ro.sample_id=s.id AND ro.side=-1),
 xs AS MATERIALIZED (SELECT *, (road_width BETWEEN 1.2 AND 9) IS TRUE road_valid, CASE WHEN (road_width BETWEEN 1.2 AND 9) IS TRUE THEN lom END left_outer_m, CASE WHEN (road_width BETWEEN 1.2 AND 9) IS TRUE THEN rom END right_outer_m FROM x0)"""


def sections(t, every=None):
    return B.cross_sections(t.sql(SAMP), cands(t))


@query("t04_outer_boundary_choice", f"WITH {XS} SELECT sample_id, round(left_inner_m,6) AS left_inner_m, round(right_inner_m,6) AS right_inner_m, round(left_outer_m,6) AS left_outer_m, round(right_outer_m,6) AS right_outer_m, road_valid FROM xs")
def _(t):
    return sections(t).select("sample_id", *[r6(c).alias(c) for c in ("left_inner_m", "right_inner_m", "left_outer_m", "right_outer_m")], "road_valid")


# Sections with gaps: the bands thinned by side and place leave one-sided and empty stretches.
GAPS = "CASE WHEN (FLOOR(sample_id / 9) % 3 = 1) OR (FLOOR(sample_id / 23) % 4 = 2) THEN NULL ELSE {0} END"
GL, GR = GAPS, "CASE WHEN (FLOOR(sample_id / 7) % 4 = 3) OR (FLOOR(sample_id / 23) % 4 = 2) THEN NULL ELSE {0} END"
XG = f"""xg AS MATERIALIZED (SELECT *, (road_width BETWEEN 1.2 AND 9) IS TRUE road_valid, CASE WHEN (road_width BETWEEN 1.2 AND 9) IS TRUE THEN 'road' WHEN left_inner_m IS NOT NULL AND right_inner_m IS NULL THEN 'left' WHEN right_inner_m IS NOT NULL AND left_inner_m IS NULL THEN 'right' WHEN left_inner_m IS NULL AND right_inner_m IS NULL THEN 'none' ELSE 'other' END state FROM
 (SELECT *, left_inner_m + right_inner_m road_width FROM (SELECT id sample_id, x, y, tx, ty, {GL.format('1.5::double + (id % 7)/16.0')} left_inner_m, {GR.format('1.75::double + (id % 5)/16.0')} right_inner_m FROM (SELECT *, id sample_id FROM ({SAMP})))))"""


def gapped(t):
    s = t.sql(SAMP).withColumn("sample_id", F.col("id"))
    s = s.withColumns({"left_inner_m": F.expr(GL.format("1.5D + (sample_id % 7)/16.0D")), "right_inner_m": F.expr(GR.format("1.75D + (sample_id % 5)/16.0D"))})
    s = s.withColumn("road_width", F.col("left_inner_m") + F.col("right_inner_m")).withColumn("road_valid", F.coalesce(F.col("road_width").between(1.2, 9.0), F.lit(False)))
    return s.drop("id")


RUNS = f"""{XG}, rb AS (SELECT *, CASE WHEN state IS DISTINCT FROM lag(state) OVER w OR sample_id IS DISTINCT FROM lag(sample_id) OVER w + 1 THEN 1 ELSE 0 END b FROM xg WINDOW w AS (ORDER BY sample_id)),
 rr AS (SELECT CAST(g AS BIGINT) run_id, min(sample_id) first_id, max(sample_id) last_id, count(*) samples, any_value(state) state FROM (SELECT *, sum(b) OVER (ORDER BY sample_id) g FROM rb) GROUP BY 1),
 rs AS MATERIALIZED (SELECT *, lag(state) OVER (ORDER BY run_id) before, lead(state) OVER (ORDER BY run_id) after FROM rr)"""


@query("w03_state_runs", f"WITH {RUNS} SELECT * FROM rs")
def _(t):
    return B.state_runs(gapped(t))


ARC = "ar AS MATERIALIZED (SELECT sample_id, sum(coalesce(st,0)) OVER (ORDER BY sample_id) arc FROM (SELECT sample_id, sqrt(power(x-lag(x) OVER w,2)+power(y-lag(y) OVER w,2)) st FROM xg WINDOW w AS (ORDER BY sample_id)))"
BRIDGE = f"""{XG}, {ARC}, vn AS (SELECT x.*, arc, lead(x.sample_id) OVER w n_id, lead(left_inner_m) OVER w nl, lead(right_inner_m) OVER w nr, lead(arc) OVER w narc, lead(tx) OVER w ntx, lead(ty) OVER w nty FROM xg x JOIN ar USING (sample_id) WHERE road_valid WINDOW w AS (ORDER BY x.sample_id)),
 vg AS (SELECT *, narc-arc path, degrees(acos(greatest(-1,least(1,tx*ntx+ty*nty)))) turn, abs(left_inner_m-nl) lc, abs(right_inner_m-nr) rc, (SELECT count(*) FROM xg g WHERE g.sample_id > vn.sample_id AND g.sample_id < n_id AND g.left_inner_m IS NOT NULL)/(n_id-sample_id-1) lf, (SELECT count(*) FROM xg g WHERE g.sample_id > vn.sample_id AND g.sample_id < n_id AND g.right_inner_m IS NOT NULL)/(n_id-sample_id-1) rf FROM vn WHERE n_id > sample_id+1),
 bk AS (SELECT *, CASE WHEN lc <= 2.5 AND rc <= 2.5 AND path <= 20 THEN 'regular_continuity' WHEN turn BETWEEN 40 AND 135 AND path <= 12 AND greatest(lf,rf) >= 0.5 THEN 'turn_continuity' WHEN turn <= 12 AND path <= 40 AND lc <= 1 AND rc <= 1 AND greatest(lf,rf) >= 0.6 AND least(lf,rf) >= 0.25 THEN 'long_corridor_evidence' END kind FROM vg),
 bs AS MATERIALIZED (SELECT sample_id first_id, left_inner_m fl, right_inner_m fr, nl, nr, n_id, kind, unnest(range(sample_id+1, n_id)) sid FROM bk WHERE kind IS NOT NULL)"""


def bridges(t):
    none = t.poses.select(F.col("frame_id").alias("id")).filter(F.lit(False))
    return B.gap_bridges(gapped(t), none)


@query("w08_gap_bridges", f"WITH {BRIDGE} SELECT sample_id AS first_id, n_id AS second_id, kind AS bridge_kind, round(path,6) AS path_m, round(turn,4) AS turn_deg FROM bk WHERE kind IS NOT NULL")
def _(t):
    return bridges(t).select("first_id", "second_id", "bridge_kind", r6("path_m").alias("path_m"), F.round("turn_deg", 4).alias("turn_deg"))


@query("w08_bridge_interpolation", f"WITH {BRIDGE} SELECT sid AS sample_id, round(fl*(1-(sid-first_id)/(n_id-first_id))+nl*((sid-first_id)/(n_id-first_id)),6) AS bridge_left, kind AS bridge_kind FROM bs")
def _(t):
    return B.bridge_samples(bridges(t)).select("sample_id", r6("bridge_left").alias("bridge_left"), "bridge_kind")


NEARW = """nw AS MATERIALIZED (SELECT sample_id, reference_id, reference_width FROM (SELECT a.sample_id, b.sample_id reference_id, b.road_width reference_width, row_number() OVER (PARTITION BY a.sample_id ORDER BY abs(b.sample_id-a.sample_id), b.sample_id) rn FROM xg a JOIN xg b ON abs(b.sample_id-a.sample_id) <= 40 AND b.road_valid AND a.tx*b.tx+a.ty*b.ty >= cos(radians(30))) WHERE rn=1)"""


@query("j27_nearest_reference_width", f"WITH {XG}, {NEARW} SELECT * FROM nw")
def _(t):
    x = gapped(t)
    return B.nearest_width(x, x)


@query("g15_one_sided_ribbons", f"""WITH {RUNS}, {NEARW}, o AS (SELECT unnest(range(first_id, last_id+1)) sample_id, state st FROM rs WHERE state IN ('left','right') AND samples >= 6), k AS (SELECT o.sample_id, st, reference_width, CASE WHEN st='left' THEN left_inner_m ELSE right_inner_m END known FROM o JOIN xg USING (sample_id) JOIN nw USING (sample_id))
SELECT sample_id, st AS kind, round(CASE WHEN st='left' THEN known-reference_width ELSE -known END,6)+0.0 AS lo, round(CASE WHEN st='left' THEN known ELSE reference_width-known END,6)+0.0 AS hi FROM k WHERE reference_width-known >= 0.6""")
def _(t):
    return B.one_sided(gapped(t)).select("sample_id", "kind", (r6("lo") + 0.0).alias("lo"), (r6("hi") + 0.0).alias("hi"))


@query("g15_open_continuations")
def _(t):
    return B.open_continuations(gapped(t), max_path=40.0).select("sample_id", "kind", r6("lo").alias("lo"), r6("hi").alias("hi"))


@query("g15_default_corridor", f"""WITH {BRIDGE} SELECT sample_id, CASE WHEN state IN ('left','right') THEN 'one_side_default_width' WHEN state='none' THEN 'no_boundary_default_width' ELSE 'two_side_abnormal_default_width' END AS kind FROM xg WHERE NOT road_valid AND sample_id NOT IN (SELECT sid FROM bs)""")
def _(t):
    return B.default_corridor(gapped(t), B.bridge_samples(bridges(t))).select("sample_id", "kind")


RIB = """rc AS (SELECT sample_id, g.ix, g.iy FROM xg JOIN gnd g ON (g.ix+0.5)*0.5 BETWEEN x-4 AND x+4 AND (g.iy+0.5)*0.5 BETWEEN y-4 AND y+4 WHERE road_valid AND abs(((g.ix+0.5)*0.5-x)*tx+((g.iy+0.5)*0.5-y)*ty) <= 0.35 AND ((g.iy+0.5)*0.5-y)*tx-((g.ix+0.5)*0.5-x)*ty BETWEEN -right_inner_m AND left_inner_m),
 rd AS MATERIALIZED (SELECT ix, iy, count(*) support FROM rc GROUP BY 1,2)"""


def measured(t):
    return gapped(t).filter("road_valid").select("sample_id", "x", "y", "tx", "ty", (-F.col("right_inner_m")).alias("lo"), F.col("left_inner_m").alias("hi"))


def road(t):
    return B.ribbon_support(measured(t), ground(t), 0.5)


@query("g14_ribbon_fill", f"WITH {XG}, {LAYERS}, {RIB} SELECT * FROM rd")
def _(t):
    return road(t)


CLS = f"""{BRIDGE}, cl AS MATERIALIZED (SELECT x.*, b.kind bkind, CASE WHEN road_valid THEN 'two_sided_measured_road_core' WHEN b.sid IS NOT NULL THEN 'two_sided_continuity_bridge' WHEN (left_inner_m IS NULL) <> (right_inner_m IS NULL) THEN 'one_sided_measured_boundary' WHEN left_inner_m IS NOT NULL THEN 'two_sided_abnormal_width_open_candidate' ELSE 'no_boundary_default_width_candidate' END AS class,
  CASE WHEN road_valid THEN 'high' WHEN b.sid IS NOT NULL OR (left_inner_m IS NULL) <> (right_inner_m IS NULL) THEN 'medium' ELSE 'low' END AS confidence, CASE WHEN road_valid THEN left_inner_m-right_inner_m WHEN b.sid IS NOT NULL THEN (fl-fr)*(1-(sid-first_id)/(n_id-first_id))+(nl-nr)*((sid-first_id)/(n_id-first_id)) END diff FROM xg x LEFT JOIN bs b ON b.sid=x.sample_id)"""


def classes(t):
    return B.classify_sections(gapped(t), B.bridge_samples(bridges(t)))


@query("c02_cross_section_class", f"WITH {CLS} SELECT sample_id, class, confidence, road_valid AS true_width FROM cl")
def _(t):
    return classes(t).select("sample_id", "class", "confidence", "true_width")


@query("a47_class_counts", f"WITH {CLS} SELECT class, confidence, count(*) AS n FROM cl GROUP BY 1,2")
def _(t):
    return classes(t).groupBy("class", "confidence").agg(F.count(F.lit(1)).alias("n"))


@query("c14_centreline_points", f"""WITH {CLS}, {LAYERS}, cp AS (SELECT sample_id, x - ty*coalesce(diff,0)/2 cx, y + tx*coalesce(diff,0)/2 cy FROM cl WHERE confidence IN ('high','medium')),
 cg AS (SELECT sample_id, cx, cy, mean_z, row_number() OVER (PARTITION BY sample_id ORDER BY power((g.ix+0.5)*0.5-cx,2)+power((g.iy+0.5)*0.5-cy,2), g.ix, g.iy) rn FROM cp JOIN gnd g ON g.ix BETWEEN CAST(floor(cx/0.5) AS BIGINT)-2 AND CAST(floor(cx/0.5) AS BIGINT)+2 AND g.iy BETWEEN CAST(floor(cy/0.5) AS BIGINT)-2 AND CAST(floor(cy/0.5) AS BIGINT)+2)
SELECT sample_id, round(cx,5) AS x, round(cy,5) AS y, round(mean_z+0.05,6) AS z FROM cg WHERE rn=1""")
def _(t):
    return B.centreline_points(classes(t), ground(t), 0.5).select("sample_id", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"), r6("z").alias("z"))


def bridged_ribbons(t):
    b = B.bridge_samples(bridges(t)).join(t.sql(SAMP).withColumnRenamed("id", "sample_id"), "sample_id")
    return b.select("sample_id", "x", "y", "tx", "ty", (-F.col("bridge_right")).alias("lo"), F.col("bridge_left").alias("hi"))


@query("a35_source_ranked_merge", f"""WITH {BRIDGE}, {LAYERS}, {RIB}, rb2 AS (SELECT *, (sid-first_id)/(n_id-first_id) a FROM bs JOIN sm2 ON sm2.id=sid), sm2 AS ({SAMP}),
 bc AS (SELECT g.ix, g.iy, count(*) support FROM rb2 JOIN gnd g ON (g.ix+0.5)*0.5 BETWEEN x-4 AND x+4 AND (g.iy+0.5)*0.5 BETWEEN y-4 AND y+4 WHERE abs(((g.ix+0.5)*0.5-x)*tx+((g.iy+0.5)*0.5-y)*ty) <= 0.35 AND ((g.iy+0.5)*0.5-y)*tx-((g.ix+0.5)*0.5-x)*ty BETWEEN -(fr*(1-a)+nr*a) AND fl*(1-a)+nl*a GROUP BY 1,2),
 al AS (SELECT *, 3 rk, 'two_sided_measured' src FROM rd UNION ALL SELECT *, 2, 'two_sided_continuity_bridge' FROM bc)
SELECT ix, iy, arg_max(src, rk) AS primary_source, arg_max(support, rk) AS support, string_agg(src, '|' ORDER BY src) AS all_sources, max(rk)=3 AS observed FROM al GROUP BY 1,2""".replace("rb2 AS", "sm2 AS (" + SAMP + "), rb2 AS").replace(f", sm2 AS ({SAMP}),\n bc", ",\n bc"))
def _(t):
    return B.merge_candidates({"two_sided_measured": road(t), "two_sided_continuity_bridge": B.ribbon_support(bridged_ribbons(t), ground(t), 0.5)})


@query("j20_mutual_best_fragments", f"""WITH bd AS ({duck(BANDS)}), p AS (SELECT a.id a_id, b.id b_id, abs(a.tx*b.tx+a.ty*b.ty) d, abs(a.nx*b.mx+a.ny*b.my-a.rho) o, least((b.tx*b.s0+b.nx*b.rho)*a.tx+(b.ty*b.s0+b.ny*b.rho)*a.ty, (b.tx*b.s1+b.nx*b.rho)*a.tx+(b.ty*b.s1+b.ny*b.rho)*a.ty)-a.s1 g FROM bd a JOIN bd b ON a.id<>b.id AND abs(a.mx-b.mx) < 20 AND abs(a.my-b.my) < 12),
 s AS (SELECT a_id, b_id, g+2*o+5*(1-d) sc FROM p WHERE d >= cos(radians(8)) AND o <= 0.5 AND g BETWEEN -0.25 AND 5), n AS (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY sc, b_id) ra, row_number() OVER (PARTITION BY b_id ORDER BY sc, a_id) rb FROM s)
SELECT a_id, b_id, round(sc,6) AS score FROM n WHERE ra=1 AND rb=1""")
def _(t):
    return B.mutual_best(t.sql(BANDS), B.COS(8.0), 0.5).select("a_id", "b_id", r6("score").alias("score"))


@query("g17_band_polyline", f"WITH bd AS ({duck(BANDS)}) SELECT id, k, round(tx*(s0+k*0.2::double)+nx*rho,6) AS x, round(ty*(s0+k*0.2::double)+ny*rho,6) AS y FROM (SELECT *, unnest(range(0, CAST(floor((s1-s0)/0.2::double+1e-9) AS BIGINT)+1)) k FROM bd)")
def _(t):
    b = t.sql(BANDS).withColumn("s1", F.col("s1") + 2e-10)
    return B.band_polyline(b, 0.2).select("id", F.col("k").cast("long").alias("k"), r6("x").alias("x"), r6("y").alias("y"))


# --- curbs ----------------------------------------------------------------------------
SLICE = f"""sm AS MATERIALIZED ({SAMP}), sp AS MATERIALIZED ({duck(PTS_ID)}), sj AS (SELECT s.id sample_id, p.x px, p.y py, p.z pz, (p.x-s.x)*s.tx+(p.y-s.y)*s.ty lon, (p.y-s.y)*s.tx-(p.x-s.x)*s.ty lat_ FROM sm s JOIN sp p ON p.x BETWEEN s.x-11 AND s.x+11 AND p.y BETWEEN s.y-11 AND s.y+11),
 sf AS (SELECT *, CASE WHEN lat_ > 0 THEN 1 ELSE -1 END side, abs(lat_) dist FROM sj WHERE abs(lon) <= 0.45 AND abs(lat_) BETWEEN 0.1 AND 10), sb AS (SELECT *, CASE WHEN dist - lag(dist) OVER w > 0.35 THEN 1 ELSE 0 END b FROM sf WINDOW w AS (PARTITION BY sample_id, side ORDER BY dist, px, py, pz)),
 sc AS MATERIALIZED (SELECT sample_id, side, CAST(cl+1 AS BIGINT) AS cluster, median(lat_) lat_, median(px) px, median(py) py, median(pz) pz, count(*) raw_count FROM (SELECT *, sum(b) OVER (PARTITION BY sample_id, side ORDER BY dist, px, py, pz) cl FROM sb) GROUP BY ALL)"""


def clusters(t):
    return B.slice_clusters(t.sql(SAMP), t.sql(PTS_ID))


@query("w10_slice_clusters", f"WITH {SLICE} SELECT sample_id, side, cluster, round(lat_,6) AS \"lateral\", round(px,6) AS px, raw_count FROM sc")
def _(t):
    return clusters(t).select("sample_id", "side", "cluster", r6("lateral").alias("lateral"), r6("px").alias("px"), "raw_count")


def tracks(t):
    return B.edge_tracks(clusters(t))


TRACKS = f"""{SLICE}, so AS MATERIALIZED (SELECT side, sample_id, cluster, lat_, px, py, raw_count, row_number() OVER (PARTITION BY side ORDER BY sample_id, cluster) rn FROM sc), gt AS (
 SELECT side, rn, sample_id, cluster, sample_id || ':' || cluster AS track, [{{'id': sample_id || ':' || cluster, 'last': sample_id, 'lat': lat_, 'used': false}}] live FROM so WHERE rn = 1
 UNION ALL SELECT side, rn, sample_id, cluster, coalesce(m.id, own), CASE WHEN m IS NULL THEN list_append(lv, {{'id': own, 'last': sample_id, 'lat': lat_, 'used': false}}) ELSE list_transform(lv, lambda e: CASE WHEN e.id = m.id THEN {{'id': e.id, 'last': sample_id, 'lat': lat_, 'used': true}} ELSE e END) END FROM (
  SELECT *, list_sort(list_filter(list_transform(lv, lambda e, i: {{'d': abs(lat_ - e.lat), 'i': i, 'id': e.id, 'ok': NOT e.used AND sample_id <= e.last + 3}}), lambda e: e.ok AND e.d <= 0.55))[1] m FROM (
   SELECT so.side, so.rn, so.sample_id, so.cluster, so.lat_, so.sample_id || ':' || so.cluster AS own, CASE WHEN so.sample_id = g.sample_id THEN g.live ELSE list_transform(list_filter(g.live, lambda e: so.sample_id <= e.last + 3), lambda e: {{'id': e.id, 'last': e.last, 'lat': e.lat, 'used': false}}) END lv FROM gt g JOIN so ON so.side = g.side AND so.rn = g.rn + 1))),
 tr AS MATERIALIZED (SELECT gt.track, so.* FROM gt JOIN so USING (side, rn))"""


@query("g12_edge_tracks", f"WITH {TRACKS} SELECT side, track, count(*) AS n, min(sample_id) AS first_id, max(sample_id) AS last_id FROM tr GROUP BY 1, 2")
def _(t):
    return tracks(t).groupBy("side", "track").agg(F.count(F.lit(1)).alias("n"), F.min("sample_id").alias("first_id"), F.max("sample_id").alias("last_id"))


@query("g13_local_bands", f"""WITH {TRACKS}, tp AS (SELECT *, CAST(1 + sum(b) OVER (PARTITION BY side, track ORDER BY sample_id, cluster) AS BIGINT) piece FROM (SELECT *, CASE WHEN sample_id > lag(sample_id) OVER (PARTITION BY side, track ORDER BY sample_id, cluster) + 3 THEN 1 ELSE 0 END b FROM tr)),
 tg AS (SELECT side, track, piece, count(*) samples, CAST(sum(raw_count) AS BIGINT) observed_inliers, arg_min(px, (sample_id, cluster)) fx, arg_min(py, (sample_id, cluster)) fy, arg_max(px, (sample_id, cluster)) lx, arg_max(py, (sample_id, cluster)) ly FROM tp GROUP BY ALL), th AS (SELECT *, sqrt((lx-fx)*(lx-fx)+(ly-fy)*(ly-fy)) length, (lx-fx)/sqrt((lx-fx)*(lx-fx)+(ly-fy)*(ly-fy)) tx, (ly-fy)/sqrt((lx-fx)*(lx-fx)+(ly-fy)*(ly-fy)) ty FROM tg WHERE samples >= 5 AND sqrt((lx-fx)*(lx-fx)+(ly-fy)*(ly-fy)) >= 2)
SELECT side, track, piece, any_value(samples) AS samples, any_value(observed_inliers) AS observed_inliers, round(any_value(length),5) AS length, round(any_value(tx),5)+0.0 AS tx, round(any_value(ty),5)+0.0 AS ty, round(any_value(-ty*fx+tx*fy),5)+0.0 AS rho, round(min(px*tx+py*ty),5)+0.0 AS s0, round(max(px*tx+py*ty),5)+0.0 AS s1 FROM th JOIN tp USING (side, track, piece) GROUP BY 1, 2, 3""")
def _(t):
    return B.local_bands(tracks(t)).select("side", "track", "piece", "samples", "observed_inliers", *[(F.round(c, 5) + 0.0).alias(c) for c in ("length", "tx", "ty", "rho", "s0", "s1")])


@query("j26_uncovered_track_points", f"""WITH {SLICE}, cb AS (SELECT sample_id, side, lat_ FROM sc WHERE raw_count >= 2) SELECT sample_id, side, cluster FROM sc t WHERE NOT EXISTS (SELECT 1 FROM cb c WHERE c.sample_id=t.sample_id AND c.side=t.side AND abs(c.lat_-t.lat_) <= 0.45)""")
def _(t):
    c = S.cut(clusters(t))
    return B.uncovered(c, c.filter("raw_count >= 2").select("sample_id", "side", "lateral")).select("sample_id", "side", "cluster")


@query("a49_longest_path", f"""WITH {CAND}, d AS (SELECT DISTINCT band_id, side, sample_id, x, y FROM cd), l AS (SELECT *, CASE WHEN sample_id > lag(sample_id) OVER w + 3 THEN 1 ELSE 0 END b, sqrt(power(x-lag(x) OVER w,2)+power(y-lag(y) OVER w,2)) st FROM d WINDOW w AS (PARTITION BY band_id, side ORDER BY sample_id)),
 g AS (SELECT *, sum(b) OVER (PARTITION BY band_id, side ORDER BY sample_id) r FROM l) SELECT band_id, side, round(max(s),6) AS continuity FROM (SELECT band_id, side, r, sum(CASE WHEN b=1 THEN 0 ELSE coalesce(st,0) END) s FROM g GROUP BY ALL) GROUP BY 1,2""")
def _(t):
    l = cands(t).join(t.sql(SAMP).select(F.col("id").alias("sample_id"), "x", "y"), "sample_id")
    return B.longest_path(l, ["band_id", "side"]).select("band_id", "side", r6("continuity").alias("continuity"))


ROADC = "SELECT DISTINCT CAST(FLOOR(x / 0.5D0) AS BIGINT) AS ix, CAST(FLOOR(y / 0.5D0) AS BIGINT) AS iy, ring < 3 AS observed FROM points WHERE is_ground"


@query("w17_last_road_support", f"""WITH sm AS ({SAMP}), rc AS (SELECT DISTINCT ix, iy FROM ({duck(ROADC)}) WHERE observed), st AS (SELECT id, side, step, CAST(floor((x - ty*step*0.5*side)/0.5) AS BIGINT) cx, CAST(floor((y + tx*step*0.5*side)/0.5) AS BIGINT) cy FROM sm, (SELECT unnest([1,-1]) side), range(1,21) r(step)),
 h AS (SELECT DISTINCT id, side, step FROM st JOIN rc ON rc.ix BETWEEN cx-1 AND cx+1 AND rc.iy BETWEEN cy-1 AND cy+1), g AS (SELECT *, step - lag(step) OVER w gap FROM h WINDOW w AS (PARTITION BY id, side ORDER BY step)), k AS (SELECT *, sum(CASE WHEN gap > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY id, side ORDER BY step) c FROM g)
SELECT id, side, max(step)*0.5::double AS road_edge_m FROM k WHERE c=0 GROUP BY 1,2""")
def _(t):
    return B.last_road_support(t.sql(SAMP), t.sql(ROADC), 0.5)


def checked(t):
    c = cands(t)
    s = t.sql(SAMP).select(F.col("id").alias("sample_id"), "x", "y", (-F.col("ty")).alias("nx"), F.col("tx").alias("ny"))
    links = c.join(s, "sample_id").withColumn("link_id", F.struct("sample_id", "side", "band_id"))
    links = links.withColumns({"use_centerline": F.col("sample_id") % 5 != 0, "inner_match": F.col("distance") <= 3.0})
    rd = t.sql(ROADC).groupBy("ix", "iy").agg(F.max("observed").alias("observed"))
    return B.link_evidence(links, ground(t), rd, t.sql(PTS_ID), 0.5)


@query("a32_boundary_support", f"""WITH {CAND}, {LAYERS}, rc AS (SELECT ix, iy, bool_or(observed) observed FROM ({duck(ROADC)}) GROUP BY 1,2), lk AS (SELECT sample_id, side, band_id, distance, px + ty*side*0.25 ix_, py - tx*side*0.25 iy_ FROM cd),
 iq AS (SELECT sample_id, side, band_id, count(*) > 0 inside FROM lk JOIN gnd g ON g.ix BETWEEN CAST(floor(ix_/0.5) AS BIGINT)-2 AND CAST(floor(ix_/0.5) AS BIGINT)+2 AND g.iy BETWEEN CAST(floor(iy_/0.5) AS BIGINT)-2 AND CAST(floor(iy_/0.5) AS BIGINT)+2 GROUP BY 1,2,3),
 rq AS (SELECT sample_id, side, band_id, bool_or(observed) ro FROM lk JOIN rc g ON g.ix BETWEEN CAST(floor(ix_/0.5) AS BIGINT)-1 AND CAST(floor(ix_/0.5) AS BIGINT)+1 AND g.iy BETWEEN CAST(floor(iy_/0.5) AS BIGINT)-1 AND CAST(floor(iy_/0.5) AS BIGINT)+1 GROUP BY 1,2,3)
SELECT band_id, side, count(*) AS links, round(avg(CASE WHEN inside THEN 1.0 ELSE 0 END),6) AS inside_support, round(avg(CASE WHEN ro IS NOT NULL THEN 1.0 ELSE 0 END),6) AS road_support, round(avg(CASE WHEN ro THEN 1.0 ELSE 0 END),6) AS observed_road_support, round(avg(CASE WHEN sample_id % 5 <> 0 THEN 1.0 ELSE 0 END),6) AS topology_support
FROM lk LEFT JOIN iq USING (sample_id, side, band_id) LEFT JOIN rq USING (sample_id, side, band_id) GROUP BY 1,2""")
def _(t):
    b = B.boundary_support(checked(t))
    return b.select("band_id", "side", "links", *[r6(c).alias(c) for c in ("inside_support", "road_support", "observed_road_support", "topology_support")])


@query("c03_boundary_semantics")
def _(t):
    b = B.classify_boundaries(B.boundary_support(checked(t)))
    return b.select("band_id", "side", "semantic", "state", F.round("confidence", 4).alias("confidence"), "reasons")


#: Band sides with every mix of supports.
BSUP = """SELECT c_custkey AS band_id, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE -1 END AS side, 3 + c_custkey % 7 AS links, (c_custkey * 5 % 9) * 1.0D0 AS continuity, (c_custkey % 11) / 10.0D0 AS edge_support, (c_custkey * 3 % 13) / 12.0D0 AS road_support, (c_custkey * 7 % 11) / 10.0D0 AS observed_road_support,
 (c_custkey * 5 % 7) / 6.0D0 AS topology_support, (c_custkey % 5) / 4.0D0 AS inside_support, (c_custkey * 3 % 8) / 8.0D0 AS outside_support, (c_custkey % 4) / 4.0D0 AS inner_match, (c_custkey % 3) / 2.0D0 AS local_road_edge_match, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE (c_custkey * 13 % 64 - 32) / 64.0D0 END AS height_delta,
 CASE WHEN c_custkey % 2 = 0 THEN 'local_edge_fit' ELSE 'band' END AS source FROM customer"""


@query("c03_boundary_semantics_rules", f"""WITH s AS ({duck(BSUP)}), k AS (SELECT *, abs(height_delta) h, least(1, continuity/8) run, links >= 5 AND continuity >= 2 AND edge_support >= 0.5 AND road_support >= 0.6 AND inside_support >= 0.45 AS basic, CASE WHEN source = 'local_edge_fit' THEN greatest(inner_match, local_road_edge_match) ELSE inner_match END mt, observed_road_support >= 0.6 AS seen FROM s),
 r AS (SELECT *, coalesce(basic AND topology_support >= 0.6 AND continuity >= 3 AND mt >= 0.5 AND h >= 0.035 AND h <= 0.3, false) curb, coalesce(basic AND h >= 0.25 AND outside_support >= 0.35, false) step, basic AND outside_support < 0.35 AS wall FROM k)
SELECT band_id, side, CASE WHEN curb THEN 'curb_candidate' WHEN step THEN 'step_candidate' WHEN wall THEN 'wall_or_green_boundary_candidate' ELSE 'unknown_boundary' END AS semantic, CASE WHEN curb THEN CASE WHEN seen THEN 'observed' ELSE 'inferred' END WHEN step THEN 'observed' WHEN wall THEN CASE WHEN edge_support >= 0.65 THEN 'observed' ELSE 'inferred' END WHEN basic THEN 'inferred' ELSE 'unknown' END AS state,
 round(CASE WHEN curb THEN least(CASE WHEN seen THEN 1.0 ELSE 0.74 END, 0.2*run+0.2*edge_support+0.15*road_support+0.1*observed_road_support+0.15*topology_support+0.1*inside_support+0.1*inner_match) WHEN step THEN least(1.0, 0.25*run+0.25*edge_support+0.25*road_support+0.25*least(1.0, h/0.5)) WHEN wall THEN least(0.85, 0.3*run+0.3*edge_support+0.25*road_support+0.15*(1-outside_support)) WHEN basic THEN least(0.49, 0.2*edge_support+0.2*road_support+0.1*inside_support) ELSE 0 END + 1e-9, 4) AS confidence,
 concat_ws('|', CASE WHEN links < 5 THEN 'few_links' END, CASE WHEN continuity < 2 THEN 'short_run' END, CASE WHEN edge_support < 0.5 THEN 'weak_edge' END, CASE WHEN road_support < 0.6 THEN 'weak_road' END, CASE WHEN NOT seen THEN 'weak_observed_road' END, CASE WHEN topology_support < 0.6 THEN 'weak_topology' END, CASE WHEN inside_support < 0.45 THEN 'weak_inside_ground' END, CASE WHEN curb AND NOT seen THEN 'inferred_continuation' END, CASE WHEN basic AND NOT curb AND NOT step AND NOT wall THEN 'basic_but_undecided' END) AS reasons FROM r""")
def _(t):
    b = B.classify_boundaries(t.sql(BSUP))
    return b.select("band_id", "side", "semantic", "state", F.round(F.col("confidence") + 1e-9, 4).alias("confidence"), "reasons")


@query("c04_low_road_review", f"SELECT band_id, side, links, continuity FROM ({duck(BSUP)}) WHERE continuity >= 3 AND edge_support >= 0.5 AND inside_support >= 0.45 AND abs(height_delta) >= 0.035 AND road_support < 0.6")
def _(t):
    return B.low_road_review(t.sql(BSUP)).select("band_id", "side", "links", "continuity")


SIDE = f"""{CAND}, sb AS (SELECT id band_id, 1 side, tx, ty, CASE WHEN id % 3 = 0 THEN 'curb_candidate' ELSE 'unknown_boundary' END sem, (id % 10)/10.0 es FROM bd UNION ALL SELECT id, -1, tx, ty, CASE WHEN id % 3 = 0 THEN 'curb_candidate' ELSE 'unknown_boundary' END, (id % 10)/10.0 FROM bd),
 sl AS (SELECT c.band_id, c.side, sample_id, lat, sb.tx, sb.ty, sem, es FROM cd c JOIN sb ON sb.band_id=c.band_id AND sb.side=c.side), so AS (SELECT i.side, i.sample_id, i.band_id inner_id, o.band_id outer_id, i.lat il, o.lat ol, abs(o.lat)-abs(i.lat) w, abs(i.tx*o.tx+i.ty*o.ty) p, o.es FROM sl i JOIN sl o ON i.side=o.side AND i.sample_id=o.sample_id AND i.band_id<>o.band_id WHERE i.sem='curb_candidate' AND o.es >= 0.35),
 sr AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY side, inner_id, sample_id ORDER BY (w >= 0.9) DESC, 1-least(abs(w-1.8),1.8)/1.8 DESC, es DESC, p DESC, outer_id) rn FROM so WHERE w BETWEEN 0.45 AND 6 AND p >= 0.94), sq AS (SELECT * FROM sr WHERE rn=1)"""


def side_bands(t):
    b = t.sql(BANDS).withColumns({"semantic": F.when(F.col("id") % 3 == 0, "curb_candidate").otherwise("unknown_boundary"), "edge_support": F.col("id") % 10 / 10.0})
    return b.withColumn("side", F.explode(F.array(F.lit(1), F.lit(-1)))).withColumnRenamed("id", "band_id")


def options(t):
    return B.sidewalk_options(cands(t), side_bands(t))


@query("t06_best_sidewalk_option", f"WITH {SIDE} SELECT side, inner_id, sample_id, outer_id, round(w,6) AS width FROM sq")
def _(t):
    return options(t).select("side", "inner_id", "sample_id", "outer_id", r6("width").alias("width"))


@query("w11_sidewalk_runs", f"""WITH {SIDE}, l AS (SELECT *, CASE WHEN sample_id > lag(sample_id) OVER w + 3 OR abs(ol-lag(ol) OVER w) > 0.75 THEN 1 ELSE 0 END b FROM sq WINDOW w AS (PARTITION BY side, inner_id ORDER BY sample_id))
SELECT side, inner_id, sample_id, CAST(1+sum(b) OVER (PARTITION BY side, inner_id ORDER BY sample_id) AS BIGINT) AS run FROM l""".replace("OVER w + 3 OR abs(ol-lag(ol) OVER w)", "OVER ww + 3 OR abs(ol-lag(ol) OVER ww)").replace("WINDOW w AS", "WINDOW ww AS"))
def _(t):
    return B.sidewalk_runs(options(t)).select("side", "inner_id", "sample_id", "run")


@query("c05_sidewalk_surfaces")
def _(t):
    curbs = side_bands(t).select("side", F.col("band_id").alias("inner_id"), F.lit(0.5).alias("curb_confidence"))
    s = B.sidewalk_surfaces(options(t), t.sql(SAMP), ground(t), curbs, 0.5)
    return s.select("side", "inner_id", "run", "outer_ids", "classification", "evidence_state", "cells", F.round("confidence", 4).alias("confidence"), "reason")


SEGS = f"""SELECT id, CASE WHEN id % 2 = 0 THEN 1 ELSE -1 END AS side, 1.25D0 + (id * 13 % 40) / 8.0D0 AS road_distance, tx * s0 + nx * rho AS ax, ty * s0 + ny * rho AS ay, tx * s1 + nx * rho AS bx, ty * s1 + ny * rho AS by1,
 (id * 11 % 30) * 0.75D0 AS direction_deg, (id % 23) * 0.5D0 AS junction_m, (id % 12) * 1.0D0 AS continuity, (id % 10) / 10.0D0 AS edge_support, (id % 8) / 8.0D0 AS inside_support, (id % 4) / 4.0D0 AS topology_support FROM ({BANDS}) b0"""
PAIRS = f"""sg AS MATERIALIZED (SELECT *, sqrt((bx-ax)*(bx-ax)+(by1-ay)*(by1-ay)) len FROM ({duck(SEGS)})), pj AS (SELECT i.id inner_id, o.id outer_id, i.road_distance inner_distance, i.len il, o.len ol, abs((i.bx-i.ax)/i.len*(o.bx-o.ax)/o.len+(i.by1-i.ay)/i.len*(o.by1-o.ay)/o.len) d,
  (o.ax-i.ax)*(i.bx-i.ax)/i.len+(o.ay-i.ay)*(i.by1-i.ay)/i.len pa, (o.bx-i.ax)*(i.bx-i.ax)/i.len+(o.by1-i.ay)*(i.by1-i.ay)/i.len pb, abs(-((o.ax+o.bx)/2-i.ax)*(i.by1-i.ay)/i.len+((o.ay+o.by1)/2-i.ay)*(i.bx-i.ax)/i.len) separation
  FROM sg i JOIN sg o ON i.id<>o.id AND i.side=o.side AND i.road_distance<o.road_distance AND abs(i.ax-o.ax) < 40 AND abs(i.ay-o.ay) < 30),
 pp AS MATERIALIZED (SELECT *, separation < 0.45 amb FROM (SELECT *, greatest(0, least(il, greatest(pa,pb))-greatest(0, least(pa,pb)))/least(il,ol) overlap FROM pj) WHERE d >= cos(radians(12)) AND overlap >= 0.5 AND separation <= 5)"""


def segs(t):
    return S.cut(t.sql(SEGS).withColumnRenamed("by1", "by"))


@query("j19_parallel_pairs", f"WITH {PAIRS} SELECT inner_id, outer_id, round(overlap,5) AS overlap, round(separation,5) AS separation, amb AS ambiguous FROM pp")
def _(t):
    return B.parallel_pairs(segs(t)).select("inner_id", "outer_id", F.round("overlap", 5).alias("overlap"), F.round("separation", 5).alias("separation"), "ambiguous")


@query("c06_constraint_status", f"""WITH {PAIRS}, am AS (SELECT inner_id id FROM pp WHERE amb UNION SELECT outer_id FROM pp WHERE amb), nr AS (SELECT DISTINCT outer_id id FROM pp),
 st AS (SELECT *, CASE WHEN id IN (SELECT id FROM am) THEN 'parallel_ambiguous_context_review' WHEN id IN (SELECT id FROM nr) THEN 'outer_context_edge' WHEN road_distance > 5 THEN 'far_context_edge' WHEN direction_deg > 15 THEN 'direction_context_review' WHEN junction_m < 6 THEN 'junction_context_review' ELSE 'inferred_road_edge_constraint' END status FROM sg)
SELECT id, status, CASE WHEN status='inferred_road_edge_constraint' THEN 'inferred' ELSE 'unknown' END AS evidence_state, round(CASE WHEN status='inferred_road_edge_constraint' THEN least(0.49, 0.12*least(1,continuity/10)+0.16*edge_support+0.16*inside_support+0.16*greatest(0,1-direction_deg/15)+0.10*topology_support) ELSE 0 END,6) AS confidence FROM st""")
def _(t):
    return B.constraint_status(segs(t), B.parallel_pairs(segs(t))).select("id", "status", "evidence_state", r6("confidence").alias("confidence"))
