"""Registered queries: multi-frame evidence, neighbour joins, components."""

from __future__ import annotations

from pyspark.sql import functions as F

from scanloom.functions import columns as C
from scanloom.operators import evidence as E
from scanloom.operators import points as P
from scanloom.operators import spatial as S
from scanloom.plans.points import r6
from scanloom.plans.registry import query

VOXELS = """v1 AS (SELECT frame_id, support, CAST(floor(x/0.5) AS BIGINT) ix, CAST(floor(y/0.5) AS BIGINT) iy, CAST(floor(z/0.5) AS BIGINT) iz, count(*) n, sum((rgb>>16)&255) r, sum(tx-x) dx FROM local_points GROUP BY ALL),
 vox AS (SELECT ix, iy, iz, CAST(sum(n) AS BIGINT) point_count, count(*) frame_count, sum(CASE WHEN support='interpolated' THEN 1.0::double ELSE 0.5 END) frame_weight, CAST(sum(r) AS BIGINT) red_sum, sum(dx) to_sensor_x_sum FROM v1 GROUP BY 1,2,3)"""


@query("a06_stable_voxels", f"WITH {VOXELS} SELECT ix, iy, iz, point_count, frame_count, frame_weight, red_sum, to_sensor_x_sum, (frame_count >= 3 AND frame_weight >= 2) AS stable FROM vox")
def _(t):
    return E.stable_voxels(t.local_points, 0.5).select("ix", "iy", "iz", "point_count", "frame_count", "frame_weight", "red_sum", "to_sensor_x_sum", "stable")


@query("a07_vertical_columns", f"""WITH {VOXELS} SELECT ix, iy, count(*) AS stable_voxels, min((iz+0.5)*0.5)::double AS min_z, max((iz+0.5)*0.5)::double AS max_z, (count(*) >= 3 AND max(iz)-min(iz) >= 2) AS candidate
FROM vox WHERE frame_count >= 3 AND frame_weight >= 2 GROUP BY 1,2""")
def _(t):
    return E.columns_of(E.stable_voxels(t.local_points, 0.5), 0.5, 3).select("ix", "iy", "stable_voxels", "min_z", "max_z", "candidate")


@query("a08_vertical_persistence", """WITH f AS (SELECT frame_id, CAST(floor(x/0.2) AS BIGINT) ix, CAST(floor(y/0.2) AS BIGINT) iy, min(z) lo, max(z) hi FROM local_points WHERE sqrt(lx*lx+ly*ly) BETWEEN 1 AND 30 GROUP BY 1,2,3 HAVING count(*) >= 4 AND max(z)-min(z) >= 0.8)
SELECT ix, iy, count(*) AS vertical_frame_count, min(lo) AS lower_min, max(hi) AS upper_max, round(avg(lo),6) AS lower_mean, round(avg(hi),6) AS upper_mean,
 (count(*) >= 5 AND max(hi)-min(lo) >= 0.8 AND max(lo)-min(lo) <= 0.25 AND max(hi)-min(hi) <= 0.25) AS persistent FROM f GROUP BY 1,2""")
def _(t):
    v = E.vertical_evidence(t.local_points, 0.2)
    return v.select("ix", "iy", "vertical_frame_count", "lower_min", "upper_max", r6("lower_mean").alias("lower_mean"), r6("upper_mean").alias("upper_mean"), "persistent")


LAYERS = """fg AS (SELECT frame_id, support, CAST(floor(x/0.5) AS BIGINT) ix, CAST(floor(y/0.5) AS BIGINT) iy, avg(z) z, count(*) n FROM local_points WHERE is_ground GROUP BY 1,2,3,4),
 fb AS (SELECT *, CASE WHEN z - lag(z) OVER w > 0.03 THEN 1 ELSE 0 END b FROM fg WINDOW w AS (PARTITION BY ix,iy ORDER BY z, frame_id)),
 fs AS (SELECT *, 1 + sum(b) OVER (PARTITION BY ix,iy ORDER BY z, frame_id ROWS UNBOUNDED PRECEDING) layer FROM fb),
 lay AS (SELECT ix, iy, CAST(layer AS BIGINT) layer, CAST(sum(n) AS BIGINT) point_count, count(*) frame_count, sum(CASE WHEN support='interpolated' THEN 1.0::double ELSE 0.5 END) effective_weight, min(z) z_min, max(z) z_max, avg(z) mean_z FROM fs GROUP BY ALL),
 gnd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ix,iy ORDER BY frame_count DESC, effective_weight DESC, layer) rn FROM lay WHERE frame_count >= 3 AND effective_weight >= 2 AND z_max-z_min <= 0.15) WHERE rn=1)"""


def layers(t):
    return E.ground_layers(E.frame_ground(t.local_points.filter("is_ground"), 0.5), 0.03)


def ground(t):
    return E.stable_ground(layers(t))


@query("a09_ground_layers", f"WITH {LAYERS} SELECT ix, iy, layer, point_count, frame_count, effective_weight, round(mean_z,6) AS mean_z FROM lay")
def _(t):
    return layers(t).select("ix", "iy", "layer", "point_count", "frame_count", "effective_weight", r6("mean_z").alias("mean_z"))


@query("a10_stable_ground", f"WITH {LAYERS} SELECT ix, iy, frame_count, effective_weight, round(mean_z,6) AS mean_z FROM gnd")
def _(t):
    return ground(t).select("ix", "iy", "frame_count", "effective_weight", r6("mean_z").alias("mean_z"))


RAYS = """ry AS (SELECT frame_id, tx, ty, x-tx dx, y-ty dy, sqrt((x-tx)*(x-tx)+(y-ty)*(y-ty)) d FROM local_points WHERE seq % 4 = 0),
 rk AS (SELECT *, unnest(range(1, CAST(ceil(least(20.0, d-0.2)/0.4) AS BIGINT))) k FROM ry WHERE d >= 0.4),
 rs AS (SELECT frame_id, CAST(floor((tx + dx*(k*0.4::double)/d)/0.5) AS BIGINT) ix, CAST(floor((ty + dy*(k*0.4::double)/d)/0.5) AS BIGINT) iy FROM rk),
 fr AS (SELECT ix, iy, count(*) AS free_ray_samples, count(DISTINCT frame_id) AS free_frame_count FROM rs GROUP BY 1,2)"""


@query("a11_free_space_rays", f"WITH {RAYS} SELECT * FROM fr")
def _(t):
    return E.free_rays(t.local_points, 0.5, stride=4)


@query("s_evidence_grid", f"""WITH {LAYERS}, {RAYS}, raw AS (SELECT CAST(floor(x/0.5) AS BIGINT) ix, CAST(floor(y/0.5) AS BIGINT) iy, count(*) n, count(DISTINCT frame_id) nf, sum(DISTINCT 0) z0 FROM local_points GROUP BY 1,2)
SELECT coalesce(raw.ix, fr.ix) AS ix, coalesce(raw.iy, fr.iy) AS iy, coalesce(n,0) AS raw_point_count, coalesce(nf,0) AS raw_point_frame_count, coalesce(free_frame_count,0) AS free_frame_count, CASE WHEN gnd.ix IS NULL THEN 0 ELSE 1 END AS stable_ground, round(gnd.mean_z,6) AS ground_mean_z
FROM raw FULL JOIN fr ON raw.ix=fr.ix AND raw.iy=fr.iy LEFT JOIN gnd ON gnd.ix=coalesce(raw.ix,fr.ix) AND gnd.iy=coalesce(raw.iy,fr.iy)""")
def _(t):
    g = E.evidence_grid(t.local_points, ground(t), E.vertical_evidence(t.local_points, 0.5), E.free_rays(t.local_points, 0.5, stride=4), 0.5)
    return g.select("ix", "iy", "raw_point_count", "raw_point_frame_count", "free_frame_count", "stable_ground", r6("ground_mean_z").alias("ground_mean_z"))


EDGES = """edges AS (SELECT a.ix cell_ix, a.iy cell_iy, CASE WHEN b.ix > a.ix THEN 0 ELSE 1 END orientation, (a.mean_z+b.mean_z)/2 z, 2*a.ix + CASE WHEN b.ix > a.ix THEN 2 ELSE 1 END u, 2*a.iy + CASE WHEN b.iy > a.iy THEN 2 ELSE 1 END v
 FROM gnd a JOIN gnd b ON (b.ix=a.ix+1 AND b.iy=a.iy) OR (b.ix=a.ix AND b.iy=a.iy+1) WHERE abs(a.mean_z-b.mean_z) BETWEEN 0.06 AND 0.35)"""


@query("g01_height_step_edges", f"WITH {LAYERS}, {EDGES} SELECT cell_ix, cell_iy, orientation, round(z,6) AS z FROM edges")
def _(t):
    return E.step_edges(ground(t)).select("cell_ix", "cell_iy", "orientation", r6("z").alias("z"))


@query("g02_edge_components", f"""WITH {LAYERS}, {EDGES}, nb AS MATERIALIZED (SELECT a.u, a.v, b.u bu, b.v bv FROM edges a JOIN edges b ON b.u BETWEEN a.u-3 AND a.u+3 AND b.v BETWEEN a.v-3 AND a.v+3 AND (a.u-b.u)*(a.u-b.u)+(a.v-b.v)*(a.v-b.v) <= 12 AND abs(a.z-b.z) <= 0.15),
 r AS (SELECT u, v, u su, v sv FROM edges UNION SELECT nb.bu, nb.bv, r.su, r.sv FROM r JOIN nb ON nb.u=r.u AND nb.v=r.v WHERE (r.su, r.sv) < (nb.bu, nb.bv)),
 m AS (SELECT u, v, min((su, sv)) root FROM r GROUP BY 1,2), z AS (SELECT root, count(*) size FROM m GROUP BY 1)
SELECT m.u, m.v, root[1] AS root_u, root[2] AS root_v, size FROM m JOIN z USING (root) WHERE size >= 4""")
def _(t):
    return E.edge_components(E.step_edges(ground(t)), tile=32).select("u", "v", "root_u", "root_v", "size")


CELLS = "SELECT DISTINCT CAST(floor(x/0.25) AS BIGINT) AS ix, CAST(floor(y/0.25) AS BIGINT) AS iy FROM points WHERE is_ground"


@query("g03_four_connected_components", f"""WITH c AS MATERIALIZED ({CELLS}), nb AS MATERIALIZED (SELECT a.ix, a.iy, b.ix bx, b.iy byy FROM c a JOIN c b ON (a.ix=b.ix AND abs(a.iy-b.iy)=1) OR (a.iy=b.iy AND abs(a.ix-b.ix)=1)),
 r AS (SELECT ix, iy, ix sx, iy sy FROM c UNION SELECT nb.bx, nb.byy, r.sx, r.sy FROM r JOIN nb ON nb.ix=r.ix AND nb.iy=r.iy WHERE (r.sx, r.sy) < (nb.bx, nb.byy)), m AS (SELECT ix, iy, min((sx, sy)) root FROM r GROUP BY 1,2)
SELECT ix, iy, root[1] AS root_ix, root[2] AS root_iy FROM m""")
def _(t):
    return S.grid_components(t.sql(CELLS), [(1, 0), (0, 1), (-1, 0), (0, -1)], 32)


@query("g08_frame_ground_planes")
def _(t):
    return E.frame_planes(t.local_points).select("frame_id", "rank", *[r6(c).alias(c) for c in "abc"], "inliers")


@query("g08_ground_points")
def _(t):
    return E.on_plane(t.local_points, E.frame_planes(t.local_points)).groupBy("frame_id").agg(F.count(F.lit(1)).alias("ground_points"), F.count_if("is_ground").alias("true_ground"))


# --- neighbour joins ----------------------------------------------------------------
QRY = "SELECT o_orderkey AS q_id, (CAST(FLOOR(o_orderkey / 512) AS BIGINT) % 8) * 8.0D0 - 8 + (o_custkey * 7 % 256) / 16.0D0 + 0.0078125D0 AS x, CAST(FLOOR(o_orderkey / 4096) AS BIGINT) * 8.0D0 + (o_custkey * 11 % 256) / 16.0D0 + 0.00390625D0 AS y FROM orders"
QRYD = QRY.replace("D0", "::double")


@query("j09_points_with_cell_aggregate", """SELECT frame_id, count(*) AS n, sum(z-g) AS sum_rel FROM (SELECT frame_id, z, min(z) OVER (PARTITION BY floor(x/0.5), floor(y/0.5)) g FROM points) GROUP BY 1""")
def _(t):
    g = P.cell_min(t.points, 0.5)
    p = t.points.withColumns({"ix": C.cell("x", 0.5), "iy": C.cell("y", 0.5)}).join(g, ["ix", "iy"])
    return p.groupBy("frame_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("z") - F.col("ground_z")).alias("sum_rel"))


@query("j10_stencil_nearest_cell", f"""WITH {LAYERS}, q AS ({QRYD}), m AS (SELECT q_id, g.ix, g.iy, mean_z, power((g.ix+0.5)*0.5-x,2)+power((g.iy+0.5)*0.5-y,2) d2 FROM q JOIN gnd g ON g.ix BETWEEN CAST(floor(x/0.5) AS BIGINT)-2 AND CAST(floor(x/0.5) AS BIGINT)+2 AND g.iy BETWEEN CAST(floor(y/0.5) AS BIGINT)-2 AND CAST(floor(y/0.5) AS BIGINT)+2)
SELECT q_id, ix, iy, round(d2,6) AS d2 FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY d2, ix, iy) rn FROM m) WHERE rn=1""")
def _(t):
    return S.nearest_cell(t.sql(QRY), ground(t), 0.5, 2, ["mean_z"]).select("q_id", "ix", "iy", r6("d2").alias("d2"))


@query("j11_radius_nearest", f"""WITH q AS ({QRYD}), b AS (SELECT box_id p_id, x, y, score FROM boxes), m AS (SELECT q_id, p_id, score, (q.x-b.x)*(q.x-b.x)+(q.y-b.y)*(q.y-b.y) d2 FROM q JOIN b ON b.x BETWEEN q.x-0.45 AND q.x+0.45 AND b.y BETWEEN q.y-0.45 AND q.y+0.45)
SELECT q_id, p_id, score, round(sqrt(d2),6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY d2, p_id) rn FROM m WHERE d2 <= 0.45*0.45::double) WHERE rn=1""")
def _(t):
    m = S.nearest_within(t.sql(QRY), t.boxes, ["x", "y"], 0.45, "q_id", "box_id", p_keep=["score"])
    return m.select("q_id", "p_id", "score", r6("distance").alias("distance"))
