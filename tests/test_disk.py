"""What goes through shuffles and stays on disk."""

import random
import re

from pyspark.sql import functions as F

from scanloom.operators import boundaries as B
from scanloom.operators import spatial as S
from scanloom.operators import terrain as T
from scanloom.session import tune

FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_written_steps_free_their_shuffles(spark):
    usual = {k: spark.conf.get(k) for k in (FREE, "spark.sql.files.openCostInBytes", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        tune(spark, False)
        assert spark.conf.get(FREE) == "true"
    finally:
        for k, v in usual.items():
            spark.conf.set(k, v)


def test_nearest_cell_repeats_cells_instead_of_queries(spark):
    rnd = random.Random(4)
    cells = spark.createDataFrame(sorted({(rnd.randrange(-9, 30), rnd.randrange(-9, 30)) for _ in range(200)}), "ix bigint, iy bigint").withColumn("z", F.col("ix") * 0.5)
    qs = [(i, rnd.uniform(-8, 18), rnd.uniform(-8, 18)) for i in range(300)] + [(7, 1.0, 1.0), (None, 2.0, 2.0), (None, 3.0, 2.5), (400, None, 1.0)]
    q = spark.createDataFrame(qs, "q_id bigint, x double, y double")
    got = [sorted(map(str, S.nearest_cell(q, cells, 0.5, 2, ["z"], halo=h).collect())) for h in (False, True)]
    assert got[0] == got[1] and len(got[0]) > 100
    plan = S.nearest_cell(q, cells, 0.5, 2, ["z"], halo=True)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("q_id" in line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Generate"))


def test_votes_shuffle_cells_instead_of_places(spark):
    p = spark.createDataFrame([(1, 0.3, 0.3, 0.25, 0.3, 0.3, 0.25, 0.0, 0.0, 0.1, 0)], "frame_id long, x double, y double, z double, lx double, ly double, lz double, tx double, ty double, tz double, seq int")
    t = spark.createDataFrame([(0, 0, 0.0, 1.0, 0.0, True)], "ix long, iy long, ground_z double, slope_deg double, rms double, fallback boolean")
    far = p.withColumns({"x": F.lit(1.9), "z": F.lit(0.4)})
    for votes in (T.obstacle_support(p, t, 0.5, 0.25), T.fallback_free(far, t, 0.5, 0.25, order=["seq"])):
        lines = votes._jdf.queryExecution().optimizedPlan().toString().splitlines()
        at = next(i for i, line in enumerate(lines) if "Join Inner" in line and "_tx" in line)
        assert not re.search(r"(^|[\[ ])[xy]#\d+[,\]]|AS [xy]#", lines[at + 1]), lines[at + 1]
        assert votes.count() > 0


def test_boundary_support_writes_what_it_reads(spark):
    cols = "band_id long, side int, edge_z double, road boolean, road_observed boolean, use_centerline boolean, inside_z double, outside_z double, inner_match boolean, height_delta double, sample_id long, x double, y double, other string"
    rows = [(1, 1, 0.1, True, True, True, 0.0, 0.2, None, 0.2, i, float(i), 0.0, "o" * 50) for i in range(6)]
    out = B.boundary_support(spark.createDataFrame(rows, cols))
    assert "other" not in out._jdf.queryExecution().toString()
    r = out.first()
    assert (r.links, r.edge_support, r.inner_match, r.height_delta, r.continuity) == (6, 1.0, 0.0, 0.2, 5.0)
