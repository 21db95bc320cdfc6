"""Registered queries: sources, sinks, reconciliation, data quality."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import functions as F

from scanloom.functions import columns as C
from scanloom.operators import audit as A
from scanloom.operators import freeze as Z
from scanloom.operators import ordered as O
from scanloom.operators import trajectory as J
from scanloom.plans import boundaries as PB
from scanloom.plans.points import r6
from scanloom.plans.registry import query
from scanloom.plans.trajectories import ARR, HOUR_US, arrived, br
from scanloom.session import cut as S_cut
from scanloom.session import scratch
from scanloom.sources import files as S


def frame_files(t):
    """Write every frame as a binary point file, one file per frame."""
    out = scratch(t.spark, "frames")
    fs, root = pafs.FileSystem.from_uri(out)
    fs.create_dir(root)

    def write(batches):
        fs, root = pafs.FileSystem.from_uri(out)
        for t in O.whole_groups(batches, "frame_id"):
            every = np.zeros(len(t), np.dtype([("x", "<f4"), ("y", "<f4"), ("z", "<f4"), ("rgb", "<u4")]))
            for c in every.dtype.names:
                every[c] = t.column(c).to_numpy()
            ids = t.column("frame_id").to_numpy()
            first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            for rec, f in zip(np.split(every, first[1:]), ids[first].tolist()):
                head = f"# .PCD v0.7\nVERSION 0.7\nFIELDS x y z rgb\nSIZE 4 4 4 4\nTYPE F F F U\nCOUNT 1 1 1 1\nWIDTH {len(rec)}\nHEIGHT 1\nVIEWPOINT 0 0 0 1 0 0 0\nPOINTS {len(rec)}\nDATA binary\n"
                # under a name of its own first, so a repeated task never leaves half a frame
                part = f"{root}/_{f:06d}-{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as fh:
                    fh.write(head.encode() + rec.tobytes())
                fs.move(part, f"{root}/frame_{f:06d}.pcd")
            yield pa.RecordBatch.from_pydict({"frame_id": ids[first]})

    O.by_group(t.points.select("frame_id", "x", "y", "z", "rgb"), "frame_id").mapInArrow(write, "frame_id bigint").count()
    return out


@query("s01_ingest_frames", "SELECT frame_id, count(*) AS n, sum(x) AS sum_x, sum(z) AS sum_z, CAST(sum(rgb) AS BIGINT) AS sum_rgb FROM points GROUP BY 1")
def _(t):
    p = S.ingest_frames(t.spark, frame_files(t))
    return p.groupBy("frame_id").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sum_x"), F.sum("z").alias("sum_z"), F.sum("rgb").alias("sum_rgb"))


@query("s02_pose_scan", "SELECT frame_id AS id, ts, tx, ty, round(qw,6) AS qw FROM poses")
def _(t):
    out = scratch(t.spark, "poses")
    p = t.poses.select(F.concat_ws(" ", "frame_id", *[F.col(c).cast("string") for c in ("ts", "tx", "ty", "tz", "qx", "qy", "qz", "qw")]).alias("value"))
    p.write.text(out)
    return S.read_poses(t.spark, out).select("id", "ts", "tx", "ty", r6("qw").alias("qw"))


@query("s03_contract_csv", "SELECT c_custkey AS timestamp_sec, c_acctbal AS x FROM customer")
def _(t):
    out = scratch(t.spark, "csv")
    t.customer.select(F.col("c_custkey").alias("timestamp_sec"), F.col("c_acctbal").alias("x")).sort("timestamp_sec").write.option("header", True).csv(out)
    return S.read_contract_csv(t.spark, out, "timestamp_sec bigint, x double", ["x"], "timestamp_sec")


@query("s04_frame_manifest", "SELECT frame_id, ts AS timestamp, 'frames/frame_' || lpad(CAST(frame_id AS VARCHAR), 6, '0') || '.pcd' AS pcd_path FROM poses")
def _(t):
    out = scratch(t.spark, "manifest")
    m = t.poses.select("frame_id", F.col("ts").alias("timestamp"), F.lit(1).alias("point_count"), F.format_string("frames/frame_%06d.pcd", "frame_id").alias("pcd_path"))
    m.write.option("header", True).csv(out)
    return S.read_manifest(t.spark, out).select("frame_id", "timestamp", "pcd_path")


@query("s05_topic_time_scan", "SELECT topic, ts_ns, event_id FROM messages WHERE topic IN ('view','click') AND ts_ns BETWEEN (SELECT min(ts_ns) FROM messages) + 86400000000000 AND (SELECT min(ts_ns) FROM messages) + 864000000000000")
def _(t):
    out = scratch(t.spark, "messages")
    t.messages.select("topic", "ts_ns", "event_id").write.partitionBy("topic").parquet(out)
    return S.scan_messages(t.spark.read.parquet(out), ["view", "click"], 86400, 777600).select("topic", "ts_ns", "event_id")


@query("s06_diagnostics_scan", "SELECT event_id, event_id AS seq, t_us*1000 AS stamp_ns, topic AS reason FROM traj WHERE user_id % 7 <> 0")
def _(t):
    return S.parse_diagnostics(t.diag).select("event_id", "seq", "stamp_ns", F.try_element_at("kv", F.lit("reason")).alias("reason"))


@query("s07_log_matches", "SELECT n % 4 AS file, row_number() OVER (PARTITION BY n % 4 ORDER BY event_id) AS line_no, line AS value FROM (SELECT *, event_id // 64 AS n FROM diag) QUALIFY line LIKE '%reason=error%'")
def _(t):
    out = scratch(t.spark, "log")
    d = t.diag.select("line", "event_id", (F.floor(F.col("event_id") / 64) % 4).alias("file"))
    d.repartition("file").sortWithinPartitions("file", "event_id").select("line", "file").write.partitionBy("file").text(out)
    return S.log_matches(t.spark, out, "reason=error").select(F.regexp_extract("file", r"file=(\d+)", 1).cast("long").alias("file"), "line_no", "value")


@query("s08_s14_point_layer_sink", "SELECT h AS layer, count(*) AS n FROM (SELECT CASE WHEN z < 0.25 THEN 'low' ELSE 'high' END h FROM points) GROUP BY 1")
def _(t):
    out = scratch(t.spark, "layers")
    S.write_points(t.points.withColumn("layer", F.when(F.col("z") < 0.25, "low").otherwise("high")), out)
    return t.spark.read.parquet(out).groupBy("layer").agg(F.count(F.lit(1)).alias("n"))


@query("s10_report_rows", """WITH m AS (SELECT count(*) n, min(c_acctbal) lo, max(c_acctbal) hi FROM customer) SELECT 'count' AS metric, printf('%.6f', n::double) AS value, 'rows' AS unit FROM m UNION ALL SELECT 'lowest', printf('%.6f', lo), 'm' FROM m UNION ALL SELECT 'highest', printf('%.6f', hi), 'm' FROM m""")
def _(t):
    s = t.customer.agg(F.count(F.lit(1)).alias("count"), F.min("c_acctbal").alias("lowest"), F.max("c_acctbal").alias("highest"))
    return S.report_rows(s, {"count": ("rows", "samples"), "lowest": ("m", "lowest value"), "highest": ("m", "highest value")}).select("metric", "value", "unit")


@query("s12_tum_export", "SELECT printf('%d.%09d %.6f %.6f %.6f %.6f %.6f %.6f %.6f', ts_ns // 1000000000, ts_ns % 1000000000, x, y, 0.0, 0.0, 0.0, 0.0, 1.0) AS value FROM (SELECT ts_ns, x*128 x, round(y*3,4) y FROM messages)")
def _(t):
    m = t.messages.select("ts_ns", (F.col("x") * 128).alias("tx"), F.round(F.col("y") * 3, 4).alias("ty"), F.lit(0.0).alias("tz"))
    return S.leica_to_tum(m)


@query("s13_point_list", """WITH v AS (SELECT CAST(floor(x/0.5) AS BIGINT) ix, CAST(floor(y/0.5) AS BIGINT) iy, CAST(floor(z/0.5) AS BIGINT) iz, CAST(round(avg((rgb>>16)&255)) AS INT) r, CAST(round(avg(rgb&255)) AS INT) b FROM points GROUP BY 1,2,3)
SELECT row_number() OVER (ORDER BY ix,iy,iz) AS id, CAST(r AS VARCHAR) AS r, CAST(b AS VARCHAR) AS b FROM v""")
def _(t):
    l = S.to_point_list(t.points, 0.5).withColumn("w", F.split("value", " "))
    return l.select("id", F.col("w")[4].alias("r"), F.col("w")[6].alias("b"))


# --- reconciliation ----------------------------------------------------------------
def manifest(t):
    return t.poses.filter("support = 'interpolated'").select("frame_id", F.col("ts").alias("timestamp"), (F.col("frame_id") % 9).alias("point_count"), F.format_string("a/frame_%06d.pcd", "frame_id").alias("pcd_path"))


def observed(t):
    return t.poses.filter("tx < 60").select("frame_id", (F.col("ts") + F.when(F.col("frame_id") % 11 == 0, 0.001).otherwise(0.0)).alias("timestamp"), (F.col("frame_id") % 9 + (F.col("frame_id") % 13 == 0).cast("int")).alias("point_count"), F.format_string("b/frame_%06d.pcd", "frame_id").alias("pcd_path"))


@query("j07_reconcile_frames", """SELECT coalesce(m.frame_id, o.frame_id) AS frame_id, CASE WHEN o.frame_id IS NULL THEN 'not observed' WHEN m.frame_id IS NULL THEN 'not in manifest' WHEN m.frame_id % 13 = 0 THEN 'point count' ELSE 'timestamp' END AS violation
FROM (SELECT * FROM poses WHERE support='interpolated') m FULL JOIN (SELECT * FROM poses WHERE tx < 60) o ON m.frame_id=o.frame_id WHERE m.frame_id IS NULL OR o.frame_id IS NULL OR m.frame_id % 13 = 0 OR m.frame_id % 11 = 0""")
def _(t):
    return A.reconcile_frames(manifest(t), observed(t))


@query("j16_missing_frames", "SELECT frame_id FROM poses WHERE frame_id NOT IN (SELECT frame_id FROM boxes WHERE class=3 AND score > 0.5)")
def _(t):
    return A.missing_frames(t.poses, t.boxes.filter("class = 3 AND score > 0.5"), ["frame_id"])


@query("j22_record_reconcile", """WITH a AS (SELECT c_custkey k, c_nationkey n, c_mktsegment s FROM customer WHERE c_nationkey <> 3), b AS (SELECT c_custkey k, CASE WHEN c_acctbal < 0 THEN c_nationkey+1 ELSE c_nationkey END n, CASE WHEN c_nationkey = 5 THEN NULL ELSE c_mktsegment END s FROM customer WHERE c_nationkey <> 4)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'only left' WHEN a.k IS NULL THEN 'only right' ELSE concat_ws(',', CASE WHEN a.n IS DISTINCT FROM b.n THEN 'n' END, CASE WHEN a.s IS DISTINCT FROM b.s THEN 's' END) END AS difference FROM a FULL JOIN b ON a.k=b.k WHERE a.k IS NULL OR b.k IS NULL OR a.n IS DISTINCT FROM b.n OR a.s IS DISTINCT FROM b.s""")
def _(t):
    c = t.customer
    a = c.filter("c_nationkey <> 3").selectExpr("c_custkey AS k", "c_nationkey AS n", "c_mktsegment AS s")
    b = c.filter("c_nationkey <> 4").selectExpr("c_custkey AS k", "CASE WHEN c_acctbal < 0 THEN c_nationkey + 1 ELSE c_nationkey END AS n", "CASE WHEN c_nationkey = 5 THEN NULL ELSE c_mktsegment END AS s")
    return A.reconcile(a, b, ["k"], ["n", "s"])


@query("a30_diag_counters", "SELECT topic AS reason, count(*) AS frames, count(*) FILTER (user_id % 2 = 1) AS accepted, round(avg(user_id % 50),6) AS inference_ms_mean, max(user_id % 50)::double AS inference_ms_max FROM traj WHERE user_id % 7 <> 0 GROUP BY 1")
def _(t):
    return A.diag_counters(S.parse_diagnostics(t.diag)).withColumn("inference_ms_mean", r6("inference_ms_mean"))


@query("a43_frame_digest", "SELECT frame_id, count(*) AS records, " + ", ".join(f"CAST(sum(CAST('0x' || substr(h, {15 * k + 1}, 15) AS BIGINT)) AS VARCHAR) AS w{k}" for k in range(4)) + " FROM (SELECT frame_id, sha256(concat_ws('|', 'ring,rgb,x', seq * 4 + ring, ring, rgb, CAST(CAST(x * 256 AS BIGINT) AS VARCHAR))) AS h FROM points) GROUP BY 1")
def _(t):
    p = t.points.select("frame_id", "ring", "rgb", (F.col("x") * 256).cast("long").alias("x"), (F.col("seq") * 4 + F.col("ring")).alias("at"))
    d = A.frame_digest(p, ["frame_id"], ["ring", "rgb", "x"], "at").withColumn("_w", F.split("digest", "-"))
    return d.select("frame_id", "records", *[F.col("_w")[k].alias(f"w{k}") for k in range(4)])


def kept(t):
    """Filtered records: most in order, some frames reversed or altered."""
    p = O.row_index(t.points, ["frame_id"], ["seq", "x", "y", "z", "ring", "rgb"], "pos")
    f = p.filter("rgb % 3 <> 0").withColumn("pos", F.when(F.col("frame_id") % 4 == 1, -F.col("pos")).otherwise(F.col("pos")))
    return f.withColumn("rgb", F.when((F.col("frame_id") % 10 == 7) & (F.col("ring") == 2), F.col("rgb") + 1).otherwise(F.col("rgb"))), p


#: The same in SQL: the full list of records of a frame, and how far its filtered list is found in it in order.
KEPT = """pf AS (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY seq,x,y,z,ring,rgb) pos FROM points), kp AS (SELECT *, CASE WHEN frame_id % 4 = 1 THEN -pos ELSE pos END fpos, CASE WHEN frame_id % 10 = 7 AND ring = 2 THEN rgb + 1 ELSE rgb END frgb FROM pf WHERE rgb % 3 <> 0),
 fl AS MATERIALIZED (SELECT frame_id, list((rgb, ring, x) ORDER BY pos) AS full_ FROM pf GROUP BY 1), wl AS MATERIALIZED (SELECT frame_id, list((frgb, ring, x) ORDER BY fpos) AS want FROM kp GROUP BY 1),
 sb AS (SELECT frame_id, 0 AS k, 0 AS pos_, want, full_ FROM wl JOIN fl USING (frame_id) UNION ALL SELECT frame_id, k + 1, CAST(least(100000000, pos_ + coalesce(nullif(list_position(full_[pos_ + 1:], want[k + 1]), 0), 100000000)) AS INT), want, full_ FROM sb WHERE k < len(want)),
 su AS MATERIALIZED (SELECT frame_id, k AS records, pos_ < 100000000 AS is_subset FROM sb WHERE k = len(want))"""


@query("a42_ordered_subset", f"WITH {KEPT} SELECT frame_id, records, is_subset FROM su")
def _(t):
    f, p = kept(t)
    return A.ordered_subset(f, p, ["frame_id"], "pos", ["rgb", "ring", "x"])


@query("q01_schema_contract", """SELECT o_orderstatus, count(*) AS rows, 'missing o_comment; o_custkey: bigint is not int; unexpected o_totalprice; unexpected o_orderdate; unexpected o_orderpriority' AS violations, '' AS kept FROM orders GROUP BY 1""")
def _(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    bad = A.contract(o, "o_orderkey bigint, o_custkey int, o_orderstatus string, o_comment string")
    good = A.contract(o.select("o_orderkey", "o_orderstatus"), "o_orderkey bigint, o_orderstatus string")
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows")).withColumns({"violations": F.lit("; ".join(bad)), "kept": F.lit("; ".join(good))})


@query("q03_conservation", "SELECT count(*) AS declared, count(*) AS actual, true AS conserved FROM points")
def _(t):
    return A.conservation(t.points.groupBy("frame_id").agg(F.count(F.lit(1)).alias("n")), "n", t.points)


def freeze_files(t, changed=False):
    """One text file a nation; ``changed`` leaves one out, alters one and adds one."""
    n = F.col("c_nationkey")
    d = t.customer.select(n.alias("n"), "c_custkey", F.concat_ws(" ", "c_custkey", "c_mktsegment").alias("value"))
    if changed:
        d = d.filter("n <> 3").withColumn("value", F.when(F.col("n") == 5, F.concat("value", F.lit("!"))).otherwise(F.col("value"))).withColumn("n", F.when(F.col("n") == 7, 77).otherwise(F.col("n")))
    out = scratch(t.spark, "freeze")
    d.repartition("n").sortWithinPartitions("n", "c_custkey").select("value", "n").write.partitionBy("n").text(out)
    return out


def by_nation(files):
    return files.filter(F.col("path").rlike("part-")).withColumn("path", F.regexp_extract("path", r"(n=\d+)/", 1))


def frozen(t, changed=False):
    return by_nation(A.freeze_manifest(t.spark, freeze_files(t, changed)))


def frozen_tree(t, changed=False):
    """Small blocks, so that the files of the given tables have trees of several levels."""
    return Z.digest_tree(by_nation(Z.block_digests(t.spark, freeze_files(t, changed), 256)), 4)


@query("q05_freeze_manifest", "SELECT 'n=' || c_nationkey AS path, CAST(sum(strlen(c_custkey || ' ' || c_mktsegment) + 1) AS BIGINT) AS bytes, sha256(string_agg(c_custkey || ' ' || c_mktsegment || chr(10), '' ORDER BY c_custkey)) AS sha256 FROM customer GROUP BY c_nationkey")
def _(t):
    return frozen(t).select("path", "bytes", "sha256")


@query("q06_freeze_verify", "SELECT * FROM (VALUES ('n=3', 'missing', 3), ('n=5', 'changed', 5), ('n=7', 'missing', 7), ('n=77', 'added', 7)) v(path, state, k) WHERE k IN (SELECT c_nationkey FROM customer)")
def _(t):
    v = A.verify_freeze(frozen(t), frozen(t, True))
    return v.withColumn("k", F.when(F.col("path") == "n=77", 7).otherwise(F.regexp_extract("path", r"(\d+)", 1).cast("int")))


@query("q05_q06_freeze_verify", "SELECT count(DISTINCT c_nationkey) AS files, CAST(0 AS BIGINT) AS changes FROM customer")
def _(t):
    m = S_cut(frozen(t))
    return A.tree_digest(m).select("files").withColumn("changes", F.lit(A.verify_freeze(m, frozen(t)).count()))


_LEAVES = """SELECT path, strlen(body) AS bytes, CAST(ceil(strlen(body) / 256.0) AS BIGINT) AS nodes, u.slot, sha256(substr(body, CAST(u.slot * 256 + 1 AS BIGINT), 256)) AS sha256
FROM (SELECT 'n=' || n AS path, string_agg(v || chr(10), '' ORDER BY c_custkey) AS body FROM {rows} GROUP BY n) f, unnest(range(CAST(ceil(strlen(body) / 256.0) AS BIGINT))) u(slot)"""
_BEFORE = "(SELECT c_nationkey AS n, c_custkey, c_custkey || ' ' || c_mktsegment AS v FROM customer) r"
_AFTER = "(SELECT CASE c_nationkey WHEN 7 THEN 77 ELSE c_nationkey END AS n, c_custkey, c_custkey || ' ' || c_mktsegment || CASE c_nationkey WHEN 5 THEN '!' ELSE '' END AS v FROM customer WHERE c_nationkey <> 3) r"


@query("q05_block_digest_tree", f"""WITH RECURSIVE leaves AS ({_LEAVES.format(rows=_BEFORE)}),
t AS (SELECT path, bytes, 0 AS level, slot, nodes, sha256 FROM leaves
UNION ALL SELECT path, bytes, level + 1, slot // 4, (nodes + 3) // 4, sha256(string_agg(sha256, '' ORDER BY slot)) FROM t WHERE nodes > 1 GROUP BY path, bytes, level, nodes, slot // 4)
SELECT path, CAST(bytes AS BIGINT) AS bytes, CAST(level AS INT) AS level, CAST(slot AS BIGINT) AS slot, CAST(nodes AS BIGINT) AS nodes, sha256 FROM t""")
def _(t):
    return frozen_tree(t)


@query("q06_changed_blocks", f"""WITH a AS ({_LEAVES.format(rows=_BEFORE)}), b AS ({_LEAVES.format(rows=_AFTER)}),
d AS (SELECT path, slot AS block, a.sha256 AS was, b.sha256 AS now FROM a FULL JOIN b USING (path, slot) WHERE a.sha256 IS DISTINCT FROM b.sha256),
h AS (SELECT was AS now, path AS from_path, block AS from_block FROM d WHERE was IS NOT NULL QUALIFY row_number() OVER (PARTITION BY was ORDER BY path, block) = 1)
SELECT path, block, CASE WHEN d.now IS NULL THEN 'missing' WHEN h.now IS NOT NULL THEN 'moved' WHEN was IS NULL THEN 'added' ELSE 'changed' END AS state, from_path, from_block FROM d LEFT JOIN h USING (now)""")
def _(t):
    return Z.changed_blocks(frozen_tree(t), frozen_tree(t, True))


@query("q07_semantic_invariants", """SELECT id, 'constraint confidence above cap' AS violation FROM (SELECT c_custkey id, (c_custkey % 100)/100.0 conf FROM customer) WHERE conf > 0.49 AND id % 3 = 0
UNION ALL SELECT c_custkey, 'inferred shown as observed' FROM customer WHERE c_custkey % 3 = 1 AND c_custkey % 2 = 0""")
def _(t):
    f = t.customer.select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 100 / 100.0).alias("confidence"), F.lit("observed").alias("geometry_evidence_state"),
                          F.when(F.col("c_custkey") % 2 == 0, "inferred").otherwise("observed").alias("semantic_evidence_state"),
                          F.when(F.col("c_custkey") % 3 == 0, "road_edge_constraints").when(F.col("c_custkey") % 3 == 1, "road_surface_observed").otherwise("other").alias("layer"))
    return A.invariant_violations(f).select("id", "violation")


#: Messages in arrival order with the stamp before them.
ARRIVED = ARR.removeprefix("WITH ").replace("m AS (", "am AS (").replace("FROM m)", "FROM am)")


@query("q08_run_verdict", ARR + " SELECT (SELECT count(*) FROM l WHERE topic IN ('view','click') AND ts_ns <= pt) = 0 AS both_healthy, false AS same_input")
def _(t):
    m = J.monotonicity(arrived(t).filter("topic IN ('view', 'click')"), ["topic"], ["arrival", "event_id"], "ts_ns")
    runs = m.select(F.col("n").alias("frames"), F.col("n").alias("poses"), F.col("not_increasing").alias("order_failures"), F.lit(1.0).alias("coverage"))
    v, c = (t.messages.filter(F.col("topic") == k).select("ts_ns") for k in ("view", "click"))
    same = v.exceptAll(c).isEmpty() and c.exceptAll(v).isEmpty()
    return A.run_verdict(runs, F.lit(same), 1, 0.95).select("both_healthy", "same_input")


@query("q08_compared_runs", f"WITH {ARRIVED}, " + br().removeprefix("WITH ") + f""", r AS (SELECT avg(CASE WHEN (t_us-pt <= {HOUR_US // 12} OR nt-t_us <= {HOUR_US // 12} OR (t_us-pt <= {HOUR_US // 3} AND nt-t_us <= {HOUR_US // 3})) THEN 1.0 ELSE 0 END) cov FROM m),
 o AS (SELECT topic, count(*) FILTER (ts_ns <= pt) bad FROM l WHERE topic IN ('view', 'click') GROUP BY 1),
 g AS (SELECT sqrt(power(x-lag(x) OVER w,2)+power(y-lag(y) OVER w,2)+power(z-lag(z) OVER w,2)) st, topic FROM traj WHERE topic IN ('view','click') WINDOW w AS (PARTITION BY topic ORDER BY t_us)),
 n AS (SELECT abs(sum(st) FILTER (topic='click') / sum(st) FILTER (topic='view') - 1) d FROM g)
SELECT (SELECT count(*) FILTER (bad > 0) FROM o) = 0 AND (SELECT cov FROM r) >= 0.5 AS both_healthy, false AS same_input, round((SELECT d FROM n),6) AS path_difference, (SELECT d FROM n) <= 0.05 AS paths_ok, round((SELECT cov FROM r),6) AS coverage""")
def _(t):
    order = J.monotonicity(arrived(t).filter("topic IN ('view', 'click')"), ["topic"], ["arrival", "event_id"], "ts_ns")
    cover = J.usable(t.traj_a, t.traj_b, "t_us", HOUR_US // 12, HOUR_US // 3).agg(F.avg(F.col("usable").cast("double")).alias("coverage"))
    delta = J.trajectory_delta(t.traj.filter("topic = 'purchase'"), t.traj_a, t.traj_b, "t_us", HOUR_US).select(F.abs(F.col("length_ratio") - 1).alias("path_difference"))
    runs = order.select(F.col("n").alias("frames"), F.col("n").alias("poses"), F.col("not_increasing").alias("order_failures")).crossJoin(F.broadcast(cover))
    v, c = (t.messages.filter(F.col("topic") == k).select("ts_ns") for k in ("view", "click"))
    same = v.exceptAll(c).isEmpty() and c.exceptAll(v).isEmpty()
    out = A.run_verdict(runs, F.lit(same), 1, 0.5).drop("paths_ok", "accepted").crossJoin(F.broadcast(delta)).crossJoin(F.broadcast(cover))
    return out.select("both_healthy", "same_input", r6("path_difference").alias("path_difference"), (F.col("path_difference") <= 0.05).alias("paths_ok"), r6("coverage").alias("coverage"))


@query("q09_bag_verdict", f"WITH {KEPT}, {ARRIVED}, dg AS (SELECT frame_id, md5(string_agg(seq || '|' || ring || '|' || rgb, ',' ORDER BY seq, ring, rgb)) d, count(*) n FROM pf GROUP BY 1), dk AS (SELECT frame_id, md5(string_agg(seq || '|' || ring || '|' || frgb, ',' ORDER BY seq, ring, frgb)) d, count(*) n FROM kp GROUP BY 1), x AS (SELECT (SELECT count(DISTINCT frame_id) FROM points WHERE frame_id NOT IN (SELECT frame_id FROM kp)) missing_frames, (SELECT count(*) FROM dg FULL JOIN dk USING (frame_id) WHERE dg.d IS DISTINCT FROM dk.d) changed_frames, (SELECT count(*) FILTER (NOT is_subset) FROM su) not_subset, (SELECT CAST(count(*) FILTER (ts_ns < pt) AS BIGINT) FROM l) order_failures) SELECT *, missing_frames = 0 AND not_subset = 0 AND order_failures = 0 AS passed FROM x")
def _(t):
    f, p = kept(t)
    cols = ["seq", "ring", "rgb"]
    order = J.monotonicity(arrived(t), ["topic"], ["arrival", "event_id"], "ts_ns")
    return A.bag_verdict(A.missing_frames(p.select("frame_id").distinct(), f.select("frame_id").distinct(), ["frame_id"]), A.frame_digest(p, ["frame_id"], cols), A.frame_digest(f, ["frame_id"], cols),
                         A.ordered_subset(f, p, ["frame_id"], "pos", ["rgb", "ring", "x"]), order, "frame_id")


BDX = "SELECT id AS record_id, mx AS x, my AS y, CASE WHEN id % 2 = 0 THEN 'curb' ELSE 'unknown' END AS semantic FROM ({0}) b1"


PROBED = "SELECT id AS record_id, mx AS x, my AS y, CASE WHEN id % 3 = 0 THEN id END AS track, id % 4 = 0 AS eligible, (id % 10) / 10.0D0 AS road_support FROM ({0}) b1"


@query("q10_probe_findings", f"""WITH r AS MATERIALIZED ({PROBED.format(PB.duck(PB.BANDS)).replace('D0', '::double')}), e AS MATERIALIZED ({PB.duck(PB.PTS_ID)}), p AS (SELECT frame_id q_id, tx x, ty y FROM poses), d AS (SELECT q_id, min(sqrt(power(e.x-p.x,2)+power(e.y-p.y,2))) edge_m FROM p JOIN e ON abs(e.x-p.x) <= 2 AND abs(e.y-p.y) <= 2 AND power(e.x-p.x,2)+power(e.y-p.y,2) <= 4 GROUP BY 1),
 n AS (SELECT q_id, count(*) near_records, count(track) tracked, count(*) FILTER (track IS NOT NULL AND eligible) shown, max(road_support) FILTER (track IS NOT NULL) best FROM p JOIN r ON abs(r.x-p.x) <= 2 AND abs(r.y-p.y) <= 2 AND power(r.x-p.x,2)+power(r.y-p.y,2) <= 4 GROUP BY 1)
SELECT p.q_id, round(edge_m,6) AS edge_m, coalesce(near_records,0) AS near_records, coalesce(tracked,0) AS tracked, coalesce(shown,0) AS shown, concat_ws('|', CASE WHEN edge_m <= 0.001 THEN 'exact raw edge' WHEN edge_m IS NOT NULL THEN 'raw edge nearby' ELSE 'no raw edge' END, CASE WHEN tracked > 0 THEN 'tracked' ELSE 'not tracked' END, CASE WHEN shown > 0 THEN 'record shown' WHEN tracked > 0 THEN 'records held back' ELSE 'no local record' END, CASE WHEN best < 0.6 THEN 'road support is the limit' END) AS finding
FROM p LEFT JOIN d USING (q_id) LEFT JOIN n USING (q_id)""")
def _(t):
    probes = t.poses.select(F.col("frame_id").alias("probe_id"), F.col("tx").alias("x"), F.col("ty").alias("y"))
    f = A.probe_findings(probes, t.sql(PB.PTS_ID).select("id", "x", "y"), t.sql(PROBED.format(PB.BANDS)))
    return f.withColumn("edge_m", r6("edge_m"))


@query("q10_point_probe", f"""WITH r AS ({BDX.format(PB.duck(PB.BANDS))}), p AS (SELECT frame_id probe_id, tx x, ty y FROM poses), m AS (SELECT probe_id, record_id, semantic, sqrt((p.x-r.x)*(p.x-r.x)+(p.y-r.y)*(p.y-r.y)) d FROM p JOIN r ON abs(p.x-r.x) <= 2 AND abs(p.y-r.y) <= 2), b AS (SELECT *, row_number() OVER (PARTITION BY probe_id ORDER BY d, record_id) rn FROM m WHERE d <= 2)
SELECT p.probe_id AS q_id, b.record_id AS p_id, b.semantic, CASE WHEN b.record_id IS NULL THEN 'no record nearby' ELSE 'nearest record' END AS finding FROM p LEFT JOIN b ON b.probe_id=p.probe_id AND rn=1""")
def _(t):
    probes = t.poses.select(F.col("frame_id").alias("probe_id"), F.col("tx").alias("x"), F.col("ty").alias("y"))
    return A.probe(probes, t.sql(BDX.format(PB.BANDS)), 2.0, ["semantic"]).select("q_id", "p_id", "semantic", "finding")


# --- scalar functions -----------------------------------------------------------------
@query("f_quaternion_compose", "SELECT frame_id, round(sin(2*a/2),9)+0.0 AS qz, round(cos(2*a/2),9)+0.0 AS qw, round(tx*cos(a)-ty*sin(a)+tx,6) AS cx, round(tx*sin(a)+ty*cos(a)+ty,6) AS cy, 2*tz AS cz, round(-(tx*cos(a)+ty*sin(a)),6) AS ix, round(tx*sin(a)-ty*cos(a),6) AS iy FROM (SELECT *, 2*atan2(qz,qw) a FROM poses)")
def _(t):
    q, tr = C.compose(C.quat(), C.vec(), C.quat(), C.vec())
    _, ti = C.inverse(C.quat(), C.vec())
    return t.poses.select("frame_id", (F.round(q[2], 9) + 0.0).alias("qz"), (F.round(q[3], 9) + 0.0).alias("qw"), F.round(tr[0], 6).alias("cx"), F.round(tr[1], 6).alias("cy"), tr[2].alias("cz"), F.round(ti[0], 6).alias("ix"), F.round(ti[1], 6).alias("iy"))


@query("f_quaternion_compose_inverse", "SELECT frame_id, true AS identity FROM poses")
def _(t):
    qi, ti = C.inverse(C.quat(), C.vec())
    p = t.poses.select("*", *[v.alias(f"i_{k}{a}") for k, vs, axes in (("q", qi, "xyzw"), ("t", ti, "xyz")) for a, v in zip(axes, vs)])
    q, tr = C.compose(C.quat(), C.vec(), C.quat("i_q"), C.vec("i_t"))
    return p.select("frame_id", ((C.hypot(*tr) < 1e-9) & (F.abs(q[3]) > 1 - 1e-12)).alias("identity"))


@query("f_so3_exp_log", "SELECT frame_id, round((frame_id % 4096)/4096.0,12)+0.0 AS wz FROM poses")
def _(t):
    q = C.so3_exp((F.lit(0.0), F.lit(0.0), F.col("frame_id") % 4096 / 4096.0))
    return t.poses.select("frame_id", (F.round(C.so3_log(q)[2], 12) + 0.0).alias("wz"))


@query("f_rotation_error", "SELECT frame_id, round(degrees(abs((frame_id % 64)/64.0 - 0.5)),5)+0.0 AS deg FROM poses")
def _(t):
    eye = (F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    return t.poses.select("frame_id", (F.round(C.rotation_angle_deg(C.quat(), eye), 5) + 0.0).alias("deg"))


@query("f_segment_geometry", """SELECT o_orderkey AS id, round(sqrt(power(greatest(0, x-4, -x),2)+y*y),6) AS point_distance, round(x*y/2,6) AS area, (x >= 0 AND x <= 4 AND y <= 0) AS crosses FROM (SELECT o_orderkey, o_custkey % 8 - 2.0::double x, o_custkey % 5 - 2.5::double y FROM orders)""")
def _(t):
    x, y, z, four = F.col("x"), F.col("y"), F.lit(0.0), F.lit(4.0)
    p = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 8 - 2.0).alias("x"), (F.col("o_custkey") % 5 - 2.5).alias("y"))
    ring = F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in ((z, z), (x, z), (z, y))])
    return p.select("id", r6(C.point_segment_distance(x, y, z, z, four, z)).alias("point_distance"), r6(C.signed_area(ring)).alias("area"),
                    C.segments_cross((x, y), (x, F.lit(1.0)), (z, z), (four, z)).alias("crosses"))


@query("f_text_helpers", """SELECT c_custkey AS id, replace(rtrim(rtrim(printf('%.2f', (c_custkey % 40)*0.25),'0'),'.'),'.','p') AS label, 'frame_' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '.pcd' AS base, concat_ws('|', CASE WHEN c_custkey % 2 = 0 THEN 'even' END, CASE WHEN c_custkey % 3 = 0 THEN 'third' END) AS reasons, NULLIF(CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END, '') AS text, c_custkey % 4 = 1 AS flag FROM customer""")
def _(t):
    k = F.col("c_custkey")
    return t.customer.select(k.alias("id"), C.height_label(k % 40 * F.lit(0.25)).alias("label"), C.basename(F.format_string("a/b/frame_%06d.pcd", k)).alias("base"), C.reasons(even=k % 2 == 0, third=k % 3 == 0).alias("reasons"),
                             C.blank_to_null(F.when(k % 5 == 0, " ").otherwise(F.col("c_mktsegment"))).alias("text"), C.text_bool((k % 4).cast("string")).alias("flag"))


@query("f_grid_keys", "SELECT o_orderkey AS id, CAST(floor(v/0.5) AS BIGINT) AS cell, CAST(trunc(v/0.5) AS BIGINT) - CASE WHEN v < 0 THEN 1 ELSE 0 END AS cell_compat, (floor(v/0.5)+0.5)*0.5 AS centre FROM (SELECT o_orderkey, (o_custkey % 64 - 32)/8.0 v FROM orders)")
def _(t):
    d = t.orders.select(F.col("o_orderkey").alias("id"), ((F.col("o_custkey") % 64 - 32) / 8.0).alias("v")).withColumn("cell", C.cell("v", 0.5))
    return d.select("id", "cell", C.cell_trunc("v", 0.5).alias("cell_compat"), C.cell_centre("cell", 0.5).alias("centre"))


@query("t01_stable_time_sort", "SELECT topic, event_id, row_number() OVER (PARTITION BY topic ORDER BY t_us, event_id) AS idx FROM traj")
def _(t):
    from scanloom.operators.ordered import row_index
    return row_index(t.traj, ["topic"], ["t_us", "event_id"]).select("topic", "event_id", "idx")


@query("t05_inspection_points", "WITH f AS (SELECT frame_id, ts FROM poses ORDER BY ts, frame_id LIMIT 12), r AS (SELECT p.*, row_number() OVER (PARTITION BY frame_id ORDER BY seq,x,y,z,ring,rgb) record FROM points p JOIN f USING (frame_id)) SELECT frame_id, record, seq, x, ring FROM r WHERE record <= 50")
def _(t):
    return A.inspection_points(t.poses, t.points, ["seq", "x", "y", "z", "ring", "rgb"], 12, 50).select("frame_id", "record", "seq", "x", "ring")


@query("t05_inspection_frames", "SELECT frame_id, ts FROM poses ORDER BY ts, frame_id LIMIT 12")
def _(t):
    return t.poses.orderBy("ts", "frame_id").limit(12).select("frame_id", "ts")
