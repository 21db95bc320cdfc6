"""Data-quality, reconciliation and provenance operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from scanloom.operators import freeze as Z
from scanloom.operators import ordered as O


def key_order_checks(df: DataFrame, keys: Sequence[str], id_col: str, t: str, rows_per_split=None) -> DataFrame:
    """Rows, repeated ids, stamps that do not increase and gaps in the ids."""
    nb = O.neighbour(df, keys, [id_col], {"_pt": F.col(t), "_pi": F.col(id_col)}, rows_per_split=rows_per_split)
    per_id = nb.groupBy(*keys, id_col).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(t) <= F.col("_pt")).alias("_b"), F.count_if(F.col(id_col) != F.col("_pi") + 1).alias("_g"))
    return per_id.groupBy(*keys).agg(F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("duplicate_keys"), F.sum("_b").alias("not_increasing"), F.sum("_g").alias("id_gaps"))


def contract(df: DataFrame, schema: T.StructType | str, exact: bool = True) -> list[str]:
    """Differences between a table and its declared columns and types."""
    want = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    have = {f.name: f.dataType for f in df.schema.fields}
    bad = [f"missing {f.name}" for f in want.fields if f.name not in have]
    bad += [f"{f.name}: {have[f.name].simpleString()} is not {f.dataType.simpleString()}" for f in want.fields if f.name in have and have[f.name] != f.dataType]
    if exact and [f.name for f in want.fields] != df.columns:
        bad += [f"unexpected {c}" for c in df.columns if c not in {f.name for f in want.fields}] or ["column order differs"]
    return bad


def reconcile_frames(manifest: DataFrame, observed: DataFrame) -> DataFrame:
    """One row per violation of the 1:1 agreement of manifest and observations."""
    from scanloom.functions.columns import basename
    o = observed.select("frame_id", F.col("timestamp").alias("o_ts"), F.col("point_count").alias("o_n"), basename("pcd_path").alias("o_base"))
    j = manifest.select("frame_id", "timestamp", "point_count", basename("pcd_path").alias("m_base")).join(o, "frame_id", "full")
    why = (F.when(F.col("o_ts").isNull(), "not observed").when(F.col("timestamp").isNull(), "not in manifest").when(F.col("point_count") != F.col("o_n"), "point count")
           .when(F.abs(F.col("timestamp") - F.col("o_ts")) > 1e-6, "timestamp").when(F.col("m_base") != F.col("o_base"), "file name"))
    return j.withColumn("violation", why).filter(F.col("violation").isNotNull()).select("frame_id", "violation")


def missing_frames(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    return a.join(b.select(*key), list(key), "left_anti").select(*key)


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Keys on one side only and columns that differ (null-safe)."""
    k = list(keys)
    l = a.select(*k, F.struct(*cols).alias("_a"))
    r = b.select(*k, F.struct(*cols).alias("_b"))
    j = l.join(r, k, "full")
    diff = F.filter(F.array(*[F.when(~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")), F.lit(c)) for c in cols]), lambda x: x.isNotNull())
    why = F.when(F.col("_b").isNull(), "only left").when(F.col("_a").isNull(), "only right").when(F.size(diff) > 0, F.array_join(diff, ","))
    return j.withColumn("difference", why).filter(F.col("difference").isNotNull()).select(*k, "difference")


def diag_counters(d: DataFrame) -> DataFrame:
    """Counts per reason with accepted frames and latency mean and maximum."""
    at = lambda k: F.try_element_at("kv", F.lit(k))
    ms = at("inference_ms").try_cast("double")
    return d.groupBy(at("reason").alias("reason")).agg(F.count(F.lit(1)).alias("frames"), F.count_if(at("accepted") == "1").alias("accepted"), F.avg(ms).alias("inference_ms_mean"), F.max(ms).alias("inference_ms_max"))


def frame_digest(records: DataFrame, keys: Sequence[str], cols: Sequence[str], position: str | None = None) -> DataFrame:
    """Digest of layout, order and content per frame: record count and four sums of 60-bit
    words of the SHA-256 of (layout, position, record).

    The layout is the names of the columns in their order; with ``position`` (the place of a
    record in its frame) equal records in another order give another digest.  The
    sums merge partially, so large frames are not gathered."""
    parts = [F.lit(",".join(cols)), *([F.col(position).cast("string")] if position else []), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols]]
    h = F.sha2(F.concat_ws("|", *parts), 256)
    word = lambda k: F.conv(F.substring(h, 15 * k + 1, 15), 16, 10).cast("decimal(20,0)")
    sums = [F.sum(word(k)).cast("decimal(38,0)").cast("string") for k in range(4)]
    return records.groupBy(*keys).agg(F.count(F.lit(1)).alias("records"), F.concat_ws("-", *sums).alias("digest"))


def ordered_subset(filtered: DataFrame, full: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], rows_per_split=None) -> DataFrame:
    """Per frame: is the filtered record list an in-order subset of the input?

    The k-th copy of a record is matched with the k-th copy in the input; if all
    match and the positions rise, it is.  Frames where copies leave that open
    are matched greedily, one bounded binary frame at a time."""
    k = list(keys)
    rec = F.xxhash64(*cols)

    def numbered(df, name):
        d = df.select(*k, F.col(order).alias(name), rec.alias("h"))
        return O.row_index(d, [*k, "h"], [name], "copy", rows_per_split)

    f, g = numbered(filtered, "fpos"), numbered(full, "ipos")
    m = f.join(g, [*k, "h", "copy"], "left")
    nb = O.neighbour(m, k, ["fpos"], {"_prev": F.col("ipos")}, rows_per_split=rows_per_split)
    s = nb.groupBy(*k).agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("ipos").isNull()).alias("unmatched"), F.count_if(F.col("ipos") <= F.col("_prev")).alias("backward"), F.count_if(F.col("copy") > 1).alias("copies"))
    dup = g.filter("copy > 1").select(*k).distinct().withColumn("_dup", F.lit(True))
    s = s.join(dup, k, "left").withColumn("open", (F.col("unmatched") == 0) & (F.col("backward") > 0) & F.col("_dup").isNotNull())
    todo = s.filter("open").select(*k)

    def greedy(a, b):
        rows, it = b.sort_values("ipos")["h"].tolist(), 0
        ok = True
        for h in a.sort_values("fpos")["h"]:
            while it < len(rows) and rows[it] != h:
                it += 1
            if it == len(rows):
                ok = False
                break
            it += 1
        import pandas as pd
        return pd.DataFrame([[*(a[c].iloc[0] for c in k), ok]], columns=[*k, "greedy"])

    ddl = "".join(f"{c} {filtered.schema[c].dataType.simpleString()}, " for c in k) + "greedy boolean"
    left = f.join(todo, k).groupBy(*k)
    right = g.join(todo, k).select(*[F.col(c).alias(f"_g_{c}") for c in k], "h", "ipos").groupBy(*[f"_g_{c}" for c in k])
    gr = left.cogroup(right).applyInPandas(greedy, ddl)
    return s.join(gr, k, "left").select(*k, "records", F.coalesce("greedy", (F.col("unmatched") == 0) & (F.col("backward") == 0)).alias("is_subset"))


def conservation(parts: DataFrame, count_col: str, total: DataFrame) -> DataFrame:
    """Sum of the declared counts against the rows of the final table."""
    a = parts.agg(F.coalesce(F.sum(count_col), F.lit(0)).alias("declared"))
    b = total.agg(F.count(F.lit(1)).alias("actual"))
    return a.crossJoin(F.broadcast(b)).withColumn("conserved", F.col("declared") == F.col("actual"))


def freeze_manifest(spark, path: str) -> DataFrame:
    """Path, size and SHA-256 of every file below ``path``, empty ones too.  A file's content is one
    row here, so files stop at 2 GB; ``freeze`` has digests by block for files of any size."""
    whole = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    digests = whole.select(F.regexp_replace("path", "^file:/+", "file:/").alias("uri"), F.sha2("content", 256).alias("sha256"))
    files = Z.listed_files(spark, path).join(digests, "uri", "left")
    return files.select("path", "bytes", F.coalesce("sha256", F.when(F.col("bytes") == 0, F.sha2(F.lit(b""), 256))).alias("sha256"))


def tree_digest(manifest: DataFrame) -> DataFrame:
    d = frame_digest(manifest.withColumn("_g", F.lit(0)), ["_g"], ["path", "sha256", "bytes"])
    return d.select(F.col("records").alias("files"), F.sha2(F.concat_ws(":", "records", "digest"), 256).alias("tree_sha256"))


def verify_freeze(frozen: DataFrame, current: DataFrame) -> DataFrame:
    """Added, missing and changed files."""
    c = current.select("path", F.col("sha256").alias("now"))
    j = frozen.select("path", "sha256").join(c, "path", "full")
    why = F.when(F.col("now").isNull(), "missing").when(F.col("sha256").isNull(), "added").when(F.col("sha256") != F.col("now"), "changed")
    return j.withColumn("state", why).filter(F.col("state").isNotNull()).select("path", "state")


def invariant_violations(features: DataFrame) -> DataFrame:
    """Rows that break the evidence rules: unknown states, inferred presented as
    observed, or an inferred constraint above its confidence cap."""
    states = ("observed", "inferred", "unknown")
    why = (F.when(~F.col("geometry_evidence_state").isin(*states) | ~F.col("semantic_evidence_state").isin(*states), "unknown state")
           .when((F.col("semantic_evidence_state") != "observed") & (F.col("layer").endswith("_observed")), "inferred shown as observed")
           .when((F.col("layer") == "road_edge_constraints") & (F.col("confidence") > 0.49), "constraint confidence above cap"))
    return features.withColumn("violation", why).filter(F.col("violation").isNotNull())


def run_verdict(runs: DataFrame, same_input: Column, min_frames: int, min_coverage: float, path_difference: Column | None = None, max_path: float = -1.0) -> DataFrame:
    """Acceptance of a pair of runs: all healthy, same input, paths close."""
    ok = (F.col("frames") >= min_frames) & (F.col("poses") > 0) & (F.col("order_failures") == 0) & (F.col("coverage") >= min_coverage)
    out = runs.agg(F.bool_and(ok).alias("both_healthy"))
    close = F.lit(True) if max_path < 0 or path_difference is None else path_difference <= max_path
    return out.withColumns({"same_input": same_input, "paths_ok": close}).withColumn("accepted", F.col("both_healthy") & F.col("same_input") & F.col("paths_ok"))


def bag_verdict(missing: DataFrame, digests_a: DataFrame, digests_b: DataFrame, subsets: DataFrame, order: DataFrame, key: str) -> DataFrame:
    """All conditions of a filtered recording in one row."""
    changed = reconcile(digests_a, digests_b, [key], ["records", "digest"])
    parts = [missing.agg(F.count(F.lit(1)).alias("missing_frames")), changed.agg(F.count(F.lit(1)).alias("changed_frames")), subsets.agg(F.count_if(~F.col("is_subset")).alias("not_subset")), order.agg(F.sum("backward").alias("order_failures"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(F.broadcast(p))  # one row each
    return out.withColumn("passed", (F.col("missing_frames") == 0) & (F.col("not_subset") == 0) & (F.col("order_failures") == 0))


def inspection_points(poses: DataFrame, points: DataFrame, order: Sequence[str], frames: int = 12, max_points: int = 50_000, rows_per_split=None) -> DataFrame:
    """The points of the first ``frames`` frames by time, up to ``max_points`` of each
    in record order; both limits are what an inspection asks for."""
    first = poses.orderBy("ts", "frame_id").limit(frames).select("frame_id", "ts")
    p = points.join(first, "frame_id")
    return O.row_index(p, ["frame_id"], order, "record", rows_per_split).filter(F.col("record") <= max_points)


def probe_findings(probes: DataFrame, edges: DataFrame, records: DataFrame, edge_r: float = 2.0, record_r: float = 2.0, min_road: float = 0.60) -> DataFrame:
    """Why each probed place was (not) classified.

    probes: probe_id, x, y; edges: id, x, y (raw height steps); records: record_id,
    x, y, track (tracked edge it was fitted to, or null), eligible, road_support.
    ``finding`` joins: exact or nearest raw edge; tracked or not; near records that
    are shown, held back, or missing; road support as the limiting factor."""
    from scanloom.operators import spatial as S
    raw = S.nearest_within(probes, edges, ["x", "y"], edge_r, "probe_id", "id").select("q_id", F.col("distance").alias("edge_m"))
    p = probes.select(F.col("probe_id").alias("q_id"), "x", "y", *[S.cell(c, record_r).alias(k) for c, k in (("x", "ix"), ("y", "iy"))])
    r = records.select(F.col("x").alias("r_x"), F.col("y").alias("r_y"), "track", "eligible", "road_support", *[S.cell(c, record_r).alias(k) for c, k in (("x", "ix"), ("y", "iy"))])
    near = S.with_offsets(p, ["ix", "iy"], S.square(1)).join(r, ["ix", "iy"]).filter(F.pow(F.col("r_x") - F.col("x"), 2) + F.pow(F.col("r_y") - F.col("y"), 2) <= record_r * record_r)
    local = F.col("track").isNotNull()
    sums = near.groupBy("q_id").agg(F.count(F.lit(1)).alias("near_records"), F.count_if(local).alias("tracked"), F.count_if(local & F.col("eligible")).alias("shown"), F.max(F.when(local, F.col("road_support"))).alias("best_road"))
    out = probes.select(F.col("probe_id").alias("q_id")).join(raw, "q_id", "left").join(sums, "q_id", "left").fillna(0, ["near_records", "tracked", "shown"])
    why = F.concat_ws("|", F.when(F.col("edge_m") <= 0.001, "exact raw edge").when(F.col("edge_m").isNotNull(), "raw edge nearby").otherwise("no raw edge"),
                      F.when(F.col("tracked") > 0, "tracked").otherwise("not tracked"),
                      F.when(F.col("shown") > 0, "record shown").when(F.col("tracked") > 0, "records held back").otherwise("no local record"),
                      F.when(F.col("best_road") < min_road, "road support is the limit"))
    return out.select("q_id", "edge_m", "near_records", "tracked", "shown", why.alias("finding"))


def probe(probes: DataFrame, records: DataFrame, r: float, cols: Sequence[str]) -> DataFrame:
    """For each probe the nearest record and why it was (not) classified."""
    from scanloom.operators.spatial import nearest_within
    near = nearest_within(probes, records, ["x", "y"], r, "probe_id", "record_id", p_keep=list(cols))
    out = probes.select(F.col("probe_id").alias("q_id")).join(near, "q_id", "left")
    return out.withColumn("finding", F.when(F.col("p_id").isNull(), "no record nearby").otherwise("nearest record"))
