"""Readers and writers: point frames, poses, manifests, logs, layers, reports."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from scanloom.functions import columns as C
from scanloom.operators import ordered as O
from scanloom.operators import points as P

#: Scalar types of the frame header.
SCALARS = {("F", 4): "<f4", ("F", 8): "<f8", ("U", 1): "<u1", ("U", 2): "<u2", ("U", 4): "<u4", ("I", 1): "<i1", ("I", 2): "<i2", ("I", 4): "<i4"}


#: Points of one batch of decoded frames.
POINTS = 50_000


def frame_columns(path: str, blob: bytes) -> dict[str, np.ndarray]:
    """Columns of one binary point frame; fails on anything unexpected."""
    head, body = {}, 0
    while "DATA" not in head:
        end = blob.find(b"\n", body)
        if end < 0:
            raise ValueError(f"{path}: header has no DATA line")
        words = blob[body:end].decode("ascii", "replace").split()
        body = end + 1
        if words and not words[0].startswith("#"):
            head[words[0]] = words[1:]
    if head["DATA"] != ["binary"] or any(c != "1" for c in head.get("COUNT", [])):
        raise ValueError(f"{path}: only binary frames with COUNT 1 are read")
    kinds = [SCALARS.get((t, int(s))) for t, s in zip(head["TYPE"], head["SIZE"])]
    if None in kinds or not {"x", "y", "z"} <= set(head["FIELDS"]) or any(k != "<f4" for f, k in zip(head["FIELDS"], kinds) if f in "xyz"):
        raise ValueError(f"{path}: unsupported fields")
    n = int(head["POINTS"][0]) if "POINTS" in head else int(head["WIDTH"][0]) * int(head["HEIGHT"][0])
    dtype = np.dtype(list(zip(head["FIELDS"], kinds)))
    if len(blob) - body != n * dtype.itemsize:
        raise ValueError(f"{path}: {len(blob) - body} payload bytes, expected {n * dtype.itemsize}")
    rec = np.frombuffer(blob, dtype, n, body)
    rgb = rec["rgb"] if "rgb" in dtype.names else np.zeros(n, "<u4")
    rgb = (rgb.view("<u4") if rgb.dtype.kind == "f" else rgb).astype("i4")
    return {"seq": np.arange(n, dtype="i8"), **{c: rec[c].astype("f8") for c in "xyz"}, "rgb": rgb}


def decode_frame(path: str, blob: bytes) -> pd.DataFrame:
    """Records of one binary point frame."""
    return pd.DataFrame(frame_columns(path, blob))


FRAME_DDL = "frame_id bigint, seq bigint, x double, y double, z double, rgb int"


def ingest_frames(spark: SparkSession, path: str, pattern: str = "*.pcd") -> DataFrame:
    """A folder of point frames as one table; each file is decoded in a task."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")

    def packed(frames):
        ids, columns = zip(*frames)
        own = np.repeat(np.array(ids, "i8"), [len(c["seq"]) for c in columns])
        # NaN in a file is null in the table
        return pa.RecordBatch.from_pydict({"frame_id": own, **{c: pa.array(np.concatenate([f[c] for f in columns]), from_pandas=True) for c in columns[0]}})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, n = [], 0
            for p, blob in zip(b.column("path"), b.column("content")):
                p = p.as_py()
                held.append((int("".join(ch for ch in p.rsplit("/", 1)[-1] if ch.isdigit())), frame_columns(p, blob.as_py())))
                n += len(held[-1][1]["seq"])
                if n >= POINTS:
                    yield packed(held)
                    held, n = [], 0
            if held:
                yield packed(held)

    return raw.mapInArrow(run, FRAME_DDL)


def read_poses(spark: SparkSession, path: str) -> DataFrame:
    """Whitespace text ``id ts tx ty tz qx qy qz qw`` with # comments; finite,
    unit quaternions, unique ids (a repeated id fails)."""
    t = spark.read.text(path).select(F.trim("value").alias("v")).filter((F.col("v") != "") & ~F.col("v").startswith("#"))
    w = F.split("v", r"\s+")
    names = ["ts", "tx", "ty", "tz", "qx", "qy", "qz", "qw"]
    fields = t.select(F.when(F.size(w) == 9, w).otherwise(F.raise_error(F.concat(F.lit("pose line: "), F.col("v")))).alias("w"))
    p = fields.select(F.col("w")[0].cast("long").alias("id"), *[F.col("w")[i + 1].cast("double").alias(n) for i, n in enumerate(names)])
    p = P.finite(p, names, "fail")
    q = C.q_normalise(C.quat())
    p = p.withColumns({f"q{a}": v for a, v in zip("xyzw", q)})
    one = p.groupBy("id").agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*names)).alias("_r"))
    return one.select(F.when(F.col("_n") == 1, F.col("id")).otherwise(F.raise_error(F.concat(F.lit("repeated pose id "), F.col("id")))).cast("long").alias("id"), "_r.*")


def read_contract_csv(spark: SparkSession, path: str, schema: T.StructType | str, finite_cols: Sequence[str] = (), rising: str | None = None) -> DataFrame:
    """Exact header and types, or failure; numerics must be finite; ``rising`` names a
    column whose values must not fall from line to line of a file."""
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("enforceSchema", False).csv(path)
    names = df.columns
    if rising is not None:
        df = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"))
        nb = O.neighbour(df, ["_file"], ["_block", "_line"], {"_before": F.col(rising)})
        falls = F.raise_error(F.concat(F.lit(f"{rising} falls at "), F.col(rising).cast("string")))
        df = nb.withColumn(rising, F.when(F.col(rising) < F.col("_before"), falls).otherwise(F.col(rising)).cast(df.schema[rising].dataType)).select(*names)
    return P.finite(df, list(finite_cols), "fail") if finite_cols else df


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Frame manifest: each id once, file names must carry the zero-padded id."""
    m = read_contract_csv(spark, path, "frame_id bigint, timestamp double, point_count bigint, pcd_path string", ["timestamp"])
    want = F.format_string("frame_%06d.pcd", "frame_id")
    one = m.groupBy("frame_id").agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct("timestamp", "point_count", "pcd_path")).alias("_r"))
    repeated = F.raise_error(F.concat(F.lit("repeated frame id "), F.col("frame_id").cast("string")))
    m = one.select(F.when(F.col("_n") == 1, F.col("frame_id")).otherwise(repeated).cast("long").alias("frame_id"), "_r.*")
    return m.withColumn("pcd_path", F.when(C.basename("pcd_path") == want, F.col("pcd_path")).otherwise(F.raise_error(F.concat(F.lit("manifest name: "), F.col("pcd_path")))))


def scan_messages(messages: DataFrame, topics: Sequence[str], offset_s: float = 0.0, duration_s: float | None = None) -> DataFrame:
    """Topics within a time range counted from the first message of all topics.
    On a table partitioned by topic both filters reach the scan."""
    start = messages.agg(F.min("ts_ns")).first()[0]
    lo = (start or 0) + int(offset_s * 1e9)
    out = messages.filter(F.col("topic").isin(list(topics)) & (F.col("ts_ns") >= lo))
    return out if duration_s is None else out.filter(F.col("ts_ns") <= lo + int(duration_s * 1e9))


def parse_diagnostics(df: DataFrame, line: str = "line") -> DataFrame:
    """``k=v;...`` records as a map; rows without whole seq and stamp drop."""
    m = df.withColumn("kv", F.str_to_map(line, F.lit(";"), F.lit("=")))
    at = lambda k: F.try_element_at("kv", F.lit(k))
    return m.withColumns({"seq": at("seq").try_cast("bigint"), "stamp_ns": at("stamp_ns").try_cast("bigint")}).filter(F.col("seq").isNotNull() & F.col("stamp_ns").isNotNull())


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their number in the file.  Row ids are consecutive inside
    a file block; block counts give each block its offset."""
    t = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_i"))
    b = t.groupBy("file", "block").agg(F.min("_i").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    w = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    b = b.select("file", "block", "_lo", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    return t.join(b, ["file", "block"]).select("file", (F.col("_before") + F.col("_i") - F.col("_lo") + 1).alias("line_no"), "value")


def log_matches(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return numbered_lines(spark, path).filter(F.col("value").rlike(pattern))


# --- sinks --------------------------------------------------------------------
def write_points(df: DataFrame, path: str, layer: str = "layer") -> None:
    """One folder per layer; an existing output is never overwritten."""
    df.write.mode("errorifexists").partitionBy(layer).parquet(path)


def write_features(df: DataFrame, path: str) -> None:
    df.select("value").write.mode("errorifexists").text(path)


def report_rows(df: DataFrame, meanings: dict[str, tuple[str, str]], digits: int = 6) -> DataFrame:
    """A one-row summary as metric, value, unit, meaning rows."""
    items = [F.struct(F.lit(k).alias("metric"), F.format_string(f"%.{digits}f", F.col(k).cast("double")).alias("value"), F.lit(u).alias("unit"), F.lit(m).alias("meaning")) for k, (u, m) in meanings.items()]
    return df.select(F.explode(F.array(*items)).alias("_r")).select("_r.*")


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def to_tum(df: DataFrame, ts: str = "ts", cols: Sequence[str] = ("tx", "ty", "tz", "qx", "qy", "qz", "qw"), digits: int = 6) -> DataFrame:
    stamp = F.format_string("%.9f", ts) if dict(df.dtypes)[ts] == "double" else F.col(ts).cast("string")
    return df.select(F.concat_ws(" ", stamp, *[F.format_string(f"%.{digits}f", c) for c in cols]).alias("value"))


def leica_to_tum(df: DataFrame) -> DataFrame:
    """Prism positions: ns stamps to seconds, identity rotation."""
    return to_tum(df.withColumns({"ts": F.format_string("%d.%09d", F.floor(F.col("ts_ns") / 1_000_000_000), F.col("ts_ns") % 1_000_000_000), "qx": F.lit(0.0), "qy": F.lit(0.0), "qz": F.lit(0.0), "qw": F.lit(1.0)}))


def to_point_list(points: DataFrame, leaf: float, rows_per_split: int | None = None) -> DataFrame:
    """``id x y z r g b err`` lines of the voxelised cloud, ids in voxel order."""
    v = O.row_index(P.voxel_rgb(points, leaf), [], ["ix", "iy", "iz"], "id", rows_per_split)
    return v.select("id", F.concat_ws(" ", F.col("id").cast("string"), *[F.format_string("%.6f", c) for c in "xyz"], *[F.col(c).cast("string") for c in "rgb"], F.lit("0")).alias("value"))
