"""Structured Streaming counterparts of the trajectory and object operators.

Keyed automata run in ``applyInPandasWithState`` and come in two kinds.  What is
defined on the order of arrival (``arrival_ordered``) sees a key's rows batch by
batch.  What is defined on event time (``event_ordered``) waits: rows are held in the
state of their key until its newest stamp is ``delay`` ahead of them (0: not at all), and then run
in event order, so the result does not depend on how files fall into batches.  Rows
that come after their place has been run are marked ``late`` and change nothing.
With ``idle`` (milliseconds; for streams that run on, as a drained one would wait for
it) a key without rows for so long gives its state up, after its held rows are run."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from scanloom.operators import objects as B
from scanloom.operators import trajectory as J
from scanloom.session import cut, scratch

#: Boolean column of end marks: such rows move a key's time forward and are not data.
END = "end_mark"


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != END)


def _timeout(idle):
    return GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout


def arrival_ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str], fn: Callable, schema: str, mode: str = "append", idle: int | None = None) -> DataFrame:
    """``fn(rows, state) -> (rows, state)`` per key and batch, rows by ``order`` (their place of arrival)."""
    order = list(order)

    def run(key, chunks: Iterator[pd.DataFrame], state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        pdf = pd.concat(list(chunks)).sort_values(order, kind="stable")
        out, inner = fn(pdf, json.loads(state.get[0]) if state.exists else None)
        state.update((json.dumps(inner),))
        if idle:
            state.setTimeoutDuration(idle)
        if len(out):
            yield out

    return df.groupBy(*keys).applyInPandasWithState(run, schema, "s string", mode, _timeout(idle))


def _pack(pdf: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    t = pa.Table.from_pandas(pdf, preserve_index=False)
    with pa.ipc.new_stream(sink, t.schema) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def event_ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str], fn: Callable, schema: str, delay: float, idle: int | None = None) -> DataFrame:
    """``fn(rows, state) -> (rows, state)`` per key in event order (``order[0]`` is the
    stamp).  Adds ``late``: rows of the input that came behind the rows already run.
    A batch holds a key's new rows and those of the last ``delay``; a key that is too
    hot for one task needs more keys or smaller batches."""
    order = list(order)

    def run(key, chunks: Iterator[pd.DataFrame], state: GroupState):
        inner, done, newest, held = None, None, None, []
        if state.exists:
            text, blob = state.get
            inner, done, newest = json.loads(text)
            held = [pa.ipc.open_stream(blob).read_pandas()] if blob else []
        gone = state.hasTimedOut
        new = [] if gone else list(chunks)
        if new:
            got = pd.concat(new, ignore_index=True)
            newest = max(float(got[order[0]].max()), newest if newest is not None else float("-inf"))
            if END in got:
                got = got[~got[END]].drop(columns=END)
            if done is not None:
                tail = got[got[order[0]] < done]
                got = got[got[order[0]] >= done]
                if len(tail):
                    yield tail.reindex(columns=names).assign(late=True)
            held = [*held, got]
        pdf = pd.concat(held, ignore_index=True).sort_values(order, kind="stable") if held else None
        if pdf is not None and len(pdf):
            ready = pdf if gone else pdf[pdf[order[0]] <= newest - delay]
            if len(ready):
                out, inner = fn(ready, inner)
                # stamps before this are run; more rows of this very stamp may still come
                done = float("inf") if gone else newest - delay
                if len(out):
                    yield out.assign(late=False)[[*names, "late"]]
            pdf = pdf.iloc[len(ready):]
        if gone:
            state.remove()
            return
        state.update((json.dumps([inner, done, newest]), _pack(pdf) if pdf is not None and len(pdf) else None))
        if idle:
            state.setTimeoutDuration(idle)

    names = [f.split()[0].strip("`") for f in schema.split(", ")]
    return df.groupBy(*keys).applyInPandasWithState(run, schema + ", late boolean", "s string, held binary", "append", _timeout(idle))


def read_table(spark: SparkSession, folder: str, pattern: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def drain(stream: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Run an append stream over all available input into a table and read it.  A folder
    of ``partition_by`` gets one file a batch, however many tasks read the batch."""
    spark = stream.sparkSession
    if partition_by:
        stream = stream.repartition(*partition_by)
    out = scratch(spark, name)
    w = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-state").outputMode("append")
    (w.partitionBy(*partition_by) if partition_by else w).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def drain_batches(stream: DataFrame, name: str, each: Callable[[DataFrame, int], DataFrame], mode: str = "append") -> DataFrame:
    """Run ``each`` on every micro-batch.  A batch writes its own folder, so a
    repeated batch replaces its earlier attempt."""
    spark = stream.sparkSession
    out = scratch(spark, name)

    def write(df: DataFrame, batch: int) -> None:
        each(df, batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", out + "-state").foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


# --- per-key automata ----------------------------------------------------------
def health(messages: DataFrame, target_s: float, slack_s: float = 0.25) -> DataFrame:
    """Running health per topic (update mode): count, span, backward steps and
    whether the wanted span has been seen."""
    def step(pdf, st):
        n, first, last, back = st or [0, None, None, 0]
        for t in pdf["ts_ns"]:
            t = int(t)
            back += last is not None and t < last
            first, last, n = t if first is None else min(first, t), t if last is None else max(last, t), n + 1
        span = (last - first) / 1e9
        out = pd.DataFrame([[pdf["topic"].iloc[0], n, first, last, span, back, span >= target_s - slack_s]], columns=["topic", "n", "first_ns", "last_ns", "span_s", "backward", "finished"])
        return out, [n, first, last, int(back)]

    return arrival_ordered(messages, ["topic"], ["arrival", "event_id"], step, "topic string, n bigint, first_ns bigint, last_ns bigint, span_s double, backward bigint, finished boolean", "update")


def epochs(messages: DataFrame) -> DataFrame:
    """Epoch id per key, raised at every step back in time."""
    def step(pdf, st):
        last, epoch = st or [None, 0]
        out = []
        for t in pdf["ts_ns"]:
            epoch += last is not None and int(t) < last
            last = int(t)
            out.append(epoch)
        return pdf.assign(epoch=out), [last, int(epoch)]

    return arrival_ordered(messages, ["topic"], ["arrival", "event_id"], step, ddl(messages) + ", epoch bigint")


def late_rows(messages: DataFrame, tolerance_ns: int = 0) -> DataFrame:
    """Mark rows older than the newest stamp seen for the key."""
    def step(pdf, st):
        top, out = st, []
        for t in pdf["ts_ns"]:
            late = top is not None and int(t) < top - tolerance_ns
            out.append(bool(late))
            top = int(t) if top is None else max(top, int(t))
        return pdf.assign(late=out), top

    return arrival_ordered(messages, ["topic"], ["arrival", "event_id"], step, ddl(messages) + ", late boolean")


def select_keyframes(poses: DataFrame, warm_up=5.0, min_dt=0.5, min_move=1.5, min_turn_deg=10.0, delay: float = 0.0) -> DataFrame:
    """Streaming keyframe selection per run; the warm-up counts from the run's first pose."""
    cols = [c for c in poses.columns if c != END]
    scan = J.keyframe_step(warm_up, min_dt, min_move, min_turn_deg, cols)

    def step(pdf, st):
        t0, last = st or [float(pdf["ts"].min()), None]
        out, last = scan(pdf.assign(_t0=t0), last)
        return out, [t0, last]

    return event_ordered(poses, ["run"], ["ts", *[c for c in ("frame_id",) if c in cols]], step, ddl(poses), delay)


def _boxes(boxes: DataFrame) -> DataFrame:
    return boxes.select("frame_id", "box_id", "ts", "x", "y", "class", *[c for c in (END,) if c in boxes.columns])


def track_boxes(boxes: DataFrame, timeout: float = 1.0, radius: float = 2.0, delay: float = 0.0) -> DataFrame:
    b = _boxes(boxes)
    cols = [c for c in b.columns if c != END]
    return event_ordered(b, ["class"], ["ts", "box_id"], B.track_step(timeout, radius, cols), ddl(b) + ", track_id string", delay)


def track_motion(boxes: DataFrame, timeout: float = 1.0, radius: float = 2.0, delay: float = 0.0, window: float = 1.5, **limits) -> DataFrame:
    """Tracks with the motion state over each track's last ``window`` seconds; the
    observations of the window are part of the state."""
    b = _boxes(boxes)
    cols = [c for c in b.columns if c != END]
    step = B.motion_step(B.track_step(timeout, radius, cols), window, **limits)
    return event_ordered(b, ["class"], ["ts", "box_id"], step, ddl(b) + ", track_id string, observations bigint, duration double, motion string", delay)


# --- stateless and joined -----------------------------------------------------------
def align_clock(df: DataFrame, t: str = "ts_ns", offset_ns: int = 0, reference: str | None = None, warn_ns: int = 500_000_000) -> DataFrame:
    """Constant clock offset; with a ``reference`` stamp the whole-second part of
    the difference is removed and a remaining step above 0.5 s is flagged."""
    d = df.withColumn("aligned_ns", F.col(t) + F.lit(offset_ns))
    if reference is None:
        return d.withColumn("suspicious", F.lit(False))
    gap = F.col("aligned_ns") - F.col(reference)
    whole = F.round(gap / 1e9).cast("long") * 1_000_000_000
    d = d.withColumn("aligned_ns", F.col("aligned_ns") - whole)
    return d.withColumn("suspicious", F.abs(F.col("aligned_ns") - F.col(reference)) > warn_ns)


def bundle_stream(records: DataFrame, images: DataFrame, max_interval: str = "3 days", bucket_s: int = 3600, delay: str = "2 hours", inclusive: bool = True) -> DataFrame:
    """Stream-stream join of records with the capture interval they fall into: (prev,
    capture] (``inclusive``, inertial rows) or [prev, capture) (scan points).  Both
    sides carry a watermark, an interval is at most ``max_interval`` long, so the state of
    both sides is let go, and the time bucket gives the join its equality.  records:
    event_time, ...; images: image_id, prev_time, event_time."""
    r = records.withWatermark("event_time", delay).withColumn("bucket", F.floor(F.unix_seconds("event_time") / bucket_s))
    lo, hi = F.floor(F.unix_seconds("prev_time") / bucket_s), F.floor(F.unix_seconds("event_time") / bucket_s)
    i = images.withColumn("bucket", F.explode(F.sequence(lo, hi))).withColumnRenamed("event_time", "capture_time").withWatermark("capture_time", delay)
    inside = (r.event_time > i.prev_time) & (r.event_time <= i.capture_time) if inclusive else (r.event_time >= i.prev_time) & (r.event_time < i.capture_time)
    bound = (r.event_time <= i.capture_time) & (r.event_time >= i.capture_time - F.expr(f"INTERVAL {max_interval}"))
    return r.join(i, (r.bucket == i.bucket) & inside & bound).drop("bucket")


def bundle_three(scans: DataFrame, inertial: DataFrame, images: Callable[[], DataFrame], **kw) -> DataFrame:
    """Scan points, inertial rows and images in one bundle: kind, id, image_id and the
    offset from the capture before.  ``images`` opens the image stream for each side."""
    def side(kind, rows, inclusive):
        b = bundle_stream(rows, images(), inclusive=inclusive, **kw)
        return b.select(F.lit(kind).alias("kind"), "id", "image_id", (F.unix_micros("event_time") - F.unix_micros("prev_time")).alias("rebased_us"))
    return side("scan", scans, False).unionByName(side("inertial", inertial, True))


def tumbling_metrics(pairs: DataFrame, width: str = "30 seconds", delay: str = "1 minute") -> DataFrame:
    return (pairs.withWatermark("event_time", delay).groupBy(F.window("event_time", width), "topic")
            .agg(F.count("error").alias("n"), F.avg("error").alias("mae_m"), F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse_m"))
            .select(F.col("window.start").alias("start"), "topic", "n", "mae_m", "rmse_m"))


def interval_files(points: DataFrame, frames_per_file: int) -> DataFrame:
    """Accumulation interval of every frame; the sink is partitioned by it."""
    return points.withColumn("interval", F.floor(F.col("frame_id") / frames_per_file))


def outcome_records(lines: DataFrame) -> DataFrame:
    """Typed outcome rows from diagnostics lines."""
    from scanloom.sources.files import parse_diagnostics
    d = parse_diagnostics(lines)
    return d.select("seq", "stamp_ns", F.try_element_at("kv", F.lit("reason")).alias("reason"), F.try_element_at("kv", F.lit("inference_ms")).try_cast("double").alias("inference_ms"))


def revisit_batches(keyframes: DataFrame, name: str, min_new: int = 5, **kw) -> DataFrame:
    """Store arriving keyframes and search those that are new, among all known ones,
    once at least ``min_new`` are; what is left at the end of the input is searched then.

    What has been searched is itself a table beside the store, so a restarted stream
    goes on where it was.  Keyframes are expected in the order of their ids."""
    spark = keyframes.sparkSession
    store, searched = scratch(spark, name + "-store"), scratch(spark, name + "-searched")
    spark.createDataFrame([], "id bigint").write.parquet(f"{searched}/batch_id=-1")
    schema = ddl(keyframes) + ", batch_id int"

    def search(least: int, batch: int) -> DataFrame:
        known = spark.read.schema(schema).parquet(store)
        fresh = cut(known.join(spark.read.parquet(searched).select("id"), "id", "left_anti"))
        n = fresh.count()
        found = J.revisit_candidates(fresh if n >= least else fresh.limit(0), points=known.drop("batch_id"), **kw)
        found = cut(found)
        if n >= least:
            fresh.select("id").write.mode("overwrite").parquet(f"{searched}/batch_id={batch}")
        return found

    def each(df: DataFrame, batch: int) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{store}/batch_id={batch}")
        return search(min_new, batch)

    done = drain_batches(keyframes, name, each).drop("batch_id")
    return done.unionByName(search(1, 1 << 30))


def coast_stream(boxes: DataFrame, frames: DataFrame, horizon_s: int = 2, delay: str = "10 seconds") -> DataFrame:
    """Boxes of the last seconds offered to every later frame (interval join on
    a time bucket)."""
    b = boxes.withWatermark("event_time", delay).withColumn("bucket", F.explode(F.sequence(F.floor(F.unix_seconds("event_time") / horizon_s), F.floor(F.unix_seconds("event_time") / horizon_s) + 1)))
    f = frames.select(F.col("frame_id").alias("to_frame"), F.col("event_time").alias("frame_time")).withWatermark("frame_time", delay).withColumn("bucket", F.floor(F.unix_seconds("frame_time") / horizon_s))
    return b.join(f, (b.bucket == f.bucket) & (f.frame_time > b.event_time) & (f.frame_time <= b.event_time + F.expr(f"INTERVAL {horizon_s} SECONDS"))).drop("bucket")
