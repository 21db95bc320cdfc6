"""Order-dependent operators that never put a whole group into one task.

A window partitioned by frame, topic or run collapses when one of them holds a
large part of the rows.  Here the order columns are cut into ranges, called
splits, of about ``rows_per_split`` rows, windows run per (group, split), and a
small carry table (one row per group and split) links the splits.  Inputs small
enough for one split take the plain window.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from scanloom.session import cut

ROWS_PER_SPLIT = 2_000_000
#: Rows of one task that handles whole small groups.
ROWS_PER_TASK = 100_000


def add_split(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_split: int | None = None) -> tuple[DataFrame, int]:
    """Add ``_split``: the range of the ``keys`` and ``order`` columns a row falls into.

    Keys come first, so a group lies in one split or in neighbouring ones and the
    pairs of group and split are hardly more than the groups; a hot group is cut by
    the order.  Rows equal in all these columns share a split, and splits of a group
    rise with the order.  The rows are written before they are counted and cut into
    ranges, which takes two passes; the source runs once.  Small splits do not make
    small tasks: where a task would hold less than a quarter of ``ROWS_PER_TASK`` rows,
    it takes a longer range and numbers the splits along its sorted rows."""
    df, most = cut(df, "rows"), rows_per_split or ROWS_PER_SPLIT
    rows = df.count()
    n = math.ceil(rows / most)
    if n <= 1:
        return df.withColumn("_split", F.lit(0)), 1
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_TASK))
    if n <= 4 * tasks:
        return cut(df.repartitionByRange(n, *keys, *order).withColumn("_split", F.spark_partition_id()), "split"), n
    sp = df.repartitionByRange(tasks, *keys, *order).sortWithinPartitions(*keys, *order).withColumn("_at", F.monotonically_increasing_id())
    first = F.min("_at").over(W.partitionBy(*keys, *order))
    at = first.bitwiseAND(F.lit((1 << 33) - 1))
    return cut(sp.withColumn("_split", first - at + F.floor(at / math.ceil(rows / (n - tasks)))).drop("_at"), "split"), n


def by_group(df: DataFrame, key: str, order: Sequence[str] = (), rows_per_task: int | None = None) -> DataFrame:
    """Rows sorted by ``key`` and ``order``, a group in one task, neighbouring groups
    together.  Tasks grow in number with the rows, not in size; for groups that are
    small by their nature, such as frames.  The rows are written before they are counted."""
    df = cut(df, "rows")
    rows, most = df.count(), rows_per_task or ROWS_PER_TASK
    n = max(1, math.ceil(rows / most), min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(10 * rows / most)))
    return df.repartitionByRange(n, key).sortWithinPartitions(key, *order)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches in which equal values of ``key`` are neighbours."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        code = group_codes(b.column(key))
        start, last = int(np.searchsorted(code, code[-1])), b.column(key)[-1]
        if start or (held and not held[-1].column(key)[-1].equals(last)):
            yield pa.Table.from_batches([*held, b.slice(0, start)])
            held = []
        held.append(b.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def group_codes(column) -> np.ndarray:
    """Numbers of the values of a column, in order of appearance; null is a value."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.dictionary_encode("encode").indices.to_numpy()


def _spec(keys, order, n):
    part = [*keys, "_split"] if n > 1 or not keys else list(keys)
    return W.partitionBy(*part).orderBy(*order)


def _carry(df: DataFrame, keys, aggs: list[Column], carried: dict[str, Callable]) -> DataFrame:
    """Per (group, split) totals, turned into the value over all earlier splits."""
    per = df.groupBy(*keys, "_split").agg(*aggs)
    before = W.partitionBy(*keys).orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    return per.select(*keys, "_split", *[fn(F.col(c)).over(before).alias(c) for c, fn in carried.items()])


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], exprs: dict[str, tuple[str, Column]],
            rows_per_split: int | None = None) -> DataFrame:
    """Running aggregates: ``{name: ("sum" | "max" | "min", column)}``."""
    fns = {"sum": F.sum, "max": F.max, "min": F.min}
    sp, n = add_split(df, keys, order, rows_per_split)
    w = _spec(keys, order, n).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = sp.select("*", *[fns[k](c).over(w).alias(name) for name, (k, c) in exprs.items()])
    if n == 1:
        return out.drop("_split")
    carry = _carry(sp, keys, [fns[k](c).alias(f"_c_{name}") for name, (k, c) in exprs.items()],
                   {f"_c_{name}": fns[k] for name, (k, _) in exprs.items()})
    out = out.join(carry, [*keys, "_split"], "left")
    for name, (k, _) in exprs.items():
        prev, here = F.col(f"_c_{name}"), F.col(name)
        merged = {"sum": F.coalesce(here, F.lit(0)) + F.coalesce(prev, F.lit(0)),
                  "max": F.greatest(here, prev), "min": F.least(here, prev)}[k]
        out = out.withColumn(name, merged if k != "sum" else F.when(here.isNull() & prev.isNull(), None).otherwise(merged))
    return out.drop("_split", *[f"_c_{name}" for name in exprs])


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "idx",
              rows_per_split: int | None = None) -> DataFrame:
    """Dense 1-based position inside each group."""
    return running(df, keys, order, {name: ("sum", F.lit(1).cast("long"))}, rows_per_split)


def neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: dict[str, Column],
              lead: bool = False, rows_per_split: int | None = None) -> DataFrame:
    """Previous (or next) row's values, across split borders too."""
    sp, n = add_split(df, keys, order, rows_per_split)
    w = _spec(keys, order, n)
    step = F.lead if lead else F.lag
    boxed = F.struct(*[c.alias(k) for k, c in cols.items()])
    out = sp.select("*", step(boxed).over(w).alias("_nb"))
    if n > 1:
        pick = F.min_by if lead else F.max_by
        per = sp.groupBy(*keys, "_split").agg(pick(boxed, F.struct(*order)).alias("_edge"))
        edge = per.select(*keys, "_split", step("_edge").over(W.partitionBy(*keys).orderBy("_split")).alias("_edge"))
        out = out.join(edge, [*keys, "_split"], "left").withColumn("_nb", F.coalesce("_nb", "_edge")).drop("_edge")
    return out.select(*df.columns, *[F.col("_nb")[k].alias(k) for k in cols])


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: dict[str, Column]) -> DataFrame:
    """Attach the group's first values: partial ``min_by`` and an equi-join back."""
    boxed = F.struct(*[c.alias(k) for k, c in cols.items()])
    head = df.groupBy(*keys).agg(F.min_by(boxed, F.struct(*order)).alias("_h"))
    return df.join(head, list(keys), "left").select(*df.columns, *[F.col("_h")[k].alias(k) for k in cols])


def sessionize(df: DataFrame, keys: Sequence[str], order: Sequence[str], compare: dict[str, Column],
               is_break: Callable[[dict], Column], name: str = "session_id",
               rows_per_split: int | None = None) -> DataFrame:
    """Number the islands of each group; a new one starts where ``is_break`` of
    the previous row's ``compare`` values holds (first row: island 1)."""
    nb = neighbour(df, keys, order, {f"_p_{k}": c for k, c in compare.items()} | {"_has": F.lit(True)},
                   rows_per_split=rows_per_split)
    brk = F.when(F.col("_has").isNull(), True).otherwise(F.coalesce(is_break({k: F.col(f"_p_{k}") for k in compare}), F.lit(False)))
    out = running(nb.withColumn("_brk", brk.cast("long")), keys, order, {name: ("sum", F.col("_brk"))}, rows_per_split)
    return out.drop("_brk", "_has", *[f"_p_{k}" for k in compare])


def halo_chunks(df: DataFrame, keys: Sequence[str], idx: str, before: int, after: int, size: int = 1_000_000) -> DataFrame:
    """Cut groups into index chunks, repeating ``before``/``after`` rows at the
    borders (``_core`` false).  Fixed-width row frames over (keys, _chunk) are
    then exact for the core rows, whatever the group size."""
    c = F.floor(F.col(idx) / size).cast("long")
    lo, hi = F.floor((F.col(idx) - after) / size).cast("long"), F.floor((F.col(idx) + before) / size).cast("long")
    return (df.withColumn("_home", c)
              .withColumn("_chunk", F.explode(F.sequence(lo, hi)))
              .withColumn("_core", F.col("_chunk") == F.col("_home")).drop("_home"))


def asof(left: DataFrame, right: DataFrame, t: str, keys: Sequence[str] = (), payload: Sequence[str] = (),
         rows_per_split: int | None = None, prev_strict: bool = False, next_strict: bool = False) -> DataFrame:
    """Attach the last right row at or before ``t`` (``prev_*``) and the first at
    or after it (``next_*``); ``*_strict`` excludes an equal stamp.  Right stamps must be unique per key; the first
    and last right row of neighbouring splits are added to a split as halo."""
    cols = [t, *payload]
    lcols = [c for c in left.columns]
    r = right.select(*keys, F.col(t).alias("_t"), F.struct(*cols).alias("_r"))
    both = (left.select(*keys, F.col(t).alias("_t"), F.struct(*lcols).alias("_l"), F.lit(None).cast(r.schema["_r"].dataType).alias("_r"))
            .unionByName(r.withColumn("_l", F.lit(None).cast(T.StructType([left.schema[c] for c in lcols])))))
    sp, n = add_split(both, keys, ["_t"], rows_per_split)
    if n > 1:
        per = sp.groupBy(*keys, "_split").agg(
            F.max_by("_r", F.when(F.col("_r").isNotNull(), F.col("_t"))).alias("_last"),
            F.min_by("_r", F.when(F.col("_r").isNotNull(), F.col("_t"))).alias("_first"))
        by = W.partitionBy(*keys).orderBy("_split")
        back = W.partitionBy(*keys).orderBy(F.desc("_split"))
        edge = per.select(*keys, "_split", F.last("_last", True).over(by.rowsBetween(W.unboundedPreceding, -1)).alias("_b"),
                          F.last("_first", True).over(back.rowsBetween(W.unboundedPreceding, -1)).alias("_a"))
        halo = edge.select(*keys, "_split", F.explode(F.array("_b", "_a")).alias("_r")).filter(F.col("_r").isNotNull())
        halo = halo.select(*keys, F.col("_r")[t].alias("_t"), "_r", "_split")
        sp = sp.unionByName(halo, allowMissingColumns=True)
    side = F.col("_l").isNotNull()
    part = [*keys, "_split"] if n > 1 or not keys else list(keys)
    up = W.partitionBy(*part).orderBy(F.col("_t"), side.desc() if prev_strict else side.asc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    down = W.partitionBy(*part).orderBy(F.col("_t").desc(), side.desc() if next_strict else side.asc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    hit = sp.select("_l", F.last("_r", True).over(up).alias("_p"), F.last("_r", True).over(down).alias("_n")).filter(side)
    return hit.select("_l.*", *[F.col("_p")[c].alias(f"prev_{c}") for c in cols], *[F.col("_n")[c].alias(f"next_{c}") for c in cols])


def order_statistic(df: DataFrame, keys: Sequence[str], value: str, ranks: dict[str, Callable[[Column], Column]],
                    rows_per_split: int | None = None, weight: str | None = None) -> DataFrame:
    """Exact order statistics: ``{name: n -> 1-based rank}`` per group.

    Copies collapse to (value, count) first; with several splits only the split
    that holds a wanted rank is searched.  ``weight`` counts a row that often."""
    counts = df.groupBy(*keys, value).agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("_c"))
    sp, n = add_split(counts, keys, [value], rows_per_split)
    names = list(ranks)
    if n == 1:
        part = list(keys) or ["_split"]
        cum = sp.select(*keys, value, "_c",
                        F.sum("_c").over(W.partitionBy(*part).orderBy(value).rowsBetween(W.unboundedPreceding, 0)).alias("_hi"),
                        F.sum("_c").over(W.partitionBy(*part)).alias("n"))
        found = cum
    else:
        per = sp.groupBy(*keys, "_split").agg(F.sum("_c").alias("_s"))
        w = W.partitionBy(*keys)
        per = per.select(*keys, "_split", F.sum("_s").over(w).alias("n"),
                         (F.sum("_s").over(w.orderBy("_split").rowsBetween(W.unboundedPreceding, 0)) - F.col("_s")).alias("_before"), "_s")
        wanted = F.lit(False)
        for fn in ranks.values():
            k = fn(F.col("n"))
            wanted = wanted | ((F.col("_before") < k) & (k <= F.col("_before") + F.col("_s")))
        hit = sp.join(per.filter(wanted).drop("_s"), [*keys, "_split"])
        found = hit.select(*keys, value, "_c", "n", (F.col("_before") + F.sum("_c").over(
            W.partitionBy(*keys, "_split").orderBy(value).rowsBetween(W.unboundedPreceding, 0))).alias("_hi"))
    lo = F.col("_hi") - F.col("_c")
    return found.groupBy(*keys).agg(F.max("n").alias("n"), *[
        F.max(F.when((lo < ranks[k](F.col("n"))) & (ranks[k](F.col("n")) <= F.col("_hi")), F.col(value))).alias(k) for k in names])


def nearest_rank(p: float) -> Callable[[Column], Column]:
    """ceil(p n), clamped to [1, n]."""
    return lambda n: F.greatest(F.lit(1), F.least(n, F.ceil(F.lit(p) * n))).cast("long")


def median_ranks() -> dict[str, Callable[[Column], Column]]:
    """Lower and upper middle; the median is their mean."""
    return {"med_lo": lambda n: F.floor((n + 1) / 2).cast("long"), "med_hi": lambda n: (F.floor(n / 2) + 1).cast("long")}


def _starts(pdf: pd.DataFrame, by: Sequence[str]) -> np.ndarray:
    """Rows at which a value of ``by`` differs from the row before, the first among them."""
    new = np.zeros(max(0, len(pdf) - 1), bool)
    for c in by:
        v, none = pdf[c].to_numpy(), pdf[c].isna().to_numpy()
        new |= np.asarray(v[1:] != v[:-1], bool) & ~(none[1:] & none[:-1])
    return np.r_[0, np.flatnonzero(new) + 1]


def _walk(batches: Iterator[pd.DataFrame], by: Sequence[str], order: Sequence[str], fn: Callable):
    """``fn`` along rows sorted by ``by`` and ``order``, from the state in ``_in`` or none.
    Yields for each batch a list of (new group?, its ``by`` values and ``_in``, state, rows)."""
    held, last, state = None, None, None
    for pdf in itertools.chain(batches, [None]):
        if pdf is None:
            ready = held
        else:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if not len(pdf):
                continue
            end = _starts(pdf, [*by, *order])[-1]  # rows equal to the last one may still come
            ready, held = pdf.iloc[:end], pdf.iloc[end:]
        if ready is None or not len(ready):
            continue
        body, done, at = ready.drop(columns=["_split", "_in"], errors="ignore"), [], _starts(ready, by)
        for a, b in zip(at, [*at[1:], len(ready)]):
            key = [ready[k].iloc[a] for k in by]
            new = last is None or any(x != y and not (pd.isna(x) and pd.isna(y)) for x, y in zip(key, last))
            if new:
                start, last = ready["_in"].iloc[a] if "_in" in ready else None, key
                state = None if start is None else json.loads(start)
            out, state = fn(body.iloc[a:b], state)
            state = json.loads(json.dumps(state))
            done.append((new, [*last, start], state, out))
        yield done


def carried_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 fn: Callable[[pd.DataFrame, object], tuple[pd.DataFrame, object]], schema: str,
                 rows_per_split: int | None = None) -> DataFrame:
    """A sequential automaton over each ordered group, exact for any group size.

    ``fn(rows, state) -> (out_rows, state)`` with a JSON-able state gets the rows of a
    group batch by batch, rows equal in ``order`` together, so no task holds a group or a split.
    With one split this is all.  Otherwise every split of a group that has several is
    first run from an unknown (None) state to get its closing state; splits whose real
    incoming state differs are run again until none does, then rows are emitted once.
    Group keys must be part of ``schema``."""
    sp, n = add_split(df, keys, order, rows_per_split)
    order = list(order)
    by = [*keys, "_split"] if n > 1 or not keys else list(keys)

    def scanned(rows, run, ddl):
        return rows.repartition(*by).sortWithinPartitions(*by, *[F.col(c).asc_nulls_last() for c in order]).mapInPandas(run, ddl)

    def emit(batches):
        for done in _walk(batches, by, order, fn):
            out = [rows for *_, rows in done if len(rows)]
            if out:
                yield pd.concat(out, ignore_index=True)

    def closing(batches):
        last = None
        for done in _walk(batches, by, order, fn):
            out = []
            for new, key, state, _ in done:
                if new and last is not None:
                    out.append(last)
                last = [*key, json.dumps(state)]
            if out:
                yield pd.DataFrame(out, columns=[*by, "_in", "_out"])
        if last is not None:
            yield pd.DataFrame([last], columns=[*by, "_in", "_out"])

    if n == 1:
        return scanned(sp, emit, schema)
    key_ddl = "".join(f"`{k}` {sp.schema[k].dataType.simpleString()}, " for k in by)
    state_ddl = f"{key_ddl}_in string, _out string"
    per = sp.select(*by).distinct().withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(*keys)))
    cut_up = cut(per.filter("_n > 1").select(*by, F.lit(None).cast("string").alias("_in")))
    states = cut(scanned(_meet(sp, cut_up, by), closing, state_ddl))
    while True:
        due = states.withColumn("_due", F.lag("_out").over(W.partitionBy(*keys).orderBy("_split")))
        stale = cut(due.filter(~F.col("_due").eqNullSafe(F.col("_in"))).select(*by, F.col("_due").alias("_in")))
        if stale.isEmpty():
            break
        redo = scanned(_meet(sp, stale, by), closing, state_ddl)
        states = cut(_meet(states, stale.select(*by), by, "left_anti").unionByName(redo))

    return scanned(_meet(sp, states.select(*by, "_in"), by, "left"), emit, schema)


def _meet(df: DataFrame, other: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``by`` in which null keys meet, as they do in a grouping."""
    named = {k: f"_on_{k}" for k in by}
    other = other.select(*[F.col(c).alias(named.get(c, c)) for c in other.columns])
    met = F.lit(True)
    for k, o in named.items():
        met = met & F.col(k).eqNullSafe(F.col(o))
    return df.join(other, met, how).drop(*named.values())
