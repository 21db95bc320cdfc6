"""Hard negatives by zone maps over candidate blocks in Hilbert order.

Vectors are put in the order of a Hilbert curve within their label and cut into blocks of
``BLOCK`` rows: a Parquet table with a row a block (ids and components packed).  The zone
map of a block has the least and the largest value of every dimension; interval
arithmetic on it bounds the scores that an anchor can have in the block.

A block's own anchors first meet the rows of their block, which gives a score that their
last positive reaches at least.  Blocks of their label whose upper bound reaches this score
give the positives; blocks of other labels whose bounds meet the window of a positive give
the negatives.  Both are joins of (anchors of a block, block to read) pairs with the blocks;
the best rows of an anchor in a block are kept, and of these the best of all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scanloom.llm.merkle import numbered
from scanloom.session import cut, drop

#: Rows of a block, zone maps of a group.
BLOCK, ZONES = 2048, 4096
#: Dimensions of the curve (those of the largest variance) and bits of each.
AXES, AXIS_BITS = 12, 5
#: Components are cut to this size, so that they take 32 bits.
LARGEST = (1 << 31) - 1
POSITIVES, NEGATIVES = 5, 3
#: Every such id is an anchor.
EVERY = 50
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows x axes of ``bits`` bits):
    the axes are turned into the transposed index plane by plane, from the highest bit."""
    x = points.astype(np.uint64).T.copy()
    for b in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(len(x)):
            on = (x[i] & bit) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint64(b)) & np.uint64(1), np.uint64((1 << b) - 1), np.uint64(0))
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for row in x:
            key = (key << np.uint64(1)) | ((row >> np.uint64(b)) & np.uint64(1))
    return key


def quantised(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label, v: rows that take part, with integer components."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    # Comparisons put NaN above everything, so one of them finds all that is not finite.
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).filter(~bad)
    label = F.when(F.pmod("id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("v", lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(x * 256.0))).cast("int"))
    return rows.select("id", label.alias("label"), whole.alias("v")).groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")


def _axes(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(dimension, least, largest) of the dimensions of the curve: one row a dimension is collected."""
    each = rows.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.min("x").alias("a"), F.max("x").alias("b"), F.var_pop(F.col("x").cast("double")).alias("s"))
    return [(r.d, r.a, r.b) for r in each.sort(F.desc("s"), "d").limit(AXES).collect()]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers; short vectors are filled with zeros."""
    out = np.zeros((len(column), width), np.int32)
    for row, v in zip(out, column):
        own = v.values.to_numpy(zero_copy_only=False)
        row[:len(own)] = own
    return out


def _unpacked(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.int32).reshape(-1, width).astype(np.int64)


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of two integer matrices (rows x dimensions each): by floating point
    where no sum can pass 2^53, else by whole numbers of any size, cut to 64 bits."""
    bound = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return np.clip(a.astype(object) @ b.astype(object).T, LEAST, MOST).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that each anchor can have in each block (wider, never
    narrower, where floating point rounds)."""
    up, down, lo, hi = (x.astype(np.float64) for x in (np.maximum(a, 0), np.minimum(a, 0), low, high))
    size = np.abs(up).max(initial=0) + np.abs(down).max(initial=0)
    bound = size * max(np.abs(lo).max(initial=0), np.abs(hi).max(initial=0)) * max(1, a.shape[1])
    slack = 0 if bound < 2.0 ** 52 else bound * 2.0 ** -40
    return up @ lo.T + down @ hi.T - slack, up @ hi.T + down @ lo.T + slack


def window(positive: int) -> tuple[int, int]:
    """Whole scores n with 50 * positive <= 100 * n <= 95 * positive."""
    return -(-positive // 2), 95 * positive // 100


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, of equal ones the smaller ids."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], ~scores[at]))][:k]


def ordered(rows: DataFrame) -> tuple[DataFrame, int]:
    """Blocks ``block, label, ids, m, low, high`` (ids as int64, the others as int32, packed)
    with their anchors ``anchors`` (ids), ``a`` (packed) and ``floors``, and the number of
    dimensions.  A floor is the score that the last of an anchor's positives reaches at least."""
    spark = rows.sparkSession
    axes, width = _axes(rows), max(1, rows.agg(F.max(F.size("v"))).first()[0] or 0)
    top = (1 << AXIS_BITS) - 1

    def place(batches):
        for b in batches:
            m = _matrix(b.column(2), width).astype(np.int64)
            scaled = np.stack([(m[:, d] - a) * top // max(1, z - a) for d, a, z in axes], axis=1) if axes else np.zeros((len(m), 1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hilbert(scaled, AXIS_BITS).view(np.int64))], names=["id", "label", "v", "h"])

    def packed(label, held):
        t = pa.Table.from_batches(held)
        ids, m = t.column("id").to_numpy().astype(np.int64), _matrix(t.column("v").combine_chunks(), width)
        at = np.flatnonzero(ids % EVERY == 0)
        floors = []
        for i, scores in zip(at, _dots(m[at], m)):
            others = np.delete(scores, i)
            floors.append(int(np.partition(others, len(others) - POSITIVES)[len(others) - POSITIVES]) if len(others) >= POSITIVES else LEAST)
        return pa.RecordBatch.from_arrays([pa.array([label], pa.int64()), *(pa.array([x], pa.binary()) for x in (ids.tobytes(), m.tobytes(), m.min(axis=0).tobytes(), m.max(axis=0).tobytes())),
                                           pa.array([ids[at]], pa.list_(pa.int64())), pa.array([m[at].tobytes()], pa.binary()), pa.array([floors], pa.list_(pa.int64()))], names=["label", "ids", "m", "low", "high", "anchors", "a", "floors"])

    def pack(batches):
        key, held = None, []
        for b in batches:
            for start, stop, k in _stretches(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k != key and held:
                    yield packed(key[0], held)
                    held = []
                key = k
                held.append(b.slice(start, stop - start))
        if held:
            yield packed(key[0], held)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK))
    keyed = rows.mapInArrow(place, "id bigint, label bigint, v array<int>, h bigint")
    inner = numbered(keyed, ["label"], ["h", "id"], "curve").withColumn("cell", F.floor(F.col("idx") / BLOCK))
    dealt = inner.select("label", "cell", "id", "v").repartition("label", "cell").sortWithinPartitions("label", "cell", "id")
    blocks = dealt.mapInArrow(pack, "label bigint, ids binary, m binary, low binary, high binary, anchors array<bigint>, a binary, floors array<bigint>")
    return cut(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks"), width


def _stretches(*keys):
    start, rows = 0, list(zip(*keys))
    for i in range(1, len(rows) + 1):
        if i == len(rows) or rows[i] != rows[start]:
            yield start, i, rows[start]
            start = i


def _wanted(chunks: DataFrame, zones: DataFrame, width: int, on: list[str], where, choose) -> DataFrame:
    """(chunk, block, rows): which anchors of each chunk must read a block, by zone maps
    alone.  Zone maps come in groups, a row each; a chunk meets a group once."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                low, high = (np.stack([_unpacked(x, width)[0] for x in r[k]]) for k in ("lows", "highs"))
                hit = choose(r, *bounds(_unpacked(r["a"], width), low, high))
                at = np.flatnonzero(hit.any(axis=0))
                yield pa.RecordBatch.from_arrays([pa.array([r["chunk"]] * len(at), pa.int64()), pa.array([r["blocks"][j] for j in at], pa.int64()), pa.array([np.flatnonzero(hit[:, j]) for j in at], pa.list_(pa.int64()))], names=["chunk", "block", "rows"])

    few = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = chunks.repartition(few, *on).join(zones.hint("merge"), on)
    return met.filter(where).mapInArrow(run, "chunk bigint, block bigint, rows array<bigint>")


def _read(wanted: DataFrame, chunks: DataFrame, blocks: DataFrame, width: int, kind: str, pick) -> DataFrame:
    """What ``pick(chunk's row, rows, ids, scores)`` yields of each block that is read."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                a, ids = _unpacked(r["a"], width)[r["rows"]], np.frombuffer(r["ids"], np.int64)
                found = [x for i, scores in zip(r["rows"], _dots(a, _unpacked(r["m"], width))) for x in pick(r, i, ids, scores)]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(4)], names=["anchor_id", "k", "id", "score"])

    # Parallel by blocks, whose pairs are small in bytes and long in time.
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = wanted.join(chunks.hint("merge"), "chunk").repartition(n, "block")
    return cut(pairs.join(blocks.select("block", "ids", "m").repartition(n, "block").hint("merge"), "block").mapInArrow(run, "anchor_id bigint, k bigint, id bigint, score bigint"), kind)


def _top(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    by = W.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null id, label, vector or component, or one that is not finite, take no part.
    Of rows that repeat an id the one with the smallest label, then vector, takes part.
    Vectors of unlike lengths are compared as if zeros followed; an empty one is all zeros.
    Components beyond 31 bits and scores beyond 63 are cut to these.  A positive score below
    zero has an empty window.  An empty table gives no rows; other columns are not read."""
    spark = df.sparkSession
    rows = cut(quantised(df, id_col, vector_col, label_col), "quantised")
    blocks, width = ordered(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    groups = 1 + blocks.count() // ZONES
    zones = blocks.groupBy("label", F.pmod(F.hash("block"), F.lit(groups)).alias("g")).agg(F.collect_list(F.struct("block", "low", "high")).alias("z"))
    zones = cut(zones.select("label", "g", F.col("z.block").alias("blocks"), F.col("z.low").alias("lows"), F.col("z.high").alias("highs")), "zones")
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g")
    chunks = cut(blocks.filter(F.size("anchors") > 0).select(F.col("block").alias("chunk"), "label", "anchors", "a", "floors"), "chunks")

    def reaches(r, low, high):
        return high >= np.array(r["floors"], np.float64)[:, None]

    def positives(r, i, ids, scores):
        me, floor = r["anchors"][i], r["floors"][i]
        at = np.flatnonzero((scores >= floor) & (ids != me))
        at = at[best(scores[at], ids[at], POSITIVES)]
        return [(me, 0, int(ids[j]), int(scores[j])) for j in at]

    wanted = _wanted(chunks.select("*", every), zones, width, ["label", "g"], F.lit(True), reaches)
    near = _read(wanted, chunks, blocks, width, "positives", positives)
    pos = cut(_top(near, ["anchor_id"], POSITIVES).select("anchor_id", F.col("rank").cast("bigint").alias("k"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "chosen")

    wins = pos.groupBy("anchor_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "positive_score"))), lambda x: x["positive_score"]).alias("wins"))
    own = chunks.select("chunk", F.posexplode("anchors").alias("at", "anchor_id")).join(wins, "anchor_id", "left")
    own = own.groupBy("chunk").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "wins"))), lambda x: F.coalesce(x["wins"], F.array().cast("array<bigint>"))).alias("wins"))
    chunks2 = cut(chunks.select("chunk", F.col("label").alias("own"), "anchors", "a").join(own, "chunk"), "windows")

    def meets(r, low, high):
        hit = np.zeros(low.shape, bool)
        for i, scores in enumerate(r["wins"]):
            for lo, hi in map(window, scores):
                if lo <= hi:
                    hit[i] |= (low[i] <= hi) & (high[i] >= lo)
        return hit

    def negatives(r, i, ids, scores):
        out = []
        for k, (lo, hi) in enumerate(map(window, r["wins"][i]), 1):
            if lo <= hi:
                at = np.flatnonzero((scores >= lo) & (scores <= hi))
                at = at[best(scores[at], ids[at], NEGATIVES)]
                out += [(r["anchors"][i], k, int(ids[j]), int(scores[j])) for j in at]
        return out

    wanted = _wanted(chunks2.select("*", every), zones, width, ["g"], "own <> label", meets)
    far = _read(wanted, chunks2, blocks, width, "negatives", negatives)
    out = _top(far, ["anchor_id", "k"], NEGATIVES).join(pos, ["anchor_id", "k"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    drop(rows, blocks, zones, chunks, chunks2, near)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


#: DuckDB's text of the query.
SQL = f"""
WITH r AS MATERIALIZED (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::double)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::bigint AS score FROM r a, r b WHERE a.id % {EVERY} = 0 AND a.id <> b.id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::int AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) <= {NEGATIVES}
"""
