"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits for each of its ``words64``; every bit is the majority of that
bit over the hashes of the text's word shingles.  Equal fingerprints are collapsed
first.  The fingerprint is cut into equal segments.  Every fingerprint enters the table of
each segment under the segment's value (its home) and, where the bits of that value are
odd in number, also under all values at one bit's distance (visits): two values that
differ in one bit have different parity, so one of the two meets the other at its home.
Rows that meet are verified on their complete fingerprints.

Two fingerprints within ``limit`` bits differ by at most one bit in some segment when
``limit < segments + visited``; the visited segments are as few as that asks for.  For a
larger limit the search is not exhaustive; see README for its measured recall.

The links inside one cell are not written out as pairs: a search over the cell leaves
the links of a spanning forest, so no connection between different texts is lost and a cell
of k copies leaves at most k - 1 links.  Cells with many homes are cut into blocks, and each
pair of blocks is a row group of its own, so no task holds a whole hot cell.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.llm import common
from scanloom.llm.common import text_of
from scanloom.operators.spatial import label_components
from scanloom.session import cut

#: Homes that one block of a cell holds.
BLOCK = 4096
#: Shingles that are hashed in one step.
STEP = 1 << 15
SEED = 42


def _mix(h: np.ndarray, k: int) -> np.ndarray:
    """Further 64 hash bits out of a 64-bit hash."""
    with np.errstate(over="ignore"):
        h = h + np.uint64((0x9E3779B97F4A7C15 * k) & 0xFFFFFFFFFFFFFFFF)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def fingerprint(text: str, words: int, words64: int = 1) -> bytes:
    """Big-endian bytes of the fingerprint; zero where the text has no word."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return bytes(8 * words64)
    n = max(1, len(w) - words + 1)
    ones = np.zeros(64 * words64, np.int64)
    digest = xxhash.xxh64_digest
    for lo in range(0, n, STEP):
        part = w[lo:lo + STEP + words - 1]
        if len(part) <= words:
            grams = [b" ".join(part)]
        else:
            grams = map(b" ".join, zip(*(part[i:] for i in range(words))))
        h = np.frombuffer(b"".join([digest(g, SEED) for g in grams]), ">u8")
        if words64 > 1:
            h64 = h.astype(np.uint64)
            h = np.stack([h64, *(_mix(h64, k) for k in range(1, words64))], axis=1).astype(">u8")
        bits = np.unpackbits(np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8 * words64), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(df: DataFrame, words: int, words64: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fp (binary) of every row, from whole texts; nothing is shuffled."""
    common.small_batches(df.sparkSession)
    docs = df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t.as_py(), words, words64) for t in b.column(1)], pa.binary())], names=["doc_id", "fp"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp binary")


def _cells(fps: DataFrame, segments: int, visited: int, words64: int) -> DataFrame:
    """cell, home, fp (and node, root where there are): the homes and visits of distinct fingerprints."""
    more = [c for c in ("node", "root") if c in fps.columns]
    width = 64 * words64 // segments
    if width > 56:
        raise ValueError("segments of at most 56 bits")

    def run(batches):
        for b in batches:
            fp = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint8).reshape(-1, 8 * words64)
            bits = np.unpackbits(fp, axis=1)
            for s in range(segments):
                own = bits[:, s * width:(s + 1) * width].astype(np.int64)
                value = own @ (np.int64(1) << np.arange(width - 1, -1, -1, dtype=np.int64))
                at, cell = np.arange(len(fp)), value
                home = np.ones(len(fp), bool)
                if s < visited:
                    odd = np.nonzero(own.sum(axis=1) % 2)[0]
                    at = np.concatenate([at, np.repeat(odd, width)])
                    cell = np.concatenate([cell, (value[odd][:, None] ^ (np.int64(1) << np.arange(width, dtype=np.int64))).ravel()])
                    home = np.concatenate([home, np.zeros(len(odd) * width, bool)])
                yield pa.RecordBatch.from_arrays([pa.array(cell + (np.int64(s) << 56)), pa.array(home), *(c.take(pa.array(at)) for c in b.columns)], names=["cell", "home", "fp", *more])

    return fps.select("fp", *more).mapInArrow(run, "cell bigint, home boolean, fp binary" + "".join(f", {c} binary" for c in more))


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _linked(key: np.ndarray, fp: np.ndarray, limit: int):
    """Index pairs of verified links between rows of equal key (rows are sorted by
    key): all of them in short runs, those of a spanning forest in long ones."""
    start = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0] if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.concatenate([start, [len(key)]]))
    run = np.repeat(np.arange(len(start)), size)
    short = (size <= 16)[run] if len(run) else np.zeros(0, bool)
    left, right = [], []
    for s in range(1, int(min(16, size.max(initial=0)))):
        i = np.nonzero((run[s:] == run[:-s]) & short[s:])[0]
        ok = _distance(fp[i], fp[i + s]) <= limit
        left.append(i[ok])
        right.append(i[ok] + s)
    for r in np.nonzero(size > 16)[0]:
        free = np.arange(start[r], start[r] + size[r])
        while len(free):
            queue, free = [free[0]], free[1:]
            while queue and len(free):
                a = queue.pop()
                near = _distance(fp[free], fp[a]) <= limit
                got, free = free[near], free[~near]
                left.append(np.full(len(got), a))
                right.append(got)
                queue.extend(got.tolist())
    return np.concatenate(left or [np.zeros(0, int)]), np.concatenate(right or [np.zeros(0, int)])


def _across(key: np.ndarray, fp: np.ndarray, root: np.ndarray, limit: int):
    """Index pairs of all rows of equal key, within ``limit`` bits and of unlike root, row by row."""
    end = np.searchsorted(key, key, "right")
    for i in range(len(key)):
        j = slice(i + 1, end[i])
        near = np.nonzero((root[j] != root[i]) & (_distance(fp[j], fp[i]) <= limit))[0]
        if len(near):
            yield np.full(len(near), i), near + i + 1


def links(fps: DataFrame, limit: int, segments: int, words64: int = 1) -> DataFrame:
    """a, b: verified links between distinct fingerprints ``fps(fp)``, those of a spanning
    forest of each cell.  With a column ``node`` a and b are its values; with a column ``root``
    all pairs of unlike root that meet, no forest."""
    names = ["fp", *(c for c in ("node", "root") if c in fps.columns)]
    visited = min(segments, max(0, limit - segments + 1))
    cells = _cells(fps, segments, visited, words64)
    homes = _cells(fps, segments, 0, words64).groupBy("cell").count().filter(F.col("count") > BLOCK)
    hot = cut(homes.select("cell", F.ceil(F.col("count") / BLOCK).cast("int").alias("n")), "hot")
    own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    dealt = cells.join(hot, "cell", "left").withColumn("own", F.coalesce(own, F.lit(0)))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("n"), F.lit(1)) - 1)))
    dealt = dealt.select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *names)
    sorted_ = dealt.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")

    def run(batches):
        held = None
        def out(t):
            cell, i, j = (t.column(k).to_numpy() for k in range(3))
            new = np.concatenate([[False], (cell[1:] != cell[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            key, raw = np.cumsum(new), t.column(3).to_pylist()
            fp = np.frombuffer(b"".join(raw), ">u8").reshape(-1, words64).astype(np.uint64)
            if "node" in names:
                raw = t.column("node").to_pylist()
            if "root" not in names:
                yield named(raw, *_linked(key, fp, limit))
                return
            _, root = np.unique(np.array(t.column("root").to_pylist(), object), return_inverse=True)
            left, right, n = [], [], 0
            for a, b in _across(key, fp, root, limit):
                left.append(a)
                right.append(b)
                n += len(a)
                if n > STEP:
                    yield named(raw, np.concatenate(left), np.concatenate(right))
                    left, right, n = [], [], 0
            if n:
                yield named(raw, np.concatenate(left), np.concatenate(right))
        def named(raw, a, b):
            return pa.RecordBatch.from_arrays([pa.array([raw[x] for x in a], pa.binary()), pa.array([raw[x] for x in b], pa.binary())], names=["a", "b"])
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            t = t.combine_chunks()
            same = pa.compute.and_(pa.compute.equal(t.column(0), t.column(0)[-1]), pa.compute.and_(pa.compute.equal(t.column(1), t.column(1)[-1]), pa.compute.equal(t.column(2), t.column(2)[-1])))
            last = len(t) - int(pa.compute.sum(same).as_py())  # the last run may go on in the next batch
            if last:
                yield from out(t.slice(0, last))
            held = t.slice(last)
        if held is not None and len(held):
            yield from out(held)

    pairs = sorted_.mapInArrow(run, "a binary, b binary")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter(F.col("a") != F.col("b")).distinct()


def near_duplicates(df: DataFrame, words: int = 5, limit: int = 2, segments: int = 2, words64: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex), component_id: one row per row.

    Texts are lower-cased in A-Z only, words are runs of anything but ASCII white space,
    and a text of fewer words than a shingle is one shingle.  Fingerprints within ``limit``
    bits link; component_id is the smallest id that links reach.  Null texts count as
    empty; texts without words have the fingerprint zero and link like any other; rows
    with equal ids keep a row each; null ids never name a component unless all its ids are null.  Other
    columns are not read; an empty table gives no rows."""
    spark = df.sparkSession
    prints = cut(fingerprints(df, words, words64, id_col, text_col), "prints")
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    # Half the usual batch, as a cell row has a fingerprint and little else.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    edges = cut(links(distinct, limit, segments, words64), "links")
    roots = label_components(edges)
    named = cut(distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "rooted")
    # a table of its own, so that the join below can split the rows of a large component
    ids = cut(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "ids")
    named = cut(named.join(ids, "root").select("fp", "component_id"), "components")
    return prints.join(named, "fp").select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def _hashes(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    grams = {b" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else ()
    return np.unique(np.frombuffer(b"".join(map(xxhash.xxh64_digest, grams)), ">u8").astype(np.int64))


def _nodes(docs: DataFrame, words: int, words64: int) -> DataFrame:
    """doc_id, fp, node (digest of the shingle set) of every row."""
    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t, words, words64) for t in texts], pa.binary()), pa.array([xxhash.xxh3_128_digest(_hashes(t, words).tobytes()) for t in texts], pa.binary())], names=["doc_id", "fp", "node"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp binary, node binary")


def _similar(pairs: DataFrame, prints: DataFrame, docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """a, b, ok of ``pairs(a, b)``: whether the Jaccard similarity of the shingle sets is at
    least ``similarity``.  Sets are made for the nodes of pairs alone."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    one = prints.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("doc_id"))).alias("m")).select("node", "m.doc_id")
    # rows that share an id have several nodes, so the text is taken by id and its own node is computed anew
    one = one.select(F.col("doc_id").alias("sl_id")).distinct()
    texts = docs.join(one, F.col("doc_id").eqNullSafe(F.col("sl_id")), "left_semi")

    def own(batches):
        for b in batches:
            sets = [_hashes(t.as_py(), words) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "set"])

    sets = texts.select("text").mapInArrow(own, "node binary, set array<bigint>").join(wanted, "node", "left_semi")
    sets = cut(sets.dropDuplicates(["node"]), "sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    common_ = F.size(F.array_intersect("sa", "sb"))
    return cut(both.select("a", "b", (common_ >= similarity * (F.size("sa") + F.size("sb") - common_)).alias("ok")), "checked")


def similar_documents(df: DataFrame, similarity: float, words: int = 5, limit: int = 60, segments: int = 12, words64: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, component_id: as ``near_duplicates``, but pairs that meet within ``limit`` bits
    are only candidates, and link where the sets of their shingles have a Jaccard similarity
    of at least ``similarity`` (64-bit hashes of shingles).

    The candidates of a cell are a spanning forest at first.  Where one of its links is
    refused, others may hold that the forest left out: there, all pairs that meet and
    are not yet connected are compared."""
    spark = df.sparkSession
    common.small_batches(spark)
    docs = df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    prints = cut(_nodes(docs, words, words64), "prints")
    nodes = cut(prints.groupBy("node").agg(F.min("fp").alias("fp"), F.min("doc_id").alias("first_id")), "nodes")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    pairs = cut(links(nodes.drop("first_id"), limit, segments, words64), "candidates")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    checked = _similar(pairs, prints, docs, words, similarity)
    edges = checked.filter("ok").select("a", "b")
    refused = checked.filter("NOT ok")
    if not refused.isEmpty():
        groups = cut(label_components(pairs).select("node", F.col("root").alias("group")), "groups")
        mixed = cut(groups.join(refused.select(F.col("a").alias("node")), "node", "left_semi").select("group").distinct(), "mixed")
        joined = label_components(edges).select("node", "root")
        rest = groups.join(mixed, "group", "left_semi").join(nodes, "node").join(joined, "node", "left")
        rest = cut(rest.select("fp", "node", F.coalesce("root", "node").alias("root")), "rest")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        across = links(rest, limit, segments, words64).join(refused.select("a", "b"), ["a", "b"], "left_anti")
        across = cut(across, "across")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        edges = cut(edges.unionByName(_similar(across, prints, docs, words, similarity).filter("ok").select("a", "b")), "edges")
    named = cut(nodes.join(label_components(edges), "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root")), "rooted")
    # a table of its own, so that the join below can split the rows of a large component
    ids = cut(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "ids")
    named = cut(named.join(ids, "root").select("node", "component_id"), "components")
    return prints.join(named, "node").select("doc_id", "component_id")
