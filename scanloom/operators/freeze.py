"""Frozen file sets as digest trees over blocks of their files.

A file is cut into blocks that tasks read on their own, so no file is a row and its size
has no limit.  The SHA-256 of the blocks are folded, ``fanout`` at a time, level by level up to
one root a file.  Two freezes are compared by roots first; only files whose roots differ
are compared block by block, which names the blocks that changed or moved.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from scanloom.session import cut

BLOCK_BYTES, FANOUT = 64 << 20, 64
#: Bytes of files that one task reads, and bytes that it holds at once.
TASK_BYTES, READ_BYTES = 1 << 30, 1 << 20


def _opened(uri: str):
    """The file system and the path in it of a file as Spark lists it."""
    if uri.startswith("file:") or "://" not in uri:
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(quote(re.sub("^s3[an]:", "s3:", uri), safe="/:@"))


def _digests(uris, starts, sizes):
    """SHA-256 of each stretch of the files; a file that became shorter is an error."""
    for uri, start, size in zip(uris, starts, sizes):
        fs, path = _opened(uri)
        h = hashlib.sha256()
        with fs.open_input_file(path) as f:
            f.seek(start)
            while size:
                part = f.read(min(size, READ_BYTES))
                if not part:
                    raise OSError(f"{uri} became shorter while it was read")
                h.update(part)
                size -= len(part)
        yield h.hexdigest()


def _plain(uri: str):
    """One spelling of local names, ``file:/x`` and ``file:///x``."""
    return F.regexp_replace(uri, "^file:/+", "file:/")


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """path (below the given one), uri, bytes of every file below ``path``.

    Spark lists the files without their contents; its scan leaves out empty files, which are
    added from its index of names."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    names = spark.createDataFrame([(unquote(n),) for n in found.inputFiles()], "uri string").withColumn("uri", _plain("uri"))
    listed = names.join(found.select(_plain("path").alias("uri"), F.col("length").alias("bytes")), "uri", "left").fillna(0, ["bytes"])
    below = F.split("uri", r"\Q" + re.sub(r"^\w+:/*", "/", path).rstrip("/") + r"/\E", 2)
    return listed.select(below[1].alias("path"), "uri", "bytes")


def block_digests(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """path (below the given one), bytes (of the file), blocks (of the file), block, sha256.

    An empty file has one empty block."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("bytes") / block_bytes))
    rows = listed_files(spark, path).withColumn("blocks", blocks)
    total, n = rows.agg(F.sum("bytes"), F.sum("blocks")).first()
    tasks = max(-(-(total or 0) // TASK_BYTES), min(n or 1, spark.sparkContext.defaultParallelism), 1)
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).repartition(tasks, "uri", "block")

    def run(batches):
        for b in batches:
            start = [k * block_bytes for k in b.column("block").to_pylist()]
            size = [min(block_bytes, n - s) for n, s in zip(b.column("bytes").to_pylist(), start)]
            found = pa.array(_digests(b.column("uri").to_pylist(), start, size), pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("path", "bytes", "blocks", "block")), found], names=["path", "bytes", "blocks", "block", "sha256"])

    return rows.mapInArrow(run, "path string, bytes bigint, blocks bigint, block bigint, sha256 string")


def digest_tree(blocks: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """path, bytes, level, slot, nodes, sha256: all nodes of the files' trees, written.

    ``nodes`` counts those of the file's level; the root is the node of a level of one.
    A node above is the SHA-256 of the hexadecimal digests of ``fanout`` nodes below (the last
    has fewer), in their order, so a group is bounded by ``fanout``."""
    level = cut(blocks.select("path", "bytes", F.lit(0).alias("level"), F.col("block").alias("slot"), F.col("blocks").alias("nodes"), "sha256"), "tree")
    most = level.agg(F.max("nodes")).first()[0] or 1
    out = level
    while most > 1:
        runs = level.filter("nodes > 1").groupBy("path", "bytes", "level", "nodes", F.floor(F.col("slot") / fanout).alias("up")).agg(F.sort_array(F.collect_list(F.struct("slot", "sha256"))).alias("run"))
        level = cut(runs.select("path", "bytes", (F.col("level") + 1).alias("level"), F.col("up").alias("slot"), F.ceil(F.col("nodes") / fanout).alias("nodes"), F.sha2(F.array_join("run.sha256", ""), 256).alias("sha256")), "tree")
        out, most = out.unionByName(level), -(-most // fanout)
    return out


def roots(tree: DataFrame) -> DataFrame:
    """path, bytes, sha256 (of the root): one row a file, a manifest for ``audit.tree_digest``."""
    return tree.filter("nodes = 1").select("path", "bytes", "sha256")


def changed_blocks(frozen: DataFrame, current: DataFrame) -> DataFrame:
    """path, block, state, from_path, from_block: the blocks in which two trees differ.

    ``missing``: the place has no block any more; ``moved``: it holds what another place held
    at the freeze and no longer holds (the first such place is named); ``added``: new
    place, new content; ``changed``: old place, new content.  Both trees have the same block size."""
    a, b = roots(frozen), roots(current)
    differ = a.select("path", F.struct("bytes", "sha256").alias("was")).join(b.select("path", F.struct("bytes", "sha256").alias("now")), "path", "full")
    differ = cut(differ.filter(~F.col("was").eqNullSafe(F.col("now"))).select("path"), "differ")

    def leaves(tree, name):
        return tree.filter("level = 0").join(differ, "path", "left_semi").select("path", F.col("slot").alias("block"), F.col("sha256").alias(name))

    places = leaves(frozen, "was").join(leaves(current, "now"), ["path", "block"], "full")
    places = cut(places.filter(~F.col("was").eqNullSafe(F.col("now"))), "places")
    homes = places.filter("was IS NOT NULL").groupBy(F.col("was").alias("now")).agg(F.min(F.struct("path", "block")).alias("home"))
    state = F.when(F.col("now").isNull(), "missing").when(F.col("home").isNotNull(), "moved").when(F.col("was").isNull(), "added").otherwise("changed")
    return places.join(homes, "now", "left").select("path", "block", state.alias("state"), F.col("home.path").alias("from_path"), F.col("home.block").alias("from_block"))
