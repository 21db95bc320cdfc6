"""Token ids in length-delimited binary files with a separate offset index.

A file starts with ``MAGIC`` and one byte, the width of an id (2 where the
vocabulary fits, else 4).  Each record is: length of the data (unsigned 64 bits,
little endian), masked CRC-32 of these eight bytes, the data (ids, little endian),
masked CRC-32 of the data.  The mask keeps a checksum of data that itself holds
checksums from being degenerate.  The index is a Parquet table beside the files:
``part, roll, file, doc_id, offset, n_bytes`` with one row a record, so shuffled
reads order the index and fetch records by offset.

Files are written by tasks under names of their own attempt and count only by
being named in the index, so failed or repeated attempts do no harm.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanloom.llm import common
from scanloom.session import scratch

MAGIC = b"SLREC1\n"
#: A file is closed after the record that takes it over this size.
FILE_BYTES = 128 << 20
#: Pieces that a worker process remembers the ids of.
PIECES = 500_000
INDEX = "part int, roll int, file string, doc_id bigint, offset bigint, n_bytes bigint"
#: What \s means to the tokenizer's pattern (the White_Space property): fixed values.
SPACES = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: A run of white space with what follows it.  The byte-level pattern never joins
#: a non-space to white space after it, so cuts before such a run are safe.
PIECE = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
INNER = re.compile(f"[{SPACES}]+[^{SPACES}]+").fullmatch
#: Pieces that are encoded in one text.
TOGETHER = 64


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


class _Known:
    """Ids of pieces met before in this worker process, first come, up to ``PIECES``."""

    def __init__(self, path: str):
        self.tok, self.row, self.flat, self.first = common.tokenizer(path), {}, array("I"), array("q", [0])
        #: Bytes that each id stands for: byte-level tokens have a character a byte, added ones are text.
        self.width = np.zeros(self.tok.get_vocab_size(), np.int64)
        added = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        for token, i in self.tok.get_vocab().items():
            self.width[i] = len(token.encode()) if token in added else len(token)

    def rows(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The row of each piece, with first and flat of the ids of all rows."""
        at = np.fromiter(map(self.row.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        miss = np.nonzero(at < 0)[0].tolist()
        new = dict.fromkeys(pieces[i] for i in miss)
        # pieces of white space and more go to the library a few at a time; bytes tell their ids apart
        inner, other = [], []
        for p in new:
            (inner if INNER(p) else other).append(p)
        new = {p: n for n, p in enumerate(itertools.chain(inner, other), len(self.first) - 1)}
        joined, base = ["".join(inner[k:k + TOGETHER]) for k in range(0, len(inner), TOGETHER)], len(self.flat)
        sizes = array("q", [0])
        for e in self.tok.encode_batch_fast(joined, add_special_tokens=False):
            self.flat.extend(e.ids)
            sizes.append(len(self.flat) - base)
        stop = np.concatenate([[0], np.cumsum(self.width[np.array(self.flat[base:], np.int64)])])
        ends = np.cumsum(np.fromiter((len(p.encode()) for p in inner), np.int64, len(inner)))
        if np.array_equal(stop[np.array(sizes, np.int64)][1:], np.append(ends[TOGETHER - 1::TOGETHER], ends[-1:])[:len(joined)]):
            self.first.extend((base + np.searchsorted(stop[:-1], ends)).tolist())
        else:  # ids that don't stand for their own bytes: the library's offsets tell
            begin, size = array("q"), 0
            del self.flat[base:]
            for e in self.tok.encode_batch(joined, add_special_tokens=False):
                offsets = e.offsets
                begin.extend([size + o[0] for o in offsets])
                self.flat.extend(e.ids)
                size = size + offsets[-1][1]
            ends = np.cumsum(np.fromiter(map(len, inner), np.int64, len(inner)))
            self.first.extend((base + np.searchsorted(np.array(begin, np.int64), ends)).tolist())
        for e in self.tok.encode_batch(other, add_special_tokens=False):
            self.flat.extend(e.ids)
            self.first.append(len(self.flat))
        at[miss] = [new[pieces[i]] for i in miss]
        first, flat = np.array(self.first, np.int64), np.array(self.flat, np.uint32)
        kept = max(0, min(len(new), PIECES - len(self.row)))
        self.row.update(itertools.islice(new.items(), kept))
        if kept < len(new):
            del self.first[len(self.row) + 1:]
            del self.flat[self.first[-1]:]
        return at, first, flat


_known = functools.lru_cache(maxsize=2)(_Known)


def encode(texts: list[str], path: str, end_id: int | None) -> list[np.ndarray]:
    """Ids of each text.  Texts are cut at safe places and each distinct piece is
    encoded once, a bounded number of pieces being remembered between calls."""
    pieces, ends = [], [0]
    for t in texts:
        pieces += PIECE.findall(t)
        ends.append(len(pieces))
    at, first, flat = _known(path).rows(pieces)
    n = first[at + 1] - first[at]
    to = np.concatenate([[0], np.cumsum(n)])
    out = flat[np.repeat(first[at] - to[:-1], n) + np.arange(to[-1])]
    tail = np.array([] if end_id is None else [end_id], np.uint32)
    return [np.concatenate([out[to[a]:to[b]], tail]) for a, b in zip(ends, ends[1:])]


def _put(f, data: bytes) -> int:
    head = struct.pack("<Q", len(data))
    f.write(head + struct.pack("<I", masked(head)))
    f.write(data)
    f.write(struct.pack("<I", masked(data)))
    return len(data) + 16


def write(df: DataFrame, root: str, path: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Encode every whole text with the tokenizer file ``path`` and write the ids in
    ascending order of ``id_col`` under ``root``; returns the offset index.

    Null texts count as empty and still give a record.  Rows with equal ids keep one
    record each, in the order of their texts; rows with null ids come first.  An empty
    table gives an index without rows.  Other columns are not read.  The range
    partitioning bounds a task by rows; a run of equal ids stays in one task.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), common.text_of(text_col).alias("text"))
    ranged = docs.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    common.small_batches(spark)

    def run(batches):
        ctx = TaskContext.get()
        part, name = ctx.partitionId(), f"part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        fs, base = pafs.FileSystem.from_uri(root)
        wide = common.tokenizer(path).get_vocab_size() > 1 << 16 or (end_id or 0) >= 1 << 16
        kind, roll, f, at = (np.dtype("<u4") if wide else np.dtype("<u2")), 0, None, 0
        try:
            for b in batches:
                ids, texts = b.column(0).to_pylist(), b.column(1)
                sizes = pc.binary_length(texts).to_pylist()
                for lo, hi in common.blocks(sizes):
                    rows = []
                    for doc_id, tokens in zip(ids[lo:hi], encode(texts.slice(lo, hi - lo).to_pylist(), path, end_id)):
                        if f is None:
                            f = fs.open_output_stream(f"{base}/{name}-{roll:04d}.rec")
                            f.write(MAGIC + bytes([kind.itemsize]))
                            at = len(MAGIC) + 1
                        size = _put(f, tokens.astype(kind).tobytes())
                        rows.append((part, roll, f"{name}-{roll:04d}.rec", doc_id, at, size - 16))
                        at += size
                        if at > FILE_BYTES:
                            f.close()
                            f, roll = None, roll + 1
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), KINDS)], names=NAMES)
        finally:
            if f is not None:
                f.close()

    fs, base = pafs.FileSystem.from_uri(root)
    fs.create_dir(base, recursive=True)
    ranged.mapInArrow(run, INDEX).write.parquet(f"{root}/index")
    return spark.read.schema(INDEX).parquet(f"{root}/index")


NAMES = ["part", "roll", "file", "doc_id", "offset", "n_bytes"]
KINDS = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]


def records(index: DataFrame, root: str, fn, ddl: str) -> DataFrame:
    """Read the files that ``index`` names, one file after the other in each task,
    check lengths and checksums, and give ``fn`` a column batch at a time:
    (index rows as dict of lists, list of uint32 arrays, ids before each row in its file)."""
    ordered = index.repartition("file").sortWithinPartitions("file", "offset")

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(root)
        name = f = None
        before = 0
        try:
            for b in batches:
                rows = b.to_pydict()
                ids, starts = [], []
                for file, offset, n in zip(rows["file"], rows["offset"], rows["n_bytes"]):
                    if file != name:
                        if f is not None:
                            f.close()
                        f, name, before = fs.open_input_file(f"{base}/{file}"), file, 0
                        top = f.read(len(MAGIC) + 1)
                        if top[:-1] != MAGIC:
                            raise ValueError(f"{file} is no record file")
                        kind = np.dtype(f"<u{top[-1]}")
                    f.seek(offset)
                    head, check = f.read(8), f.read(4)
                    data, last = f.read(n), f.read(4)
                    if struct.unpack("<Q", head)[0] != n or struct.unpack("<I", check)[0] != masked(head) or struct.unpack("<I", last)[0] != masked(data):
                        raise ValueError(f"damaged record at {offset} of {file}")
                    ids.append(np.frombuffer(data, kind).astype("<u4"))
                    starts.append(before)
                    before += len(ids[-1])
                yield fn(rows, ids, starts)
        finally:
            if f is not None:
                f.close()

    return ordered.mapInArrow(run, ddl)


def read(index: DataFrame, root: str) -> DataFrame:
    """doc_id and its ids, from the files; the index may be filtered or thinned."""
    def out(rows, ids, starts):
        return pa.RecordBatch.from_arrays([pa.array(rows["doc_id"], pa.int64()), pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64()))], names=["doc_id", "ids"])
    return records(index, root, out, "doc_id bigint, ids array<bigint>")


def digests(index: DataFrame, root: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, file, offset of every record of a whole
    index.  Running counts are taken in each file; the ids before a file come from
    the index, whose per-file totals (one row a file) are the only ordered step."""
    def out(rows, ids, starts):
        return pa.RecordBatch.from_arrays([pa.array(rows["file"], pa.string()), pa.array(rows["offset"], pa.int64()), pa.array(rows["doc_id"], pa.int64()), pa.array(starts, pa.int64()),
                                           pa.array([len(i) for i in ids], pa.int64()), pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
                                           pa.array([max(1, n // max(1, len(i))) for n, i in zip(rows["n_bytes"], ids)], pa.int64())],
                                          names=["file", "offset", "doc_id", "within", "n_tokens", "ids_crc32", "width"])
    got = records(index, root, out, "file string, offset bigint, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint, width bigint")
    files = index.groupBy("part", "roll", "file").agg(F.sum("n_bytes").alias("n"))
    before = files.withColumn("_before", F.coalesce(F.sum("n").over(Window.orderBy("part", "roll").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return got.join(before.select("file", "_before"), "file").select(
        "doc_id", (F.expr("_before div width") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", "file", "offset")


def op1(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    root = scratch(docs.sparkSession, "records")
    return digests(write(docs, root, path, end_id), root)
