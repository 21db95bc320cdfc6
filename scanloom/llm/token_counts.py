"""Token counts of whole texts without keeping any ids."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.llm import common

#: Texts over this size are cut at white space into parts of about this size.
LONG_BYTES = 1 << 20
_SPACE = re.compile("[\\t\\n\\x0b\\x0c\\r ]")


def parts(text: str, limit: int):
    """Cut before an ASCII white space at or after each ``limit`` characters; a
    stretch without any stays whole."""
    at = 0
    while len(text) - at > limit:
        m = _SPACE.search(text, at + limit)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def lengths(texts: list[str], path: str, limit: int = LONG_BYTES) -> np.ndarray:
    """Number of tokens of each text.  The vocabulary drops white space, so no token
    crosses it: the block is cut there and each distinct word is encoded once."""
    tok = common.tokenizer(path)
    cut = [(i, p) for i, t in enumerate(texts) for p in parts(t, limit)]
    words = pc.ascii_split_whitespace(pa.array([p for _, p in cut], pa.large_string()))
    coded = pc.dictionary_encode(words.flatten())
    size = np.array([len(e) for e in tok.encode_batch(coded.dictionary.to_pylist(), add_special_tokens=False)], np.int64)
    run = np.concatenate([[0], np.cumsum(size[coded.indices.to_numpy(zero_copy_only=False)] if len(size) else np.zeros(0, np.int64))])
    ends = words.offsets.to_numpy()
    ends = ends - ends[0]
    return np.bincount(np.array([i for i, _ in cut], np.int64), weights=run[ends[1:]] - run[ends[:-1]], minlength=len(texts)).astype(np.int64)


def count_tokens(df: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row, for tokenizer files whose
    pattern drops white space.  Special strings in a text count as the library's
    default has it.  Null texts count as empty (no tokens); rows with equal or null
    ids each keep a row; other columns are not read; an empty table gives no rows.
    Partitions are the scan's, which are balanced by bytes; nothing is shuffled."""
    common.small_batches(df.sparkSession)
    docs = df.select(F.col(id_col).alias("doc_id"), common.text_of(text_col).alias("text"))

    def run(batches):
        for b in batches:
            sizes = pc.binary_length(b.column(1)).to_pylist()
            n = [lengths(b.column(1).slice(lo, hi - lo).to_pylist(), path) for lo, hi in common.blocks(sizes, 4 * common.BLOCK_BYTES)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(np.concatenate(n or [[]]), pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = docs.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return got.withColumn("over_limit", F.col("n_tokens") > limit)
