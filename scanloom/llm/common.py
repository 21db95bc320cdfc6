"""Small helpers of the training-data operators."""

from __future__ import annotations

import functools
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom.session import table_bytes

#: Bytes of text that one step of a Python function holds besides its Arrow batch.
BLOCK_BYTES = 4 << 20


#: Largest table (Parquet bytes) that is sent to all executors.
BROADCAST_BYTES = 16 << 20


def sided(small: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A written table as the small side of a join: broadcast where its measured size
    is at most ``limit``, else for a sort-merge join, whose skewed partitions Spark splits."""
    return F.broadcast(small) if table_bytes(small) <= limit else small.hint("merge")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def small_batches(spark: SparkSession) -> None:
    """Rows can hold long texts, so few of them go to Python at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    """One tokenizer a worker process; its own threads stay off, tasks are the parallelism."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def blocks(sizes, limit: int = BLOCK_BYTES):
    """(start, stop) runs of rows of about ``limit`` bytes each."""
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)
