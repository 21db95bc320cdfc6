"""Shards of bounded size by extendible hashing over document keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.llm import extendible
from scanloom.llm.common import text_of
from scanloom.session import cut

#: Bytes of text a shard may hold.
SHARD_BYTES = 1 << 20


def assign(df: DataFrame, limit: int = SHARD_BYTES, keys: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``df`` with shard, shard_depth, shard_part, shard_bytes and shard_rows.

    The hash of ``keys`` picks a bucket of the directory; a bucket over ``limit`` bytes
    of text is split on another bit until it fits.  Rows of one key cannot be told
    apart by these bits: where they alone exceed the limit, such rows are numbered, written
    with their numbers, and go to a second directory over the hashes of these (shards
    named ``rows:...``, ``shard_part`` 1, else 0).  shard_bytes and shard_rows are those of the
    shard; a single longer text has a shard of its own.  Null keys hash like any value, null
    texts have no bytes, an empty table gives no rows.  Existing columns of the added
    names are replaced."""
    added = ["shard", "shard_depth", "shard_part", "shard_bytes", "shard_rows"]
    base = df.drop(*added)
    own = base.columns
    name = {c: f"in{i}" for i, c in enumerate(own)}
    key = F.concat_ws("\x1f", *(F.coalesce(F.col(name[k]).cast("string"), F.lit("\x00")) for k in keys))
    sized = base.withColumnsRenamed(name).withColumns({"sl_h": extendible.hex_key(F.md5(key)), "sl_w": F.octet_length(text_of(name[text_col])).cast("bigint")})
    pages = extendible.grow(sized.select(F.col("sl_h").alias("h"), F.col("sl_w").alias("w")), limit)
    found = extendible.look_up(sized, pages, "sl_h")

    def named(rows, prefix, part):
        return rows.select(*(F.col(f"in{i}").alias(c) for i, c in enumerate(own)),
                           F.concat_ws(":", *prefix, "depth", "bucket").alias("shard"), F.col("depth").alias("shard_depth"),
                           F.lit(part).cast("bigint").alias("shard_part"), F.col("bucket_w").alias("shard_bytes"), F.col("bucket_n").alias("shard_rows"))

    over = (F.col("bucket_w") > limit) & (F.col("bucket_n") > 1)
    if all(page.filter(over).isEmpty() for _, page in pages):
        return named(found, [], 0)
    # written, so that a row keeps its number when a task runs again
    rows = cut(found.filter(over).drop("depth", "bucket", "bucket_w", "bucket_n").withColumn("sl_r", F.monotonically_increasing_id()), "rows")
    rows = rows.withColumn("sl_h", extendible.hex_key(F.md5(F.col("sl_r").cast("string"))))
    again = extendible.look_up(rows, extendible.grow(rows.select(F.col("sl_h").alias("h"), F.col("sl_w").alias("w")), limit), "sl_h")
    return named(found.filter(~over), [], 0).unionByName(named(again, [F.lit("rows")], 1))


def write(df: DataFrame, root: str, limit: int = SHARD_BYTES, keys: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> None:
    """One folder of Parquet a shard under ``root``; every shard is written by one task."""
    sharded = assign(df, limit, keys, text_col)
    sharded.repartition("shard", "shard_part").sortWithinPartitions("shard", "shard_part").write.partitionBy("shard", "shard_part").parquet(root)


#: DuckDB's text of the same directory: the least depth at which the sum of a prefix
#: fits.  {limit} bytes; md5's first 60 bits are the hash.
SQL = """
WITH k AS (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::varchar, chr(0))), 1, 15))::bigint AS h, strlen(coalesce(text, ''))::bigint AS w FROM documents),
b AS (SELECT d, h >> (60 - d) AS p, sum(w)::bigint AS bw, count(*) AS bn, min(h) = max(h) AS one FROM k, generate_series(0, 60) t(d) GROUP BY ALL),
f AS (SELECT k.doc_id, k.w, d, p, bw, bn, row_number() OVER (PARTITION BY doc_id ORDER BY d) AS r FROM k JOIN b ON b.p = k.h >> (60 - b.d) WHERE bw <= {limit} OR one)
SELECT doc_id, w AS n_bytes, d || ':' || p AS shard, d::int AS shard_depth, bw AS shard_bytes, bn AS shard_rows FROM f WHERE r = 1
"""
