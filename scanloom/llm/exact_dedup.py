"""Exact duplicates through an extendible-hash index on shared files.

1. Digests: texts are read once; what a later step needs of a row (id, length, digest,
   hash bits) is written without its text.
2. Directory: grown from the distinct hashes; buckets with too many of them split on
   another bit, and the slots of an oversized bucket's page are doubled.
3. Insert: a row goes through the directory (hash bits -> slot -> bucket).  Only texts
   whose hash occurs again are moved: inside a bucket they are grouped by hash and
   whole normalised text, so their bytes are compared.  Spark sums a group in each task before
   the shuffle, so a text that a third of all rows share moves once a task.
4. Buckets are dealt to owner tasks in ranges of keys, whole buckets to one task, and
   written in their order.  Entries of one hash are links of a chain.
5. Lookup: hash bits -> slot -> bucket -> chain; a row takes the link of its digest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanloom.llm import extendible
from scanloom.llm.common import sided, text_of
from scanloom.session import cut, drop

#: Characters that do not count: fixed values, [\x20\x09-\x0D].
BLANK = " \t\n\x0b\x0c\r"
#: Entries a bucket may hold.
BUCKET_ENTRIES = 65536
_TOP = "cast('18446744073709551616' as decimal(38,0))"  # 2^64


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.length(text).alias("n_cp"), F.translate(text, BLANK, "").alias("norm"))
    return rows.withColumn("text_sha256", F.sha2("norm", 256)).withColumn("h", extendible.hex_key(F.col("text_sha256")))


def _bucketed(df: DataFrame, pages: list) -> DataFrame:
    """``df(h, ...)`` with depth and bucket of its rows, by the directory."""
    return extendible.look_up(df, pages, "h").drop("bucket_w", "bucket_n")


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_entries: int = BUCKET_ENTRIES) -> tuple[DataFrame, list, DataFrame]:
    """The written digests of all rows (doc_id, n_cp, text_sha256, h), the pages of the
    directory, and the written index: depth, bucket, h, link, text_sha256, keep_id,
    keep_cp, group_size."""
    # One number ranks by code points, then by smallest id (null last): n_cp * 2^64 - (id + 2^63).
    rank = F.expr(f"cast(cast(n_cp as decimal(11,0)) * {_TOP} as decimal(38,0)) - coalesce(cast(doc_id as decimal(20,0)) + cast('9223372036854775808' as decimal(20,0)), {_TOP} - 1)").cast("decimal(38,0)")
    digests = cut(_keyed(df, id_col, text_col).drop("norm"), "digests")
    hashes = cut(digests.groupBy("h").agg(F.count("*").alias("n")), "hashes")
    pages = extendible.grow(hashes.select("h", F.lit(1).cast("bigint").alias("w")), bucket_entries)
    again = cut(hashes.filter("n > 1").select("h"), "again")

    texts = _bucketed(_keyed(df, id_col, text_col).drop("text_sha256").join(sided(again), "h", "left_semi"), pages)
    texts = texts.groupBy("depth", "bucket", "h", "norm").agg(F.count("*").alias("group_size"), F.max(rank).alias("best"))
    entries = texts.select("depth", "bucket", "h", F.sha2("norm", 256).alias("text_sha256"), "group_size", "best")
    entries = entries.withColumn("_id", F.expr(f"pmod(-best, {_TOP})")).withColumn("keep_cp", F.expr(f"cast((best + _id) / {_TOP} as int)"))
    entries = entries.withColumn("keep_id", F.expr(f"case when _id = {_TOP} - 1 then null else cast(_id - cast('9223372036854775808' as decimal(20,0)) as bigint) end"))
    alone = _bucketed(digests.join(sided(again), "h", "left_anti"), pages)
    alone = alone.select("depth", "bucket", "h", "text_sha256", F.lit(1).cast("bigint").alias("group_size"), F.col("n_cp").alias("keep_cp"), F.col("doc_id").alias("keep_id"))

    # Buckets lie side by side on the keys, so a range of first keys is whole buckets.
    first = F.expr(f"shiftleft(bucket, {extendible.BITS} - depth)")
    owned = entries.select(*alone.columns).unionByName(alone).withColumn("first_key", first).repartitionByRange("first_key")
    chain = Window.partitionBy("first_key", "h").orderBy("text_sha256")
    index = cut(owned.withColumn("link", F.row_number().over(chain)).drop("first_key"), "index")
    drop(hashes, again)
    return digests, pages, index


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, bucket, depth, link: one row per row.

    Texts are equal when they are the same without the characters of ``BLANK``; null
    counts as empty, and all empty texts are one group.  The row with the most code
    points stays, then the smallest id (null ids come last).  Rows that repeat both id
    and text carry the same flags.  Other columns are not read; an empty table gives
    no rows."""
    digests, pages, index = build_index(df, id_col, text_col, bucket_entries)
    rows = _bucketed(digests, pages)
    return rows.join(index, ["depth", "bucket", "h", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_cp") == F.col("keep_cp"))).alias("kept"), "text_sha256", "depth", "bucket", "link")


#: DuckDB's text of ``exact_dedup``.
SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS s FROM documents),
k AS (SELECT *, first(doc_id) OVER (PARTITION BY s ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(s) AS text_sha256 FROM k
"""
