"""Extendible hashing over columns: a directory over hash-prefix bits in which only
oversized buckets are split on another bit.

A key is a column of ``BITS`` hash bits.  The directory is grown level by level from
counts that are summed before they are shuffled, a few levels in one pass; what is
still oversized at the deepest of these levels goes on alone.  Each pass leaves one
page: the slots of ``bits`` prefix bits that point to a bucket (slots that are absent
belong to the next page), so that a lookup is one equality join a page.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.session import cut

BITS = 60


def hex_key(digest: Column) -> Column:
    """The first 60 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint")


def prefix(h: Column, bits: int) -> Column:
    return F.shiftright(h, BITS - bits)


def grow(keys: DataFrame, limit: int, step: int = 8) -> list[tuple[int, DataFrame]]:
    """Pages of the directory for ``keys(h, w)``: buckets are split until the sum of
    ``w`` is at most ``limit`` or all rows have one hash.  Page columns: ``slot,
    depth, bucket, bucket_w, bucket_n``.  No rows give one page without slots."""
    total = keys.agg(F.sum("w")).first()[0] or 0
    lo, hi, rest, pages = 0, min(BITS, max(1, math.ceil(math.log2(max(1, total / limit))) + 2)), keys, []
    while True:
        sums = [F.sum("w").alias("w"), F.sum("n").alias("n"), F.min("a").alias("a"), F.max("b").alias("b")]
        cells = cut(rest.groupBy(prefix(F.col("h"), hi).alias("slot")).agg(F.sum("w").alias("w"), F.count("*").alias("n"), F.min("h").alias("a"), F.max("h").alias("b")), "cells")
        levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(lo), F.lit(hi))))
        levels = levels.groupBy("depth", F.expr(f"shiftright(slot, {hi} - depth)").alias("p")).agg(*sums)
        levels = cut(levels.withColumn("fits", (F.col("w") <= limit) | (F.col("a") == F.col("b"))), "levels")
        # a bucket fits where the one of one bit less does not
        above = levels.filter(~F.col("fits")).select((F.col("depth") + 1).alias("depth"), F.col("p").alias("q"), F.lit(True).alias("split"))
        leaf = (levels.filter("fits").withColumn("q", F.expr("shiftright(p, 1)")).join(above, ["depth", "q"], "left")
                .filter(F.col("split") | (F.col("depth") == lo)).select("depth", F.col("p").alias("bucket"), F.col("w").alias("bucket_w"), F.col("n").alias("bucket_n")))
        # the directory: every slot of the deepest level points to the bucket over it
        first = F.expr(f"shiftleft(bucket, {hi} - depth)")
        page = cut(leaf.withColumn("slot", F.explode(F.sequence(first, first + F.expr(f"shiftleft(1L, {hi} - depth)") - 1))), "page")
        pages.append((hi, page))
        over = levels.filter((F.col("depth") == hi) & ~F.col("fits")).select(F.col("p").alias("slot"))
        if hi == BITS or over.isEmpty():
            return pages
        rest = cut(rest.withColumn("slot", prefix(F.col("h"), hi)).join(over, "slot", "left_semi").select("h", "w"), "oversized")
        lo, hi = hi + 1, min(BITS, hi + step)


def look_up(df: DataFrame, pages: list[tuple[int, DataFrame]], h: str) -> DataFrame:
    """``df`` with depth, bucket, bucket_w and bucket_n of the row's bucket.  A page has
    a few slots for each bucket; Spark broadcasts it only where its files are small
    enough for that, and splits skewed slots otherwise."""
    found = ["depth", "bucket", "bucket_w", "bucket_n"]
    for i, (bits, page) in enumerate(pages):
        page = page.select("slot", *(F.col(c).alias(f"_{c}") for c in found))
        df = df.withColumn("slot", prefix(F.col(h), bits)).join(page, "slot", "left").drop("slot")
        df = df.select(*(c for c in df.columns if c not in found and not c.startswith("_")), *((F.coalesce(c, f"_{c}") if i else F.col(f"_{c}")).alias(c) for c in found))
    return df
