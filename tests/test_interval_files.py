"""Files of a partitioned stream sink."""

import collections
import os
import tempfile

from pyspark.sql import functions as F

from scanloom.streaming import operators as ST


def test_one_file_an_interval_and_batch(spark):
    """Every task of a batch wrote a file for every interval."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = spark.range(800).select((F.col("id") % 40).alias("frame_id"), F.col("id").cast("double").alias("x"))
    rows.repartition(4).write.parquet(folder + "/in")
    s = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 4).parquet(folder + "/in")
    out = ST.drain(ST.interval_files(s, 10), "intervals", ["interval"])
    files = collections.Counter(os.path.dirname(f) for f in out.inputFiles())
    assert len(files) == 4 and set(files.values()) == {1}
    got = {r.interval: (r.n, r.s) for r in out.groupBy("interval").agg(F.count("*").alias("n"), F.sum("x").alias("s")).collect()}
    assert got == {k: (200, float(sum(i for i in range(800) if i % 40 // 10 == k))) for k in range(4)}
