"""Inputs whose columns have the names of helper columns, and many rows without an id."""

from scanloom.llm import kneser_ney, mixing, shards


def test_clashing_helper_names(spark):
    rows = [(i, "Aa bb cc. " * (i % 5 + 1), "en", i, i, i, i) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, sl_h int, sl_w int, sl_id int, sl_lang int")
    plain = df.select("doc_id", "text", "lang")
    names = ("doc_id", "shard", "shard_bytes", "shard_rows")
    got = shards.assign(df, 100)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(map(tuple, shards.assign(plain, 100).select(*names).collect()))
    assert got.columns[:7] == df.columns and all(r.sl_h == r.sl_w == r.doc_id for r in got.collect())
    kept = kneser_ney.keep(df, plain.filter("doc_id < 30").select("doc_id"))
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in kneser_ney.keep(plain, plain.filter("doc_id < 30").select("doc_id")).collect()}


def test_rows_without_ids_are_dealt_to_many_partitions(spark):
    df = spark.createDataFrame([(None, "s", f"text {i}") for i in range(400)], "doc_id bigint, source string, text string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = mixing.mix(df, seed=4)  # one copy of each row
        sizes = [n for n in out.rdd.glom().map(len).collect() if n]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(sizes) == 400 and len(sizes) > 2 and max(sizes) < 240
