"""Registered queries of the training-data operators, with their production parameters."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from scanloom.llm import binary_records, decontam, exact_dedup, html_text, kneser_ney, lang_id, licenses, merkle, mixing, negatives, shards, simhash, token_counts
from scanloom.llm.common import table
from scanloom.session import tune

_QUERIES, _SQL = {}, {}


def query(name, sql=None):
    def add(fn):
        _QUERIES[name] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
        if sql is not None:
            _SQL[name] = sql
        return fn
    return add


def queries():
    return dict(_QUERIES)


def oracle_sql():
    return dict(_SQL)


@query("op1_binary_records")
def op1(spark, sf_dir):
    return binary_records.op1(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2)


@query("op4_token_counts")
def op4(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


@query("op2_poisson_mix", mixing.SQL)
def op2(spark, sf_dir):
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "lang", F.md5("text").alias("text_md5"), "copy")


@query("op3_extendible_shards", shards.SQL.format(limit=shards.SHARD_BYTES))
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = shards.assign(docs)
    return out.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"), "shard", "shard_depth", "shard_bytes", "shard_rows")


@query("op6_exact_dedup", exact_dedup.SQL)
def op6(spark, sf_dir):
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op8_simhash")
def op8(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, limit=2, segments=2)


@query("op7_kneser_ney_quality")
def op7(spark, sf_dir):
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").filter("quality = 1"))


@query("op9_license_scan", licenses.SQL)
def op9(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op10_bm25_decontamination")
def op10(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_html_mincut")
def op5(spark, sf_dir):
    return html_text.main_text(table(spark, sf_dir, "pages"))


@query("op11_merkle_manifest", merkle.SQL)
def op11(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.third_of_ids).drop("lang")


@query("op13_language_id")
def op13(spark, sf_dir):
    return lang_id.predict(table(spark, sf_dir, "documents"))


@query("op12_hard_negatives", negatives.SQL)
def op12(spark, sf_dir):
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))
