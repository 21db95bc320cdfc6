"""Quality classifier: interpolated modified Kneser-Ney trigrams of trusted text.

A document is judged by two models of its language: one of the words themselves and one
of their shapes (``shapes``).  They are counted from all trusted documents.  Documents are
tokenised once, into blocks (``gram_blocks``).  For trigrams, then pairs, then words, each
block sends its distinct keys to the shards they fall in, with what its trusted documents
count; a shard adds up the counts of a key over all blocks and answers each of them.  One
block owns a key: it says what the key adds to its context and suffix, one order lower.
With all answers a block has the probabilities of its documents' trigrams.

A model of words knows the documents it learned from by heart, so thresholds come from
held-out text: the trusted documents are cut in two by their ids, each half is judged by
models of the other, and the threshold is a quantile of these perplexities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.llm import common, gram_blocks
from scanloom.llm.common import text_of
from scanloom.session import cut, drop, scratch

#: Share of a language's trusted documents that its thresholds keep.
QUANTILE = 0.99
#: Least discount: few counts can give none at all, which would leave no mass for the unseen.
LEAST = 0.1
#: Bytes of text in a block (one longer text is a block of its own).
BLOCK_BYTES = 6 << 20
#: Positions (of words and shapes) for each shard of keys.
SHARD_POSITIONS = 1_200_000
#: Parts that the shards of an order are sent in, one after the other: they bound what is on disk at once.
PARTS = {3: 1, 2: 2, 1: 1}
#: Positions that are judged at a time.
STEP = 1 << 18
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _blocks(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    common.small_batches(df.sparkSession)
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), text_of(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        number, ids, langs, texts, held = TaskContext.get().partitionId() << 32, [], [], [], 0

        def out():
            sizes, *blobs, forms, several, n_words = gram_blocks.write_block(texts)
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)), pa.array([langs], pa.list_(pa.string())), pa.array([sizes], pa.list_(pa.int32())),
                *(pa.array([b], pa.binary()) for b in blobs), pa.array([forms], pa.list_(pa.string())), pa.array([several], pa.int64()), pa.array([n_words], pa.int64()), pa.array([2 * (sum(sizes) + 3 * len(sizes))], pa.int64())],
                names=["block", "ids", "langs", "sizes", "tokens", "words", "form", "forms", "several", "n_words", "positions"])

        for b in batches:
            for lo, hi in common.blocks(pc.binary_length(b.column(2)).to_pylist(), BLOCK_BYTES):
                size = pc.sum(pc.binary_length(b.column(2).slice(lo, hi - lo))).as_py()
                if texts and held + size > BLOCK_BYTES:
                    yield out()
                    number, ids, langs, texts, held = number + 1, [], [], [], 0
                ids.append(b.column(0).slice(lo, hi - lo))
                langs += b.column(1).slice(lo, hi - lo).to_pylist()
                texts += b.column(2).slice(lo, hi - lo).to_pylist()
                held += size
        if texts:
            yield out()

    return docs.mapInArrow(run, f"block bigint, ids array<{kind}>, langs array<string>, sizes array<int>, tokens binary, words binary, form binary, forms array<string>, several bigint, n_words bigint, positions bigint")


CONTENT = ["block", "langs", "sizes", "tokens", "words", "form", "forms", "several", "n_words"]


def _trusted_halves(blocks: DataFrame, good: DataFrame, root: str) -> None:
    """For each block the places of its trusted documents and their half."""
    each = blocks.select("block", F.posexplode("ids").alias("place", "doc_id")).join(good, "doc_id")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    rows = each.select("block", F.struct("place", half.alias("half")).alias("t")).groupBy("block").agg(F.collect_list("t").alias("trusted"))
    rows.write.partitionBy("block").parquet(root)


def _halves(root: str, block: int, n: int) -> np.ndarray:
    out = np.full(n, -1)
    for row in gram_blocks.folder(root, block, ["trusted"]):
        for t in row["trusted"]:
            out[t["place"]] = t["half"]
    return out


def _exchange(blocks: DataFrame, root: str, roots: dict, order: int, shards: int) -> list[str]:
    """Send the keys of an order to their shards and write the answers by block."""
    written = []
    parts = min(PARTS[order], shards)
    for part in range(parts):
        def ask(batches):
            for b in batches:
                for row in b.to_pylist():
                    halves = _halves(f"{root}/halves", row["block"], len(row["sizes"]))
                    given = {order + 1: gram_blocks.reply(roots[order + 1], row["block"], order + 1)} if order < 3 else {}
                    rows = [(s, row["block"], len(k), gram_blocks.pack(np.diff(k, prepend=np.uint64(0))), gram_blocks.pack(v))
                            for s, k, v in gram_blocks.requests(gram_blocks.Block(row, min(3, order + 1)), given, halves, order, shards, part, parts)]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["shard", "block", "n", "keys", "sums"])

        def answer(table):
            rows = sorted(table.to_pylist(), key=lambda r: r["block"])
            c = 2 if order == 3 else gram_blocks.SUMS
            found = [(np.cumsum(gram_blocks.unpack(r["keys"], "<u8", r["n"]), dtype=np.uint64), gram_blocks.unpack(r["sums"], "<i4", c * r["n"]).reshape(c, -1)) for r in rows]
            got = [(r["block"], r["shard"], r["n"], v.itemsize, gram_blocks.pack(v)) for r, v in zip(rows, gram_blocks.answers(found))]
            return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()))], names=["block", "shard", "n", "width", "sums"])

        asked = blocks.select(*CONTENT).mapInArrow(ask, "shard int, block bigint, n bigint, keys binary, sums binary")
        got = asked.groupBy("shard").applyInArrow(answer, "block bigint, shard int, n bigint, width int, sums binary")
        written.append(f"{root}/order{order}-{part}")
        got.repartition("block").write.partitionBy("block").parquet(written[-1])
    return written


def _discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney, from how many keys were counted 1, 2, 3 and 4 times."""
    if not (n[0] and n[1]):
        return [0.5] * 3
    y = n[0] / (n[0] + 2 * n[1])
    return [min(float(i), max(LEAST, i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else float(i))) for i in (1, 2, 3)]


def _models(blocks: DataFrame, roots: dict) -> dict:
    """Discounts of the three orders, and sum and number of words, of each model."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                block, out = gram_blocks.Block(row), []
                for order in (1, 2, 3):
                    _, where, _ = block.distinct(order)
                    given = gram_blocks.reply(roots[order], row["block"], order)
                    mine = np.flatnonzero(given[-1])
                    model = block.model[where[mine]]
                    for m in range(3):
                        n = gram_blocks.counts(given, order, m, mine)
                        for k in np.unique(model[n > 0]).tolist():
                            v = n[(model == k) & (n > 0)]
                            out.append((block.models[k], m, order, *((v == i).sum() for i in (1, 2, 3, 4)), v.sum(), len(v)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.string(), pa.int32(), pa.int32()] + [pa.int64()] * 6)], names=["model", "m", "o", "n1", "n2", "n3", "n4", "n", "kinds"])

    rows = blocks.select(*CONTENT).mapInArrow(run, "model string, m int, o int, n1 bigint, n2 bigint, n3 bigint, n4 bigint, n bigint, kinds bigint")
    out: dict = {}
    for r in rows.groupBy("model", "m", "o").agg(*(F.sum(c).alias(c) for c in ("n1", "n2", "n3", "n4", "n", "kinds"))).collect():
        d = _discounts([r.n1, r.n2, r.n3, r.n4])
        of = out.setdefault((r.model, r.m), {"d": {}})
        of["d"][r.o] = d
        if r.o == 1:
            of["lowest"] = (float(r.n), d[0] * r.n1 + d[1] * r.n2 + d[2] * (r.kinds - r.n1 - r.n2), float(r.kinds))
    return out


def log_probabilities(block: gram_blocks.Block, given: dict, models: dict, m: int, at: np.ndarray) -> np.ndarray:
    """logp of the trigrams at these positions under the model ``m`` of their language;
    NaN where it has none.

    p(z|xy) = max(n - D(n), 0) / n(xy.) + gamma(xy) p(z|y); lower orders count the
    distinct words to the left, the lowest mixes with 1 / (kinds + 1); a context that
    was never seen takes the lower order alone."""
    none, model = {"d": {}, "lowest": (np.nan,) * 3}, block.model[at]
    of = [models.get((k, m), none) for k in block.models]
    low = np.array([k["lowest"] for k in of])[model]
    p = low[:, 1] / low[:, 0] / (low[:, 2] + 1)
    for order in (1, 2, 3):
        d = np.array([k["d"].get(order, (np.nan,) * 3) for k in of])[model]
        n = gram_blocks.counts(given[order], order, m, block.distinct(order)[2][at + 3 - order]).astype(np.float64)
        num = np.where(n > 0, n - np.where(n == 1, d[:, 0], np.where(n == 2, d[:, 1], d[:, 2])), 0.0)
        if order == 1:
            p = num / low[:, 0] + p
            continue
        s, one, two, kinds = given[order - 1][4 * m:4 * m + 4][:, block.distinct(order - 1)[2][at + 3 - order]].astype(np.float64)
        gam = d[:, 0] * one + d[:, 1] * two + d[:, 2] * (kinds - one - two)
        seen = s > 0
        s = np.where(seen, s, 1.0)
        p = np.where(seen, num / s + gam / s * p, p)
    return np.log(p)


def perplexities(blocks: DataFrame, root: str, roots: dict, models: dict) -> DataFrame:
    """doc_id, lang, n_tokens, trusted and of words (w) and shapes (s) the perplexity under
    the whole model and, of trusted documents, under that of the other half (``_held``)."""
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    sums = [k + h for k in gram_blocks.KINDS for h in ("", "_held")]

    def run(batches):
        for b in batches:
            ids = b.column(b.schema.get_field_index("ids"))
            for r, row in enumerate(b.drop_columns(["ids"]).to_pylist()):
                block, n = gram_blocks.Block(row), len(row["sizes"])
                halves = _halves(f"{root}/halves", row["block"], n)
                given = {o: gram_blocks.reply(roots[o], row["block"], o) for o in (1, 2, 3)}
                half, out = np.concatenate([halves, halves])[block.doc], np.zeros((2, 2 * n))
                _, where, rows = block.distinct(3)
                logp = np.concatenate([log_probabilities(block, given, models, 0, where[lo:lo + STEP]) for lo in range(0, len(where), STEP)])
                out[0] = np.bincount(block.doc[block.at[3]], weights=logp[rows[block.at[3]]], minlength=2 * n)
                for m in (1, 2):
                    every = block.at[3][half[block.at[3]] == 2 - m]
                    for lo in range(0, len(every), STEP):
                        at = every[lo:lo + STEP]
                        out[1] += np.bincount(block.doc[at], weights=log_probabilities(block, given, models, m, at), minlength=2 * n)
                out[1][np.concatenate([halves, halves]) < 0] = np.nan
                values = [pa.array(v, pa.float64(), from_pandas=True) for v in (out[0][:n], out[1][:n], out[0][n:], out[1][n:])]
                yield pa.RecordBatch.from_arrays([ids.slice(r, 1).flatten(), pa.array(row["langs"], pa.string()), pa.array(np.array(row["sizes"], np.int64) + 1), pa.array(halves >= 0), *values],
                                                 names=["doc_id", "lang", "n_tokens", "trusted", *sums])

    scored = blocks.select("ids", *CONTENT).mapInArrow(run, f"doc_id {kind}, lang string, n_tokens bigint, trusted boolean, " + ", ".join(f"{c} double" for c in sums))
    scored = scored.groupBy("doc_id", "lang").agg(F.sum("n_tokens").alias("n_tokens"), F.max("trusted").alias("trusted"), *(F.sum(c).alias(c) for c in sums))
    return scored.select("doc_id", "lang", "n_tokens", "trusted", *(F.exp(-F.col(c) / F.col("n_tokens")).alias(c) for c in sums))


def _judged(df: DataFrame, good: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``perplexities`` of all documents, written."""
    spark = df.sparkSession
    usual = spark.conf.get(FREE)
    spark.conf.set(FREE, "true")  # shuffles go with the step that wrote them
    try:
        root = scratch(spark, "grams")
        blocks = cut(_blocks(df, id_col, text_col, lang_col), "blocks")
        _trusted_halves(blocks, good, f"{root}/halves")
        positions = blocks.agg(F.sum("positions")).first()[0] or 0
        roots: dict = {}
        for order in (3, 2, 1):
            roots[order] = _exchange(blocks, root, roots, order, max(1, -(-positions // SHARD_POSITIONS)))
        out = cut(perplexities(blocks, root, roots, _models(blocks, roots)), "scored")
        drop(blocks)
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        return out
    finally:
        spark.conf.set(FREE, usual)


def classify(df: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, lang, n_tokens, perplexity, threshold (of words), form_perplexity,
    form_threshold (of shapes), kept: one row for each id and language.

    ``trusted(doc_id)`` names the documents that the models learn from, all of them; both
    thresholds together keep the share ``quantile`` of them at least.
    Rows of one id and language are judged as one text.  Null texts count as empty (an end mark
    alone, n_tokens 1); null languages are a language of their own (empty name); null
    ids are judged together and are never trusted; a language without trusted text
    has no threshold and is kept; one whose trusted documents are all in one half takes their
    own perplexities.  An empty table gives no rows; other columns are not
    read."""
    good = trusted.select(F.col("doc_id")).filter(F.col("doc_id").isNotNull()).distinct()
    each = 1 - (1 - quantile) / 2
    scored = _judged(df, good, id_col, text_col, lang_col)
    of = lambda c, name: F.percentile_approx(F.when(F.col("trusted"), F.col(c)), each, 10000).alias(name)
    limits = scored.groupBy("lang").agg(of("w", "w0"), of("w_held", "w1"), of("s", "s0"), of("s_held", "s1"))
    limits = cut(limits.select("lang", F.coalesce("w1", "w0").alias("threshold"), F.coalesce("s1", "s0").alias("form_threshold")), "limits")
    out = scored.join(limits, "lang", "left").withColumnsRenamed({"w": "perplexity", "s": "form_perplexity"})
    within = lambda p, t: F.col(t).isNull() | F.col(p).isNull() | (F.col(p) <= F.col(t))
    return out.select("doc_id", "lang", "n_tokens", "perplexity", "threshold", "form_perplexity", "form_threshold", (within("perplexity", "threshold") & within("form_perplexity", "form_threshold")).alias("kept"))


def keep(df: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` that ``classify`` keeps; rows with null ids stay."""
    id_col, lang_col = options.get("id_col", "doc_id"), options.get("lang_col", "lang")
    out = classify(df, trusted, **options).filter(~F.col("kept") & F.col("doc_id").isNotNull())
    out = cut(out.select(F.col("doc_id").alias("sl_id"), F.col("lang").alias("sl_lang")).sort("sl_id"), "rejected")
    out = common.sided(out)
    return df.join(out, (df[id_col] == out["sl_id"]) & (F.coalesce(df[lang_col].cast("string"), F.lit("")) == out["sl_lang"]), "left_anti")
