"""The quality model against a plain one, and its accuracy on held-out labels."""

import math
from collections import Counter

from scanloom.llm import kneser_ney as K
from scanloom.llm.shapes import tokens, trigrams


def slow_model(grams):
    """log p of a trigram by the textbook, from Counter of trigrams."""
    def parts(counts):
        n = [sum(1 for v in counts.values() if v == k) for k in (1, 2, 3, 4)]
        d = [0.5] * 3
        if n[0] and n[1]:
            y = n[0] / (n[0] + 2 * n[1])
            d = [min(k, max(0.1, k - (k + 1) * y * n[k] / n[k - 1])) if n[k - 1] else k for k in (1, 2, 3)]
        den, gam = Counter(), Counter()
        for key, v in counts.items():
            den[key[:-1]] += v
            gam[key[:-1]] += d[min(v, 3) - 1]
        return counts, d, den, gam
    two, one = Counter(k[1:] for k in grams), Counter()
    for k in two:
        one[k[1:]] += 1
    levels = [parts(one), parts(two), parts(grams)]

    def logp(g):
        p = 1 / (len(one) + 1)
        for order, (counts, d, den, gam) in enumerate(levels, 1):
            key = g[3 - order:]
            if den[key[:-1]]:
                v = counts.get(key, 0)
                p = (v - d[min(v, 3) - 1] if v else 0) / den[key[:-1]] + gam[key[:-1]] / den[key[:-1]] * p
        return math.log(p)
    return logp


def test_tokens():
    assert tokens("The end.\n\nAbc aé 12x!! a a\nfoo bar baz\nfoo bar baz\n") == ["Aa", "a.", "/", "Aa", "a", "0a!", "a", "=", "/", "a", "a", "a", "/", "~", "~", "~", "/"]
    assert tokens("") == [] and trigrams("") == Counter({("<", "<", ">"): 1})


def test_against_plain_model_and_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(d + "/documents.parquet").filter("doc_id < 4000")
    labels = spark.read.parquet(d + "/labels.parquet").filter("doc_id < 4000")
    got = {r.doc_id: r for r in K.classify(docs, labels.filter("quality = 1 and doc_id % 2 = 0")).collect()}
    rows, lab = docs.select("doc_id", "lang", "text").collect(), {r.doc_id: r.quality for r in labels.collect()}
    for lang in ("en", "es"):
        counts = Counter()
        for r in rows:
            if r.lang == lang and r.doc_id % 2 == 0 and lab.get(r.doc_id) == 1:
                counts.update(trigrams(r.text))
        logp = slow_model(counts)
        for r in [r for r in rows if r.lang == lang][:150]:
            g = trigrams(r.text)
            want = math.exp(-sum(n * logp(k) for k, n in g.items()) / sum(g.values()))
            assert abs(got[r.doc_id].perplexity - want) < 1e-9 * want and got[r.doc_id].n_tokens == sum(g.values())
    good = [got[i].kept for i, q in lab.items() if q == 1 and i % 2 and i in got]
    bad = [got[i].kept for i, q in lab.items() if q == 0 and i in got]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.05


def test_odd_inputs(spark):
    rows = [(1, "Aa bb. cc dd.", "en", 1), (2, None, "en", 1), (3, "", None, 1), (None, "x", "en", 1), (4, "Aa bb.", "en", 1), (4, "Aa bb.", "en", 1), (5, "zz " * 50000, "xx", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, g int")
    got = {(r.doc_id, r.lang): r for r in K.classify(df, spark.createDataFrame([(1,), (4,), (None,)], "doc_id bigint")).collect()}
    assert len(got) == 6 and got[4, "en"].n_tokens == 8 and got[2, "en"].n_tokens == 1
    assert got[5, "xx"].kept and got[5, "xx"].threshold is None and got[3, ""].kept
    kept = K.keep(df, spark.createDataFrame([(1,), (4,)], "doc_id bigint"))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {1, 3, 4, 5, None}
    assert K.classify(df.filter("false"), spark.createDataFrame([(1,)], "doc_id bigint")).collect() == []
    assert all(r.kept for r in K.classify(df, spark.createDataFrame([], "doc_id bigint")).collect())


def test_words_not_only_their_shapes(spark):
    """Shuffled words and words of another vocabulary have good shapes and are still rejected."""
    import random
    rnd = random.Random(4)
    vocab = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(2, 9))) for _ in range(200)]
    after = {w: rnd.sample(vocab, 3) for w in vocab}

    def prose():
        out = [rnd.choice(vocab)]
        while len(out) < 120:
            out.append(rnd.choice(after[out[-1]]))
        return out

    def salad(words):
        return " ".join(rnd.sample(words, len(words)))
    foreign = dict(zip(vocab, ("q" + w[::-1] for w in vocab)))
    rows = [(i, " ".join(prose()), "en") for i in range(300)]
    rows += [(1000 + i, salad(prose()), "en") for i in range(40)] + [(2000 + i, " ".join(foreign[w] for w in prose()), "en") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r.kept for r in K.classify(df, df.filter("doc_id < 200").select("doc_id")).collect()}
    assert sum(got[i] for i in range(200, 300)) >= 95
    assert not any(got[i] for i in got if i >= 1000)


def test_small_blocks_and_shards(spark, monkeypatch):
    """Blocks, shards and parts change no figure; a block takes less than its text."""
    from scanloom.session import cut, table_bytes
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id < 300").coalesce(2)
    good = docs.filter("doc_id % 2 = 0").select("doc_id")
    size = docs.selectExpr("sum(octet_length(text))").first()[0]
    assert table_bytes(cut(K._blocks(docs, "doc_id", "text", "lang"))) < 0.8 * size

    def got():
        return {(r.doc_id, r.lang): r for r in K.classify(docs, good).collect()}
    whole = got()
    monkeypatch.setattr(K, "BLOCK_BYTES", 50_000)
    monkeypatch.setattr(K, "SHARD_POSITIONS", 20_000)
    monkeypatch.setattr(K, "PARTS", {3: 3, 2: 2, 1: 2})
    small = got()
    assert K._blocks(docs, "doc_id", "text", "lang").count() > 5 and whole.keys() == small.keys()
    for k, a in whole.items():
        b = small[k]
        assert (a.n_tokens, a.kept) == (b.n_tokens, b.kept)
        for c in ("perplexity", "threshold", "form_perplexity", "form_threshold"):
            assert a[c] == b[c] or abs(a[c] - b[c]) < 1e-9 * a[c]
