"""The pipeline stage by stage against plain versions on the smallest tables."""

from collections import Counter

import corpus_pipeline as P
from scanloom.llm import decontam, kneser_ney, simhash
from test_decontam import slow
from test_hashing import slow_count

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(SF + "/labels.parquet").collect()}
    names = docs.columns
    seen = {r.doc_id: r for r in docs.collect()}
    stages = dict(P.STAGES)
    assert len(P.STAGES) == 5

    one = P.cut(stages["quality classifier"](spark, docs, SF))
    judged = {r.doc_id: r.kept for r in kneser_ney.classify(docs, spark.read.parquet(SF + "/labels.parquet").filter("quality = 1")).collect()}
    assert one.columns == names and {r.doc_id for r in one.collect()} == {i for i, k in judged.items() if k}
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(judged[i] for i in bad) <= 0.1 * len(bad)

    two = P.cut(stages["SimHash near-dedup"](spark, one, SF))
    rows = {r.doc_id: r.text for r in one.collect()}
    fp = {i: int.from_bytes(simhash.fingerprint(t, 5, 4), "big") for i, t in rows.items()}
    left = {r.doc_id for r in two.collect()}
    assert two.columns == names and left <= set(rows)
    for i in rows:
        same = [j for j in rows if fp[j] == fp[i]]
        assert (i in left) <= (i == min(same))
        if i not in left:  # a smaller near-duplicate is linked, maybe over others
            assert any(j != i and bin(fp[i] ^ fp[j]).count("1") <= P.NEAR["limit"] for j in rows)
    close = [(i, j) for i in rows for j in rows if i < j and bin(fp[i] ^ fp[j]).count("1") <= 13]
    assert all(j not in left or i == j for i, j in close)

    three = P.cut(stages["benchmark decontamination"](spark, two, SF))
    items = [tuple(r) for r in spark.read.parquet(SF + "/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {d for d, _ in slow([(i, rows[i]) for i in left], items)}
    kept = {r.doc_id for r in three.collect()}
    assert three.columns == names and kept == left - dirty and decontam.MIN_OVERLAP == 0.8

    four = P.cut(stages["mixing to target weights"](spark, three, SF))
    size = Counter()
    for i in kept:
        size[seen[i].source] += len(seen[i].text)
    total, w = sum(size.values()), sum(v ** 0.5 for v in size.values())
    want = Counter({i: slow_count(0, i, size[seen[i].source] ** 0.5 / w * total / size[seen[i].source]) for i in kept})
    assert four.columns == names and Counter(r.doc_id for r in four.collect()) == +want

    five = stages["sharding"](spark, four, SF)
    out = five.collect()
    assert five.columns[:len(names)] == names and Counter(r.doc_id for r in out) == +want
    held = Counter()
    for r in out:
        held[r.shard, r.shard_part] += len(r.text.encode())
    assert all(v <= 1 << 20 for v in held.values())


def test_near_dedup_recall(spark):
    """Near copies at Jaccard 0.8 and more are found, unlike texts stay."""
    import random
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(2, 9)))
    rows, pairs = [], []
    for i in range(120):
        w = [word() for _ in range(rnd.randrange(150, 500))]
        v = list(w)
        for _ in range(max(1, len(w) // 60)):
            v[rnd.randrange(len(v))] = word()
        grams = [{tuple(x[k:k + 5]) for k in range(len(x) - 4)} for x in (w, v)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
        pairs.append((2 * i + 1, len(grams[0] & grams[1]) / len(grams[0] | grams[1])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = {r.doc_id for r in P.near_dedup(spark, docs, "").collect()}
    assert all(i in left for i in range(0, 240, 2))
    high = [i not in left for i, j in pairs if j >= 0.8]
    assert len(high) > 60 and sum(high) / len(high) >= 0.9


def test_odd_rows(spark):
    rows = [(1, "a b c d e f g", "en", "s", 1), (1, "a b c d e f g", "en", "s", 1), (2, "a b c d e f g", "en", "s", 1), (None, "a b c d e f g", "en", "s", 1), (3, None, None, None, None), (4, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = docs
    for _, stage in P.STAGES:
        got = P.cut(stage(spark, got, SF))
    assert got.columns[:5] == docs.columns
    assert sorted((r.doc_id or 0) for r in P.near_dedup(spark, docs, SF).collect()) == [0, 1, 3]
    for _, stage in P.STAGES:
        assert stage(spark, docs.filter("false"), SF).collect() == []


def test_near_dedup_by_similarity(spark):
    """Pairs at 0.80-0.83 are found, pairs at 0.70-0.75 stay, whatever their fingerprints say."""
    import random
    rnd = random.Random(6)
    rows, high, low = [], [], []
    for i in range(240):
        want, n = (rnd.uniform(0.805, 0.825), high) if i % 2 else (rnd.uniform(0.70, 0.75), low)
        w = [f"w{rnd.randrange(10**9)}" for _ in range(rnd.randrange(300, 900))]
        v, sets = list(w), lambda x: {tuple(x[k:k + 5]) for k in range(len(x) - 4)}
        # the tail is replaced until the similarity is as wanted
        k = round((len(w) - 4) * (1 - want) / (1 + want))
        v[len(v) - k:] = [f"v{rnd.randrange(10**9)}" for _ in range(k)]
        a, b = sets(w), sets(v)
        j = len(a & b) / len(a | b)
        assert (j >= 0.8) == bool(i % 2)
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
        n.append(2 * i + 1)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = {r.doc_id for r in P.near_dedup(spark, docs, "").collect()}
    assert all(i in left for i in low) and all(2 * i in left for i in range(240))
    assert sum(i not in left for i in high) >= 0.9 * len(high)
