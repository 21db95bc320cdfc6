"""Decontamination against brute force over all windows and items."""

import random

import numpy as np

from scanloom.llm import decontam as D


def slow_edits(part, words):
    """Least word edits from ``part`` to any stretch of ``words``, cell by cell."""
    prev = [0] * (len(words) + 1)
    for i, p in enumerate(part, 1):
        row = [i]
        for j, w in enumerate(words, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (p != w)))
        prev = row
    return min(prev)


def slow_has(part, have, words):
    if not part or len(D.shingles(part) & have) >= 0.8 * len(D.shingles(part)):
        return True
    known = set(words)
    return sum(w not in known for w in part) <= 0.2 * len(part) and 1 - slow_edits(part, words) / len(part) >= 0.8


def slow(docs, items):
    """Pairs by shingles and word edits alone, over all positions of the whole text."""
    out = set()
    for d, t in docs:
        w = D.words_of(t or "")
        have = {tuple(w[i:i + n]) for n in range(1, 6) for i in range(len(w) - n + 1)}
        for i, x in items:
            q, a = D.question_answer(x or "")
            if q and slow_has(q, have, w) and slow_has(a, have, w):
                out.add((d, i))
    return out


def slow_scores(ix, words):
    """Score of every item in every window by plain loops."""
    out = {}
    for lo in range(0, max(1, len(words) - ix.step), ix.step):
        for n in range(len(ix.ids)):
            s = 0.0
            for w in set(words[lo:lo + 2 * ix.step]):
                t = ix.term.get(w)
                if t is not None:
                    s += sum(ix.weight[k] for k in range(ix.start[t], ix.start[t + 1]) if ix.item[k] == n)
            if s >= 0.6 - 1e-9:
                out[lo, n] = s
    return out


def test_query_against_brute_force(spark):
    from scanloom.llm import queries
    d = "/root/testdata/sf0.01"
    read = lambda t: [tuple(r) for r in spark.read.parquet(f"{d}/{t}.parquet").collect()]
    items, docs = [(r[0], r[1]) for r in read("benchmark")], [(r[0], r[1]) for r in read("documents")]
    got = {(r.doc_id, r.item_id) for r in queries.queries()["op10_bm25_decontamination"](spark, d).collect()}
    assert got == slow(docs, items) and got


def test_retrieval_is_complete(spark):
    d = "/root/testdata/sf0.01"
    items = [tuple(r) for r in spark.read.parquet(d + "/benchmark.parquet").select("item_id", "text").collect()]
    ix = D.Index(items)
    docs = [D.words_of(r.text) for r in spark.read.parquet(d + "/documents.parquet").filter("doc_id % 9 = 0").limit(60).collect()]
    docs += [D.words_of(items[0][1] + " foo " + items[1][1]), [], D.words_of(items[2][1])[3:]]
    got = {}
    for k, lo, n, s in D.retrieve(ix, docs, 0.6):
        got.setdefault(k, {})[lo, n] = s
    for k, w in enumerate(docs):
        want = slow_scores(ix, w)
        assert set(want) == set(got.get(k, {})) and all(np.isclose(want[x], got[k][x]) for x in want)


def test_odd_inputs(spark):
    long = "lorem ipsum " * 60000
    item = "Which river runs through the old town of Elbing today? The river Elbing."
    rows = [(1, None, 1), (2, "", 1), (3, "x WHICH river, runs through the OLD town of\nElbing today -- the river elbing y", 1), (4, long + item, 1),
            (None, item, 1), (3, item, 1), (5, "Which river runs through the old town of Elbing today? Nobody knows.", 1), (6, "the river Elbing", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score int")
    items = spark.createDataFrame([(10, item, 0), (11, None, 0), (12, "", 0), (10, item, 0), (13, "Short one", 0)], "item_id bigint, text string, doc_id int")
    for per_index in (2, 20000):
        got = sorted((r.doc_id or 0, r.item_id) for r in D.leaks(docs, items, per_index=per_index).collect())
        assert got == sorted([(3, 10), (3, 10), (3, 10), (3, 10), (4, 10), (4, 10), (0, 10), (0, 10)])
        left = D.clean(docs, items, per_index=per_index)
        assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 5, 6]
    assert D.leaks(docs.filter("false"), items).collect() == [] and D.leaks(docs, items.filter("false")).collect() == []
    assert D.clean(docs, items.filter("false")).count() == len(rows)


def test_resemblance_by_cells():
    rnd = random.Random(3)
    for _ in range(300):
        part = [rnd.choice("abcdef") for _ in range(rnd.randrange(1, 12))]
        words = [rnd.choice("abcdefgh") for _ in range(rnd.randrange(0, 30))]
        assert np.isclose(D.resemblance(part, words), 1 - slow_edits(part, words) / len(part))


def test_altered_copies_are_found(spark):
    """One or two words of every item replaced, left out or put in, inside other text: 0.9 or
    more are found; items with half their words replaced are not, nor are the other items."""
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").select("item_id", "text").collect()]
    ix, rnd = D.Index(items), random.Random(5)
    filler = [f"filler{k}" for k in range(200)]
    for kind in ("replace", "leave", "insert"):
        for edits in (1, 2):
            docs = []
            for _, t in items:
                w = D.words_of(t)
                for at in sorted(rnd.sample(range(len(w)), edits), reverse=True):
                    w[at:at + (kind != "insert")] = [] if kind == "leave" else ["altered"]
                docs.append(filler[:rnd.randrange(100)] + w + filler[100:])
            found = D.matches(ix, docs, D.MIN_SCORE, D.MIN_OVERLAP)
            assert sum((k, k) in found for k in range(len(items))) >= 0.9 * len(items), (kind, edits)
            assert all(k == i for k, i in found)
    half = [[w if k % 2 else "other" for k, w in enumerate(D.words_of(t))] for _, t in items]
    assert not D.matches(ix, half, D.MIN_SCORE, D.MIN_OVERLAP)
