"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash

from scanloom.llm import queries, simhash

M = (1 << 64) - 1


def slow_print(text, k):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(rows, limit):
    """rows: (id, fingerprint)"""
    parent = {}

    def find(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a
    fps = sorted({f for _, f in rows})
    for i, a in enumerate(fps):
        x = np.array(fps[i + 1:], dtype=np.uint64)
        for j in np.nonzero(np.bitwise_count(x ^ np.uint64(a)) <= limit)[0]:
            ra, rb = find(a), find(int(x[j]))
            if ra != rb:
                parent[ra] = rb
    first = {}
    for i, f in rows:
        r = find(f)
        first[r] = min(first.get(r, i), i)
    return {(i, f"{f:016x}", first[find(f)]) for i, f in rows}


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(d + "/documents.parquet").select("doc_id", "text").collect()
    want = slow_components([(r.doc_id, slow_print(r.text, 3)) for r in docs], 2)
    got = {tuple(r) for r in queries.queries()["op8_simhash"](spark, d).select("doc_id", "fingerprint", "component_id").collect()}
    assert got == want


def test_links_of_planted_bit_flips(spark, monkeypatch):
    """Chains, one-bit and two-bit neighbours across segments, and a cell over the block size."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rnd, rows = random.Random(3), []
    for _ in range(60):
        f = rnd.getrandbits(64)
        rows.append(f)
        for _ in range(rnd.randrange(4)):
            f ^= sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 4)))
            rows.append(f)
    hub = rnd.getrandbits(64)
    rows += [hub] + [hub ^ (1 << a) ^ (1 << b) for a in range(0, 12) for b in range(a)] + [hub ^ (3 << 40), hub ^ (1 << 40) ^ (1 << 3)]
    rows = [(i, f & M) for i, f in enumerate(rows)]
    df = spark.createDataFrame([(bytearray(f.to_bytes(8, "big")),) for f in {f for _, f in rows}], "fp binary")
    got = simhash.label_components(simhash.links(df, 2, 2)).collect()
    root = {int.from_bytes(r.node, "big"): int.from_bytes(r.root, "big") for r in got}
    comp = {}
    for i, f in rows:
        comp[root.get(f, f)] = min(comp.get(root.get(f, f), i), i)
    assert {(i, f"{f:016x}", comp[root.get(f, f)]) for i, f in rows} == slow_components(rows, 2)


def test_odd_inputs(spark):
    rows = [(1, None, 9), (2, "", 9), (3, " \n\t", 9), (4, "One", 9), (5, "one", 9), (6, "a b", 9), (6, "a b", 9), (None, "A  B", 9), (8, "x " * 70000, 9), (9, "x " * 70001, 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, fp int")
    got = sorted(map(tuple, simhash.near_duplicates(df, words=3).collect()), key=str)
    by = {}
    for i, f, c in got:
        by.setdefault(i, []).append((f, c))
    assert len(got) == 10 and {by[i][0] for i in (1, 2, 3)} == {("0" * 16, 1)}
    assert by[4][0] == (f"{xxhash.xxh64_intdigest(b'one', 42):016x}", 4) == by[5][0]
    assert len(by[6]) == 2 and by[6][0][1] == by[None][0][1] == 6
    assert by[8][0][1] == by[9][0][1] == 8 and by[8][0][0] == f"{slow_print('x ' * 9, 3):016x}"
    assert simhash.near_duplicates(df.filter("false"), words=3).collect() == []


@pytest.mark.parametrize("words64,segments", [(1, 3), (3, 9)])
def test_wide_fingerprints_agree_with_distance(spark, words64, segments):
    """All pairs under the exhaustive limit are linked."""
    rnd = random.Random(5)
    base = " ".join(rnd.choice("abcdefghij") + str(rnd.randrange(99)) for _ in range(400)).split()
    docs = []
    for i in range(40):
        w = list(base) if i % 2 else [rnd.choice(base) for _ in base]
        for _ in range(i % 7):
            w[rnd.randrange(len(w))] = "z" + str(rnd.randrange(999))
        docs.append((i, " ".join(w)))
    limit = 2 * segments - 1
    fp = {i: int.from_bytes(simhash.fingerprint(t, 5, words64), "big") for i, t in docs}
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), 5, limit, segments, words64).collect()}
    for a in fp:
        for b in fp:
            if bin(fp[a] ^ fp[b]).count("1") <= limit:
                assert got[a] == got[b]
