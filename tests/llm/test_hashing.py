"""Extendible hashing, shards, exact dedup and Poisson mixing against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from scanloom.llm import exact_dedup, extendible, mixing, queries, shards

SF = "/root/testdata/sf0.001"


def slow_buckets(rows, limit):
    """(depth, prefix) of each hash by splitting one bucket at a time."""
    out, todo = {}, [(0, 0, rows)]
    while todo:
        d, p, part = todo.pop()
        if sum(w for _, w in part) <= limit or len({h for h, _ in part}) <= 1:
            out.update({h: (d, p, sum(w for _, w in part), len(part)) for h, _ in part})
        else:
            for b in (0, 1):
                todo.append((d + 1, 2 * p + b, [(h, w) for h, w in part if (h >> (59 - d)) & 1 == b]))
    return out


@pytest.mark.parametrize("limit", [1, 40, 1000, 10**6])
def test_directory(spark, limit):
    rnd = random.Random(limit)
    hs = [rnd.getrandbits(60) for _ in range(300)] + [(5 << 50) + k for k in range(40)] + [7] * 30
    rows = [(h, rnd.randrange(0, 30)) for h in hs]
    df = spark.createDataFrame(rows, "h bigint, w bigint")
    got = extendible.look_up(df, extendible.grow(df, limit), "h").distinct().collect()
    want = slow_buckets(rows, limit)
    assert {r.h: (r.depth, r.bucket, r.bucket_w, r.bucket_n) for r in got} == want
    for r in got:
        assert r.bucket_w <= limit or len({h for h, _ in rows if h >> (60 - r.depth) == r.bucket}) == 1


def test_shards_odd_inputs(spark, tmp_path):
    rows = [(i, "x" * (i % 50), "keep") for i in range(200)] + [(7, "y" * 90, "k")] * 40 + [(None, None, None), (900, "z" * 5000, "big"), (901, "", "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, shard string")
    got = shards.assign(df, 1000).collect()
    assert len(got) == len(rows) and got[0].__fields__[:2] == ["doc_id", "text"]
    size, where = defaultdict(int), defaultdict(set)
    for r in got:
        size[r.shard, r.shard_part] += len(r.text or "")
        where[r.doc_id].add((r.shard, r.shard_part))
    big = where[900]
    assert all(n <= 1000 or {k} == big for k, n in size.items()) and len(where[7]) > 1
    assert shards.assign(df.filter("false"), 1000).collect() == []
    shards.write(df.drop("shard"), f"file://{tmp_path}/out", 1000)
    back = spark.read.parquet(f"file://{tmp_path}/out")
    assert back.count() == len(rows)


def test_shards_of_one_key_fit(spark):
    """Copies of one id, and null ids, go to shards that fit and report their own bytes and rows."""
    rows = [(k, "x" * 600) for k in range(20) for _ in range(2)] + [(None, "n" * (i % 400)) for i in range(300)] + [(50, "z" * 3000), (50, "z" * 10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = shards.assign(df, 1000)
    got = out.collect()
    size, count, says = Counter(), Counter(), {}
    for r in got:
        size[r.shard] += len(r.text)
        count[r.shard] += 1
        assert says.setdefault(r.shard, (r.shard_bytes, r.shard_rows)) == (r.shard_bytes, r.shard_rows)
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    assert says == {k: (size[k], count[k]) for k in size}
    assert all(n <= 1000 or count[k] == 1 for k, n in size.items())
    assert Counter((r.doc_id, r.text, r.shard) for r in got) == Counter((r.doc_id, r.text, r.shard) for r in out.collect())


def test_dedup_odd_inputs(spark):
    rows = [(1, None, 1), (2, "", 1), (3, " \t\r\n\x0b\x0c", 1), (4, "a b", 1), (5, "ab", 1), (6, " a b", 1), (7, "a  b ", 1), (8, "a b  ", 1), (None, "q", 1), (9, "q", 1), (None, "z", 1), (10, "r", 1), (10, "r", 1), (11, "L" * 10**6, 1), (12, "L " * 10**6, 1), (-5, "neg", 1), (13, "neg", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, h int")
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), i is None, i, t))
    want = Counter()
    for norm, g in groups.items():
        best = min(g, key=lambda x: (x[0], x[1], x[2] or 0))
        for n, _, i, t in g:
            want[i, best[2], len(g), i == best[2] and n == best[0], hashlib.sha256(norm.encode()).hexdigest()] += 1
    for capacity in (1, 65536):
        got = exact_dedup.exact_dedup(df, bucket_entries=capacity)
        assert Counter(tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == want
    assert exact_dedup.exact_dedup(df.filter("false")).collect() == []


def test_dedup_chains_and_buckets(spark, monkeypatch):
    """Sixteen hashes for sixty texts: chains of several links, each with its own bytes;
    whole buckets are in one file; without the directory no row is found."""
    monkeypatch.setattr(extendible, "hex_key", lambda d: F.shiftleft(F.conv(F.substring(d, 1, 1), 16, 10).cast("bigint"), 56))
    rows = [(i, f"text {i % 60}" + " " * (i % 3)) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = exact_dedup.exact_dedup(df, bucket_entries=2).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t.replace(" ", "")].append((-len(t), i))
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(i, min(g)[1], len(g)) for g in groups.values() for _, i in g} and len(got) == 150
    chains = defaultdict(set)
    for r in got:
        chains[r.depth, r.bucket, r.text_sha256[0]].add((r.link, r.text_sha256))
    assert max(map(len, chains.values())) > 2 and all(sorted(k for k, _ in c) == list(range(1, len(c) + 1)) for c in chains.values())
    digests, pages, index = exact_dedup.build_index(df, bucket_entries=2)
    files = index.select("depth", "bucket", F.input_file_name().alias("file")).groupBy("depth", "bucket").agg(F.countDistinct("file").alias("n")).collect()
    assert len(files) > 4 and all(r.n == 1 for r in files)
    lost = exact_dedup._bucketed(digests, [(bits, page.filter("false")) for bits, page in pages])
    assert lost.join(index, ["depth", "bucket", "h", "text_sha256"]).count() == 0


def slow_count(seed, doc_id, mean):
    pieces = max(1, math.ceil(mean / mixing.PIECE))
    total = 0
    for i in range(1, pieces + 1):
        u = int(hashlib.md5(f"{seed}:{'null' if doc_id is None else doc_id}:{i}".encode()).hexdigest()[:13], 16) / 2**52
        p = c = math.exp(-mean / pieces)
        k = 0
        while c <= u:
            k += 1
            p *= mean / pieces / k
            c += p
        total += k
    return total


def test_mix_odd_inputs(spark):
    rows = [(i, "w" * 10, "big", 1) for i in range(900)] + [(1000 + i, "v" * 10, "small", 1) for i in range(100)] + [(None, "n" * 10, None, 1), (5000, None, "empty", 1), (5001, "", "empty", 1), (3, "w" * 10, "big", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copy int")
    weights = spark.createDataFrame([("big", 1.0), ("small", 97.0), ("absent", 5.0), (None, 2.0)], "source string, weight double")
    total = sum(len(t or "") for _, t, _, _ in rows)
    size = Counter()
    for _, t, s, _ in rows:
        size[s] += len(t or "")
    mean = {"big": 1 / 100 * total / size["big"], "small": 97 / 100 * total / size["small"], None: 2 / 100 * total / size[None], "empty": 1.0}
    got = mixing.mix(df, seed=4, weights=weights)
    assert got.columns == ["doc_id", "text", "source", "copy"]
    n = Counter((r.doc_id, r.source) for r in got.collect())
    want = Counter()
    for i, _, s, _ in rows:
        want[i, s] += slow_count(4, i, mean[s])
    assert n == +want
    drawn = sum(v for (_, s), v in n.items() if s == "small")
    assert abs(drawn / 100 - mean["small"]) < 5 * math.sqrt(mean["small"] / 100)
    assert mixing.mix(df.filter("false")).collect() == []


@pytest.mark.parametrize("name", ["op2", "op3", "op6", "op9"])
def test_sql_twins(spark, name):
    import check
    name = next(k for k in queries.queries() if k.startswith(name + "_"))
    ok, note = check.compare(spark, check.connect(SF), SF, name, queries.queries()[name], queries.oracle_sql()[name])
    assert ok, note
