"""The Merkle manifest against a plain tree of hashlib."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from scanloom.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_leaf(row, text):
    out = []
    for v in (row[0], row[1], row[2], row[3], text):
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return sha(*out)


def slow_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def slow_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text) rows."""
    parts = defaultdict(list)
    for r in rows:
        leaf, other = slow_leaf(r, r[4]), None
        if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
            other = slow_leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
        parts[r[2]].append((r[0] is not None, r[0] or 0, leaf, other or leaf))
    langs = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    trees = [slow_levels([x[2] for x in sorted(parts[g])]) for g in langs]
    top = slow_levels([t[-1][0] for t in trees])
    out = []
    for g, (lang, levels) in enumerate(zip(langs, trees)):
        for i, (known, doc, leaf, h) in enumerate(sorted(parts[lang])):
            beside = []
            for at, steps in ((i, levels[:-1]), (g, top[:-1])):
                for nodes in steps:
                    run = nodes[at // 8 * 8:at // 8 * 8 + 8]
                    beside += run[:at % 8] + run[at % 8 + 1:]
                    run[at % 8] = h
                    h, at = sha(*run), at // 8
            out.append((doc if known else None, leaf, levels[-1][0], top[-1][0], sha(*beside), h, h == top[-1][0]))
    return out


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def run(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in merkle.manifest(df, merkle.third_of_ids).collect()), key=repr)


@pytest.mark.parametrize("counts", [{"en": 1}, {"a": 65, "b": 513, "": 8, None: 1, "d": 9}, {f"l{i}": 2 for i in range(70)}])
def test_against_plain_tree(spark, counts):
    rnd, rows, i = random.Random(len(counts)), [], 0
    for lang, n in counts.items():
        for _ in range(n):
            rows.append((i, rnd.choice(["s", "ü", None]), lang, rnd.choice([None, 5, -7]), rnd.choice([None, "", "Abc É", "low", "1:x" * 50])))
            i += 1
    rnd.shuffle(rows)
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(3)) == sorted(slow_manifest(rows), key=repr)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "s", None, 1, "X"), (None, "s", None, 1, "X"), (3, "s", "en", 1, "A" * 300_000), (3, "s", "en", 1, "B"), (3, "s", "en", 1, "B"), (-4, "", "", 0, ""), (6, "s", "en", 2, "é\n Q")]
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA + ", f0 string, idx int, part int, n int")
    assert run(df) == sorted(slow_manifest(rows), key=repr)
    assert run(df.filter("false")) == []


def test_tampering_is_found(spark):
    df = spark.createDataFrame([(i, "s", "en", 3, "Abc" if i % 2 else "abc") for i in range(200)], SCHEMA)
    got = {r.doc_id: r.verified for r in merkle.manifest(df, merkle.third_of_ids).collect()}
    assert {i for i, ok in got.items() if not ok} == {i for i in range(200) if i % 2 and zlib.crc32(str(i).encode()) % 3 == 0}
    assert all(r.verified for r in merkle.manifest(df).collect())
