"""Language identification against plain sets of n-grams, and its held-out accuracy."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from scanloom.llm import lang_id as L

D = "/root/testdata/sf0.01/documents.parquet"


def plain_grams(text):
    s = " " + " ".join("".join(c if c.isalpha() else " " for c in text.casefold()).split()) + " "
    return [(n, s[i:i + n]) for n in L.ORDERS for i in range(len(s) - n + 1)] if s.strip() else []


def plain_sets(rows, share):
    found = defaultdict(Counter)
    for i, text, lang in rows:
        if i is not None and lang is not None and text and zlib.crc32(str(i).encode()) % 5:
            found[lang].update(plain_grams(text))
    total = {(g, n): sum(k for (m, _), k in c.items() if m == n) for g, c in found.items() for n in L.ORDERS}
    return {g: {x for x, k in c.items() if k >= share * total[g, x[0]]} for g, c in found.items()}


def test_pieces_have_the_grams_of_the_whole():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab  c1é.") for _ in range(rnd.randrange(60))) for _ in range(200)] + ["", "...", "a"]
    for text in texts:
        whole = Counter(int(k) for _, by in L.grams([text]) for v in by.values() for k in v)
        assert sum(whole.values()) == (len(plain_grams(text)) if any(map(str.isalpha, text)) else 0)
        assert len(whole) == len(set(plain_grams(text)))
        for limit in (1, 2, 3, 7):
            assert Counter(int(k) for _, by in L.grams([text], limit) for v in by.values() for k in v) == whole


def test_filters_hold_every_language_of_every_gram(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(D).select("doc_id", "text", "lang").collect()]
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    langs, filters = L.learn(spark.createDataFrame([(r[2], r[1]) for r in learned], "lang string, text string"))
    sets = plain_sets(rows, L.SHARE)
    assert set(langs) == set(sets) and len(filters) == 1
    keys = {}
    for _, text, _ in rows[:200]:
        flat = [int(k) for _, by in L.grams([text or ""]) for v in by.values() for k in v]
        keys.update(zip(plain_grams(text or ""), flat))
    masks = L.contained(np.array(list(keys.values()), np.uint64), filters[0]["rows"])[:, 0]
    for i, lang in enumerate(filters[0]["names"]):
        has = {g for g, m in zip(keys, masks) if int(m) >> i & 1}
        real = {g for g in keys if g in sets[lang]}
        assert real <= has and len(has - real) <= 10 + 3 * filters[0]["chance"][i] * len(keys)


def test_against_plain_sets_and_held_out_languages(spark):
    df = spark.read.parquet(D)
    rows = [(r.doc_id, r.text, r.lang) for r in df.select("doc_id", "text", "lang").collect()]
    got = {r.doc_id: r for r in L.predict(df).collect()}
    assert len(got) == len(rows)
    sets = plain_sets(rows, L.SHARE)
    same = right = out = 0
    for i, text, lang in rows:
        g = plain_grams(text or "")
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= got[i].score <= 1
        if not g:
            assert got[i].lang_pred == "und" and got[i].score == 0
            continue
        n = {k: sum(x in s for x in g) for k, s in sets.items()}
        same += n[got[i].lang_pred] >= max(n.values()) - 0.01 * len(g)
        if got[i].held_out:
            out += 1
            right += got[i].lang_pred == lang
    assert same >= 0.995 * len(rows) and right >= 0.98 * out


def test_odd_rows(spark):
    en, de = "the cat and the dog went over the hill ", "der hund und die katze gingen nach hause "
    ids = [i for i in range(1, 200) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, en * 3, "en", 1) for i in ids[:20]] + [(i, de * 3, "de", 1) for i in ids[20:60]]
    rows += [(None, en, "en", 1), (None, None, None, 1), (500, "", None, 1), (501, "12 !", "en", 1), (502, "zzqx", None, 1), (502, "zzqx", None, 1), (503, "DER HUND", "en", 1), (504, (en + "x" * 50) * 60_000, None, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, id int")
    out = L.predict(df).collect()
    assert len(out) == len(rows)
    got = defaultdict(list)
    for r in out:
        got[r.doc_id].append(r)
    assert sorted((r.lang_pred, r.held_out) for r in got[None]) == [("en", False), ("und", False)]
    assert got[500][0].lang_pred == got[501][0].lang_pred == "und"
    assert [r.lang_pred for r in got[502]] == ["de", "de"] and got[502][0].score == 0
    assert got[503][0].lang_pred == "de" and got[504][0].lang_pred == "en" and got[504][0].score > 0.8
    assert L.predict(df.filter("false")).collect() == []
    assert {(r.lang_pred, r.score) for r in L.predict(df.withColumn("lang", df.lang.substr(9, 1)).filter("false").union(df.selectExpr("doc_id", "text", "cast(null as string)", "id"))).collect()} == {("und", 0.0)}


def test_more_languages_than_one_filter_holds(spark, monkeypatch):
    monkeypatch.setattr(L, "LANGUAGES", 2)
    rnd = random.Random(1)
    words = {f"l{k}": ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(8)] for k in range(5)}
    rows = [(i, " ".join(rnd.choice(words[f"l{i % 5}"]) for _ in range(30)), f"l{i % 5}") for i in range(200)]
    got = L.predict(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    assert all(r.lang_pred == f"l{r.doc_id % 5}" and 0.5 < r.score <= 1 for r in got)
