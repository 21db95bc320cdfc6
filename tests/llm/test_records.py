"""Binary records and token counts: round trips, damage, and the library's own results."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scanloom.llm import binary_records as R
from scanloom.llm import queries, token_counts
from scanloom.session import scratch

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = [" ", " ", "  ", "\n", "\t", "\xa0", "\x85", " ", "\x1c", "a", "B", "é", "é", "'s", "'ll", "1", "22", "!", "<|endoftext|>", "<|startoftext|>", "̈", "Σ", "ß", "漢", "\x00", "...", "​", "don't"]


@pytest.fixture(scope="module")
def odd():
    rnd = random.Random(8)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(14))) for _ in range(6000)]


def test_pieces_encode_like_whole_texts(odd, monkeypatch):
    tok = Tokenizer.from_file(BYTE)
    want = [tok.encode(t, add_special_tokens=False).ids for t in odd]
    assert [list(i) for i in R.encode(odd, BYTE, None)] == want
    monkeypatch.setattr(R, "PIECES", 50)
    R._known.cache_clear()
    assert [list(i) for k in range(0, len(odd), 700) for i in R.encode(odd[k:k + 700], BYTE, 2)] == [w + [2] for w in want]
    R._known.cache_clear()


def test_lengths_like_whole_texts(odd):
    tok = Tokenizer.from_file(WORD)
    want = [len(tok.encode(t, add_special_tokens=False)) for t in odd]
    for limit in (1, 5, 1 << 20):
        assert list(token_counts.lengths(odd, WORD, limit)) == want


def test_queries(spark):
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(d + "/documents.parquet").collect()}
    got, start = {r.doc_id: r for r in queries.queries()["op1_binary_records"](spark, d).collect()}, 0
    byte, word = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
    for i in sorted(docs):
        ids = byte.encode(docs[i], add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    for r in queries.queries()["op4_token_counts"](spark, d).collect():
        n = len(word.encode(docs[r.doc_id], add_special_tokens=False))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 2048)


def test_files(spark, monkeypatch, tmp_path):
    """Files roll over, shuffled reads find their records, damage is noticed."""
    monkeypatch.setattr(R, "FILE_BYTES", 400)
    rows = [(i, "word " * (i % 40), "x") for i in range(300)] + [(None, None, "x"), (7, "again", "x"), (7, "", "x"), (1 << 40, "b " * 200000, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, file string")
    root = scratch(spark, "test-records")
    index = R.write(docs, root, BYTE, 2, partitions=3)
    tok = Tokenizer.from_file(BYTE)
    want = sorted((str(i), tok.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.ids) for r in R.read(index, root).collect()) == want
    part = index.filter("doc_id % 10 = 3").orderBy("n_bytes")
    assert sorted(r.doc_id for r in R.read(part, root).collect()) == list(range(3, 300, 10))
    ordered = R.digests(index, root).orderBy("start").collect()
    assert [r.doc_id for r in ordered if r.doc_id is not None] == sorted(i for i, _, _ in rows if i is not None) and ordered[0].doc_id is None
    assert all(b.start == a.start + a.n_tokens for a, b in zip(ordered, ordered[1:]))
    row = index.filter("doc_id = 33").first()
    path = f"{root.removeprefix('file:')}/{row.file}"
    blob = bytearray(open(path, "rb").read())
    assert struct.unpack_from("<Q", blob, row.offset)[0] == row.n_bytes and blob[:7] == R.MAGIC and blob[7] == 2
    blob[row.offset + 14] ^= 1
    open(path, "wb").write(blob)
    with pytest.raises(Exception, match="damaged record"):
        R.read(index, root).count()
    empty = scratch(spark, "test-records")
    assert R.digests(R.write(docs.filter("false"), empty, BYTE, 2), empty).collect() == []


def test_counts_odd_inputs(spark):
    rows = [(1, None, 5), (2, "", 5), (None, "one two", 5), (3, "a" * 30000, 5), (3, "w " * 3000, 5)]
    got = token_counts.count_tokens(spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int"), WORD, 2048)
    tok = Tokenizer.from_file(WORD)
    want = [(i, len(t or ""), len(tok.encode(t or "", add_special_tokens=False))) for i, t, _ in rows]
    assert sorted(map(str, [(r.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()])) == sorted(map(str, want))
    assert {r.doc_id for r in got.filter("over_limit").collect()} == {3}
    assert got.filter("false").collect() == []


def test_pieces_are_told_apart_by_bytes(monkeypatch):
    """Without the library's offsets, which cost time, and with them where ids don't stand for their bytes."""
    texts = [" one  two three é 漢字 <|endoftext|> x" * 50 + "".join(f" w{i}" for i in range(500))]
    want = Tokenizer.from_file(BYTE).encode(texts[0], add_special_tokens=False).ids
    R._known.cache_clear()
    known = R._known(BYTE)
    assert (known.width[want].sum(), list(R.encode(texts, BYTE, None)[0])) == (len(texts[0].encode()), want)
    R._known.cache_clear()
    known = R._known(BYTE)
    known.width[:] = 1
    assert list(R.encode(texts, BYTE, None)[0]) == want
    R._known.cache_clear()
