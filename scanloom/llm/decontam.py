"""Benchmark decontamination: a BM25 inverted index of the test items, queried with every
passage of every document.

An item's impacts (BM25 contributions of its terms) are divided by their sum, so a passage
that has all terms of an item scores 1.  Passages are windows of twice the longest item
of the index, half overlapping, so any stretch as long as an item lies whole in one.  All
items at or above ``min_score`` are retrieved, by upper bounds that never lose one:

- terms that together cannot give an item more than ``SLACK`` are left out of the first
  bound (for a fixed threshold this is WAND's pivot test), which sums each term's largest
  impact over the window;
- windows that pass are tested against the block maxima of the posting lists, and only
  blocks of items whose bound reaches the threshold are opened and scored.

What is retrieved is verified, question and answer apart, by the greater of two shares:
that of the part's five-word shingles which the passage has, and one less the word edits
(insert, leave out, replace) from the part to the nearest stretch of the passage over the
part's length.  One changed word breaks five shingles, so for short parts the edits find
what the shingles lose.  The answer is an item's last sentence; an item of one sentence
is all question.

The index is made from the benchmark in blocks of about ``ITEMS`` items and ``ITEM_BYTES``
bytes of text, each broadcast on its own and bounded by these numbers, and the documents
are read once a block.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.llm import common
from scanloom.llm.common import text_of

K1, B = 1.2, 0.75
MIN_SCORE, MIN_OVERLAP, WORDS = 0.6, 0.8, 5
#: Items of one index, items of one block of its lists, and what the terms of the second rank may add up to.
ITEMS, BLOCK, SLACK = 20_000, 16, 0.1
#: Bytes of text of the items of one index.
ITEM_BYTES = 16 << 20
#: Bytes of text whose windows are held at once.
STEP_BYTES = 1 << 20
_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingles(words: list[str]) -> set:
    """Shingles of WORDS words; fewer words are one shingle, none give none."""
    return {tuple(words[i:i + WORDS]) for i in range(max(1, len(words) - WORDS + 1))} if words else set()


def question_answer(text: str) -> tuple[list[str], list[str]]:
    cut = [words_of(s) for s in re.split(r"(?<=[.!?])\s+", text)]
    cut = [s for s in cut if s]
    if len(cut) < 2:
        return (cut[0] if cut else []), []
    return [w for s in cut[:-1] for w in s], cut[-1]


def resemblance(part: list[str], words: list[str]) -> float:
    """1 - edits / length, where edits are the least word edits from ``part`` to a stretch of ``words``."""
    ids = {w: k for k, w in enumerate(dict.fromkeys(part))}
    row = np.array([ids.get(w, -1) for w in words], np.int64)
    at = np.arange(len(row) + 1)
    cost = np.zeros(len(row) + 1, np.int64)  # a stretch may begin anywhere
    for w in part:
        step = np.append(cost[0] + 1, np.minimum(cost[1:] + 1, cost[:-1] + (row != ids[w])))
        cost = np.minimum.accumulate(step - at) + at  # words of the passage that the part lacks
    return 1 - int(cost.min()) / len(part)


class Index:
    """Posting lists of one block of items; plain arrays, so that it is small to send."""

    def __init__(self, items: list[tuple]):
        self.ids = [i for i, _ in items]
        self.texts = [question_answer(t) for _, t in items]
        self.parts = [tuple(shingles(p) for p in t) for t in self.texts]
        docs = [words_of(t) for _, t in items]
        # an altered copy may be a fifth longer than its item, by MIN_OVERLAP
        self.step = max([32, *(-(-6 * len(d) // 5) for d in docs)])
        self.term: dict[str, int] = {}
        counts = []
        for n, d in enumerate(docs):
            own: dict[int, int] = {}
            for w in d:
                k = self.term.setdefault(w, len(self.term))
                own[k] = own.get(k, 0) + 1
            counts += [(k, n, tf) for k, tf in own.items()]
        term, item, tf = (np.array(c, np.int64) for c in (zip(*counts) if counts else ([], [], [])))
        v, n = len(self.term), max(1, len(docs))
        df = np.bincount(term, minlength=v)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        size = np.array([len(d) for d in docs], float)
        norm = K1 * (1 - B + B * size / max(1.0, size.mean() if len(size) else 1.0))
        w = idf[term] * tf * (K1 + 1) / (tf + norm[item]) if len(term) else np.zeros(0)
        w = w / np.bincount(item, w, minlength=n)[item] if len(term) else w
        order = np.lexsort((item, term))
        self.item, self.weight, term = item[order], w[order], term[order]
        self.start = np.concatenate([[0], np.cumsum(df)])
        self.top = np.zeros(v)
        np.maximum.at(self.top, term, self.weight)
        # block maxima: a list of (block, largest impact in it) for each term
        self.blocks = (n + BLOCK - 1) // BLOCK
        key, at = np.unique(term * self.blocks + self.item // BLOCK, return_inverse=True)
        self.block, self.block_top = key % self.blocks, np.zeros(len(key))
        np.maximum.at(self.block_top, at, self.weight)
        self.block_start = np.concatenate([[0], np.cumsum(np.bincount(key // self.blocks, minlength=v))])
        # second rank: frequent terms, as long as no item gets more than SLACK from all of them
        self.second, got = np.zeros(v, bool), np.zeros(n)
        for t in np.argsort(-df, kind="stable").tolist():
            lo, hi = self.start[t], self.start[t + 1]
            add = got[self.item[lo:hi]] + self.weight[lo:hi]
            if add.max(initial=0) > SLACK:
                break
            got[self.item[lo:hi]] = add
            self.second[t] = True
        self.second_top = float(got.max(initial=0))


def _spread(start: np.ndarray, term: np.ndarray):
    """Positions of all list entries of the terms, and which term each is of."""
    n = start[term + 1] - start[term]
    of = np.repeat(np.arange(len(term)), n)
    return np.repeat(start[term] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()), of


def retrieve(ix: Index, docs: list[list[str]], min_score: float):
    """(document, first word of the passage, item, score) of all passages and items at or above the score."""
    size = np.array([len(d) for d in docs], np.int64)
    wins = np.maximum(1, -(-(size - ix.step) // ix.step))  # windows of a document: [k step, (k + 2) step)
    first = np.concatenate([[0], np.cumsum(wins)])
    get = ix.term.get
    ids = np.fromiter((get(w, -1) for d in docs for w in d), np.int64, int(size.sum()))
    doc = np.repeat(np.arange(len(docs)), size)
    at = np.arange(len(ids)) - np.repeat(np.cumsum(size) - size, size)
    known = np.nonzero(ids >= 0)[0]
    term, doc, at = ids[known], doc[known], at[known] // ix.step
    later, earlier = at < wins[doc], at > 0
    win = np.concatenate([(first[doc] + at)[later], (first[doc] + at - 1)[earlier]])
    term = np.concatenate([term[later], term[earlier]])
    prime = ~ix.second[term]
    bound = np.bincount(win[prime], ix.top[term[prime]], minlength=int(first[-1]))
    open_ = (bound >= min_score - ix.second_top - 1e-9)[win]
    if not open_.any():
        return []
    key = np.unique(win[open_] * len(ix.term) + term[open_])
    win, term = key // len(ix.term), key % len(ix.term)
    # block maxima
    where, of = _spread(ix.block_start, term)
    cell, back = np.unique(win[of] * ix.blocks + ix.block[where], return_inverse=True)
    good = cell[np.bincount(back, ix.block_top[where]) >= min_score - 1e-9]
    if not len(good):
        return []
    keep = np.isin(win, good // ix.blocks)
    win, term = win[keep], term[keep]
    where, of = _spread(ix.start, term)
    keep = np.isin(win[of] * ix.blocks + ix.item[where] // BLOCK, good)
    where, of = where[keep], of[keep]
    n = len(ix.ids)
    pair, back = np.unique(win[of] * n + ix.item[where], return_inverse=True)
    score = np.bincount(back, ix.weight[where])
    hit = score >= min_score - 1e-9
    w, i = pair[hit] // n, pair[hit] % n
    d = np.searchsorted(first, w, side="right") - 1
    return list(zip(d.tolist(), ((w - first[d]) * ix.step).tolist(), i.tolist(), score[hit].tolist()))


def matches(ix: Index, docs: list[list[str]], min_score: float, min_overlap: float) -> dict:
    """(document, item) -> (score, question overlap, answer overlap) of the best verified passage."""
    best: dict = {}
    for d, lo, i, score in retrieve(ix, docs, min_score):
        have = shingles(docs[d][lo:lo + 2 * ix.step])
        words, answer = docs[d][lo:lo + 2 * ix.step], ix.parts[i][1]
        short = [s for p in ix.parts[i] for s in p if len(s) < WORDS]
        for s in short:
            have.update(tuple(words[k:k + len(s)]) for k in range(len(words) - len(s) + 1))
        q, a = (len(p & have) / len(p) if p else 1.0 for p in ix.parts[i])
        # a word that the passage lacks is an edit at least
        known = set(words)
        likely = [sum(w in known for w in t) >= min_overlap * len(t) for t in ix.texts[i]]
        if likely[0] and likely[1]:
            if q < min_overlap:
                q = max(q, resemblance(ix.texts[i][0], words))
            if q >= min_overlap > a:
                a = max(a, resemblance(ix.texts[i][1], words))
        if q >= min_overlap and a >= min_overlap:
            best[d, i] = max(best.get((d, i), (0.0, 0.0, 0.0)), (score, q, a if answer else 1.0))
    return best


def indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text", per_index: int = ITEMS):
    """Indexes over blocks of about ``per_index`` items and ``ITEM_BYTES``, one after the other; a
    block is all that the driver holds.  Items without words are in no index."""
    items = items.select(F.col(id_col).alias("item_id"), text_of(text_col).alias("text"))
    n, size = items.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    blocks = max(-(-n // per_index), -(-size // ITEM_BYTES), 1) if n else 0
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).sort("item_id", "text")
        rows = [(r.item_id, r.text) for r in part.collect() if words_of(r.text)]
        if rows:
            yield Index(rows)


def leaks(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE, min_overlap: float = MIN_OVERLAP, id_col: str = "doc_id", text_col: str = "text", per_index: int = ITEMS) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: one row for each row of
    ``docs`` and each row of ``items`` that it holds, with its best passage.

    Case, punctuation and white space do not count.  Null texts have no words and
    match nothing; null and repeated ids keep their rows; empty tables give no rows; other
    columns are not read.  Whole texts are read and nothing is shuffled."""
    spark = docs.sparkSession
    common.small_batches(spark)
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kinds = (base.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString())
    ddl = f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, question_overlap double, answer_overlap double"
    out = None
    for index in indexes(items, per_index=per_index):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            ix = sent.value
            for b in batches:
                ids = b.column(0)
                for lo, hi in common.blocks(pa.compute.binary_length(b.column(1)).to_pylist(), STEP_BYTES):
                    found = sorted(matches(ix, [words_of(t) for t in b.column(1).slice(lo, hi - lo).to_pylist()], min_score, min_overlap).items())
                    if found:
                        rows = ids.take(pa.array([lo + d for (d, _), _ in found]))
                        yield pa.RecordBatch.from_pydict({"doc_id": rows, "item_id": pa.array([ix.ids[i] for (_, i), _ in found], pa.int64() if kinds[1] == "bigint" else None),
                                                          **{c: pa.array([v[k] for _, v in found], pa.float64()) for k, c in enumerate(("score", "question_overlap", "answer_overlap"))}})

        part = base.mapInArrow(run, ddl)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], ddl) if out is None else out


def clean(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE, min_overlap: float = MIN_OVERLAP, text_col: str = "text", per_index: int = ITEMS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item."""
    common.small_batches(docs.sparkSession)
    for index in indexes(items, per_index=per_index):
        sent = docs.sparkSession.sparkContext.broadcast(index)
        place = docs.columns.index(text_col)

        def run(batches, sent=sent, place=place):
            ix = sent.value
            for b in batches:
                texts = b.column(place)
                keep = np.ones(len(texts), bool)
                for lo, hi in common.blocks([n or 0 for n in pa.compute.binary_length(texts).to_pylist()], STEP_BYTES):
                    found = matches(ix, [words_of(t or "") for t in texts.slice(lo, hi - lo).to_pylist()], min_score, min_overlap)
                    keep[[lo + d for d, _ in found]] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
