"""Token sequences of a block of documents as 64-bit keys of words, pairs and trigrams.

A block holds the tokens of some documents once; their shapes follow from the words.  A
key is a hash of kind (words or shapes), language and tokens.  Two of n keys meet by
chance with odds of about n * n / 2 ** 65, 0.3 for three billion distinct ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs

from scanloom.llm.shapes import marked, shapes, word

#: Tokens 0 to 4 of every block.
SIGNS = ["<", ">", "/", "~", "="]
#: Words and shapes are kinds of their own.
KINDS = ("w", "s")
#: Counts that a key collects: of each of three models (all, two halves) the sum of the
#: counts in its context, how many are 1 and 2, how many there are; then its own counts.
SUMS = 15


class Ids(dict):
    def __missing__(self, w: str) -> int:
        n = self[w] = len(self) + len(SIGNS)
        return n


def pack(a: np.ndarray) -> bytes:
    """Integers byte by byte of their places, compressed."""
    return pa.compress(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes(), "zstd", asbytes=True) if a.size else b""


def unpack(data: bytes, kind: str, n: int) -> np.ndarray:
    kind = np.dtype(kind)
    raw = pa.decompress(data, n * kind.itemsize, "zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()


def hashes(names: list[str]) -> np.ndarray:
    """SipHash of each string."""
    return pd.util.hash_array(np.array([*names, ""], object)[:-1], categorize=False) if names else np.zeros(0, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _chain(k: np.ndarray) -> np.ndarray:
    """Keys of neighbours."""
    return _mix(_mix(k[:-1] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) + k[1:])


def write_block(texts: list[str]) -> tuple:
    """Tokens of each text; tokens, hashes of words, numbers of their shapes, shapes; how
    many of the words are tokens several times, and how many there are.  Words met once are told by
    one number, as they come in their order."""
    ids, sizes, flat = Ids(), [], []
    for t in texts:
        before = len(flat)
        flat += marked(t, ids.__getitem__, 4, 3, 2)
        sizes.append(len(flat) - before)
    tokens, names = np.array(flat, np.int64), [*SIGNS, *ids]
    n = np.bincount(tokens, minlength=len(names))
    n[:len(SIGNS)] = len(tokens) + 9 - np.arange(len(SIGNS))  # these stay in front
    order = np.argsort(np.where(n == 1, 0, -n), kind="stable")
    several, to = int((n > 1).sum()), np.empty(len(names), np.int64)
    to[order] = np.arange(len(names))
    put = np.minimum(to[tokens], several).astype(np.uint32)
    names = [names[i] for i in order.tolist()]
    form, forms = pd.factorize(np.array(names[:len(SIGNS)] + shapes(names[len(SIGNS):]), object))
    names[len(SIGNS):] = map(word, names[len(SIGNS):])
    return sizes, pack(put), pack(hashes(names)), pack(form.astype(np.uint32)), forms.tolist(), several, len(names)


class Block:
    """Keys of all positions of a block, words first, shapes after them."""

    def __init__(self, row: dict, top: int = 3):
        sizes, names = np.array(row["sizes"], np.int64), sorted(set(row["langs"]))
        put = unpack(row["tokens"], "<u4", int(sizes.sum())).astype(np.int64)
        once = np.flatnonzero(put == row["several"])
        put[once] += np.arange(len(once))
        full = sizes + 3
        ends = np.cumsum(full) - 1
        starts, mask = ends + 1 - full, np.ones(int(full.sum()), bool)
        seq = np.zeros(len(mask), np.int64)
        mask[starts] = mask[starts + 1] = mask[ends] = False
        seq[mask], seq[ends] = put, 1
        at = {l: i for i, l in enumerate(names)}
        lang = np.array([at[l] for l in row["langs"]], np.int64)
        self.docs, self.models = len(sizes), [k + l for k in KINDS for l in names]
        tables = [unpack(row["words"], "<u8", row["n_words"]), hashes(row["forms"])[unpack(row["form"], "<u4", row["n_words"])]]
        seeds = hashes(["model " + m for m in self.models])
        doc = np.repeat(np.arange(self.docs), full)
        #: Document (counted on for shapes) and model of each position.
        self.doc = np.concatenate([doc, doc + self.docs])
        self.model = np.concatenate([lang, lang + len(names)])[self.doc]
        self.key = {1: _mix(np.concatenate([t[seq] for t in tables]) + seeds[self.model])}
        for order in range(2, top + 1):
            self.key[order] = _chain(self.key[order - 1])
        last = np.zeros(len(self.doc), bool)
        ends = np.concatenate([ends, ends + len(doc)])
        last[ends] = True
        self.at = {1: np.arange(len(last)), 2: np.flatnonzero(~last)}
        last[ends - 1] = True
        self.at[3] = np.flatnonzero(~last)
        self._found = {}

    def distinct(self, order: int, at: np.ndarray | None = None):
        """Sorted distinct keys, a position of each, and the row of every position."""
        if at is None and order in self._found:
            return self._found[order]
        every = self.at[order] if at is None else at
        code, keys = pd.factorize(self.key[order][every])
        by = np.argsort(keys)
        to = np.empty(len(keys), np.int32)
        to[by] = np.arange(len(keys), dtype=np.int32)
        rows, where = np.zeros(len(self.doc), np.int32), np.empty(len(keys), np.int32)
        rows[every] = to[code]
        where[rows[every]] = every
        found = keys[by], where, rows
        if at is None:
            self._found[order] = found
        return found


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def requests(block: Block, replies: dict, halves: np.ndarray, order: int, shards: int, part: int, parts: int):
    """(shard, keys, counts) for the shards of a part: counts of trigrams in trusted
    documents of each half, or what the owned keys of the next order add to context and
    suffix."""
    if order == 3:
        at = block.at[3]
        keys, _, rows = block.distinct(3, at[shard_of(block.key[3][at], shards) % parts == part])
        own = halves[block.doc[at] % block.docs] if block.docs else np.zeros(0, np.int64)
        sums = np.zeros((2, len(keys)), np.int32)
        for h in (0, 1):
            p = at[own == h]
            p = p[shard_of(block.key[3][p], shards) % parts == part]
            sums[h] = np.bincount(rows[p], minlength=len(keys))
    else:
        _, where, _ = block.distinct(order + 1)
        keys, _, rows = block.distinct(order)
        given = replies[order + 1]
        mine = np.flatnonzero(given[-1])
        sums = np.zeros((SUMS, len(keys)), np.int32)
        for m in range(3):
            n = counts(given, order + 1, m, mine)
            here = n > 0
            n, p = n[here], where[mine[here]]
            for j, w in enumerate((n, n == 1, n == 2, n > 0)):
                sums[4 * m + j] = np.bincount(rows[p], weights=w, minlength=len(keys))
            sums[12 + m] = np.bincount(rows[p + 1], minlength=len(keys))
    shard = shard_of(keys, shards)
    edges = np.searchsorted(shard, np.arange(shards + 1))
    for s in np.unique(shard[shard % parts == part]).tolist():
        lo, hi = edges[s], edges[s + 1]
        yield s, keys[lo:hi], sums[:, lo:hi]


def counts(given: np.ndarray, order: int, m: int, rows) -> np.ndarray:
    """Own counts of keys under the model ``m``."""
    if order == 3:
        return given[0][rows] + given[1][rows] if m == 0 else given[m - 1][rows]
    return given[12 + m][rows]


def answers(found: list[tuple[np.ndarray, np.ndarray]]):
    """For each block's keys and counts, the sums over all blocks, and a last row that is
    1 where this block is the first to count the key."""
    keys, sums = np.concatenate([k for k, _ in found]), np.concatenate([s for _, s in found], axis=1)
    by = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[by][1:] != keys[by][:-1]
    starts, rows = np.flatnonzero(new), np.empty(len(keys), np.int64)
    rows[by] = np.cumsum(new) - 1
    total = [np.add.reduceat(s[by], starts, dtype=np.int64) for s in sums]
    first = np.minimum.reduceat(np.where(sums.any(axis=0), np.arange(len(keys)), len(keys))[by], starts)
    kind = np.dtype("<u4") if max(t.max() for t in total) < 1 << 32 else np.dtype("<u8")
    lo = 0
    for k, _ in found:
        r = rows[lo:lo + len(k)]
        yield np.stack([*(t[r] for t in total), first[r] == np.arange(lo, lo + len(k))]).astype(kind)
        lo += len(k)


def folder(root: str, block: int, columns: list[str]) -> list[dict]:
    """Rows written for a block."""
    fs, base = pafs.FileSystem.from_uri(root)
    path = f"{base}/block={block}"
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return []
    return ds.dataset(path, filesystem=fs, format="parquet").to_table(columns=columns).to_pylist()


def reply(roots: list[str], block: int, order: int) -> np.ndarray:
    rows = sorted((r for root in roots for r in folder(root, block, ["shard", "n", "width", "sums"])), key=lambda r: r["shard"])
    c = (2 if order == 3 else SUMS) + 1
    return np.concatenate([unpack(r["sums"], f"<u{r['width']}", c * r["n"]).reshape(c, -1).astype(np.int64 if r["width"] > 4 else np.uint32) for r in rows], axis=1)
