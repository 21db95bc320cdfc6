"""Digest trees of file sets against plain hashing."""

import hashlib
import os
import random

from scanloom.operators import audit as A
from scanloom.operators import freeze as Z


def sha(b):
    return hashlib.sha256(b).hexdigest()


def slow_tree(body, size, fanout):
    level, out, depth = [sha(body[i:i + size]) for i in range(0, max(1, len(body)), size)], {}, 0
    while True:
        out.update({(depth, k): d for k, d in enumerate(level)})
        if len(level) == 1:
            return out
        level, depth = [sha("".join(level[i:i + fanout]).encode()) for i in range(0, len(level), fanout)], depth + 1


def put(folder, files):
    for name, body in files.items():
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "wb") as f:
            f.write(body)
    return str(folder)


def test_tree_and_changes(spark, tmp_path):
    rnd = random.Random(1)
    files = {"a b.bin": rnd.randbytes(1000), "sub/empty": b"", "sub/one": b"x", "exact": rnd.randbytes(160), "gone": rnd.randbytes(50), "same": rnd.randbytes(333), "grows": rnd.randbytes(90)}
    one = put(tmp_path / "one.d", files)
    whole = {r.path: (r.bytes, r.sha256) for r in A.freeze_manifest(spark, one).collect()}
    assert whole == {p: (len(b), sha(b)) for p, b in files.items()}
    tree = Z.digest_tree(Z.block_digests(spark, one, 16), 3)
    got = {}
    for r in tree.collect():
        got.setdefault(r.path, {})[r.level, r.slot] = r.sha256
        assert r.bytes == len(files[r.path])
    assert got == {p: slow_tree(b, 16, 3) for p, b in files.items()}
    assert {r.path: r.sha256 for r in Z.roots(tree).collect()} == {p: list(slow_tree(b, 16, 3).values())[-1] for p, b in files.items()}

    now = dict(files)
    del now["gone"]
    b = bytearray(now["a b.bin"])
    b[33] ^= 1                                       # block 2 changes
    b[64:80], b[320:336] = b[320:336], b[64:80]      # blocks 4 and 20 change places
    now |= {"a b.bin": bytes(b), "grows": files["grows"] + b"more" * 5, "new": b"new", "elsewhere": files["gone"][16:32]}
    other = Z.digest_tree(Z.block_digests(spark, put(tmp_path / "two", now), 16), 3)
    found = {(r.path, r.block): (r.state, r.from_path, r.from_block) for r in Z.changed_blocks(tree, other).collect()}
    none = (None, None)
    assert found == {("a b.bin", 2): ("changed", *none), ("a b.bin", 4): ("moved", "a b.bin", 20), ("a b.bin", 20): ("moved", "a b.bin", 4),
                     **{("gone", k): ("missing", *none) for k in range(4)}, ("grows", 5): ("changed", *none), ("grows", 6): ("added", *none),
                     ("new", 0): ("added", *none), ("elsewhere", 0): ("moved", "gone", 1)}
    assert Z.changed_blocks(tree, tree).count() == 0


def test_large_file_is_read_by_several_tasks(spark, tmp_path):
    """A sparse file over the 2 GB limit of a row: blocks of one digest, several tasks, no content in the plan."""
    with open(tmp_path / "big", "wb") as f:
        f.truncate((2 << 30) + 5)
    blocks = Z.block_digests(spark, str(tmp_path), 256 << 20)
    assert "content" not in blocks._jdf.queryExecution().executedPlan().toString()
    assert blocks.rdd.getNumPartitions() > 1
    got = {r.block: r.sha256 for r in blocks.collect()}
    assert len(got) == 9 and len(set(got.values())) == 2 and got[8] == sha(b"\0" * 5)
