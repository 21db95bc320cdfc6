"""Merkle manifest of a dataset: a hash tree over its rows, built by equality joins.

Rows are leaves, numbered within their part (here: language).  A level is one table of
nodes; the slot-zero node of every run of ``ARITY`` nodes is joined to the nodes whose
index is its own plus 1, 2, ... on (part, run): all sides are shuffled by the run, each
node once, so the chain of joins keeps that partitioning.  The slot-zero rows then emit
the parents.  A run is one row with the digests of its nodes, so a proof is found on the
way back: the path of a run is that of its parent's run with one step before it, one row
a run and not a document.  Levels are as many as the logarithm of the largest part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import sided
from scanloom.session import cut, drop

#: Nodes of a run; fixed by the format.
ARITY = 8
#: Fields of a leaf in order; fixed by the format.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(*values: Column) -> Column:
    """Hexadecimal SHA-256 of the values: ``-`` for null, else bytes, ``:``, value."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (c.cast("string") for c in values)]
    return F.sha2(F.concat(*parts), 256)


def numbered(df: DataFrame, part: list[str], order: list[str], name: str) -> DataFrame:
    """``df``, written, with ``idx``: 0, 1, ... by ``order`` within ``part`` (nulls first),
    and ``n``, the rows of the part.

    Rows are dealt to sorted ranges of all these columns, so a large part has many; the
    number within a range and one running count a (range, part) make the index.  Rows
    equal in all columns are interchangeable."""
    keys = [*part, *order]
    at = F.monotonically_increasing_id()
    rows = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("sl_at", at).withColumn("sl_range", F.shiftright("sl_at", 33)), name)
    each = rows.groupBy("sl_range", *part).agg(F.min("sl_at").alias("sl_first"), F.count("*").alias("sl_rows"))
    before = ", ".join(part)
    each = each.withColumn("sl_before", F.expr(f"sum(sl_rows) OVER (PARTITION BY {before} ORDER BY sl_range) - sl_rows")).withColumn("n", F.expr(f"sum(sl_rows) OVER (PARTITION BY {before})"))
    each = cut(each.select("sl_range", F.struct(*part).alias("sl_part"), "sl_first", "sl_before", "n"), f"{name}-starts")
    found = rows.join(sided(each), (rows["sl_range"] == each["sl_range"]) & F.struct(*(rows[c] for c in part)).eqNullSafe(each["sl_part"]))
    return found.select(*(rows[c] for c in df.columns), (F.col("sl_before") + F.col("sl_at") - F.col("sl_first")).alias("idx"), "n")


def runs_of(nodes: DataFrame, level: int, name: str) -> DataFrame:
    """Of ``nodes(part, idx, n, digest)`` of parts with several nodes one row a run:
    part, run, digests, parent, n (nodes of the part on the next level)."""
    nodes = nodes.withColumn("run", F.floor(F.col("idx") / ARITY))
    slot = F.pmod("idx", F.lit(ARITY))
    out = nodes.filter(slot == 0).select("part", "run", F.ceil(F.col("n") / ARITY).alias("n"), F.col("digest").alias("d0"))
    for k in range(1, ARITY):
        out = out.join(nodes.filter(slot == k).select("part", "run", F.col("digest").alias(f"d{k}")).hint("merge"), ["part", "run"], "left")
    digests = F.array_compact(F.array(*(f"d{k}" for k in range(ARITY))))
    return cut(out.select("part", "run", digests.alias("digests"), F.sha2(F.concat_ws("", digests), 256).alias("parent"), "n"), f"{name}{level}")


def tree(leaves: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(paths, roots) of ``leaves(part, idx, n, digest)``.

    ``paths(part, run, path)`` has one row for each run of leaves; ``path`` is an array of
    (digests, slot) whose first step is the run itself, without a slot, and whose further
    ones are those of its ancestors.  Parts of one leaf have no run.  ``roots(part, digest)``."""
    levels, nodes, roots = [], leaves, leaves.filter("n = 1").select("part", "digest")
    most = leaves.agg(F.max("n")).first()[0] or 1
    while most > 1:
        most = -(-most // ARITY)
        runs = runs_of(nodes.filter("n > 1"), len(levels), name)
        levels.append(runs)
        nodes = runs.select("part", F.col("run").alias("idx"), "n", F.col("parent").alias("digest"))
        roots = roots.unionByName(nodes.filter("n = 1").select("part", "digest"))
    step = F.struct("digests", F.lit(None).cast("int").alias("slot"))
    paths = None
    for runs in reversed(levels):
        own = runs.select("part", "run", "n", step.alias("own"))
        if paths is None:
            paths = own.select("part", "run", F.array("own").alias("path"))
            continue
        above = paths.select("part", F.col("run").alias("up"), F.col("path").alias("more"))
        joined = own.withColumn("up", F.floor(F.col("run") / ARITY)).join(above.hint("merge"), ["part", "up"], "left")
        first = F.struct(F.col("more")[0]["digests"].alias("digests"), F.pmod("run", F.lit(ARITY)).cast("int").alias("slot"))
        more = F.when(F.col("more").isNotNull(), F.concat(F.array(first), F.slice("more", 2, 64))).otherwise(F.array().cast("array<struct<digests:array<string>,slot:int>>"))
        paths = joined.select("part", "run", F.concat(F.array("own"), more).alias("path"))
    if paths is None:
        paths = leaves.filter("false").select("part", F.col("idx").alias("run"), F.array(F.struct(F.array("digest").alias("digests"), F.lit(None).cast("int").alias("slot"))).alias("path"))
    return paths, roots


def on_paths(rows: DataFrame, paths: DataFrame) -> DataFrame:
    """``rows(part, idx, ...)`` with ``path``, an array of (digests, slot) from their own
    run to the root; empty where the part is one leaf."""
    rows = rows.withColumn("run", F.floor(F.col("idx") / ARITY))
    joined = rows.join(paths.hint("merge"), ["part", "run"], "left")
    first = F.struct(F.col("path")[0]["digests"].alias("digests"), F.pmod("idx", F.lit(ARITY)).cast("int").alias("slot"))
    whole = F.when(F.col("path").isNotNull(), F.concat(F.array(first), F.slice("path", 2, 64))).otherwise(F.array().cast("array<struct<digests:array<string>,slot:int>>"))
    return joined.withColumn("path", whole).drop("run")


def siblings(path: Column) -> Column:
    """The digests beside the path, level by level and left to right, as one text."""
    return F.concat_ws("", F.flatten(F.transform(path, lambda s: F.concat(F.slice(s["digests"], F.lit(1), s["slot"]), F.slice(s["digests"], s["slot"] + 2, F.lit(ARITY))))))


def folded(digest: Column, path: Column) -> Column:
    """The root that ``digest`` and the digests beside its path give."""
    def up(d, s):
        return F.sha2(F.concat_ws("", F.slice(s["digests"], F.lit(1), s["slot"]), d, F.slice(s["digests"], s["slot"] + 2, F.lit(ARITY))), 256)
    return F.aggregate(path, digest, up)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def manifest(df: DataFrame, tampered: Callable[[dict[str, Column]], Column] | None = None, id_col: str = "doc_id", part_col: str = "lang", text_col: str = "text", fields: tuple[str, ...] = FIELDS, tamper=lower_ascii) -> DataFrame:
    """One row a row of ``df``: id, part, leaf, subroot, root, proof_sha256, folded_root,
    verified.

    ``tampered`` makes of the fields (columns by name) the rule which rows are checked
    with ``tamper(text)`` in place of their text (null texts and null rules: with their own);
    ``folded_root`` is the root that their leaf and the untampered digests beside its path give.

    Nulls are values of their own in any column; rows with null ids come first in their
    part, equal ids are ordered by their leaves, so repeated rows are leaves side by side.
    Empty texts are not null.  An empty table gives no rows; columns that are not in
    ``fields`` are not read, whatever their names."""
    source = df.select(*(df[c].alias(f"f{i}") for i, c in enumerate(fields)))
    col = {c: F.col(f"f{i}") for i, c in enumerate(fields)}
    values = [col[c] for c in fields]
    changed = [tamper(col[c]) if c == text_col else col[c] for c in fields]
    flag = F.lit(False) if tampered is None else F.coalesce(tampered(col), F.lit(False))
    leaves = source.select(col[id_col].alias("id"), col[part_col].alias("part_value"), leaf_digest(*values).alias("leaf"), F.when(flag & col[text_col].isNotNull(), leaf_digest(*changed)).alias("other"))
    ranked = numbered(leaves, ["part_value"], ["id", "leaf"], "leaves")
    # Parts by number: joins need no null-safe keys, and the order of the roots is theirs.
    parts = numbered(ranked.select("part_value").distinct().withColumn("one", F.lit(0)), ["one"], ["part_value"], "parts")
    named = cut(parts.select("part_value", F.col("idx").alias("part"), F.col("n").alias("parts")), "named")
    leaves = cut(ranked.join(sided(named), ranked["part_value"].eqNullSafe(named["part_value"])).select("id", ranked["part_value"], "part", "idx", "n", "leaf", "other"), "indexed")
    drop(ranked, parts)

    paths, roots = tree(leaves.select("part", "idx", "n", F.col("leaf").alias("digest")), "nodes")
    roots = cut(roots.select("part", F.col("digest").alias("subroot")), "roots")
    tops = roots.join(sided(named), "part").select(F.lit(0).alias("part"), F.col("part").alias("idx"), F.col("parts").alias("n"), F.col("subroot").alias("digest"))
    up, top = tree(tops, "subroots")
    top = top.select(F.col("digest").alias("root"))
    above = roots.select(F.lit(0).alias("part"), F.col("part").alias("idx"), "subroot")
    above = cut(on_paths(above, up).select(F.col("idx").alias("part"), "subroot", F.col("path").alias("up")).join(F.broadcast(top)), "above")

    proven = on_paths(leaves, paths).join(sided(above), "part")
    whole = F.concat("path", "up")
    out = proven.select("id", "part_value", "leaf", "subroot", "root", F.sha2(siblings(whole), 256).alias("proof_sha256"), folded(F.coalesce("other", "leaf"), whole).alias("folded_root"))
    return out.select(F.col("id").alias(id_col), F.col("part_value").alias(part_col), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def third_of_ids(col: dict[str, Column]) -> Column:
    """Whether 3 divides the CRC-32 of the decimal id."""
    return F.pmod(F.crc32(col["doc_id"].cast("string")), F.lit(3)) == 0


#: DuckDB's text of the query; CRC-32 bit by bit.
SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, source, lang, n_chars, text, CASE WHEN text IS NOT NULL AND doc_id IS NOT NULL AND
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, strlen(doc_id::varchar) + 1), lambda i: ascii(substr(doc_id::varchar, i::int, 1))::bigint)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::bigint) ELSE r // 2 END)), 4294967295::bigint) % 3 = 0
    THEN translate(text, '{UPPER}', '{LOWER}') END AS changed FROM documents),
p AS (SELECT *, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') AS head FROM d),
l AS MATERIALIZED (SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  CASE WHEN changed IS NOT NULL THEN sha256(head || strlen(changed) || ':' || changed) END AS other FROM p),
i AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS part, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM l),
nodes(level, part, idx, n, h) AS (SELECT 0, part, idx, n, leaf FROM i
  UNION ALL SELECT level + 1, part, idx // {ARITY}, max(n + {ARITY - 1}) // {ARITY}, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY level, part, idx // {ARITY}),
roots AS MATERIALIZED (SELECT part, h AS subroot FROM nodes WHERE n = 1),
tops(level, idx, n, h) AS (SELECT 0, part, (SELECT count(*) FROM roots), subroot FROM roots
  UNION ALL SELECT level + 1, idx // {ARITY}, max(n + {ARITY - 1}) // {ARITY}, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, idx // {ARITY}),
height AS (SELECT part, max(level) AS h FROM nodes GROUP BY part),
runs AS MATERIALIZED (SELECT level, part, idx // {ARITY} AS run, list(h ORDER BY idx) AS hs FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT height.h + t.level, height.part, t.run, t.hs FROM height, (SELECT level, idx // {ARITY} AS run, list(h ORDER BY idx) AS hs FROM tops WHERE n > 1 GROUP BY ALL) t),
walk(doc_id, part, first, level, idx, h, sibs) AS (SELECT doc_id, part, idx, 0, CASE WHEN n = 1 THEN part ELSE idx END, coalesce(other, leaf), '' FROM i
  UNION ALL SELECT w.doc_id, w.part, w.first, w.level + 1, CASE WHEN w.level + 1 = height.h THEN w.part ELSE w.idx // {ARITY} END,
    sha256(array_to_string(r.hs[1:w.idx % {ARITY}] || [w.h] || r.hs[w.idx % {ARITY} + 2:], '')), w.sibs || array_to_string(r.hs[1:w.idx % {ARITY}] || r.hs[w.idx % {ARITY} + 2:], '')
    FROM walk w JOIN height USING (part) JOIN runs r ON r.level = w.level AND r.part = w.part AND r.run = w.idx // {ARITY}),
ends AS (SELECT part, first, arg_max(h, level) AS folded_root, sha256(arg_max(sibs, level)) AS proof_sha256 FROM walk GROUP BY part, first)
SELECT i.doc_id, i.leaf, roots.subroot, t.h AS root, e.proof_sha256, e.folded_root, e.folded_root = t.h AS verified
FROM i JOIN ends e ON e.part = i.part AND e.first = i.idx JOIN roots ON roots.part = i.part, tops t WHERE t.n = 1
"""
