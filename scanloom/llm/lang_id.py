"""Language identification by n-gram filters with a bit for each language.

Learning counts the character n-grams of every learned document, keeps those that make up
at least ``SHARE`` of the n-grams of a language, and enters them in one Bloom filter a
language.  The filters are stored bit-sliced: a row for each position holds the bits of all
languages, so that the rows of an n-gram's positions, and-ed, are the languages that contain
it.  A document goes to the language with most of its n-grams, after its count is corrected
for the n-grams that the filter of that language contains by chance.

``SHARE`` bounds a filter: a language has at most ``1 / SHARE`` n-grams of an order, however
large the corpus is.  ``LANGUAGES`` languages are one filter; further languages go to further
filters, through which the documents pass in turn.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm import common
from scanloom.llm.common import text_of
from scanloom.session import cut, drop

#: Lengths of the n-grams, in letters; a run of other characters is one blank.
ORDERS = (3, 4)
#: Least share of the n-grams of one order in a language.
SHARE = 1e-5
#: Positions of an n-gram and bits of the filter for each n-gram of the largest language.
HASHES, BITS = 5, 10
#: Languages of one filter: at most 2^22 positions (both orders, ``1 / SHARE`` each) of 16 bytes.
LANGUAGES = 128
#: Characters of a long text that are looked at together.
PIECE = 1 << 20
#: Counted n-grams that a task of the learning step holds before it hands them on.
HELD = 1 << 21
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _codes(text: str, before: int = 0) -> np.ndarray:
    """Code points of the letters of the folded text, 0 for a run of others; ``before`` is
    the code that the text follows."""
    raw = np.frombuffer(text.casefold().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(_letters()[raw], raw, 0)
    return c[(c != 0) | (np.concatenate([[before], c[:-1]]) != 0)] if len(c) else c


def _keys(codes: np.ndarray, order: int) -> np.ndarray:
    """A 64-bit hash of each n-gram (two of n n-grams collide with odds of n^2 / 2^65)."""
    if len(codes) < order:
        return np.empty(0, np.uint64)
    n, h = len(codes) - order + 1, np.full(len(codes) - order + 1, order, np.uint64)
    for j in range(order):
        h = (h ^ codes[j:j + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def grams(texts, limit: int = PIECE):
    """(row, keys by order): the n-grams of each text, long ones in several runs.

    A text is put between blanks; a text without letters has none."""
    for row, text in enumerate(texts):
        tail, end = np.zeros(1, np.uint32), 0
        first = True
        while text and end < len(text):
            part = text[end:end + limit]
            end += limit
            codes = _codes(part + " " if end >= len(text) else part, tail[-1])
            joined = np.concatenate([tail, codes])
            yield row, {n: _keys(joined if first else joined[max(0, len(tail) - n + 1):], n) for n in ORDERS}
            first, tail = False, joined[-(max(ORDERS) - 1):]


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: 5 divides the CRC-32 of their id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def counts(df: DataFrame) -> DataFrame:
    """(lang, n, key, k): the counts of n-grams of ``df(lang, text)``, summed in the tasks
    before the shuffle."""
    common.small_batches(df.sparkSession)
    schema = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("key", pa.int64()), ("k", pa.int64())])

    def summed(parts):
        keys, k = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(keys)
        keys, k = keys[order], k[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[at], np.add.reduceat(k, at)

    def rows(held):
        for (lang, n), parts in held.items():
            keys, k = summed(parts)
            yield pa.record_batch([pa.array([lang] * len(keys)), pa.array(np.full(len(keys), n, np.int32)), pa.array(keys.view(np.int64)), pa.array(k)], schema=schema)

    def run(batches):
        held, size = {}, 0
        for b in batches:
            langs, sizes = b.column("lang").to_pylist(), b.column("text").cast(pa.large_binary()).to_pylist()
            for start, stop in common.blocks([len(t) for t in sizes]):
                found = {}
                texts = b.column("text").slice(start, stop - start).to_pylist()
                for row, by in grams(texts):
                    for n, keys in by.items():
                        if len(keys):
                            found.setdefault((langs[start + row], n), []).append(keys)
                for at, keys in found.items():
                    key, k = np.unique(np.concatenate(keys), return_counts=True)
                    held.setdefault(at, []).append((key, k))
                    size += len(key)
                if size > HELD:
                    held = {at: [summed(parts)] for at, parts in held.items()}
                    size = sum(len(p[0][0]) for p in held.values())
                    if size > HELD // 2:
                        yield from rows(held)
                        held, size = {}, 0
        yield from rows(held)

    found = df.select("lang", "text").mapInArrow(run, "lang string, n int, key bigint, k bigint")
    return found.groupBy("lang", "n", "key").agg(F.sum("k").alias("k"))


def learn(df: DataFrame, share: float = SHARE) -> tuple[list[str], list[dict]]:
    """(languages, filters) of ``df(lang, text)``, the most frequent languages first.

    A filter is a dict of ``names``, ``rows`` (positions x words of 64 bits) and
    ``chance`` (of a language to contain an n-gram that it never learned)."""
    all_ = cut(counts(df), "ngrams")
    sums = cut(all_.groupBy("lang", "n").agg(F.sum("k").alias("total")), "totals")
    kept = cut(all_.join(common.sided(sums), ["lang", "n"]).filter(F.col("k") >= share * F.col("total")).select("lang", "key"), "kept")
    size = kept.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    # One row a language.
    langs = [r.lang for r in sums.groupBy("lang").agg(F.sum("total").alias("t")).sort(F.desc("t"), "lang").collect()]
    positions = 1 << max(10, int(BITS * size - 1).bit_length())
    names = df.sparkSession.createDataFrame(list(enumerate(langs)), "number int, lang string")
    numbered = cut(kept.join(names, "lang").select("number", "key"), "numbered")
    filters = []
    for start in range(0, len(langs), LANGUAGES):
        block = langs[start:start + LANGUAGES]
        own = numbered.filter(F.col("number").between(start, start + len(block) - 1)).withColumn("number", F.col("number") - start)
        low, high = F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("key", 32).bitwiseOR(F.lit(1))
        at = F.explode(F.array(*((low + j * high).bitwiseAND(F.lit(positions - 1)) for j in range(HASHES))))
        bits = own.select(at.alias("at"), F.floor(F.col("number") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, number % 64)").alias("bit"))
        t = bits.groupBy("at", "word").agg(F.bit_or("bit").alias("bits")).toArrow()
        rows = np.zeros((positions, -(-len(block) // 64)), np.uint64)
        rows[t["at"].to_numpy(), t["word"].to_numpy()] = t["bits"].to_numpy().view(np.uint64)
        fill = [((rows[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(block))]
        filters.append({"names": block, "rows": rows, "chance": np.array(fill) ** HASHES})
    drop(all_, sums, kept, numbered)
    return langs, filters


def contained(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of each n-gram the bits of the languages that contain it: its rows, and-ed."""
    low, high = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    mask, out = np.uint64(len(rows) - 1), None
    for j in range(HASHES):
        got = rows[((low + np.uint64(j) * high) & mask).astype(np.int64)]
        out = got if out is None else out & got
    return out


def _scores(texts, rows: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Corrected counts, a row a text and a column a language."""
    hits, total = np.zeros((len(texts), len(chance))), np.zeros(len(texts))

    def add(at, keys):
        if not keys:
            return
        starts = np.concatenate([[0], np.cumsum([len(k) for k in keys])[:-1]])
        masks = contained(np.concatenate(keys), rows)
        for i in range(len(chance)):
            bit = ((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(np.int64)
            np.add.at(hits[:, i], at, np.add.reduceat(bit, starts))
        np.add.at(total, at, [len(k) for k in keys])

    at, keys, size = [], [], 0
    for row, by in grams(texts):
        for k in by.values():
            if len(k):
                at.append(row)
                keys.append(k)
                size += len(k)
        if size > PIECE:
            add(at, keys)
            at, keys, size = [], [], 0
    add(at, keys)
    return np.maximum(0.0, (hits - chance * total[:, None]) / (1 - np.minimum(chance, 0.999999)))


def identify(df: DataFrame, langs: list[str], filters: list[dict], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, lang_pred, score: the language with most corrected n-grams, and its share of
    those of all languages.

    Of languages with as many the one with more learned text is taken, which also gets the
    texts without any known n-gram (score 0).  Texts that are null or have no letter are
    ``und`` with score 0, and so is every text where no language was learned.  Rows with
    null or repeated ids give a row each; an empty table gives no rows."""
    spark = df.sparkSession
    common.small_batches(spark)
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.lit(None).cast("string").alias("lang_pred"), F.lit(0.0).alias("best"), F.lit(0.0).alias("total"))
    schema = f"id {df.schema[id_col].dataType.simpleString()}, text string, lang_pred string, best double, total double"
    for f in filters:
        held = spark.sparkContext.broadcast((f["names"], f["rows"], f["chance"]))
        rows = rows.mapInArrow(functools.partial(_pass, held), schema)
    first = langs[0] if langs else UNKNOWN
    letter = F.col("text").rlike(r"\p{L}")
    known = letter & F.lit(bool(langs))
    pred = F.when(known, F.coalesce("lang_pred", F.lit(first))).otherwise(F.lit(UNKNOWN))
    score = F.when(known & (F.col("total") > 0), F.least(F.lit(1.0), F.col("best") / F.col("total"))).otherwise(F.lit(0.0))
    return rows.select(F.col("id").alias(id_col), pred.alias("lang_pred"), score.alias("score"))


def _pass(held, batches):
    names, table, chance = held.value
    for b in batches:
        sizes = [len(t) for t in b.column(1).cast(pa.large_binary()).to_pylist()]
        pred, best, total = b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist()
        for start, stop in common.blocks(sizes):
            t = _scores(b.column(1).slice(start, stop - start).to_pylist(), table, chance)
            top = t.argmax(axis=1)
            for i, (j, row) in enumerate(zip(top, t), start):
                total[i] += float(row.sum())
                if row[j] > best[i]:
                    pred[i], best[i] = names[j], float(row[j])
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pred, pa.string()), pa.array(best, pa.float64()), pa.array(total, pa.float64())], names=["id", "text", "lang_pred", "best", "total"])


def predict(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", share: float = SHARE) -> DataFrame:
    """Id, held_out, lang_pred, score of every row; learned from the rows that have a
    language and are not held out (rows with null ids are neither).

    Empty and null texts teach nothing; a language whose texts have no letters is not
    learned; other columns are not read, whatever their names."""
    source = df.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), text_of(text_col).alias("text"))
    langs, filters = learn(source.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull()), share)
    out = identify(source, langs, filters)
    return out.select(F.col("doc_id").alias(id_col), held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
