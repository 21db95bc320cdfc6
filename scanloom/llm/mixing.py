"""Mixing sources to target weights by Poisson replication.

The size of a source and its target weight give the mean number of times each of its
documents is repeated.  Each document inverts the Poisson distribution of that mean at
a number drawn from a hash of seed and id, is exploded by the count, and all copies are
put in the order of another hash over the whole corpus.  A mean above ``PIECE`` is cut into
equal pieces that draw apart, for sums of Poisson numbers are Poisson.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import text_of
from scanloom.session import cut

#: Largest mean that is inverted in one piece: exp(-PIECE) is far from underflow.
PIECE = 64
#: Terms of the distribution; beyond the last one the chance is below 2^-52 at any mean up to PIECE.
TERMS = 160
#: The exponent of the default weights: target share in proportion to size to this power.
ALPHA = 0.5


def uniform(*parts) -> Column:
    """A number of [0, 1) with 52 bits from the hash of the parts."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def rates(df: DataFrame, source_col: str = "source", text_col: str = "text", weights: DataFrame | None = None, alpha: float = ALPHA, epochs: float = 1.0) -> DataFrame:
    """One row a source: mean repetition, pieces and the distribution of one piece.

    A source's share of the output (in code points) is its weight of ``weights(source,
    weight)`` over the sum of weights, or where none is given its size to the power of
    ``alpha``; the expected output is ``epochs`` times the input.  Sources without a
    weight get none of it, weights of absent sources count for nothing, and a source
    whose texts are all empty is repeated once on average."""
    sizes = df.groupBy(F.col(source_col).alias("source")).agg(F.sum(F.length(text_of(text_col))).alias("size"))
    sizes = cut(sizes, "sizes")
    if weights is None:
        shares = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(alpha)))
    else:
        given = weights.groupBy(F.col("source").alias("_s")).agg(F.sum("weight").alias("weight"))
        shares = sizes.join(given, F.col("source").eqNullSafe(F.col("_s")), "left").select("source", "size", F.coalesce(F.when(F.col("size") > 0, F.col("weight")), F.lit(0.0)).cast("double").alias("weight"))
    all_ = shares.agg(F.sum("size").cast("double").alias("total"), F.sum("weight").alias("sum_w"))
    mean = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("sum_w") > 0, F.col("weight") / F.col("sum_w") * F.col("total") * float(epochs) / F.col("size")).otherwise(F.lit(0.0))
    found = shares.join(all_).select("source", "size", mean.alias("mean"))
    found = found.withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("mean") / PIECE)).cast("int"))
    found = found.withColumn("_m", F.col("mean") / F.col("pieces"))
    cdf = F.expr(f"""aggregate(sequence(1, {TERMS}), named_struct('p', exp(-_m), 'c', exp(-_m), 'all', array(exp(-_m))),
        (s, k) -> named_struct('p', s.p * _m / k, 'c', s.c + s.p * _m / k, 'all', array_append(s.all, s.c + s.p * _m / k)), s -> s.all)""")
    return cut(found.withColumn("cdf", cdf).drop("_m"), "rates")


def mix(df: DataFrame, seed: int = 0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: DataFrame | None = None, alpha: float = ALPHA, epochs: float = 1.0, shuffle: bool = True) -> DataFrame:
    """``df`` with each row repeated by its count, a column ``copy`` (1, 2, ...), in the
    order of a hash over the whole corpus.

    Null sources are a source; null ids draw like any id; rows with equal ids draw the
    same number; an empty table gives no rows.  A column ``copy`` of the input is
    replaced.  The table of rates has a row a source; Spark broadcasts it only where
    its files are below the session's limit, else it splits a skewed source."""
    own = [c for c in df.columns if c != "copy"]
    rows = df.drop("copy").withColumnsRenamed({c: f"in{i}" for i, c in enumerate(own)})
    name = {c: f"in{i}" for i, c in enumerate(own)}
    stats = rates(df, source_col, text_col, weights, alpha, epochs).select(F.col("source").alias("sl_source"), "pieces", "cdf")
    joined = rows.join(stats, F.col(name[source_col]).eqNullSafe(F.col("sl_source")))
    draws = F.transform(F.sequence(F.lit(1), F.col("pieces")), lambda i: F.size(F.filter("cdf", lambda c: c <= uniform(F.lit(seed), F.col(name[id_col]), i))))
    counted = joined.withColumn("sl_n", F.aggregate(draws, F.lit(0), lambda a, x: a + x)).filter("sl_n > 0")
    out = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("sl_n"))))
    if shuffle:
        # Rows without an id are told apart by their texts, so that they are no single key.
        ident = F.col(name[id_col])
        out = out.withColumn("sl_key", F.when(ident.isNull(), F.xxhash64(F.lit(seed), F.md5(text_of(name[text_col])), "copy")).otherwise(F.xxhash64(F.lit(seed), ident, "copy")))
        out = out.repartition("sl_key").sortWithinPartitions("sl_key", name[id_col], "copy")
    return out.select(*(F.col(f"in{i}").alias(c) for i, c in enumerate(own)), "copy")


#: DuckDB's text of ``mix`` with the default weights.
SQL = f"""
WITH z AS (SELECT source, sum(length(coalesce(text, '')))::double AS size FROM documents GROUP BY 1),
t AS (SELECT sum(size) AS total, sum(sqrt(size)) AS w FROM z),
m AS (SELECT source, CASE WHEN size = 0 THEN 1.0 ELSE sqrt(size) / w * total / size END AS mean FROM z, t),
q AS (SELECT source, greatest(1, ceil(mean / {PIECE}))::int AS pieces, mean / greatest(1, ceil(mean / {PIECE})) AS l FROM m),
c AS (SELECT source, pieces, k, sum(exp(-l + k * ln(l) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf FROM q, generate_series(0, {TERMS}) g(k)),
u AS (SELECT doc_id, source, i, ('0x' || substr(md5('0:' || coalesce(doc_id::varchar, 'null') || ':' || i), 1, 13))::bigint / 4503599627370496.0 AS u
      FROM (SELECT doc_id, source, unnest(generate_series(1, pieces)) AS i FROM documents JOIN q USING (source))),
n AS (SELECT doc_id, count(*)::int AS n FROM u JOIN c ON u.source = c.source AND c.cdf <= u.u GROUP BY 1)
SELECT d.doc_id, d.source, d.lang, md5(d.text) AS text_md5, unnest(generate_series(1, n))::int AS copy FROM documents d JOIN n USING (doc_id)
"""
