"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source's repetition rate is budget * weight / sum of weights / rows of the source. Each row draws its
number of copies by inverting the Poisson distribution with that mean at a number in [0, 1) hashed from
the seed and its id; the copies then go to partitions, and are ordered in them, by a hash of their own.
A mean over PART is drawn as a sum of independent Poisson numbers of mean PART at most, so that tables
stay short and exp(-mean) never underflows.

Defined results: a null source is a source of its own; a null id draws as the empty string; equal ids
draw equal counts; a source without a weight, or of weight 0, gets no row; an empty table gives an empty
table. Input columns that are called like a result column are replaced, all others are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .columns import others

#: Largest mean that one table of cumulated probabilities serves, and the table's length.
PART, TERMS = 8.0, 64
#: The table of sources is broadcast up to this count of sources, which is checked; beyond it, it is joined.
MAX_BROADCAST = 10_000
SEED = "mix-1"
HEX_DIGITS, SPAN = 13, float(1 << 52)


def uniform(*parts) -> F.Column:
    """A number in [0, 1) of 52 bits from the md5 of the parts, joined by |."""
    text = F.concat_ws("|", *parts)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HEX_DIGITS), 16, 10).cast("long").cast("double") / F.lit(SPAN)


def cumulated(mean) -> F.Column:
    """P(X <= k) of a Poisson number for k from 0 to TERMS."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), F.array(first).alias("c"))

    def add(s, k):
        p = s["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(s["c"], F.array(F.element_at(s["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, add, lambda s: s["c"])


def rates(df: DataFrame, source: str, weights: dict | None, budget: float | None) -> DataFrame:
    """One row for each source: its mean, the number of parts it is drawn in, and a part's cumulated probabilities."""
    sizes = df.groupBy(F.col(source).alias("_mix_source")).agg(F.count(F.lit(1)).alias("_mix_rows"))
    if weights is None:
        weighed = sizes.withColumn("_mix_weight", F.lit(1.0))
    else:
        chosen = F.lit(0.0)
        for name, weight in weights.items():
            chosen = F.when(F.col("_mix_source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(chosen)
        weighed = sizes.withColumn("_mix_weight", chosen)
    total = weighed.agg(F.sum("_mix_weight").alias("_mix_weights"), F.sum("_mix_rows").alias("_mix_all"))
    goal = F.lit(float(budget)) if budget is not None else F.col("_mix_all").cast("double")
    mean = goal * F.col("_mix_weight") / F.col("_mix_weights") / F.col("_mix_rows")
    parts = F.greatest(F.lit(1), F.ceil(F.col("_mix_mean") / F.lit(PART))).cast("int")
    return (
        weighed.crossJoin(F.broadcast(total))  # one row on the right
        .where(F.col("_mix_weight") > 0)
        .select("_mix_source", mean.alias("_mix_mean"))
        .withColumn("_mix_parts", parts)
        .withColumn("_mix_cdf", cumulated(F.col("_mix_mean") / F.col("_mix_parts")))
    )


def mix(
    df: DataFrame,
    weights: dict | None = None,
    budget: float | None = None,
    seed: str = SEED,
    source: str = "source",
    key: str = "doc_id",
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """df with each row as often as its source's rate asks for, shuffled globally.

    weights: by source, in any unit; None gives all sources the same share. budget: expected rows of the
    result, by default those of df. Adds copy (1, 2, ...) and mix_key, by whose hash copies are dealt out
    and by which they are ordered in their partition.
    """
    kept = others(df, "copy", "mix_key")
    table = rates(df, source, weights, budget)
    few = table.select("_mix_source").limit(max_broadcast + 1).count() <= max_broadcast
    drawn = df.select(*kept).join(F.broadcast(table) if few else table, F.col(source).eqNullSafe(F.col("_mix_source")))
    id_text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    count = F.aggregate(
        F.sequence(F.lit(1), F.col("_mix_parts")),
        F.lit(0),
        lambda n, part: n + F.size(F.filter(F.col("_mix_cdf"), lambda c: c <= uniform(F.lit(seed), id_text, part.cast("string")))),
    )
    return (
        drawn.withColumn("_mix_n", count)
        .where(F.col("_mix_n") > 0)
        .select(*kept, F.explode(F.sequence(F.lit(1), F.col("_mix_n"))).alias("copy"))
        .withColumn("mix_key", F.md5(F.concat_ws("|", F.lit(seed), id_text, F.col("copy").cast("string")).cast("binary")))
        .repartition("mix_key")
        .sortWithinPartitions("mix_key")
    )


def op7_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = f"""
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
totals AS (SELECT count(*) AS k, sum(n) AS total FROM sizes),
rates AS (SELECT source, CAST(total AS DOUBLE) * 1.0 / CAST(k AS DOUBLE) / n AS mean FROM sizes, totals),
parted AS (SELECT source, mean, CAST(greatest(1, ceil(mean / {PART})) AS INTEGER) AS parts FROM rates),
terms AS (
  SELECT source, parts, k, CASE WHEN k = 0 THEN exp(-mean / parts) ELSE exp(-mean / parts + k * ln(mean / parts) - lgamma(k + 1)) END AS p
  FROM parted, (SELECT unnest(range(0, {TERMS + 1})) AS k)
),
steps AS (SELECT source, parts, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
draws AS (
  SELECT d.doc_id, d.source, part, parts,
    CAST(CAST('0x' || substr(md5('{SEED}|' || CAST(d.doc_id AS VARCHAR) || '|' || CAST(part AS VARCHAR)), 1, {HEX_DIGITS}) AS BIGINT) AS DOUBLE) / {SPAN} AS u
  FROM documents d JOIN (SELECT source, parts, unnest(range(1, parts + 1)) AS part FROM parted) p ON d.source IS NOT DISTINCT FROM p.source
),
counts AS (SELECT doc_id, count(*) AS n FROM draws JOIN steps ON draws.source IS NOT DISTINCT FROM steps.source AND c <= u GROUP BY doc_id),
copies AS (SELECT doc_id, unnest(range(1, n + 1)) AS copy FROM counts)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, CAST(c.copy AS INTEGER) AS copy,
  md5('{SEED}|' || CAST(d.doc_id AS VARCHAR) || '|' || CAST(c.copy AS VARCHAR)) AS mix_key
FROM documents d JOIN copies c ON d.doc_id = c.doc_id
"""
