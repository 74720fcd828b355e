"""Mixing sources to target weights by Poisson replication.

A source of `size` characters that should make up the share `w` of an output of `budget` times the
input's characters is repeated at the mean rate `w * budget * total / size`. Each document's
number of copies is drawn from the Poisson distribution of that mean by inverting it at a number
between 0 and 1 that md5 makes of seed and document id; every copy then goes to a place that md5
makes of seed, id and copy number, which shuffles the copies of all sources among each other.

Without given weights a source's weight is its size to the power `temperature`, which evens out
large and small sources. Built-in functions only: one aggregate that combines before its shuffle,
a join with one row per source, one shuffle of the output by a uniform key.

Defined results: a null source is a source of its own. Null text counts no characters. A source
without characters has rate 1, a source missing in given weights rate 0. Null ids share one draw;
repeated rows have the same number of copies each. Columns of `docs` named copy, rate or
shuffle_key are replaced. An empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import fresh
from logweir.sources.staging import stage

HEX_DIGITS = 13  # 52 bits, which a double holds exactly


def _uniform(*parts: Column) -> Column:
    """A BIGINT of 52 bits from the md5 of the parts, joined by colons."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("bigint")


def rates(
    docs: DataFrame,
    weights: DataFrame | None = None,
    budget: float = 1.0,
    temperature: float = 0.5,
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """(_source, rate, cdf) per source; `weights` has columns source and weight, rows of one
    source add up.

    `cdf` holds the Poisson distribution function at 0, 1, 2 and so on, far into its tail.
    """
    length = F.coalesce(F.char_length(F.col(text_col).cast("string")), F.lit(0))
    sizes = docs.groupBy(F.col(source_col).alias("_source")).agg(F.sum(length).alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        given = weights.groupBy(F.col("source").alias("_name")).agg(F.sum("weight").alias("weight"))
        sizes = sizes.join(given, F.col("_source").eqNullSafe(F.col("_name")), "left").select(
            "_source", "size", F.coalesce(F.col("weight").cast("double"), F.lit(0.0)).alias("weight")
        )
    sizes = stage(sizes, "sizes")
    total, weight = sizes.agg(F.sum("size"), F.sum("weight")).first()
    share = F.try_divide(F.col("weight"), F.lit(weight))
    rate = F.try_divide(F.coalesce(share, F.lit(0.0)) * budget * F.lit(total), F.col("size"))
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")

    def step(state: Column, k: Column) -> Column:
        log_term = F.when(k == 0, -F.col("rate")).otherwise(
            state["log_term"] + F.ln(F.col("rate")) - F.ln(k.cast("double"))
        )
        total = state["total"] + F.exp(log_term)
        return F.struct(
            log_term.alias("log_term"),
            total.alias("total"),
            F.concat(state["cdf"], F.array(total)).alias("cdf"),
        )

    start = F.struct(
        F.lit(0.0).alias("log_term"),
        F.lit(0.0).alias("total"),
        F.array().cast("array<double>").alias("cdf"),
    )
    cdf = F.when(F.col("rate") == 0, F.array(F.lit(1.0))).otherwise(
        F.aggregate(F.sequence(F.lit(0), last), start, step, lambda state: state["cdf"])
    )
    return (
        sizes.withColumn("rate", F.when(F.col("size") == 0, F.lit(1.0)).otherwise(F.round(rate, 9)))
        .select("_source", "rate", cdf.alias("cdf"))
    )


def mixed(
    docs: DataFrame,
    weights: DataFrame | None = None,
    budget: float = 1.0,
    temperature: float = 0.5,
    seed: str = "mix",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """The copies of `docs`, shuffled, with copy (from 1), rate and shuffle_key."""
    columns = [c for c in docs.columns if c not in ("copy", "rate", "shuffle_key")]
    # Written, so that Spark sees its size and broadcasts it if it is small.
    per_source = stage(rates(docs, weights, budget, temperature, source_col, text_col), "rates")
    name, own, copies = (fresh(c, docs) for c in ("_source", "_rate", "_copies"))
    per_source = per_source.select(
        F.col("_source").alias(name), F.struct("rate", "cdf").alias(own)
    )
    draw = _uniform(F.lit(seed), F.col(id_col)) / F.lit(float(1 << 4 * HEX_DIGITS))
    same = docs[source_col].eqNullSafe(F.col(name))
    return (
        docs.select(*columns)
        .join(per_source, same)
        .withColumn(copies, F.size(F.filter(F.col(f"{own}.cdf"), lambda c: c <= draw)))
        .where(F.col(copies) > 0)
        .select(
            *columns, F.col(f"{own}.rate").alias("rate"),
            F.explode(F.sequence(F.lit(1), F.col(copies))).alias("copy"),
        )
        .withColumn("shuffle_key", _uniform(F.lit(seed), F.col(id_col), F.col("copy")))
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )


ORACLE_SQL = """
WITH sizes AS (
  SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS size FROM documents GROUP BY source
), weighed AS (
  SELECT *, sqrt(size) / sum(sqrt(size)) OVER () AS share, sum(size) OVER () AS total FROM sizes
), rated AS (
  SELECT source, CASE WHEN size = 0 THEN 1.0::DOUBLE
                      ELSE round(share * total / size, 9) END AS rate
  FROM weighed
), terms AS (
  SELECT source, rate, k,
         CASE WHEN rate = 0 THEN 1.0 ELSE exp(k * ln(rate) - rate - lgamma(k + 1)) END AS term
  FROM rated, LATERAL (SELECT unnest(range(0, (rate + 12 * sqrt(rate) + 31)::BIGINT)) AS k)
), functions AS (
  SELECT source, rate, k, sum(term) OVER (PARTITION BY source ORDER BY k) AS cdf FROM terms
), drawn AS (
  SELECT *, ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT
            / 4503599627370496.0::DOUBLE AS draw
  FROM documents
), counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, f.rate,
         count(*) FILTER (WHERE f.cdf <= d.draw) AS copies
  FROM drawn d JOIN functions f ON d.source IS NOT DISTINCT FROM f.source
  GROUP BY ALL
), copied AS (
  SELECT *, unnest(range(1, copies + 1))::INTEGER AS "copy" FROM counted
)
SELECT doc_id, text, lang, source, n_chars, rate, "copy",
       ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || "copy"), 1, 13)
       )::BIGINT AS shuffle_key
FROM copied
"""
