"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.llm.common import stored

#: Hexadecimal digits of an MD5 that make a uniform number: 52 bits, exact in a double.
DIGITS = 13
#: Standard deviations of the Poisson table beyond its mean; more copies are less likely than 1e-20.
TAIL = 12


def _uniform(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long") / F.lit(float(16**DIGITS))


def rates(docs: DataFrame, source: str, weights: dict[str | None, float] | None, size: float | None) -> DataFrame:
    """(source, rate): how often a document of each source is to appear on average.

    ``weights`` are relative target shares by source; a source that has none there gets 0 and its documents go.
    Without ``weights`` the target share of a source is the square root of its number of documents, relative
    to the others.  ``size`` is the target number of documents (default: as many as come in).
    """
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    spark = docs.sparkSession
    if weights is None:
        weighed = counts.withColumn("weight", F.sqrt(F.col("n").cast("double")))
    else:
        if any(not 0 <= w < math.inf for w in weights.values()):
            raise ValueError("weights must be finite and not negative")
        schema = T.StructType([T.StructField("of", T.StringType()), T.StructField("weight", T.DoubleType())])
        given = spark.createDataFrame([(k, float(w)) for k, w in weights.items()], schema)
        weighed = counts.join(given, counts["source"].eqNullSafe(given["of"]), "left").select(
            "source", "n", F.coalesce("weight", F.lit(0.0)).alias("weight")
        )
    weighed = stored(weighed, "mixing-weights")
    sums = weighed.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    total, weight = sums["n"] or 0, sums["weight"] or 0.0
    goal = float(total if size is None else size)
    share = F.col("weight") / F.lit(weight) if weight else F.lit(0.0)
    return weighed.select("source", (share * F.lit(goal) / F.col("n")).alias("rate"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    weights: dict[str | None, float] | None = None,
    size: float | None = None,
    seed: int = 42,
) -> DataFrame:
    """Every document as often as a Poisson number with its source's mean rate says, in a global shuffle.

    Result: the columns of ``docs``, ``copy`` (from 0) and ``shuffle_key``, a double that is uniform over
    0 to 1; rows lie in the order of that key within a partition, and in partitions at random.  The number of
    copies inverts the Poisson distribution at a uniform number that comes from ``seed`` and ``doc_id`` alone:
    the same document gets the same number in every run, on any cluster, after any lost executor.  Rows with
    the same id (a null id is one, too) get the same number each.  A null source is a source of its own.  Null and
    empty texts are documents like others.  Columns ``copy`` and ``shuffle_key`` are replaced; an empty table
    gives no rows.

    Counts are summed before they are shuffled; the table of distributions has a row for each source, is
    written first, and Spark joins it by its size.  Nothing is gathered by source.
    """
    table = rates(docs, source, weights, size)
    # log of the probabilities, so that a large rate does not underflow; summed in order of the count
    top = F.ceil(F.col("rate") + F.lit(TAIL) * F.sqrt("rate") + F.lit(20)).cast("int")
    factorial = F.aggregate(
        F.sequence(F.lit(1), top),
        F.array(F.lit(0.0)),
        lambda got, k: F.concat(got, F.array(F.element_at(got, -1) + F.log(k.cast("double")))),
    )
    chance = F.transform(F.col("logs"), lambda f, k: F.exp(-F.col("rate") + k * F.log("rate") - f))
    below = F.aggregate(
        F.col("chances"),
        F.array().cast("array<double>"),
        lambda got, p: F.concat(got, F.array(F.when(F.size(got) == 0, p).otherwise(F.element_at(got, -1) + p))),
    )
    table = table.where("rate > 0").withColumn("logs", factorial).withColumn("chances", chance)
    table = stored(table.select(F.col("source").alias("lm source"), below.alias("lm below")), "mixing-distributions")

    kept = [c for c in docs.columns if c.lower() not in ("copy", "shuffle_key")]
    named = {c: f"lm kept {k}" for k, c in enumerate(kept)}
    key = F.coalesce(F.col(named[doc_id]).cast("string"), F.lit("null"))
    held = docs.select(*(F.col(c).alias(n) for c, n in named.items()))
    drawn = held.withColumn("lm u", _uniform(F.lit(f"{seed}:copies"), key)).join(
        table, F.col(named[source]).eqNullSafe(F.col("lm source"))
    )
    copies = F.size(F.filter("lm below", lambda p: p <= F.col("lm u")))
    many = drawn.where(copies > 0).select(*named.values(), F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    order = _uniform(F.lit(f"{seed}:order"), key, F.col("copy").cast("string"))
    mixed = many.select(*(F.col(n).alias(c) for c, n in named.items()), "copy", order.alias("shuffle_key"))
    return mixed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def mix_sql(table: str, seed: int = 42) -> str:
    """``mix`` with default weights over a table of documents, in DuckDB's SQL."""
    uniform = f"CAST(CAST('0x' || substr(md5(%s), 1, {DIGITS}) AS BIGINT) AS DOUBLE) / {float(16**DIGITS)!r}"
    copies = uniform % f"'{seed}:copies:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')"
    order = uniform % f"'{seed}:order:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST(copy AS VARCHAR)"
    return f"""
WITH counts AS (SELECT source, count(*) AS n FROM {table} GROUP BY source),
rates AS (
  SELECT source, sqrt(CAST(n AS DOUBLE)) / (SELECT sum(sqrt(CAST(n AS DOUBLE))) FROM counts)
                 * CAST((SELECT sum(n) FROM counts) AS DOUBLE) / n AS rate FROM counts
),
chances AS (
  SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1.0)) AS p
  FROM rates, range(0, CAST(ceil(rate + {TAIL} * sqrt(rate) + 20) AS BIGINT) + 1) AS r(k)
),
below AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS p FROM chances),
drawn AS (SELECT d.*, {copies} AS u FROM {table} d),
counted AS (
  SELECT d.doc_id, any_value(d.text) AS text, any_value(d.lang) AS lang, any_value(d.source) AS source,
         any_value(d.n_chars) AS n_chars, count(*) AS copies
  FROM drawn d JOIN below b ON d.source IS NOT DISTINCT FROM b.source AND b.p <= d.u
  GROUP BY d.doc_id
),
many AS (SELECT *, unnest(range(0, copies)) AS copy FROM counted)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy, {order} AS shuffle_key FROM many
"""
