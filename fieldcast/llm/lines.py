"""Boilerplate lines by their frequency within a site.  DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcast.llm.common import stored

#: Blanks that do not count at the ends of a line (ASCII white space without the line end itself).
BLANKS = "[\\x20\\x09\\x0B-\\x0D]+"


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, f"^{BLANKS}|{BLANKS}$", "")


def _digest(line: Column) -> Column:
    return F.xxhash64(_trimmed(line))


def boilerplate(docs: DataFrame, host: str, text: str, ratio: float, min_pages: int) -> DataFrame:
    """(host, lines): digests of the lines on more than ``ratio`` of a host's pages, and on ``min_pages`` at least.

    A page counts once for a line however often it repeats it.  The list of a host is short whatever
    the number of its pages: it holds at most (mean number of lines of its pages) / ratio lines.  Only
    digests of 8 bytes are shuffled, counted first where they are read, so that a host with a third of all
    pages is no hot spot; the same goes for a line that is everywhere.
    """
    pages = docs.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("pages"))
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: _trimmed(x) != "")
    seen = docs.select(F.col(host).alias("host"), F.explode(F.array_distinct(F.transform(lines, _digest))).alias("line"))
    counted = seen.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    both = counted.join(pages, counted["host"].eqNullSafe(pages["host"]))
    often = both.where(F.col("n") > F.col("pages") * F.lit(float(ratio))).select(pages["host"], "line")
    return often.groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.05, min_pages: int = 5
) -> DataFrame:
    """``docs`` without their boilerplate lines, and ``n_dropped``: how many lines of a row went.

    Lines end at ``\\n``; they are compared without blanks at their ends.  Blank lines are neither counted
    nor dropped.  A null text stays null (0 dropped) and an empty one empty, both count as pages; a text all of whose
    lines are boilerplate becomes empty, its row stays.  A null host is a site of its own.  Repeated rows
    are pages of their own.  A column ``n_dropped`` is replaced; an empty table gives no rows.

    Pages are not shuffled when the lists are few: they are written first, so Spark sees their size and
    chooses between a broadcast and a join by host whose skewed partitions it can split.
    """
    lists = stored(boilerplate(docs, host, text, ratio, min_pages), "boilerplate")
    lists = lists.select(F.col("host").alias("lm host"), F.col("lines").alias("lm lines"))
    kept = [c for c in docs.columns if c.lower() != "n_dropped"]
    named = {c: f"lm kept {k}" for k, c in enumerate(kept)}
    joined = docs.select(*(F.col(c).alias(n) for c, n in named.items()))
    joined = joined.join(lists, F.col(named[host]).eqNullSafe(F.col("lm host")), "left")
    given = F.col(named[text])
    lines = F.split(given, "\n")
    # a digest in the list is that of a line that is not blank
    stay = F.filter(lines, lambda x: ~F.array_contains(F.col("lm lines"), _digest(x)))
    some = F.col("lm lines").isNotNull() & given.isNotNull()
    joined = joined.withColumn("lm stay", F.when(some, stay))
    clean = F.when(some, F.array_join("lm stay", "\n")).otherwise(given)
    dropped = F.when(some, F.size(lines) - F.size("lm stay")).otherwise(0).cast("long")
    return joined.select(*(clean.alias(c) if c == text else F.col(n).alias(c) for c, n in named.items()), dropped.alias("n_dropped"))


def drop_boilerplate_sql(table: str, ratio: float, min_pages: int) -> str:
    """The same over a table with doc_id, source and text, in DuckDB's SQL."""
    blanks = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH docs AS (SELECT *, row_number() OVER () AS page FROM {table}),
lines AS (
  SELECT page, source, u.i AS i, u.line AS line, trim(u.line, {blanks}) AS bare
  FROM (SELECT page, source, string_split(text, chr(10)) AS parts FROM docs WHERE text IS NOT NULL),
       unnest(parts) WITH ORDINALITY AS u(line, i)
),
often AS (
  SELECT c.source, c.bare
  FROM (SELECT source, bare, count(DISTINCT page) AS n FROM lines WHERE bare <> '' GROUP BY source, bare) c
  JOIN (SELECT source, count(*) AS pages FROM docs GROUP BY source) p ON c.source IS NOT DISTINCT FROM p.source
  WHERE n >= {min_pages} AND n > pages * CAST({ratio} AS DOUBLE)
),
clean AS (
  SELECT l.page, count(*) FILTER (WHERE o.bare IS NOT NULL) AS n_dropped,
         string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE o.bare IS NULL) AS kept
  FROM lines l LEFT JOIN often o ON l.source IS NOT DISTINCT FROM o.source AND l.bare = o.bare
  GROUP BY l.page
)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(c.kept, '') END AS text,
       coalesce(c.n_dropped, 0) AS n_dropped
FROM docs d LEFT JOIN clean c ON d.page = c.page
"""
