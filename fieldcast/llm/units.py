"""Substring dedup by hashing lines (or paragraphs): of equal units the first stays."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.llm.common import stored
from fieldcast.session import send_with_tasks

send_with_tasks(__name__)

#: Letters of scripts that are written without blanks: Thai, Lao, Burmese, Khmer, kana, Han.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
LONG_WORD = 20


def normalised(unit: str) -> bytes:
    """A unit with A-Z in lower case and every run of ASCII white space as one blank, none at the ends."""
    return b" ".join(unit.encode("utf-8", "surrogatepass").lower().split())


def n_words(plain: bytes) -> int:
    """Words of a unit in normal form; a letter of a script without blanks is one, and 20 code points are one at least."""
    words, text = plain.count(b" ") + 1, plain.decode("utf-8", "surrogatepass")
    if not text.isascii():
        words += len(UNSPACED.findall(text))
    return max(words, len(text) // LONG_WORD)


def drop_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", separator: str = "\n", min_words: int = 1
) -> DataFrame:
    """``docs`` without the units that stand earlier, in this or another document.

    Units lie between separators (``\\n`` for lines, ``\\n\\n`` for paragraphs) and are compared in normal form, by 128 bits
    of hash.  Those with fewer than ``min_words`` words (:func:`n_words`) are never touched.  Of equal units the one with the
    smallest ``doc_id`` (nulls last), and there the first, stays; of rows with the same id, one of them.  Results:
    ``n_units``, ``n_removed`` and ``removed``, the (start, length) in code points of each removed unit within the original
    text; the text keeps the other units, joined as before.  A null text stays null, an empty one empty; columns named like
    a result are replaced; an empty table gives no rows.

    Only digests and places are grouped, the least place of each being found before the shuffle as far as it goes, so a
    unit that a third of all documents hold is no hot spot.  Numbered documents are written first, so that places
    mean the same rows in every job.
    """
    new = ("n_units", "n_removed", "removed")
    kept = [c for c in docs.columns if c.lower() not in new]
    named = [F.col(c).alias(f"lm kept {k}") for k, c in enumerate(kept)]
    table = stored(docs.select(*named, F.monotonically_increasing_id().alias("lm row")), "units-documents")
    own = {c: f"lm kept {k}" for k, c in enumerate(kept)}
    places = "lm_row long, at int, digest binary"

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, digests = [], [], []
            for row, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for k, unit in enumerate((whole or "").split(separator)):
                    plain = normalised(unit)
                    if plain and (plain.count(b" ") + 1 >= min_words or n_words(plain) >= min_words):
                        rows.append(row)
                        at.append(k)
                        digests.append(xxhash.xxh3_128_digest(plain))
            columns = [pa.array(rows, pa.int64()), pa.array(at, pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["lm_row", "at", "digest"])

    found = stored(
        table.select("lm row", own[text]).mapInArrow(units, places), "units-digests"
    )
    ids = table.select(F.col("lm row").alias("lm_row"), F.col(own[doc_id]).alias("id"))
    # digests that occur once need no order; the others are ranked
    many = stored(found.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "units-many")
    # what is joined grows with the documents, so the joins are sorted ones at every size; an aggregate is written
    # before it is joined, so that a digest that very many documents hold can be split
    again = stored(found.join(many.hint("merge"), "digest").join(ids.hint("merge"), "lm_row"), "units-repeated")
    place = F.struct(F.col("id").isNull().alias("none"), "id", F.col("lm_row"), F.col("at"))
    first = stored(again.groupBy("digest").agg(F.min(place).alias("first")), "units-first")
    gone = again.join(first.hint("merge"), "digest").where((F.col("lm_row") != F.col("first.lm_row")) | (F.col("at") != F.col("first.at")))
    lists = gone.groupBy("lm_row").agg(F.collect_list("at").alias("gone"))

    joined = table.join(lists.hint("merge"), table["lm row"] == lists["lm_row"], "left")
    joined = joined.select(*(own[c] for c in kept), "gone")
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))
    added = [T.StructField("n_units", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("removed", spans)]
    schema = T.StructType([docs.schema[c] for c in kept] + added)
    where = kept.index(text)
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))]

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, dropped, places_ = [], [], [], []
            for whole, gone_ in zip(batch.column(where).to_pylist(), batch.column(len(kept)).to_pylist(), strict=True):
                parts, out, stay, start = (whole or "").split(separator), [], [], 0
                away = set(gone_ or ())
                for k, part in enumerate(parts):
                    if k in away:
                        out.append({"start": start, "length": len(part)})
                    else:
                        stay.append(part)
                    start += len(part) + len(separator)
                texts.append(None if whole is None else separator.join(stay))
                counts.append(0 if whole is None else len(parts))
                dropped.append(len(out))
                places_.append(out)
            columns = batch.columns[: len(kept)]
            columns[where] = pa.array(texts, columns[where].type)
            made = [pa.array(v, kind) for v, kind in zip((counts, dropped, places_), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns + made, names=schema.names)

    return joined.mapInArrow(rebuild, schema)


def drop_repeats_sql(table: str, min_words: int) -> str:
    """Lines that stand earlier removed, over a table with unique doc_id, in DuckDB's SQL.

    It counts words at blanks alone, which is the same for ``min_words`` 1.
    """
    space = "[\\x20\\x09-\\x0D]+"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH lines AS (
  SELECT doc_id, u.i AS i, u.line AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM {table} WHERE text IS NOT NULL),
       unnest(parts) WITH ORDINALITY AS u(line, i)
),
placed AS (
  SELECT *, trim(regexp_replace(translate(line, '{upper}', '{upper.lower()}'), '{space}', ' ', 'g'), ' ') AS plain,
         coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM lines
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY plain ORDER BY doc_id, i) > 1
            AND plain <> '' AND len(string_split(plain, ' ')) >= {min_words} AS again
  FROM placed
),
kept AS (
  SELECT doc_id, count(*) AS n_units, count(*) FILTER (WHERE again) AS n_removed,
         string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT again) AS text,
         string_agg(CAST(CAST(start AS BIGINT) AS VARCHAR) || '+' || CAST(length(line) AS VARCHAR), ',' ORDER BY i) FILTER (WHERE again) AS removed
  FROM ranked GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_units, 0) AS n_units, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.removed, '') AS removed
FROM {table} d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
