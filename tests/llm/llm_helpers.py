"""Small documents with awkward cases, shared by the tests of the corpus operators."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    ]
)
SYLLABLES = "ka lo mi tu ne sar vel ino der ata".split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    out = ["".join(draw.choice(SYLLABLES) for _ in range(draw.randint(1, 4))) for _ in range(words)]
    for k in range(9, words, 10):
        out[k] += draw.choice([".", ".\n", ","])
    return " ".join(out).replace("\n ", "\n")


def awkward() -> list[tuple]:
    """Nulls, empty and blank texts, repeated rows, ties, a very long text, odd white space, other scripts."""
    shared = prose(900, 120)
    texts = [prose(k, 20 + 13 * k) for k in range(12)]
    texts += [shared, shared + " end", "begin " + shared, prose(901, 30) + "\n" + shared + "\n" + prose(902, 30)]
    texts += ["", " \t\n", "one", "a  b c\n\n d", "Привет мир " * 30, "x" * 5000, "ab " * 2000, prose(903, 20_000)]
    rows = [(k, t, "en", f"src{k % 3}", len(t)) for k, t in enumerate(texts)]
    rows += [(100, None, None, None, None), (None, shared, "en", "src0", 1), (None, None, None, None, None)]
    rows += [(101, texts[3], "en", "src1", 1)] * 2
    return rows


def table(spark, rows=None, **extra):
    """Documents with further columns, whose names may clash with results."""
    frame = spark.createDataFrame(awkward() if rows is None else rows, DOCS).repartition(3)
    from pyspark.sql import functions as F

    return frame.withColumns({name: F.lit(value) for name, value in extra.items()})
