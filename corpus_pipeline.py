"""From raw documents to packed training sequences: quality, boilerplate, near-duplicates, mixture, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcast.llm import fertility, lines, mixing, packing, simhash
from fieldcast.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(_spark: SparkSession, docs: DataFrame, _sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within the fertility bands of their language."""
    return fertility.judge(docs, language="lang").where("kept").select(docs.columns)


def boilerplate(_spark: SparkSession, docs: DataFrame, _sf_dir: str) -> DataFrame:
    """Documents without the lines that are on more than a twentieth of their source's documents."""
    clean = lines.drop_boilerplate(docs, "source", "text", ratio=0.05, min_pages=5)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_duplicates(_spark: SparkSession, docs: DataFrame, _sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 4-word shingles, at most 4 bits apart."""
    return simhash.one_of_each(docs, words=4, max_bits=4)


def mixture(_spark: SparkSession, docs: DataFrame, _sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate says; sources count by the square root of their size."""
    return mixing.mix(docs).select(docs.columns)


def sequences(_spark: SparkSession, docs: DataFrame, _sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048; ``doc_row`` tells the copies of a document apart."""
    return packing.pack(docs, capacity=2048, end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("line dedup", boilerplate),
    ("simhash near-dedup", near_duplicates),
    ("mixing sources", mixture),
    ("packing", sequences),
]

#: Fertility, SimHash and packing are not expressible in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on all that its predecessor kept, written and read again in between."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
