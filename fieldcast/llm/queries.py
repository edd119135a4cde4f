"""The corpus operators as queries over the driver's tables, with SQL checks where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcast.llm import (
    fertility, importance, jaccard, lines, mixing, neighbours, packing, ranking, simhash, suffixes, toxicity, trie, units,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by the clause grammar."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"), threshold=0.5)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, at most 4 bits apart."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, words=4, max_bits=4)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that are on more than a twentieth of their source's documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.drop_boilerplate(docs, "source", "text", LINE_RATIO, LINE_PAGES)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, replicated towards source shares that go with the square root of the sources' sizes."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, capacity=2048, end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids", "doc_row")


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every twentieth vector with all others."""
    table = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(table, F.col("vec_id") % 20 == 0, k=20)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of strings of 400 bytes that start more than once."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffixes.drop_repeated(docs, length=400)
    left = F.expr("make_valid_utf8(cast(kept as string))")  # a cut may fall within a character
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", left.alias("text"))


def op8_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and fertility bands over every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = fertility.judge(docs, keep_text=False)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", *fertility.MEASURES, "script",
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that stand earlier, and where these were."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = units.drop_repeats(docs, min_words=UNIT_WORDS)
    spans = F.transform("removed", lambda s: F.concat_ws("+", s["start"].cast("string"), s["length"].cast("string")))
    return found.withColumn("removed", F.array_join(spans, ","))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by pairwise ranking."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = ranking.score(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality"), threshold=0.3)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations that begin like the first of their hundred."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return trie.prefix_trie(turns)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every document towards the benchmark, and the ranks of the twentieth that is drawn."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, _table(spark, sf_dir, "benchmark").select("text"))


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose 4-word shingles overlap by 85 % or more."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.similar(docs, words=SHINGLE_WORDS, percent=SHINGLE_PERCENT)


LINE_RATIO, LINE_PAGES = 0.05, 5
SHINGLE_WORDS, SHINGLE_PERCENT = 4, 85
UNIT_WORDS = 1

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_line_dedup": op3_line_dedup,
    "op4_mixing": op4_mixing,
    "op5_packing": op5_packing,
    "op6_ann": op6_ann,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_tokeniser_fertility": op8_tokeniser_fertility,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality": op10_quality,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_importance": op12_importance,
    "op13_jaccard": op13_jaccard,
}

ORACLE: dict[str, str] = {
    "op3_line_dedup": lines.drop_boilerplate_sql("documents", LINE_RATIO, LINE_PAGES),
    "op4_mixing": mixing.mix_sql("documents"),
    "op9_substring_dedup": units.drop_repeats_sql("documents", UNIT_WORDS),
    "op11_prefix_trie": trie.prefix_trie_sql("conversations"),
    "op12_importance": importance.resample_sql("documents", "benchmark"),
    "op13_jaccard": jaccard.similar_sql("documents", SHINGLE_WORDS, SHINGLE_PERCENT),
}
