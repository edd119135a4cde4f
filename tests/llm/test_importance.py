import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from llm_helpers import DOCS, awkward, prose, table
from pyspark.sql import functions as F

from fieldcast.llm import importance


def runs(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(rows, goal, percent):
    """(doc_id, n_features, weight, score, rank) of every row, by the definitions."""
    found = [runs(r[1]) for r in rows]
    s, t = Counter(b for _, f in found for b in f), Counter(b for g in goal for b in runs(g)[1])
    total, wanted = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total + 10_000) / ((s[b] + 1) * (wanted + 10_000)))) for b in s}
    out, order = [], []
    for k, ((words, features), row) in enumerate(zip(found, rows, strict=True)):
        h = int(hashlib.sha256(f"42:{'' if row[0] is None else row[0]}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in features)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([row[0], len(features), weight, score, None])
        if len(words) >= 20:
            order.append((-score, row[0] is None, row[0] or 0, k))
    for rank, (*_, k) in enumerate(sorted(order)[: percent * len(order) // 100], 1):
        out[k][4] = rank
    return Counter(map(tuple, out))


@pytest.mark.parametrize(("percent", "segment"), [(5, 200_000), (40, 5), (100, 9)])
def test_equal_to_plain_version(spark, percent, segment, monkeypatch):
    monkeypatch.setattr(importance, "PIECE", 1000)
    monkeypatch.setattr(importance, "BATCH_WORDS", 3000)
    rows = [*awkward(), *((1000 + k, prose(k, 15 + k % 40), "en", "s", 0) for k in range(120))]
    rows += [(2000, f"{prose(5, 25)} {'Wörter' * 80} x{'y' * 300} \x7f 1a2B", "de", "s", 0)]
    goal = [prose(7, 60), None, "", prose(8, 30)]
    docs = table(spark, rows, rank="r", score="s", **{"lm score": "a", "lm kept 0": "b", "lm segment": "c", "lm id": "d", "bucket": "e"})
    target = spark.createDataFrame([(g, "z") for g in goal], "text string, `lm text` string")
    got = importance.resample(docs, target, percent=percent, rows_per_segment=segment)
    assert got.columns == [*(c for c in docs.columns if c not in ("text", "rank", "score")), "n_features", "weight", "score", "rank"]
    made = got.select("doc_id", "n_features", "weight", "score", "rank").collect()
    # repeated rows are alike, so it is open which of them has which rank
    assert Counter(tuple(r) for r in made) == plain(rows, goal, percent)


def test_one_score_for_very_many_rows(spark):
    docs = spark.createDataFrame([(7, prose(1, 30))], "doc_id long, text string").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(500))))
    ranks = [r["rank"] for r in importance.resample(docs, docs, percent=50, rows_per_segment=20).select("rank").collect()]
    assert sorted(r for r in ranks if r) == list(range(1, 251)) and len(ranks) == 500


def test_appending_bytes_to_a_crc():
    import numpy as np

    features = importance.Features(3)
    for size in (0, 1, 63, 64, 65, 4095, 100_000):
        after = zlib.crc32(bytes(size), zlib.crc32(b"abc"))
        moved = features.append(np.array([zlib.crc32(b"abc")], np.uint32), np.array([size]))[0]
        assert moved ^ zlib.crc32(bytes(size)) == after


def test_nothing(spark):
    docs, goal = spark.createDataFrame([], DOCS), spark.createDataFrame([], "text string")
    assert importance.resample(docs, goal).collect() == []
    one = importance.resample(table(spark, [(1, prose(1, 50), "en", "s", 0)]), goal, percent=100).first()
    assert one["rank"] == 1 and one["n_features"] == 147
