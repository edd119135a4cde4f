import hashlib
import math
from collections import Counter

import pytest
from llm_helpers import awkward, table

from fieldcast.llm import mixing


def uniform(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 16**13


def plain(rows, weights, size, seed):
    n = Counter(r[3] for r in rows)
    weights = {s: math.sqrt(k) for s, k in n.items()} if weights is None else weights
    total = sum(weights.get(s, 0.0) for s in n)
    out = Counter()
    for r in rows:
        rate = weights.get(r[3], 0.0) / total * (len(rows) if size is None else size) / n[r[3]] if total else 0.0
        key = "null" if r[0] is None else r[0]
        u, copies, p, below = uniform(f"{seed}:copies", key), 0, math.exp(-rate), 0.0
        while rate and copies < 1000:
            below += p
            if u < below:
                break
            copies += 1
            p *= rate / copies
        for k in range(copies if rate else 0):
            out[r[0], r[1], k, uniform(f"{seed}:order", key, k)] += 1
    return out


@pytest.mark.parametrize(
    ("weights", "size"), [(None, None), ({"src0": 3.0, "src1": 1.0}, 100.0), ({None: 1.0}, 40.0), ({}, None), (None, 0.0), ({"no such": 1.0}, 5.0)]
)
def test_against_plain_version(spark, weights, size):
    got = mixing.mix(table(spark, copy="x", shuffle_key="y", rate="z", **{"lm source": "a", "lm below": "b", "lm u": "c"}), weights=weights, size=size, seed=7)
    rows = got.collect()
    assert Counter((r.doc_id, r.text, r["copy"], r.shuffle_key) for r in rows) == plain(awkward(), weights, size, 7)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "rate", "lm source", "lm below", "lm u", "copy", "shuffle_key"]


def test_mean_rates(spark):
    rows = [(k, "t", "en", "a" if k < 9000 else "b", 1) for k in range(10_000)]
    got = mixing.mix(table(spark, rows), weights={"a": 1.0, "b": 1.0}).groupBy("source").count().collect()
    assert all(abs(r["count"] - 5000) < 5 * math.sqrt(5000) for r in got)


def test_nothing_and_bad_weights(spark):
    assert mixing.mix(table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(table(spark), weights={"src0": -1.0})
