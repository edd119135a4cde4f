import hashlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import awkward, prose, table

from fieldcast.llm import suffixes


def plain(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(b[k : k + length] for b in texts for k in range(len(b) - length + 1))
    out = Counter()
    for r, b in zip(rows, texts, strict=True):
        change = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                change[k] += 1
                change[k + length] -= 1
        gone = np.cumsum(change)[:-1] > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[r[0], len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def edges():
    """Passages that meet their repeats at other places, overlap, end with the text, or differ in one byte."""
    a, b = prose(50, 80), prose(51, 80)
    rows = [a + b, b + a, "x" + a, a[:399], a[:400], a[100:] + b[:150], a[:200] + "#" + a[201:], a + a, prose(52, 40) + b[37:]]
    rows += [prose(60 + k, 15) + a[k : k + 400 + k] + prose(90 + k, 15) for k in range(20)]
    rows += ["ab" * 500, "ab" * 300, "a" * 400, "a" * 401, "ü" * 300, "ü" * 199 + "xy"]
    return [(k, t, "en", "s", 0) for k, t in enumerate(rows)]


@pytest.mark.parametrize("hot", [5000, 1])
@pytest.mark.parametrize("length", [400, 37])
def test_against_plain_version(spark, length, hot):
    rows = edges() + [(r[0] if r[0] is None else r[0] + 500, *r[1:]) for r in awkward() if len(r[1] or "") < 50_000]
    got = suffixes.drop_repeated(table(spark, rows, kept="x", n_bytes="y", k1="z", k2="a", spans="b", low="c", at="d", name="e", **{"lm text": "f", "lm spans": "g"}), length=length, hot=hot).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == plain(rows, length)
    for r in got:
        assert sum(s.length for s in r.removed) == r.n_removed and len(r.removed) == r.n_spans
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256


def test_long_text_and_nothing(spark):
    long = prose(5, 60_000)
    rows = [(1, long, "en", "s", 0), (2, "zz" + long[1000:3000] + "zz", "en", "s", 0)]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffixes.drop_repeated(table(spark, rows)).collect()}
    assert got == {1: (2000, 1), 2: (2000, 1)}
    assert suffixes.drop_repeated(table(spark, [])).count() == 0


def test_sliding_least():
    x = np.random.default_rng(3).integers(0, 50, 200)
    for width in (1, 2, 7, 199, 200):
        assert suffixes.sliding_least(x, width).tolist() == [x[k : k + width].min() for k in range(200 - width + 1)]
