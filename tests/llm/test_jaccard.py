import random
from collections import Counter

import pytest
from llm_helpers import DOCS, awkward, prose, table

from fieldcast.llm import jaccard


def shingles(text, words=4):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def plain(rows, words, percent):
    """Components by comparing all pairs."""
    sets = [shingles(r[1], words) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, row in enumerate(rows):
        ids = least.setdefault(find(k), [])
        ids += [row[0]] if row[0] is not None else []
    return Counter((row[0], len(sets[k]), min(least[find(k)], default=None)) for k, row in enumerate(rows))


def near(seed, base, edits):
    draw, words = random.Random(seed), base.split(" ")
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**9)}"
    return " ".join(words)


def documents():
    rows = awkward()
    hot, passage = prose(50, 150), prose(51, 60)
    rows += [(1000 + k, near(k, hot, k % 9), "en", "s", 0) for k in range(150)]  # a large group around the threshold
    rows += [(2000 + k, f"{passage} {prose(3000 + k, 3 + k % 30)}", "en", "s", 0) for k in range(90)]  # a passage most texts consist of
    rows += [(3000 + k, near(k, prose(52, 40 + k // 4), k % 4), "en", "s", 0) for k in range(40)]
    rows += [(4000 + k, " ".join(random.Random(k).choices("ab", k=3 + k % 12)), "en", "s", 0) for k in range(60)]  # few shingles, often
    return [r for r in rows if r[1] is None or len(r[1]) < 50_000]


@pytest.mark.parametrize(("words", "percent", "few", "many"), [(4, 85, 32, 255), (4, 85, 3, 20), (2, 60, 4, 20), (3, 50, 8, 30), (4, 100, 2, 255)])
def test_components_equal_all_pairs(spark, monkeypatch, words, percent, few, many):
    monkeypatch.setattr(jaccard, "FEW", few)
    monkeypatch.setattr(jaccard, "MANY", many)
    monkeypatch.setattr(jaccard, "CLASSES", ((2, 6), (3, many)))
    monkeypatch.setattr(jaccard, "BLOCK", 5000)
    rows = documents()
    docs = table(spark, rows, n_shingles="a", row="b", tokens="c", n="d", digest="e", kind="f", bucket="g", block="h", id="i")
    got = jaccard.similar(docs, words=words, percent=percent)
    assert got.columns == [*(c for c in docs.columns if c not in ("text", "n_shingles")), "n_shingles", "component_id"]
    made = Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect())
    assert made == plain(rows, words, percent)


@pytest.mark.parametrize("percent", [60, 70, 85, 95])
def test_alike_sets_meet(percent):
    draw = random.Random(percent)
    met = 0
    for _ in range(400):
        n = draw.randint(1, 120)
        counts = {t: draw.choice([2, 3, 20, 40, 255]) for t in draw.sample(range(10**6), n + 40)}
        a = draw.sample(sorted(counts), n)
        b = set(a)
        for _ in range(draw.randint(0, max(1, n // 10))):
            b.discard(draw.choice(a))
            b.add(draw.choice(sorted(counts)))
        if not b or 100 * len(b & set(a)) < percent * len(b | set(a)):
            continue
        signed = []
        for s in sorted((a, sorted(b)), key=len):
            order = sorted(s, key=lambda t: (counts[t], t))
            signed.append(jaccard.signatures(order, [counts[t] for t in order], len(order), percent))
        small, large = signed
        assert any(role & jaccard.SMALL and large.get(sig, 0) & jaccard.LARGE for sig, role in small.items())
        met += 1
    assert met > 50


def test_long_sets_have_few_combinations():
    tokens = list(range(1, 20_000))
    assert len(jaccard.signatures(tokens, [255] * len(tokens), len(tokens), 85)) < 3 * len(tokens)


def test_a_very_long_text_and_its_near_copy(spark):
    long = prose(903, 20_000)
    rows = [(1, long, "en", "s", 0), (2, near(1, long, 300), "en", "s", 0), (3, near(2, long, 2000), "en", "s", 0)]
    assert [r["component_id"] for r in jaccard.similar(table(spark, rows)).sort("doc_id").collect()] == [1, 1, 3]


def test_nothing(spark):
    assert jaccard.similar(spark.createDataFrame([], DOCS)).collect() == []
    blank = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n", "en", "s", 0)]
    assert {tuple(r)[-2:] for r in jaccard.similar(table(spark, blank)).collect()} == {(0, 1), (0, 2), (0, 3)}
