from collections import Counter

import pytest
import xxhash
from llm_helpers import awkward, prose, table

from fieldcast.llm import graph, simhash


def plain_print(text, words):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    grams = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    ones = Counter()
    for gram in grams:
        h = xxhash.xxh64_intdigest(gram, 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def plain_components(prints, ids, max_bits):
    root = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= max_bits:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    least = {}
    for r, i in zip(root, ids, strict=True):
        least[r] = i if least.get(r) is None else least[r] if i is None else min(least[r], i)
    return [least[r] for r in root]


@pytest.mark.parametrize("max_bits", [0, 1, 4, 9])
def test_against_plain_version(spark, max_bits):
    rows = awkward()
    for k in range(40):  # near copies that differ in a word or two
        words = prose(7 + k % 4, 200).split(" ")
        words[(11 * k) % len(words)] = f"new{k % 5}"
        rows.append((200 + k, " ".join(words), "en", "s", 0))
    got = simhash.near_duplicates(table(spark, rows, fp="x", component_id="y"), words=4, max_bits=max_bits)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "fp", "component_id"]
    prints = [plain_print(r[1], 4) for r in rows]
    ids = [r[0] for r in rows]
    expected = Counter(zip(ids, prints, plain_components(prints, ids, max_bits), strict=True))
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got.collect()) == expected


def test_one_of_each(spark):
    docs = table(spark, fp="x")
    rows = simhash.one_of_each(docs).collect()
    labels = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(table(spark)).collect()}
    assert len(rows) == len({c for _, c in labels})
    assert {r.doc_id for r in rows} == {c for _, c in labels}
    assert rows[0].fp == "x" and set(rows[0].asDict()) == set(docs.columns)


def test_empty(spark):
    docs = table(spark, [])
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_of_each(docs).count() == 0


def test_links_are_exact(spark):
    base = 0x0123456789ABCDEF
    values = [base ^ (1 << a) ^ (1 << b) ^ (1 << c) for a in range(0, 64, 7) for b in range(3, 64, 11) for c in range(0, 64, 13)]
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    got = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), 4)
    expected = {(a, b) for a in values for b in values if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 4}
    assert {(r.src, r.dst) for r in got.collect()} == expected


def test_exploded_keys_are_never_broadcast(spark):
    # Spark takes them to be as small as the fingerprints, and the driver would hold 70 rows for each
    frame = simhash.links(spark.createDataFrame([(v,) for v in (0, 1, 3, 1 << 40, -1)], "fp long"), 4)
    assert {(r.src, r.dst) for r in frame.collect()} == {(0, 1), (0, 3), (1, 3), (0, 1 << 40), (1, 1 << 40), (3, 1 << 40)}
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_components_of_chain_star_and_loops(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (3, 2), (200, 150), (150, 170)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {k: 100 for k in range(100, 140)} | {k: 150 for k in (150, 170, 200)}
