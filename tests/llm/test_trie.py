import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.llm import trie

TURNS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def plain(rows):
    """All nodes by gathering the members of every prefix."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            order = (turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest())
            own[c].append((order, (role, text)))
    own = {c: [turn for _, turn in sorted(v, key=lambda p: p[0])] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if whole[c] == p)
        above = min(members[p[:-1]]) if p else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(m), len(p), above, len(m), children[p], leaves[p], saved[p], sha))
    return Counter(out)


def conversations():
    draw = random.Random(3)
    ids = [*range(0, 500, 3), *range(-250, 0, 9), *range(100, 115)]
    texts = ["a", "bb", "", "hé😀", None, "x" * 50]
    rows = [
        (c, draw.choice([None, 0, 1]) if draw.random() < 0.1 else k, draw.choice(["user", "bot", None]), draw.choice(texts))
        for c in ids
        for k in range(draw.randint(1, 9))
    ]
    rows += [(None, 1, "a", "b"), *rows[:5]]  # no conversation, repeated rows
    rows += [(c, k, "user", "same") for c, n in ((5000, 150), (5003, 149)) for k in range(n)]  # long ones
    rows += [(c, k, "user", f"hot{k}") for c in range(6000, 7200, 100) for k in range(8)]  # copies
    return rows + [(8001, 0, "user", "alone")]  # may be left without any turn


@pytest.mark.parametrize("per_shard", [60, 10**6])
def test_nodes_equal_plain_version(spark, per_shard, monkeypatch):
    monkeypatch.setattr(trie, "PIECE_IDS", 5)
    rows = conversations()
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    clashes = ("id", "ids", "sizes", "sig", "shard", "salt", "depth", "digest", "turns", "head", "lm id", "n")
    turns = turns.withColumns({c: F.lit("x") for c in clashes})
    assert Counter(tuple(r) for r in trie.prefix_trie(turns, turns_per_shard=per_shard).collect()) == plain(rows)


def test_shards_of_one_list_each():
    lists = [[1], [1, 2], [1, 2, 3], [1, 2, 4], [1, 5], [2]]
    common = [1, 2, 2, 1, 0]
    made = [trie.first_shards(k, [0, 1, 2, 3, 4, 5], common, list(map(len, lists))) for k in range(6)]
    assert made == [[], [0, 0], [0, 0, 1], [0, 0, 1], [0, 0], [0]]


def test_siblings_are_balanced():
    tree = trie.Tree([([k], [1], 1, k, b"") for k in range(1023)])

    def height(node):
        return 1 + max(height(tree.lo[node]), height(tree.hi[node])) if node else 0

    assert height(tree.eq[0]) == 10


def test_nothing(spark):
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).collect() == []
