from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import awkward, table
from tokenizers import Tokenizer

from fieldcast.llm import packing


def ids_of(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_equal_those_of_the_tokenizers_library():
    bpe = packing.ByteBpe()
    odd = ["", " ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "don't we'll", "x  y", "<|endoftext|> z", "a<|endoftext|>b", "end. <|endoftext|> Next", "<|endoftext|><|endoftext|>", "x <|endo y\n<|endoftext|>\n", "x", "x", "12 3,4\t5", "é ß  q", "word " * 50 + "\x1c a"]
    texts = odd + [r[1] for r in awkward()]
    for _ in range(2):  # the second time from memory
        assert [x.tolist() for x in bpe.encode([t or "" for t in texts])] == ids_of(texts)


@pytest.mark.parametrize(("capacity", "shard_tokens"), [(2048, 1 << 20), (64, 1 << 12), (1, 1 << 10)])
def test_every_id_is_in_one_piece(spark, capacity, shard_tokens):
    rows = [r for r in awkward() if len(r[1] or "") < (10_000 if capacity == 1 else 1_000_000)]
    got = packing.pack(table(spark, rows, start="x", ids="y"), capacity=capacity, shard_tokens=shard_tokens).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length > 0
        pieces[r.doc_row].append((r.start, ids, r.doc_id, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    made = Counter()
    for parts in pieces.values():
        parts.sort()
        ids = [x for _, part, _, _ in parts for x in part]
        assert [p[0] for p in parts] == np.cumsum([0, *(len(p[1]) for p in parts)])[:-1].tolist()
        assert {p[3] for p in parts} == {len(ids)}
        made[parts[0][2], tuple(ids)] += 1
    assert made == Counter((r[0], (*ids, 1)) for r, ids in zip(rows, ids_of([r[1] for r in rows]), strict=True))
    for parts in sequences.values():
        parts.sort()
        assert [p[0] for p in parts] == np.cumsum([0, *(p[1] for p in parts)])[:-1].tolist()
        assert sum(p[1] for p in parts) <= capacity
    total, shards = sum(r.length for r in got), len({s >> 36 for s in sequences})
    assert len(sequences) * capacity - total < capacity * shards


def test_costs_are_balanced():
    draw = np.random.default_rng(1)
    sizes = draw.integers(1, 900, 400)
    cost = defaultdict(float)
    for _row, _start, length, sequence, _offset in packing.assign(np.arange(400), sizes, 2048, 1.0, 1 / 2048):
        cost[sequence] += length + length * length / 2048
    values = np.array(sorted(cost.values()))
    in_order = np.add.reduceat(sizes + sizes**2 / 2048, np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum(), 2048)))
    assert values.std() / values.mean() < 0.6 * in_order.std() / in_order.mean()


def test_nothing(spark):
    assert packing.pack(table(spark, [])).count() == 0
