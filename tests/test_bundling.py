"""Next-fit in blocks against the plain loop."""

import random

import pytest

from fieldcast.operators.bundling import NO_LIMIT, block_table, next_fit


def plain(sizes, limit, max_files=NO_LIMIT, entry=None):
    """Indexes by the plain loop, and (bytes, files) left open."""
    index, now, out = 0, entry, []
    for size in sizes:
        if now is not None and (now[0] + size > limit or now[1] + 1 > max_files):
            index, now = index + 1, None
        now = (size, 1) if now is None else (now[0] + size, now[1] + 1)
        out.append(index)
    return out, now


@pytest.mark.parametrize("seed", range(30))
def test_composed_block_functions_follow_the_loop(seed):
    import numpy as np

    rng = random.Random(seed)
    limit, most = rng.choice([1, 10, 50]), rng.choice([1, 2, 5, 9, NO_LIMIT])
    sizes = [rng.choice([0, 0, 1, 3, 7, 20, 60]) for _ in range(60)]
    cuts = sorted(rng.sample(range(1, 60), 5))
    blocks = [sizes[a:b] for a, b in zip([0, *cuts], [*cuts, 60])]
    tables = [block_table(np.array(b), limit, most) for b in blocks]
    entry, closed, whole, tail = None, 0, None, None
    for table in tables:
        more, *left = table.apply(entry)
        entry, closed = tuple(left), closed + more
        whole = table if whole is None else whole.then(table)
        tail = tail if whole is table else table if tail is None else tail.then(table)
    indexes, left = plain(sizes, limit, most)
    assert (closed, entry) == (indexes[-1], left)
    assert whole.apply(None) == (indexes[-1], *left)
    # any entry, as for a block in the middle
    rest = [s for b in blocks[1:] for s in b]
    for size in range(0, 75, 3):
        for files in (1, 2, 4, 9, 30):
            wanted, left = plain(rest, limit, most, (size, files))
            assert tail.apply((size, files)) == (wanted[-1], *left), (size, files)


@pytest.mark.parametrize("rows_per_block, fan_in, most", [(None, 1000, None), (40, 1000, 4), (20, 3, None), (20, 3, 6)])
def test_next_fit_equals_the_loop_for_a_hot_group(spark, rows_per_block, fan_in, most):
    rng = random.Random(5)
    data = [("hot" if i % 10 else None if i % 20 else "cold", f"m{rng.random()}", rng.choice([0, 5, 900, 3000, 20000])) for i in range(800)]
    frame = spark.createDataFrame(data, "lang string, id string, bytes bigint")
    found = next_fit(frame, ["lang"], "id", "bytes", 10_000, rows_per_block, fan_in, most).collect()
    got = {(r["lang"], r["id"]): r["bundle_index"] for r in found}
    assert len(found) == len(data)
    for lang in ("hot", "cold", None):
        part = sorted((i, b) for g, i, b in data if g == lang)
        wanted, _ = plain([b for _, b in part], 10_000, most or NO_LIMIT)
        assert [got[(lang, i)] for i, _ in part] == wanted
