import math

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.llm import neighbours

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def plain(rows, k):
    out = []
    fine = [
        (i, np.array(v, np.float64)) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    for q, a in fine:
        if q % 20 == 0:
            scored = sorted((-float(a @ b), i) for i, b in fine if i != q and len(b) == len(a))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"rank": F.lit("x"), "score": F.lit("y"), "block": F.lit(1)})
    got = neighbours.nearest(frame.repartition(3), F.col("vec_id") % 20 == 0, **options)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())


def agree(got, expected):
    assert [x[:3] for x in got] == [x[:3] for x in expected]
    assert np.allclose([x[3] for x in got], [x[3] for x in expected], rtol=0, atol=1e-12)


def test_awkward_vectors_and_ties(spark):
    draw = np.random.default_rng(0)
    rows = [(k, draw.integers(-3, 4, 4).astype(float).tolist()) for k in range(1, 90)]
    rows += [(k, [1.0, 2.0, 0.0, 1.0]) for k in range(100, 140)]  # ties
    rows += [(200, None), (220, []), (240, [0.0] * 4), (260, [1.0, None, 1.0, 1.0]), (280, [float("nan"), 1.0, 1.0, 1.0])]
    rows += [(300, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (320, [1.0, 2.0]), (321, [2.0, 2.0]), (340, [1.0, 2.0, 3.0])]
    for options in ({}, {"vector_block": 16, "query_block": 2}):
        agree(found(spark, rows, k=20, **options), plain(rows, 20))


def test_recall_on_hard_vectors(spark):
    draw = np.random.default_rng(1)
    centres = draw.standard_normal((30, 32))
    rows = []
    for k in range(3000):
        v = draw.standard_normal(32) if k % 2 else centres[k % 30] + 0.1 * draw.standard_normal(32)
        rows.append((k, (v * draw.uniform(0.5, 2)).astype(np.float32).tolist()))
    got, expected = found(spark, rows, k=20, vector_block=1000, query_block=64), plain(rows, 20)
    assert len(got) == len(expected)
    hits = {(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in expected}
    assert len(hits) >= 0.95 * len(expected)


def test_few_and_none(spark):
    agree(found(spark, [(20, [1.0, 0.0]), (1, [0.5, 0.5])], k=20), [(20, 1, 1, 0.5)])
    assert found(spark, [(20, [1.0, 0.0])]) == []
    assert found(spark, []) == []


def test_repeated_rows(spark):
    got = found(spark, [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5])], k=2)
    assert got == [(20, 1, 1, 0.5), (20, 1, 1, 0.5), (20, 2, 1, 0.5), (20, 2, 1, 0.5)]
