import random
import zlib

import numpy as np
import pytest
from llm_helpers import awkward, prose, table

from fieldcast.llm import grammar, ranking, toxicity

LABELS = "doc_id long, toxic int, quality int, score string"


def corpus():
    draw = random.Random(5)
    rows, labels = [], []
    for k in range(600):
        words = prose(k, draw.randint(40, 200)).split(" ")
        toxic, bad = k % 6 == 0, k % 5 == 1
        if toxic:
            for _ in range(draw.randint(2, 5)):
                words.insert(draw.randrange(len(words)), draw.choice(["zogfoul", "Vrakter", "brimox"]) + draw.choice(["", ",", "."]))
        if bad:
            words = [w + draw.choice(["###", "$$$", "|"]) for w in words] if k % 2 else [w for w in words for _ in range(6)]
        rows.append((k, " ".join(words), "en", "s", 0))
        labels.append((k, int(toxic), int(not bad), "x"))
    return rows, labels


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.mark.parametrize(("score", "column"), [(toxicity.score, "toxic"), (ranking.score, "quality")])
def test_held_out_documents(spark, score, column):
    rows, labels = corpus()
    awkward_rows = [(None if r[0] is None else r[0] + 5000, *r[1:]) for r in awkward()]
    labelled = spark.createDataFrame(labels + [(None, 1, 1, None), (5001, None, None, None)], LABELS)
    got = score(table(spark, rows + awkward_rows, score="x", label="y", held_out=1), labelled).collect()
    assert len(got) == len(rows) + len(awkward_rows)
    truth = {i: (t if column == "toxic" else q) for i, t, q, _ in labels}
    threshold = 0.5 if column == "toxic" else 0.3
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) and r.held_out == held(r.doc_id) for r in got)
    tested = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(tested) > 80 and np.mean([r.predicted == truth[r.doc_id] for r in tested]) > 0.97
    empty = {r.score for r in got if r.doc_id in (5016, 5017, 5100, None)} - {r.score for r in got if r.doc_id == 5012}
    assert len(empty) <= 1 or column == "quality"


@pytest.mark.parametrize("score", [toxicity.score, ranking.score])
def test_held_out_labels_are_not_read(spark, score):
    rows, labels = corpus()
    turned = [(i, 1 - t, 1 - q, s) if held(i) else (i, t, q, s) for i, t, q, s in labels]
    one, two = (
        {r.doc_id: r.score for r in score(table(spark, rows), spark.createDataFrame(x, LABELS)).collect()} for x in (labels, turned)
    )
    assert one == two


@pytest.mark.parametrize("score", [toxicity.score, ranking.score])
def test_without_labels_or_documents(spark, score):
    none = spark.createDataFrame([], LABELS)
    assert len({r.score for r in score(table(spark), none).collect()}) == 1
    one_class = spark.createDataFrame([(k, 1, 1, "") for k in range(10)], LABELS)
    assert len({r.score for r in score(table(spark), one_class).collect()}) == 1
    assert score(table(spark, []), none).count() == 0


def weight(symbols):
    return grammar.clause_weight(grammar.clause_grammar(), [(s, 2.0) for s in symbols])


def test_grammar():
    assert weight("ooo") == (0.0, 0)
    assert weight("oio") == (2.0, 1)
    assert weight("yoi") == (2.0 * grammar.DIRECTED, 1)
    assert weight("ooiy") == (2.0 + grammar.BONUS, 1)
    assert weight("noi") == (2.0 * grammar.NEGATED, 1)
    assert weight("nooooi") == (2.0, 1)
    assert weight("roi") == (2.0 * grammar.REPORTED, 1)
    assert weight("qoiqi") == pytest.approx((2.0 * grammar.REPORTED + 2.0, 2))
    assert weight("t") == (0.0, 0) and weight("y") == (0.0, 0)
    assert weight("oty") == (grammar.THREAT_WEIGHT, 1)
    assert weight("nty") == (grammar.THREAT_WEIGHT * grammar.NEGATED, 1)


def test_composition_is_one_after_the_other():
    first, second = grammar.target(), grammar.negation()
    both = grammar.compose(first, second)
    draw = random.Random(2)
    for _ in range(200):
        a = b = c = 0
        for _ in range(12):
            symbol = draw.choice("oyintrq")
            a, middle, f = first[a, symbol]
            b, out, g = second[b, middle]
            c, got, h = both[c, symbol]
            assert (got, h) == (out, f * g)


def test_the_cut_is_that_of_all_labelled_documents(spark):
    values = [((k * 7919) % 5003) ** 3 / 1e9 for k in range(5003)]
    rows = [(float(v), k % 2) for k, v in enumerate(values)]
    assert ranking.quantile(spark.createDataFrame(rows, "strength double, label int"), {0: 1.0, 1: 1.0}, 1234 / 5003) == sum(sorted(values)[1233:1235]) / 2
    equal = spark.createDataFrame([(2.0, k % 2) for k in range(1500)], "strength double, label int")
    assert ranking.quantile(equal, {0: 1.0, 1: 1.0}, 0.5) == 2.0
    strengths = spark.createDataFrame([(k, float(v)) for k, v in enumerate(values)], "id long, strength double")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(5003)], "doc_id long, quality int")
    taught = [(k, values[k]) for k in range(5003) if zlib.crc32(str(k).encode()) % 5]
    bad, order = sum(k % 3 == 0 for k, _ in taught), sorted(v for _, v in taught)
    assert ranking.cut_of(strengths, labels, "quality", "doc_id") == (order[bad - 1] + order[bad]) / 2
