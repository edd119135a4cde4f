"""Stages on small documents, against plain versions of what each stage decides."""

from collections import Counter

import corpus_pipeline
from llm_helpers import awkward, prose, table

from fieldcast.llm import fertility, queries, simhash
from fieldcast.llm.common import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rows = [(1000 + k, f"shared menu line here now\n{prose(k, 90 + k)}", "en", f"src{k % 2}", 0) for k in range(40)]
    words = prose(3, 400).split(" ")
    rows += [(2000 + k, " ".join([*words[:-1], f"w{k}"]), "en", "src1", 0) for k in range(3)]
    return rows + awkward()


def test_stages(spark):
    docs, seen = table(spark, corpus()), []
    before = Counter(tuple(r) for r in docs.collect())
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, ""), "test-stage")
        seen.append((name, docs, after))
        docs = after
    assert all(a.columns == COLUMNS for _, _, a in seen[:-1])
    (_, _, good), (_, _, lines), (_, _, single), (_, _, mixed), (_, _, packed) = seen

    kept = Counter(tuple(r[c] for c in COLUMNS) for r in fertility.judge(table(spark, corpus())).where("kept").collect())
    assert Counter(tuple(r) for r in good.collect()) == kept and kept <= before
    assert lines.count() == good.count()
    assert not lines.where("text like '%shared menu line here now%'").count()
    assert lines.where("n_chars <> length(text)").count() == 0

    labels = simhash.near_duplicates(lines).collect()
    assert Counter(r.doc_id for r in single.collect()) == Counter({r.component_id for r in labels})
    assert {r.doc_id for r in single.collect()} & {2000, 2001, 2002} == {2000}

    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in single.collect()}
    assert packed.select("doc_row").distinct().count() == mixed.count()
    assert packed.where("length < 1 or length > 2048 or offset < 0").count() == 0


def test_registered():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLE) < set(queries.QUERIES)


def test_pipeline_of_nothing(spark):
    docs = table(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), "test-stage")
    assert docs.count() == 0
