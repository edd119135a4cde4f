import math
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from llm_helpers import awkward, prose, table
from pyspark.sql import functions as F

from fieldcast.llm import fertility, textstats


def plain(text):
    words = (text or "").encode().split()
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ids = [i for w in words for i in pieces.encode(w.decode())]
    share = [n / len(ids) for n in Counter(ids).values()]
    chars = sum(len(w.decode()) for w in words)
    return (
        len(words), chars, sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), len(ids),
        chars / len(ids) if ids else None, sum(map(pieces.is_byte, ids)) / len(ids) if ids else None,
        -sum(p * math.log2(p) for p in share) if ids else None,
    )


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", *fertility.MEASURES)


def test_figures_against_plain_version(spark):
    rows = [*awkward(), (300, "a b c a b c\na b\na b\n#x# 汉字 😀", "zh", "s", 0), (301, "x y z x y", "en", "s", 0)]
    got = fertility.measured(table(spark, rows, n_words="x")).collect()
    made = {r.text: [r[c] for c in NAMES] for r in got}
    assert len(got) == len(rows)
    for text, values in made.items():
        for a, b in zip(values, plain(text), strict=True):
            assert a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9), (text, values)


def test_many_distinct_words_do_not_overflow():
    text = " ".join(map(str, range(2_200_000))) + " 0 1 2"
    f = textstats.figures(text)
    assert f.n_repeat_words == 6 and len(f.words) == 2_200_003


def test_verdicts(spark):
    rows = [(k, prose(k, 80 + k), "en", "s", 0) for k in range(60)]
    rows += [(100, "힣ༀሴ " * 80, "en", "s", 0), (101, " ".join(f"{k}{chr(0x2580 + k)}" for k in range(90)), "en", "s", 0)]
    rows += [(102, prose(1, 30), "en", "s", 0), (103, "w v u " * 40, "en", "s", 0), (104, None, None, None, None), (105, prose(2, 90), None, "s", 0)]
    docs = table(spark, rows * 1, kept="x", base_failed="y", **{"lm group": "z", "low byte_share": "a", "lm lang": "b", "lm band 0": "c", "lm group 0": "d"})
    got = {r.doc_id: r for r in fertility.judge(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[k].kept and not got[k].base_failed for k in range(60))
    assert not got[100].kept and not got[101].kept and not got[101].base_failed
    assert all(got[k].base_failed and not got[k].kept for k in (102, 103, 104))
    assert got[105].kept and got[105].script == "latin"


@pytest.mark.parametrize(("text", "name"), [("", "other"), ("123", "other"), ("abc д", "latin"), ("дом a", "cyrillic"), ("漢字かな漢", "han"), ("Ünï", "latin")])
def test_script(text, name):
    assert fertility.script(text) == name


def test_bands_reach_as_far_as_the_measured_ranges_say(spark):
    rows = [(2.0 + k / 1000, 0.0, 4.0 + k / 100, 256, False, 0, 100) for k in range(101)]
    names = ("chars_per_token", "byte_share", "token_entropy", "n_tokens", "base_failed", "n_symbols", "word_chars")
    made = fertility.bands(spark.createDataFrame(rows, names), F.lit("all"), 2.0, 30, 5).first()
    wanted = [2.025 - 0.1, 2.075 + 0.1, -0.02, 0.02, (4.25 - 1) / 8, (4.75 + 1) / 8]
    assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(made[1:], wanted, strict=True)), made


def test_small_groups_take_wider_bands(spark):
    rows = [(k, prose(k, 80 + k), "en", "s", 0) for k in range(60)]
    junk = " ".join(f"{k}{chr(0x2580 + k)}" for k in range(90))
    rows += [(100 + k, junk if k % 2 else prose(k, 90), "xx", "s", 0) for k in range(10)]  # too few for a band of their own
    rows += [(200, "ж" + " ж".join(chr(0x430 + k % 30) * 9 for k in range(80)), "ru", "s", 0)]  # a script without bands
    got = {r.doc_id: r.kept for r in fertility.judge(table(spark, rows)).collect()}
    assert all(got[100 + k] == (k % 2 == 0) for k in range(10)) and not got[200]


def test_verdict_equals_plain_version(spark):
    rows = [(k, prose(k, 60 + k % 70) + (" \u2580" * (k % 9) if k % 7 == 0 else ""), "en" if k % 3 else None, "s", 0) for k in range(150)]
    judged = fertility.judge(table(spark, rows)).collect()

    def shape(r):
        return r.chars_per_token, r.byte_share, r.token_entropy / math.log2(max(2, min(r.n_tokens, 256)))

    def limits(group):
        usual = [shape(r) for r in group if not r.base_failed and 100 * r.n_symbols <= 5 * r.word_chars]
        for values, flat in zip(zip(*usual, strict=True), (0.15, 0.01, 0.03), strict=True):
            values = sorted(values)
            low, high = (values[max(0, math.ceil(q * len(values)) - 1)] for q in (0.25, 0.75))
            yield low - 2 * (high - low or flat), high + 2 * (high - low or flat)

    by_group = {lang: list(limits([r for r in judged if r.lang == lang])) for lang in ("en",)}
    by_group[None] = list(limits(judged))  # all are of one script
    for r in judged:
        inside = all(low <= v <= high for v, (low, high) in zip(shape(r), by_group[r.lang], strict=True))
        assert r.kept == (not r.base_failed and inside), r.doc_id
    assert 0 < sum(r.kept for r in judged) < len(judged)


def test_labelled_junk_is_rejected(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    judged = fertility.judge(read("documents")).where("not base_failed").join(read("labels"), "doc_id")
    kept = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept[0] < 0.5 and kept[1] > 0.95, kept


def test_nothing(spark):
    assert fertility.judge(table(spark, [])).count() == 0
