from collections import Counter, defaultdict

import pytest
from llm_helpers import awkward, prose, table

from fieldcast.llm import lines, units

STRIP = " \t\x0b\x0c\r"


def site(n):
    rows = [(k, f"menu\n{prose(k, 30)}\n  footer \nmenu\n\nrare {k % 7}", "en", "a" if k % 3 else "b", 0) for k in range(n)]
    return rows + [(900, "menu", "en", None, 0), (901, "menu\nmenu", "en", "c", 0), (902, None, "en", "a", 0), (903, "", "en", "a", 0)]


def plain_lines(rows, ratio, min_pages):
    pages, seen = Counter(r[3] for r in rows), defaultdict(Counter)
    for r in rows:
        seen[r[3]].update({x.strip(STRIP) for x in (r[1] or "").split("\n")} - {""})
    out = []
    for r in rows:
        often = {x for x, n in seen[r[3]].items() if n >= min_pages and n > ratio * pages[r[3]]}
        parts = [] if r[1] is None else r[1].split("\n")
        stay = [x for x in parts if x.strip(STRIP) not in often]
        out.append((r[0], r[3], None if r[1] is None else "\n".join(stay), len(parts) - len(stay)))
    return Counter(out)


@pytest.mark.parametrize(("ratio", "min_pages"), [(0.5, 5), (0.05, 2), (0.0, 1), (1.0, 1)])
def test_boilerplate_against_plain_version(spark, ratio, min_pages):
    rows = site(60) + awkward()
    got = lines.drop_boilerplate(table(spark, rows, n_dropped="x", host="y", lines="z", pages="a", line="b", n="c", **{"lm host": "d", "lm lines": "e", "lm stay": "f"}), "source", "text", ratio, min_pages)
    assert Counter((r.doc_id, r.source, r.text, r.n_dropped) for r in got.collect()) == plain_lines(rows, ratio, min_pages)
    assert "host" in got.columns


def test_boilerplate_stays_native(spark):
    plan = lines.drop_boilerplate(table(spark, site(9)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_boilerplate_of_nothing(spark):
    assert lines.drop_boilerplate(table(spark, [])).count() == 0


def plain_units(rows, separator, min_words):
    """With distinct ids: what stays of each text, and what went from where."""
    seen, out = set(), {}
    for r in sorted(rows, key=lambda r: r[0]):
        stay, gone, start = [], [], 0
        for part in (r[1] or "").split(separator):
            plain = b" ".join(part.encode().lower().split())
            if plain and len(plain.split(b" ")) >= min_words and plain in seen:
                gone.append((start, len(part)))
            else:
                stay.append(part)
            seen.add(plain)
            start += len(part) + len(separator)
        out[r[0]] = (None if r[1] is None else separator.join(stay), gone)
    return out


@pytest.mark.parametrize(("separator", "min_words"), [("\n", 5), ("\n", 1), ("\n\n", 2)])
def test_units_against_plain_version(spark, separator, min_words):
    rows = [r for r in awkward() if r[0] is not None and r[0] < 101] + site(20)[:20]
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]
    got = units.drop_repeats(table(spark, rows, removed="x", gone="y", lm_row="z", digest="a", id="b", at="c", first="d", **{"lm row": "e", "lm gone": "f"}), separator=separator, min_words=min_words).collect()
    assert {r.doc_id: (r.text, [tuple(s) for s in r.removed]) for r in got} == plain_units(rows, separator, min_words)
    assert all(r.n_removed == len(r.removed) for r in got)


def test_units_of_equal_rows_and_null_ids(spark):
    rows = [(None, "a b c d e", "en", "s", 0), (5, "A  b c d e ", "en", "s", 0), (5, "A  b c d e ", "en", "s", 0), (None, None, None, None, None)]
    got = units.drop_repeats(table(spark, rows)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter({(None, ""): 1, (5, "A  b c d e "): 1, (5, ""): 1, (None, None): 1})


def test_units_without_blanks_take_part(spark):
    texts = ["重复的一段文字没有空格。", "ข้อความที่ซ้ำกัน", "https://example.org/" + "path/" * 30, "two words"]
    rows = [(k, "\n".join([*texts, f"{k}"]), None, "s", 0) for k in range(2)]
    got = {r.doc_id: r.text for r in units.drop_repeats(table(spark, rows), min_words=5).collect()}
    assert got == {0: rows[0][1], 1: "two words\n1"}


def test_units_of_nothing(spark):
    assert units.drop_repeats(table(spark, [])).count() == 0
