"""Pattern joins against a plain LIKE matcher."""

import re

import pytest

from pyspark.sql import functions as F

from fieldcast.operators.names import ilike_join, match_names, pattern_grams, wildcard_flags

SUBJECTS = ["pkg_1", "PKGX1", "pkg-1", "abc", "ABCD", "a%c", None, "", "pkg_1_long", "x", "ab_c", "b\\", "été_1é", "%"]
PATTERNS = [
    "PKG_1", "abc", "ab%", "%", "a\\%c", "pkg__", None, "", "zzz", "%g_1%", "%", "_", "%\\%%", "%_b%", "%long", "a_\\_%", "%b\\\\%", "__%__",
]


def ilike(subject, pattern):
    if subject is None or pattern is None:
        return False
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
            out += re.escape(pattern[i])
        else:
            out += {"%": ".*", "_": "."}.get(c, re.escape(c))
        i += 1
    return re.fullmatch(out, subject, re.I | re.S) is not None


@pytest.fixture
def sides(spark):
    subjects = spark.createDataFrame([(k, s, i) for k in ("p", "q") for i, s in enumerate(SUBJECTS)], "k string, s string, sid int")
    patterns = spark.createDataFrame([(k, s, i) for k in ("p", "r") for i, s in enumerate(PATTERNS)], "k string, pat string, pid int")
    return subjects, patterns


EXPECTED = sorted((i, j) for i, s in enumerate(SUBJECTS) for j, p in enumerate(PATTERNS) if ilike(s, p))


def test_inner_join_with_the_pattern_on_either_side(sides):
    subjects, patterns = sides
    right = ilike_join(subjects, patterns, ["k"], "s", "pat", "right")
    left = ilike_join(patterns, subjects, ["k"], "pat", "s", "left")
    for joined in (right, left):
        assert sorted((r["sid"], r["pid"]) for r in joined.collect()) == EXPECTED
        assert {r["k"] for r in joined.collect()} == {"p"}


def test_left_join_keeps_unmatched_patterns_once(sides):
    subjects, patterns = sides
    joined = ilike_join(patterns, subjects, ["k"], "pat", "s", "left", how="left").where("k = 'p'").collect()
    lonely = sorted(r["pid"] for r in joined if r["sid"] is None)
    assert lonely == sorted(set(range(len(PATTERNS))) - {j for _, j in EXPECTED})
    assert sorted((r["sid"], r["pid"]) for r in joined if r["sid"] is not None) == EXPECTED


def test_plain_names_join_on_equality_only(spark):
    a = spark.createDataFrame([("p", "Ab", 1)], "k string, s string, x int")
    b = spark.createDataFrame([("p", "aB", 2)], "k string, pat string, y int")
    joined = ilike_join(a, b, ["k"], "s", "pat", "right", wildcards=False)
    assert [(r["x"], r["y"]) for r in joined.collect()] == [(1, 2)]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "LIKE" not in plan.upper()


def test_no_nested_loop_join(sides):
    subjects, patterns = sides
    for frame in (ilike_join(subjects, patterns, ["k"], "s", "pat", "right"), match_names(subjects, patterns, ["k"], "s", "pat")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_outer_join_must_keep_the_pattern_side(sides):
    with pytest.raises(ValueError):
        ilike_join(sides[0], sides[1], ["k"], "s", "pat", "right", how="left")


def test_wildcard_flags(spark):
    frame = spark.createDataFrame([("a_b", "x", None), ("c", "y", None)], "a string, b string, c string")
    assert wildcard_flags(frame, ["a", "b", "c"]) == {"a": True, "b": False, "c": False}


def test_grams_of_a_pattern(spark):
    def grams(pattern):
        row = spark.createDataFrame([(pattern,)], "p string").select(pattern_grams(F.col("p")).alias("g")).first()
        return {g.replace("\ue003", "^").replace("\ue004", "$").replace("\ue005", "?") for g in row["g"]}

    assert grams("%a_1%") == {"^", "a", "1", "a?1", "$"}
    assert grams("ab%") == {"^", "a", "b", "^a", "ab", "^ab", "^?b", "$"}
    assert grams("%\\__\\\\%") == {"^", "_", "\\", "_?\\", "$"}


def test_many_names_of_one_project(spark):
    """Patterns that begin with a wildcard, against 60,000 names of one project: equal to a check of all, and evenly dealt."""
    names = spark.range(60_000).select(F.lit("p").alias("k"), F.concat_ws("-", F.lit("pack"), F.hex(F.col("id") * 7919 % 1048576), F.col("id") % 97).alias("s"))
    listed = [r["s"] for r in names.select("s").distinct().collect()]
    patterns = ["%a_1%", "%-9_", "%ff%0%", "%_____________%"]
    frame = spark.createDataFrame([("p", p) for p in patterns], "k string, pat string")
    found = match_names(names, frame, ["k"], "s", "pat")
    compiled = {p: re.compile(p.replace("%", ".*").replace("_", "."), re.I) for p in patterns}
    expected = {(s.lower(), p) for p in patterns for s in listed if compiled[p].fullmatch(s)}
    assert {(r["__subject"], r["__pattern"]) for r in found.collect()} == expected
    dealt = names.select(
        F.pmod(F.hash("k", F.lit("\ue003"), F.pmod(F.xxhash64(F.lower("s")), F.lit(32)).cast("int")), F.lit(8)).alias("task")
    )  # all names hold their beginning: the hottest gram of all
    sizes = sorted(r["count"] for r in dealt.groupBy("task").count().collect())
    assert sizes[-1] < 3 * sizes[len(sizes) // 2]
