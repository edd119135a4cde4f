"""Case-insensitive pattern joins (``subject ILIKE pattern``) that stay equi-joins.

A pattern without ``%``, ``_`` or ``\\`` can only match the same text in another case, so it
joins on ``lower()``.  Patterns that do hold such characters are first matched against the
*distinct* names, and the match goes back into the big join as one more equality key.  The
big tables therefore meet in exactly one hash or sort-merge join, whatever the names are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WILDCARD = r"[%_\\]"
#: stand-ins that no name holds: beginning and end of a name, an open character, escaped characters of a pattern
BEGIN, END, GAP = "\ue003", "\ue004", "\ue005"
ESCAPED = {"\\\\": "\ue000", "\\%": "\ue001", "\\_": "\ue002"}
#: parts into which the names that hold one gram are dealt
SALTS = 32


def has_wildcard(col: Column) -> Column:
    return F.coalesce(col.rlike(WILDCARD), F.lit(False))


def wildcard_flags(df: DataFrame, columns: list[str]) -> dict[str, bool]:
    """Which of the columns hold any LIKE metacharacter: one column-pruned scan, one row back."""
    row = df.select(*[F.coalesce(F.bool_or(has_wildcard(F.col(c))), F.lit(False)).alias(c) for c in columns]).first()
    return {c: bool(row[c]) for c in columns}


def _grams(text: Column) -> Column:
    """Runs of one, two and three characters of a text, and of three whose middle one is open."""

    def at(i: Column) -> Column:
        w = F.substr(text, i, F.lit(3))
        first = F.substr(w, F.lit(1), F.lit(1))
        open_middle = F.concat(first, F.lit(GAP), F.substr(w, F.lit(3), F.lit(1)))
        shorter = F.array(w, F.substr(w, F.lit(1), F.lit(2)), first)
        return F.when(F.length(w) == 3, F.concat(shorter, F.array(open_middle))).otherwise(shorter)

    return F.flatten(F.transform(F.sequence(F.lit(1), F.length(text)), at))


def _ends(text: Column) -> Column:
    return F.concat(F.lit(BEGIN), text, F.lit(END))


def pattern_grams(pattern: Column) -> Column:
    """The grams that every text which matches a LIKE pattern holds, its beginning and end counted as characters."""
    plain = pattern
    for escaped, stand_in in ESCAPED.items():
        plain = F.replace(plain, F.lit(escaped), F.lit(stand_in))
    runs = F.filter(F.split(_ends(plain), "%"), lambda run: F.length(run) > 0)
    grams = F.filter(F.flatten(F.transform(runs, _grams)), lambda g: ~F.contains(g, F.lit("_")))

    def literal(gram: Column) -> Column:
        for escaped, stand_in in ESCAPED.items():
            gram = F.replace(gram, F.lit(stand_in), F.lit(escaped[1]))
        return gram

    return F.array_distinct(F.transform(grams, literal))


def match_names(
    subjects: DataFrame, patterns: DataFrame, keys: list[str], subject: str, pattern: str
) -> DataFrame:
    """``(keys, __subject, __pattern)`` pairs of lower-case names where a wildcard pattern matches.

    An index of grams finds the candidates: a pattern looks only at the names that hold its rarest literal gram, wherever
    in the name that stands, and ILIKE confirms them.  ``%a_1%`` has ``a`` and ``1`` with an open character between;
    a pattern without any literal has the beginning that all names have.  Names are dealt out within each gram, so one that
    very many names of a project hold is spread over as many tasks as others are.
    """
    wild = patterns.where(has_wildcard(F.col(pattern))).select(*keys, F.lower(pattern).alias("__pattern")).distinct()
    names = subjects.where(F.col(subject).isNotNull()).select(*keys, F.lower(subject).alias("__subject")).distinct()
    held = names.select(*keys, "__subject", F.explode(F.array_distinct(_grams(_ends(F.col("__subject"))))).alias("__gram"))
    often = held.groupBy(*keys, "__gram").agg(F.count("*").alias("__n"))
    asked = wild.select(*keys, "__pattern", F.explode(pattern_grams(F.col("__pattern"))).alias("__gram"))
    # a gram that no name holds is the rarest, and then nothing matches
    counted = asked.join(often, [*keys, "__gram"], "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    rarest = counted.groupBy(*keys, "__pattern").agg(F.min(F.struct("__n", "__gram")).alias("__least"))
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")
    wanted = rarest.where("__least.__n > 0").select(*keys, "__pattern", F.col("__least.__gram").alias("__gram"), salt)
    dealt = held.withColumn("__salt", F.pmod(F.xxhash64("__subject"), F.lit(SALTS)).cast("int"))
    return (
        wanted.join(dealt, [*keys, "__gram", "__salt"])
        .where(F.expr("__subject ILIKE __pattern"))
        .select(*keys, "__subject", "__pattern")
    )


def ilike_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_name: str,
    right_name: str,
    pattern_side: str,
    how: str = "inner",
    wildcards: bool = True,
) -> DataFrame:
    """Join on ``keys`` and an ILIKE between two name columns.

    ``pattern_side`` says whose name is the pattern.  ``wildcards=False`` states that no
    pattern holds a LIKE metacharacter (see :func:`wildcard_flags`), which drops the
    name-matching part from the plan.  Column names other than ``keys`` must not overlap.
    """
    if pattern_side not in ("left", "right"):
        raise ValueError("pattern_side must be 'left' or 'right'")
    if how not in ("inner", "left") or (how == "left" and pattern_side != "left"):
        raise ValueError("an outer ILIKE join keeps the pattern side, so it must be the left one")
    if not wildcards:
        joined = left.withColumn("__name", F.lower(left_name)).join(
            right.withColumn("__name", F.lower(right_name)), [*keys, "__name"], how
        )
        return joined.drop("__name")

    if pattern_side == "left":
        patterns, pattern, subjects, subject = left, left_name, right, right_name
    else:
        patterns, pattern, subjects, subject = right, right_name, left, left_name
    matches = (
        match_names(subjects, patterns, keys, subject, pattern)
        .groupBy(*keys, "__subject")
        .agg(F.collect_set(F.concat(F.lit("w"), "__pattern")).alias("__wild"))
    )
    keyed_patterns = patterns.withColumn(
        "__name",
        F.concat(F.when(has_wildcard(F.col(pattern)), F.lit("w")).otherwise(F.lit("x")), F.lower(pattern)),
    )
    keyed_subjects = (
        subjects.withColumn("__subject", F.lower(subject))
        .join(matches, [*keys, "__subject"], "left")
        .withColumn(
            "__name",
            F.explode(
                F.concat(
                    F.array(F.concat(F.lit("x"), "__subject")),
                    F.coalesce("__wild", F.array().cast("array<string>")),
                )
            ),
        )
        .drop("__subject", "__wild")
    )
    if pattern_side == "left":
        return keyed_patterns.join(keyed_subjects, [*keys, "__name"], how).drop("__name")
    return keyed_subjects.join(keyed_patterns, [*keys, "__name"], how).drop("__name")
