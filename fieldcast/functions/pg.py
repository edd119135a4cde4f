"""Column helpers that reproduce PostgreSQL arithmetic, NULL and text rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_list(col: Column, sep: str = ";") -> Column:
    """``string_agg(DISTINCT x, sep)``: NULLs skipped, sorted, NULL for an all-NULL group."""
    values = F.collect_set(col.cast("string"))
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), sep))


def int_div(num: Column, den: Column | int) -> Column:
    """Integer division that truncates towards zero."""
    return F.call_function("div", num, den if isinstance(den, Column) else F.lit(den))


def round_ratio(num: Column, den: Column | int, digits: int) -> Column:
    """``round(num / den, digits)`` for integers and ``den > 0``, half away from zero.

    Worked out in whole numbers, so a tie never depends on how a double was stored.
    """
    den = den.cast("bigint") if isinstance(den, Column) else F.lit(den).cast("bigint")
    num = num.cast("bigint")
    scale = 10**digits
    steps = int_div(F.abs(num) * F.lit(2 * scale) + den, den * F.lit(2))
    return F.when(num < 0, -steps).otherwise(steps) / F.lit(float(scale))


def to_bigint(col: Column) -> Column:
    """Cast of a numeric to bigint: rounds half away from zero, where a plain Spark cast truncates."""
    return F.round(col, 0).cast("bigint")


def concat_skip_null(*cols: Column) -> Column:
    """``concat()``: NULL arguments count as empty text."""
    return F.concat_ws("", *[c.cast("string") for c in cols])


def category_label(name: Column, title: Column | None = None) -> Column:
    """Category text: a name starting with ``General`` loses its first 8 characters; no name falls back to the title."""
    fallback = name if title is None else F.coalesce(name, title)
    return F.when(name.like("General%"), F.substr(name, F.lit(9))).otherwise(fallback)


def same(left: str, right: str) -> Column:
    """Equality that is a filter of a join and no key of it, so that the join's shuffle goes by its other key alone."""
    return (F.col(left) >= F.col(right)) & (F.col(left) <= F.col(right))


def met_where_dealt(left: DataFrame, right: DataFrame, key: tuple[str, str], filters: list[tuple[str, str]]) -> DataFrame:
    """Inner join on one key that both sides are dealt by; the other equalities are filters, hashes being compared before texts.

    The columns of ``right`` that are compared are dropped.
    """
    sides = [side.withColumn(f"__h{k}", F.xxhash64(*[names[k] for names in filters])) for k, side in enumerate((left, right))]
    on = (F.col(key[0]) == F.col(key[1])) & same("__h0", "__h1")
    for mine, other in filters:
        on = on & same(mine, other)
    return sides[0].join(sides[1], on).drop("__h0", "__h1", key[1], *[other for _, other in filters])
