"""Text, map and date columns used by the sources."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinels of the input data.
UNKNOWN = "Unknown"
UNKNOWN_USER = "UNKNOWN"
UNASSIGNED_SERIAL = "-- TO BE ASSIGNED --"
NON_SPECIFIC = "NON-SPECIFIC"
#: A decimal number, as each half of a coordinate pair must be
DECIMAL = r"^[-+]?(?:\d+(?:\.\d*)?|\.\d+)$"
BLANKS = " \t\r\n\x0b\x0c"
#: what parts the values of several columns in one text, and what stands for it, for itself and for NULL there
PART_END, MARK = "\x1f", "\x1e"
STAND_INS = {MARK: f"{MARK}0", PART_END: f"{MARK}1"}
NOTHING = f"{MARK}2"


def strip(col: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(col, F.lit(BLANKS))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def as_one_text(columns: list[str]) -> Column:
    """The values of several columns as one text, from which :func:`from_one_text` has each of them again, NULL and all."""

    def marked(value: Column) -> Column:
        for mark, stand_in in STAND_INS.items():
            value = F.replace(value, F.lit(mark), F.lit(stand_in))
        return F.coalesce(value, F.lit(NOTHING))

    return F.array_join(F.transform(F.array(*[F.col(c).cast("string") for c in columns]), marked), PART_END)


def from_one_text(whole: Column) -> Column:
    """An array of the values, as texts, that :func:`as_one_text` put together."""

    def given(value: Column) -> Column:
        plain = value
        for mark, stand_in in reversed(STAND_INS.items()):
            plain = F.replace(plain, F.lit(stand_in), F.lit(mark))
        return F.when(~F.contains(value, F.lit(MARK)), value).when(value != NOTHING, plain)

    return F.transform(F.split(whole, PART_END, -1), given)


def last_wins(pairs: Column) -> Column:
    """Array of (key, value) structs -> map, where the last of equal keys stays; pairs without a key are left out.

    The array is worked out once for a row, and only rows that repeat a key compare their keys.
    """

    def unique(kept: Column, keys: Column) -> Column:
        later = F.filter(
            kept, lambda p, i: F.array_position(F.slice(keys, i + F.lit(2), F.size(keys)), p["key"]) == F.lit(0)
        )
        return F.map_from_entries(F.when(F.size(F.array_distinct(keys)) == F.size(keys), kept).otherwise(later))

    named = F.filter(pairs, lambda p: p["key"].isNotNull())
    return bound(named, lambda kept: bound(F.transform(kept, lambda p: p["key"]), lambda keys: unique(kept, keys)))


def pair(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


def key_values(fields: Column) -> Column:
    """``k:v`` texts -> (key, value) structs; split at the first colon, a bare key has the value ``True``."""

    def one(text: Column) -> Column:
        bits = F.split(text, ":", 2)
        return pair(F.get(bits, F.lit(0)), F.coalesce(F.get(bits, F.lit(1)), F.lit("True")))

    return F.transform(fields, one)


def properties_map(text: Column) -> Column:
    """Text of a properties file -> map; ``#`` lines and lines without ``=`` are skipped."""
    lines = F.transform(F.split(text, "\r?\n"), strip)
    kept = F.filter(lines, lambda s: ~s.startswith("#") & (F.instr(s, "=") > 1))

    def one(line: Column) -> Column:
        bits = F.split(line, "=", 2)
        return pair(strip(F.get(bits, F.lit(0))), strip(F.get(bits, F.lit(1))))

    return last_wins(F.transform(kept, one))


def first_key(data: Column, *names: str) -> Column:
    """Value of the first key that is present, else empty text."""
    return F.coalesce(*[F.try_element_at(data, F.lit(n)) for n in names], F.lit(""))


def prefixed(data: Column, prefix: str) -> Column:
    """The map with every key prefixed."""
    return F.transform_keys(data, lambda k, _: F.concat(F.lit(prefix), k))


def merged(*maps: Column) -> Column:
    """Maps put together; on equal keys the later map wins.  Each map is worked out once for a row, not once for a key."""

    def over(earlier: Column, later: Column) -> Column:
        return F.map_concat(F.map_filter(earlier, lambda k, _: ~F.map_contains_key(later, k)), later)

    out = maps[0]
    for later in maps[1:]:
        out = bound(later, partial(over, out))
    return out


def default_text(col: Column, default: str, *also: str) -> Column:
    """``default`` for empty text and the values in ``also``."""
    return F.when(col.isin("", *also), F.lit(default)).otherwise(col)


def coordinates(col: Column) -> Column:
    """``(a, b)``, ``a,b`` or ``a b`` -> struct of latitude and longitude; NULL if it is anything else.

    Of two halves one may be no decimal number: it is NULL then.
    """
    text = strip(col)
    bare = strip(F.when(text.startswith("(") & text.endswith(")"), F.substr(text, F.lit(2), F.length(text) - 2)).otherwise(text))
    halves = F.split(bare, r"\s*,\s*|\s+")
    latitude, longitude = F.get(halves, F.lit(0)), F.get(halves, F.lit(1))
    return F.when(
        (F.size(halves) == 2) & (latitude.rlike(DECIMAL) | longitude.rlike(DECIMAL)),
        F.struct(
            F.when(latitude.rlike(DECIMAL), latitude.try_cast("double")).alias("latitude"),
            F.when(longitude.rlike(DECIMAL), longitude.try_cast("double")).alias("longitude"),
        ),
    )


def _digits_to_time(col: Column, pattern: str) -> Column:
    return F.regexp_replace(col, pattern, "$1-$2-$3 $4:$5:$6").try_cast("timestamp_ntz")


def compact_timestamp(col: Column) -> Column:
    """``20170927T100005.486Z`` -> timestamp; the zone is ignored, as the columns have none."""
    return _digits_to_time(col, r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2}(?:\.\d+)?).*$")


def positional_timestamp(col: Column) -> Column:
    """``2017Y10M04D11h22m33s`` (any separators) -> timestamp."""
    return _digits_to_time(col, r"^(\d{4}).(\d{2}).(\d{2}).(\d{2}).(\d{2}).(\d{2}).*$")


def directory_timestamp(col: Column) -> Column:
    """``2017y09m27d10h00m05s`` in a directory name -> timestamp."""
    return _digits_to_time(
        F.regexp_extract(col, r"(\d{4}y\d{2}m\d{2}d\d{2}h\d{2}m\d{2}s)", 1),
        r"^(\d{4})y(\d{2})m(\d{2})d(\d{2})h(\d{2})m(\d{2})s$",
    )


def checked_date(col: Column) -> Column:
    """``2021/03/09`` -> ``20210309``; anything that is no such date -> NULL."""
    day = F.try_to_timestamp(col, F.lit("yyyy/M/d"))
    return F.date_format(day, "yyyyMMdd")


def clock(seconds: Column) -> Column:
    """``h:mm:ss``, ``m:ss`` or ``s seconds``."""
    seconds = seconds.cast("bigint")
    hours = F.floor(seconds / 3600)
    minutes = F.floor(seconds % 3600 / 60)
    rest = seconds % 60
    return (
        F.when(hours > 0, F.format_string("%d:%02d:%02d", hours, minutes, rest))
        .when(minutes > 0, F.format_string("%d:%02d", minutes, rest))
        .otherwise(F.format_string("%d seconds", rest))
    )
