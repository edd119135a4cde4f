"""Column helpers against values worked out by hand or by Python."""

import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fieldcast.functions import pg, text
from fieldcast.functions.ids import NAMESPACE_UF, message_uuid, uuid5


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "num, den, digits, expected",
    [(9, 60, 1, 0.2), (3, 60, 1, 0.1), (-3, 60, 1, -0.1), (2, 60, 1, 0.0), (-1, 60, 0, 0.0), (30, 60, 0, 1.0), (7, 3600, 2, 0.0), (18, 3600, 2, 0.01)],
)
def test_round_ratio_rounds_half_away_from_zero(spark, num, den, digits, expected):
    assert one(spark, pg.round_ratio(F.col("a"), F.col("b"), digits), a=num, b=den) == expected


def test_round_ratio_keeps_null(spark):
    assert one(spark, pg.round_ratio(F.col("a").cast("bigint"), 60, 1), a=None) is None


def test_integer_division_truncates_towards_zero(spark):
    assert one(spark, pg.int_div(F.col("a"), 7), a=-20) == -2


def test_bigint_cast_rounds(spark):
    for value, expected in (("2.5", 3), ("-2.5", -3), ("2.4", 2)):
        assert one(spark, pg.to_bigint(F.col("a")), a=Decimal(value)) == expected


def test_text_list_is_sorted_distinct_text_and_null_for_nothing(spark):
    data = spark.createDataFrame([(1, 10), (1, 2), (1, 2), (1, None), (2, None)], "k int, v int")
    found = {r["k"]: r["x"] for r in data.groupBy("k").agg(pg.text_list(F.col("v")).alias("x")).collect()}
    assert found == {1: "10;2", 2: None}


def test_category_label(spark):
    data = spark.createDataFrame([("General-x", "t"), ("General", "t"), (None, "t"), ("Topic", "t")], "n string, t string")
    labels = [r["x"] for r in data.select(pg.category_label(F.col("n"), F.col("t")).alias("x")).collect()]
    assert labels == ["x", "", "t", "Topic"]


def test_concat_skips_null(spark):
    assert one(spark, pg.concat_skip_null(F.lit("a"), F.col("n"), F.lit(3)), n=None) == "a3"


@pytest.mark.parametrize(
    "value, expected",
    [("(1.5, -2)", (1.5, -2.0)), ("1.5 -2", (1.5, -2.0)), (" ( +3 , 4 ) ", (3.0, 4.0)), ("garbage", None), ("", None), ("1..2, 3", (None, 3.0))],
)
def test_coordinates(spark, value, expected):
    found = one(spark, text.coordinates(F.col("c")), c=value)
    assert (None if found is None else tuple(found)) == expected


def test_timestamps(spark):
    assert str(one(spark, text.compact_timestamp(F.col("t")), t="20170927T100005.486Z")) == "2017-09-27 10:00:05.486000"
    assert str(one(spark, text.positional_timestamp(F.col("t")), t="2017Y10M04D11h22m33s")) == "2017-10-04 11:22:33"
    assert str(one(spark, text.directory_timestamp(F.col("t")), t="x/2017y09m27d10h00m05s")) == "2017-09-27 10:00:05"
    assert one(spark, text.compact_timestamp(F.col("t")), t="soon") is None


def test_checked_date(spark):
    for value, expected in (("2021/03/09", "20210309"), ("2021/02/30", None), ("x", None), ("", None)):
        assert one(spark, text.checked_date(F.col("d")), d=value) == expected


def test_clock(spark):
    for value, expected in ((3723, "1:02:03"), (75, "1:15"), (9, "9 seconds"), (0, "0 seconds"), (3600, "1:00:00")):
        assert one(spark, text.clock(F.col("s")), s=value) == expected


def test_map_merge_and_last_wins(spark):
    a = F.create_map(F.lit("k"), F.lit("1"), F.lit("l"), F.lit("2"))
    b = F.create_map(F.lit("k"), F.lit("9"))
    assert one(spark, text.merged(a, b)) == {"k": "9", "l": "2"}
    pairs = F.array(*[text.pair(F.lit(k), F.lit(v)) for k, v in (("a", "1"), ("b", "2"), ("a", "3"))])
    assert one(spark, text.last_wins(pairs)) == {"a": "3", "b": "2"}


def test_uuid5_equals_python(spark):
    space = uuid.UUID(NAMESPACE_UF)
    for name in ("", "abc", "häuser ✓", "x" * 5000):
        assert one(spark, uuid5(F.col("n")), n=name) == str(uuid.uuid5(space, name))


def test_message_uuid_over_sorted_values(spark):
    md = F.create_map(F.lit("T"), F.lit("zeta"), F.lit("A"), F.lit("alpha"))
    expected = str(uuid.uuid5(uuid.UUID(NAMESPACE_UF), "c1" + "alphazeta"))
    assert one(spark, message_uuid(md, F.lit("c1"))) == expected
    empty = F.map_filter(md, lambda k, v: F.lit(False))
    assert len(one(spark, message_uuid(empty, F.lit("c1")))) == 36


def test_merged_works_a_later_map_out_once(spark):
    frame = spark.sql("SELECT map('a', '1', 'b', '2') AS x, map('b', '3', 'c', '4') AS y, map('a', '5') AS z")
    whole = frame.select(text.merged(F.col("x"), text.prefixed(F.col("y"), ""), F.col("z")).alias("m"))
    assert whole.first()["m"] == {"a": "5", "b": "3", "c": "4"}
    assert whole._jdf.queryExecution().analyzed().toString().count("transform_keys") == 1
