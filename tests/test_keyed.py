"""Tables merged by key against the merge of whole DataFrames."""

import random

import pytest
from pyspark.sql import functions as F

from fieldcast.operators import keyed, merge

SCHEMA = "k int, l string, v int, n int"
COLUMNS = ["k", "l", "v", "n"]


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def state(frame):
    return sorted(map(str, frame.collect()))


@pytest.mark.parametrize("way", ["replace", "upsert"])
def test_a_run_of_batches_equals_merges_of_dataframes(spark, tmp_path, way, monkeypatch):
    monkeypatch.setattr(keyed, "MANY_VERSIONS", 3)
    draw = random.Random(4)
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), ["k", "l"], COLUMNS, buckets=4, blocks=2)
    whole = rows(spark)
    plain = merge.merge_replace if way == "replace" else merge.upsert
    for turn in range(5):
        data = [(draw.choice([None, *range(60)]), draw.choice(["a", "b", None]), draw.randrange(100), k) for k in range(30)]
        if way == "upsert":  # NULL keys are inserted by every batch
            data = [r for r in data if r[0] is not None and r[1] is not None]
        batch = rows(spark, *data)
        getattr(table, way)(batch, ["n", "v"])
        whole = spark.createDataFrame(plain(whole, batch, ["k", "l"], ["n", "v"]).collect(), SCHEMA)
        assert state(table.read()) == state(whole), turn


def test_ten_keys_rewrite_at_most_ten_files(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"], ["k", "v"], buckets=64, blocks=1)
    stored = spark.range(50_000).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    assert table.replace(stored, ["v"]).replaced == 0 and table.files() == 64
    ten = spark.createDataFrame([(k * 4999, 1) for k in range(10)], "k long, v int")
    done = table.replace(ten, ["v"])
    assert 0 < done.replaced <= 10 and done.appended == 0 and table.files() == 64
    assert table.read().where("v = 1").count() == 10 and table.read().count() == 50_000


def test_new_keys_are_added_without_reading_what_is_stored(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"], ["k", "v"], buckets=2, blocks=8)
    table.replace(spark.range(1000).select(F.col("id").alias("k"), F.lit(0).alias("v")), ["v"])
    done = table.replace(spark.createDataFrame([(10**9 + k, 1) for k in range(4)], "k long, v int"), ["v"])
    assert done.replaced == 0 and done.appended == 2 and table.files() == 4
    assert table.read().count() == 1004
    for k in range(keyed.MANY_VERSIONS):
        table.replace(spark.createDataFrame([(2 * 10**9 + 10 * k + j, 1) for j in range(8)], "k long, v int"), ["v"])
    assert table.files() <= 2 * keyed.MANY_VERSIONS and table.read().count() == 1004 + 8 * keyed.MANY_VERSIONS
    left = {p.name for p in (tmp_path / "t" / "index").iterdir()}
    there = {v.name.split("=")[1] for lot in (tmp_path / "t" / "data").iterdir() if lot.is_dir() for v in lot.iterdir() if v.is_dir()}
    assert left == there


def test_before_the_first_merge(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"], ["k"]).read()
