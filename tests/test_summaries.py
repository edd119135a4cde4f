"""Distinct counts in one pass, and the four sources of older devices read once."""

import random

import pytest
from pyspark.sql import functions as F

from fieldcast.operators.summary import distinct_summary
from fieldcast.tables import Tables
import fieldcast.plans  # noqa: F401


@pytest.mark.parametrize("spread", [None, "device"])
def test_counts_lists_and_sums(spark, spread):
    draw = random.Random(1)
    rows = [("a" if k % 3 else None, draw.choice([None, *range(40)]), draw.choice([None, 2, 10, 7]), k) for k in range(300)]
    rows += [("hot", k % 50, 1, 1) for k in range(2000)] + [("none", None, None, None)]
    frame = spark.createDataFrame(rows, "g string, device int, place int, n int")
    got = distinct_summary(frame, ["g"], {"devices": "device", "places": "place"}, {"list": "place"}, {"total": "n"}, spread=spread)
    assert "unpivot" not in got._jdf.queryExecution().toString().lower() and "Expand" not in got._jdf.queryExecution().toString()
    made = {r["g"]: tuple(r)[1:] for r in got.collect()}
    for g in ("a", None, "hot", "none"):
        of = [r for r in rows if r[0] == g]
        places = {r[2] for r in of} - {None}
        total = sum(r[3] for r in of) if any(r[3] is not None for r in of) else None
        text = ";".join(sorted(map(str, places))) if places else None
        assert made[g] == (len({r[1] for r in of} - {None}), len(places), text, total)


def test_a_listed_column_cannot_be_spread(spark):
    with pytest.raises(ValueError):
        distinct_summary(spark.range(1).withColumn("g", F.lit(1)), ["g"], {"n": "id"}, {"l": "id"}, spread="id")


def sources(spark):
    keys = [("p", "v", "t", "c"), ("p", "v", "t", "d"), ("q", "v", None, "c"), ("q", "v", "u", "c")]
    counters = ["totaltimeplayed", "countstarted", "countquarter", "counthalf", "countthreequarters", "countcompleted"]
    draw = random.Random(2)
    synced = [(*k, s, *(draw.choice([None, *range(9)]) for _ in counters)) for k in keys for s in (1, 2, 3, 4) for _ in range(draw.randint(0, 2))]
    schema = "contentpackage string, village string, talkingbook string, contentid string, datasource int, "
    syncaggregation = spark.createDataFrame(synced, schema + ", ".join(f"{c} int" for c in counters))
    events = [(*k, draw.choice([60, 90]), draw.randint(5, 60), draw.random(), draw.random() < 0.2) for k in [*keys, ("r", "v", "t", "c")] for _ in range(6)]
    events += [("s", "v", "t", "c", 60, 1, 0.1, False)]  # a key of which no event counts
    playedevents = spark.createDataFrame(
        events, "packageid string, village string, talkingbookid string, contentid string, totaltime int, timeplayed int, percentdone double, isfinished boolean"
    )
    return {
        "syncaggregation": syncaggregation, "playedevents": playedevents,
        "communities": spark.createDataFrame([("x", "v"), ("y", "v")], "project string, communityname string"),
        "contentmetadata2": spark.createDataFrame([("x", "c", 60), ("y", "c", 70), ("x", "d", 80)], "project string, contentid string, duration_sec int"),
    }


def test_all_sources_equal_outer_joins(spark):
    """Repeated keys of a source multiply, NULL in a key matches nothing, keys without any counter stay."""
    t = Tables(sources(spark))
    keys = ["contentpackage", "village", "talkingbook", "contentid"]
    wide = t["played_keys"]
    logged = t["logstats_from_played_events"].withColumnsRenamed({"packageid": "contentpackage", "talkingbookid": "talkingbook"})
    wide = wide.join(logged.select(*keys, F.col("timeplayed").alias("l"), F.col("completed").cast("long").alias("done")), keys, "left")
    for n in (1, 2, 3):
        side = t["syncaggregation"].where(F.col("datasource") == n).select(*keys, F.col("countcompleted").cast("long").alias(f"s{n}"))
        wide = wide.join(side, keys, "left")
    wide = wide.join(t["communities"].withColumnRenamed("communityname", "village"), "village").join(t["contentmetadata2"], ["project", "contentid"])
    expected = sorted(map(str, wide.select("project", *keys, "l", "done", "s1", "s2", "s3").collect()))
    got = t["allsources"].select(
        "project", *keys, F.col("played_seconds_logevents").alias("l"), F.col("completed_logevents").alias("done"),
        F.col("completed_logs").alias("s1"), F.col("completed_stats").alias("s2"), F.col("completed_flash").alias("s3"),
    )
    assert sorted(map(str, got.collect())) == expected and len(expected) > 10


def test_all_sources_reads_each_fact_once(spark, tmp_path):
    stored = {}
    for name, frame in sources(spark).items():
        frame.write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    plan = Tables(stored)["allsources"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 4
