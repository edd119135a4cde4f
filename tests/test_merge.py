"""Merges, stored tables, streaming."""

import pytest
from pyspark.sql import functions as F

from fieldcast.operators import merge
from fieldcast.operators.commits import CommittedTable
from fieldcast.operators.compare import report_diff
from fieldcast.streaming import ingest

SCHEMA = "k string, l int, v string, n int"


@pytest.fixture
def sides(spark):
    target = spark.createDataFrame([("a", 1, "old", 0), ("b", 1, "old", 0), (None, 1, "old", 0)], SCHEMA)
    batch = spark.createDataFrame([("a", 1, "new", 2), ("a", 1, "first", 1), ("c", 1, "new", 1), (None, 1, "new", 1), (None, 1, "new", 2)], SCHEMA)
    return target, batch


def values(df):
    return sorted((r["k"] or "", r["v"]) for r in df.collect())


def test_replace(sides):
    merged = merge.merge_replace(*sides, ["k", "l"], ["n"])
    assert values(merged) == [("", "new"), ("", "new"), ("", "old"), ("a", "first"), ("b", "old"), ("c", "new")]


def test_replace_twice_is_replace_once(sides):
    target, batch = sides
    batch = batch.where("k IS NOT NULL")
    once = merge.merge_replace(target, batch, ["k", "l"], ["n"])
    twice = merge.merge_replace(once, batch, ["k", "l"], ["n"])
    assert values(once) == values(twice)


def test_insert_ignore(sides):
    assert values(merge.insert_ignore(*sides, ["k", "l"], ["n"])) == [("", "new"), ("", "new"), ("c", "new")]


def test_upsert_keeps_columns_the_batch_lacks(spark, sides):
    target, batch = sides
    merged = merge.upsert(target.withColumn("extra", F.lit("kept")), batch, ["k", "l"], ["n"])
    found = {(r["k"], r["v"]): r["extra"] for r in merged.where("k IS NOT NULL").collect()}
    assert found == {("a", "first"): "kept", ("b", "old"): "kept", ("c", "new"): None}


def test_copies_of_a_key_are_cut_before_the_shuffle(sides):
    plan = merge.first_per_key(sides[1], ["k", "l"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_versioned_table_swaps_whole_versions(spark, tmp_path):
    table = merge.VersionedTable(spark, str(tmp_path / "t"))
    assert table.current() is None
    assert table.replace(spark.range(3)).count() == 3
    before = table.read()
    assert table.replace(before.where("id > 0")).count() == 2
    assert before.count() == 3 and table.read().count() == 2


def test_normalize_update_and_backfill(spark):
    frame = spark.createDataFrame([("p", "x")], "project string, contentpackage string")
    assert tuple(merge.normalize_case(frame, "contentinpackage").first()) == ("P", "X")
    assert merge.normalize_case(frame, "other") is frame
    messages = spark.createDataFrame([("m1", "p", 1, None), ("m2", "p", 1, "b0")], "message_uuid string, programid string, deploymentnumber int, bundle_uuid string")
    assigned = spark.createDataFrame([("m1", "p", 1, "b1"), ("m2", "q", 1, "b1")], messages.schema)
    assert sorted((r[0], r[3]) for r in merge.update_uf_bundles(messages, assigned).collect()) == [("m1", "b1"), ("m2", "b0")]


def test_report_diff(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([("x", 1), (None, 2), ("z", 3)], "s string, i int")
    found = {r["report"]: tuple(r)[1:] for r in report_diff({"same": a, "r": a, "gone": a}, {"same": a, "r": b}).collect()}
    assert found == {"same": (0, 0, True), "r": (1, 1, False), "gone": (3, 0, False)}


LINE = "{ts},play,project:P,deployment:D,talkingbookid:T,contentid:{c},tbcdid:1,completed:{n},played_seconds:5,community:here"


def test_incremental_ingest_is_idempotent(spark, tmp_path):
    inbox, table = tmp_path / "inbox", str(tmp_path / "table")
    inbox.mkdir()
    people = spark.createDataFrame([("P", "HERE", "r1")], "project string, directory string, recipientid string")

    def arrive(name, *lines):
        (inbox / name).write_text("\n".join(lines) + "\n")
        ingest.ingest_incremental(spark, str(inbox), table, people, str(tmp_path / "checkpoint"))
        stored = ingest.read_periods(spark, table)
        return sorted((str(r["timestamp"])[:10], r["contentid"], r["completed"], r["recipientid"]) for r in stored.collect())

    one = LINE.format(ts="20210105T100000.000Z", c="c1", n=1)
    two = LINE.format(ts="20210105T100000.000Z", c="c2", n=2)
    assert arrive("a.kvp", one, two) == [("2021-01-05", "c1", 1, "r1"), ("2021-01-05", "c2", 2, "r1")]
    # the same lines again, one of them corrected, and a late day
    late = LINE.format(ts="20201231T100000.000Z", c="c1", n=9)
    final = [("2020-12-31", "c1", 9, "r1"), ("2021-01-05", "c1", 1, "r1"), ("2021-01-05", "c2", 7, "r1")]
    assert arrive("b.kvp", one, two.replace("completed:2", "completed:7"), late) == final
    ingest.reingest(spark, str(inbox / "b.kvp"), table, people)
    assert ingest.read_periods(spark, table).count() == 3


def test_a_merge_that_dies_before_its_commit_can_be_repeated(spark, tmp_path, monkeypatch):
    frame = lambda *rows: spark.createDataFrame(rows, "timestamp string, k string, v int, line int").selectExpr(
        "cast(timestamp as timestamp_ntz) as timestamp", "k", "v", "line"
    )
    path = str(tmp_path / "t")
    merge_in = lambda batch: ingest.merge_periods(spark, path, batch, ["timestamp", "k"], ["line"])
    state = lambda: sorted((r.k, r.v) for r in ingest.read_periods(spark, path).collect())
    merge_in(frame(("2020-01-01", "old1", 1, 0), ("2020-01-01", "old2", 1, 1), ("2020-01-02", "other", 1, 2)))
    assert state() == [("old1", 1), ("old2", 1), ("other", 1)]

    batch = frame(("2020-01-01", "old1", 2, 0), ("2020-01-03", "new", 1, 1), (None, "no time", 1, 2))
    real = type(spark).createDataFrame

    def fails(self, *args, **kwargs):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(type(spark), "createDataFrame", fails)
    with pytest.raises(RuntimeError):
        merge_in(batch)
    monkeypatch.setattr(type(spark), "createDataFrame", real)
    assert state() == [("old1", 1), ("old2", 1), ("other", 1)]
    merge_in(batch)
    assert state() == [("new", 1), ("no time", 1), ("old1", 2), ("old2", 1), ("other", 1)]


def test_old_versions_are_removed(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"), keep=2)
    for k in range(5):
        table.commit(spark.range(k, k + 1).withColumn("p", F.lit("x")), "p")
    table.commit(spark.range(9, 10).withColumn("p", F.lit("y")), "p")
    assert table.commits() == [5, 6]
    assert sorted(r.id for r in table.read().collect()) == [4, 9]
    assert len(list((tmp_path / "t" / "data" / "lot=x").iterdir())) == 1
    assert table.read(["z"]) is None


def test_a_commit_that_died_halfway_blocks_nobody(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"), orphan_hours=24)
    table.commit(spark.range(3).withColumn("p", F.lit("x")), "p")
    (tmp_path / "t" / "commits" / "000000000002" / "_temporary").mkdir(parents=True)
    assert table.commits() == [1]
    assert table.commit(spark.range(5, 6).withColumn("p", F.lit("y")), "p") == 3
    assert sorted(r.id for r in table.read().collect()) == [0, 1, 2, 5]
    assert (tmp_path / "t" / "commits" / "000000000002").exists()  # its writer may be at work
    CommittedTable(spark, str(tmp_path / "t"), orphan_hours=-1).commit(spark.range(7, 8).withColumn("p", F.lit("y")), "p")
    assert not (tmp_path / "t" / "commits" / "000000000002").exists()


def test_versions_of_dead_writers_go(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"), orphan_hours=-1)
    table.commit(spark.range(3).withColumn("p", F.lit("x")), "p")
    table.write(spark.range(9).withColumn("p", F.lit("x")), "p")  # and dies
    assert len(list((tmp_path / "t" / "data" / "lot=x").iterdir())) == 2
    table.commit(spark.range(1).withColumn("p", F.lit("y")), "p")
    assert len(list((tmp_path / "t" / "data" / "lot=x").iterdir())) == 1 and table.read().count() == 4


def test_a_writer_that_was_overtaken_fails(spark, tmp_path):
    one, two = (CommittedTable(spark, str(tmp_path / "t")) for _ in range(2))
    one.commit(spark.range(1))
    slow = one.write(spark.range(2))
    two.commit(spark.range(3))
    with pytest.raises(RuntimeError, match="in between"):
        one.publish(slow, {("all", v) for v in one.segments()["all"]})
    assert two.read().count() == 3 and two.commits() == [1, 2]


def test_parts_of_any_name(spark, tmp_path):
    names = ["a/b", "a=b", "a:b", "", None, "_null_", "a_b", "a b", "é", "2020-01-01", "%41", "a"]
    table = CommittedTable(spark, str(tmp_path / "t"))
    frame = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "p string, k int")
    table.commit(frame, "p")
    assert set(table.versions()) == set(names)
    assert {r.p: r.k for r in table.read().collect()} == dict(zip(names, range(len(names)), strict=True))
    for k, n in enumerate(names):
        assert [r.k for r in table.read([n]).collect()] == [k]
    table.commit(frame.where("p = 'a:b'").withColumn("k", F.lit(99)), "p", replaced=["a/b"])
    assert sorted(r.k for r in table.read().collect()) == [*(k for k in range(1, 12) if k != 2), 99]


def test_the_merge_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    frame = spark.range(10).withColumn("p", F.lit("x")).mapInArrow(count, "id long, p string")
    CommittedTable(spark, str(tmp_path / "t")).commit(frame, "p")
    assert seen.value == 10


def test_only_changed_periods_are_derived_again(spark, tmp_path):
    source, target = str(tmp_path / "plays"), str(tmp_path / "usage")
    facts = CommittedTable(spark, source)
    rows = lambda *days: spark.createDataFrame(
        [(f"2020-01-{d:02d} 10:00:00", d * 10 + k, v) for d, v in days for k in range(3)], "t string, k int, v int"
    ).selectExpr("cast(t as timestamp_ntz) as timestamp", "k", "v", f"substring(t, 1, 10) as {ingest.PERIOD}")
    build = lambda frame: frame.select("timestamp", "k", (F.col("v") * 2).alias("twice"))
    refresh = lambda **more: ingest.refresh_periods(spark, source, target, build, **more)
    state = lambda: sorted((r.k, r.twice) for r in ingest.read_periods(spark, target).collect())
    full = lambda: sorted((r.k, r.twice) for r in build(facts.read()).collect())

    facts.commit(rows((1, 1), (2, 1), (3, 1)), ingest.PERIOD)
    assert refresh() == {"2020-01-01", "2020-01-02", "2020-01-03"} and state() == full()
    before = CommittedTable(spark, target).versions()
    assert refresh() == set()
    facts.commit(rows((2, 5)), ingest.PERIOD)
    assert refresh() == {"2020-01-02"} and state() == full() and (20, 10) in state()
    after = CommittedTable(spark, target).versions()
    assert {p for p in after if after[p] != before[p]} == {"2020-01-02"}
    facts.commit(rows((4, 1)), ingest.PERIOD, replaced=["2020-01-01"])
    assert refresh() == {"2020-01-01", "2020-01-04"} and state() == full() and len(state()) == 9
    for k in range(4):
        facts.commit(rows((3, k)), ingest.PERIOD)  # the commit the target was made from is no longer kept
    assert len(refresh()) == 3 and state() == full()
    assert len(refresh(whole=True)) == 3 and state() == full()


def test_a_replayed_file_rewrites_nothing(spark, tmp_path):
    inbox, table = tmp_path / "inbox", str(tmp_path / "table")
    people = spark.createDataFrame([("P", "HERE", "r1")], "project string, directory string, recipientid string")
    commits = lambda: CommittedTable(spark, table).commits()[-1]

    def arrive(folder, name, *lines, **more):
        (inbox / folder).mkdir(parents=True, exist_ok=True)
        (inbox / folder / name).write_text("\n".join(lines) + "\n")
        ingest.ingest_incremental(spark, str(inbox), table, people, str(tmp_path / "checkpoint"), **more)
        return sorted((r.contentid, r.completed) for r in ingest.read_periods(spark, table).collect())

    line = lambda c, n: LINE.format(ts="20210105T100000.000Z", c=c, n=n)
    assert arrive("one", "a.kvp", line("c1", 1), line("c2", 2)) == [("c1", 1), ("c2", 2)]
    first = commits()
    assert arrive("two", "a.kvp", line("c1", 1), line("c2", 2)) == [("c1", 1), ("c2", 2)]
    assert commits() == first  # nothing new came
    assert arrive("three", "a.kvp", line("c1", 1), line("c3", 3)) == [("c1", 1), ("c2", 2), ("c3", 3)]
    second = commits()
    assert second == first + 1
    # a file of another name is no replay: its lines go through the merge, and a very old day does too
    old = LINE.format(ts="19990105T100000.000Z", c="c1", n=8)
    assert arrive("four", "b.kvp", line("c1", 7), old) == [("c1", 7), ("c1", 8), ("c2", 2), ("c3", 3)]
    assert commits() == second + 1


def test_lots_merge_like_replace_in_one_shuffle(spark, rows):
    schema = "day string, k int, v string, place int"
    stored = spark.createDataFrame([("a", 1, "old", 0), ("a", 1, "old twin", 0), ("a", 2, "stays", 0), ("a", 2, "stays too", 0), (None, 3, "no day", 0), ("b", None, "no key", 0)], schema).drop("place")
    batch = spark.createDataFrame([("a", 1, "second", 2), ("a", 1, "first", 1), ("b", 9, "new", 1), (None, 3, "x", 1), (None, 3, "x", 2), ("b", None, "y", 1)], schema)
    for most in (1, 100):
        merged = merge.merge_replace_lots(stored, batch, ["day", "k"], ["place"], "day", most)
        assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
        assert rows(merged) == rows(merge.merge_replace(stored, batch, ["day", "k"], ["place"]))
    assert rows(merge.merge_replace_lots(stored.limit(0), batch, ["day", "k"], ["place"], "day", 100)) == rows(merge.merge_replace(stored.limit(0), batch, ["day", "k"], ["place"]))
