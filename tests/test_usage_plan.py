"""The usage chain: how often the plays are shuffled, and rows that repeat or lack a key."""

import pytest
from pyspark.sql import functions as F

import fieldcast.plans  # noqa: F401
from fieldcast.functions.text import as_one_text, from_one_text
from fieldcast.tables import Tables


@pytest.fixture
def tables(spark):
    def table(columns, *rows):
        return spark.createDataFrame(list(rows), columns)

    play = ("2020-01-01", "P", "D1", "pk-1", "C", "TB1", "M1", 5, 4, 3, 2, 1, 60, "t1", "2019-12-01", "u1", "r1")
    unknown, other = (*play[:-1], None), (*play[:6], "M2", *play[7:-1], "r9")
    return Tables({
        "playstatistics": table(
            "timestamp string, project string, deployment string, contentpackage string, community string, talkingbookid string, "
            "contentid string, started int, quarter int, half int, threequarters int, completed int, played_seconds int, tbcdid string, "
            "deployment_timestamp string, deployment_uuid string, recipientid string",
            play, play, unknown, unknown, other,
        ),
        "contentmetadata2": table(
            "project string, contentid string, languagecode string, title string, format string, duration_sec int, sdg_goals string, sdg_targets string",
            ("P", "M1", "en", "one", "song", 9, None, None), ("Q", "M1", "en", "elsewhere", "song", 9, None, None), ("P", "M2", "en", "two", "song", 8, None, None),
        ),
        "contentinpackage": table(
            "project string, contentpackage string, contentid string, categoryid string, position int",
            ("P", "PK-1", "M1", "K", 1), ("P", "PK-1", "M1", "K", 1), ("P", "PK-2", "M1", "K", 1), ("Q", "pk-1", "M2", "K", 2),
        ),
        "categories": table("projectcode string, categoryid string, categoryname string", ("P", "K", "General-Health"), ("Q", "K", "Farm")),
        "packagesindeployment": table("project string, contentpackage string, deployment string", ("P", "pk-1", "D1")),
        "deployments": table(
            "project string, deployment string, deploymentnumber int, deploymentname string, startdate string", ("P", "D1", 1, "one", "2019-12-01")
        ),
        "languages": table("projectcode string, languagecode string, language string", ("P", "en", "English")),
        "recipients": table(
            "recipientid string, project string, partner string, affiliate string, country string, region string, district string, "
            "communityname string, groupname string, agent string, supportentity string",
            *[("r1", "P", "p", None, "c", "r", "d", "C", "G", None, "s")] * 2,
        ),
    })


def _shuffles(spark, frame):
    """How many shuffles carry the plays: those whose rows have the device."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def count(node):
            names = [node.output().apply(i).name() for i in range(node.output().size())]
            here = node.nodeName() == "Exchange" and "talkingbookid" in names
            children = node.children()
            return here + sum(count(children.apply(i)) for i in range(children.size()))

        plan = frame._jdf.queryExecution().executedPlan()
        return count(plan.initialPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_plays_are_shuffled_once_for_their_content(spark, tables):
    assert _shuffles(spark, tables["usage_info_base_view"]) == 1


def test_messages_are_summed_where_the_plays_are(spark, tables):
    columns = ["timestamp", "recipientid", "contentid", "talkingbookid", "category", "country"]
    found = sorted(map(tuple, tables["usage_info"].select(*columns).collect()), key=str)
    assert found == sorted([
        ("2020-01-01", "r1", "M1", "TB1", "Health", "c"), ("2020-01-01", None, "M1", "TB1", "Health", None),
        ("2020-01-01", "r9", "M2", "TB1", "Farm", None),
    ], key=str)
    extract = tables["twbx_info"].collect()
    assert [(r["Message"], r["Total Completions"], r["Total Time Played"]) for r in extract] == [("one", 2, 120)]
    stored = tables.with_table("usage_info", tables["usage_info"])
    assert stored["twbx_info"].collect() == extract


def test_plays_are_shuffled_by_recipient_and_by_content(spark, tables):
    """By recipient, by content and once for each of the three joins with a dimension that is not broadcast."""
    assert _shuffles(spark, tables["usage_info"]) == 5


def test_values_come_back_from_one_text(spark):
    odd = ["", " ", "a", "\x1f", "\x1e", "\x1e0", "\x1e1", "\x1e2", "\x1e\x1f", "\x1f\x1f2", "é\x1e", "[null]", None]
    rows = [(a, b, None if a is None else len(a)) for a in odd for b in odd]
    frame = spark.createDataFrame(rows, "a string, b string, n int").withColumn("whole", as_one_text(["a", "b", "n"]))
    got = frame.select("a", "b", "n", from_one_text(F.col("whole")).alias("parts")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.parts == [r.a, r.b, None if r.n is None else str(r.n)]


def test_what_plays_only_carry_along_travels_as_one_text(spark, tables):
    plan = tables["usage_info"]._jdf.queryExecution().optimizedPlan()

    def dealt(node):
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        here = [set(names)] if node.nodeName() == "RepartitionByExpression" and "talkingbookid" in names else []
        return here + [x for i in range(node.children().size()) for x in dealt(node.children().apply(i))]

    by_recipient = [names for names in dealt(plan) if "__asked" in names]
    by_content = [names for names in dealt(plan) if "__asked" not in names]
    assert len(by_recipient) == len(by_content) == 1
    assert "__carried" in by_content[0] and not by_content[0] & {"communityname", "agent", "deployment_uuid", "played_seconds"}
