"""Report rules on small hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import fieldcast.plans  # noqa: F401
from fieldcast.plans.deployments import latest_per_project
from fieldcast.plans.production import production_by_deployment
from fieldcast.plans.retired import ordered
from fieldcast.tables import Tables

DAY = dt.date(2021, 1, 1)


def test_dashboard_puts_unknown_dates_first_and_breaks_ties(spark):
    data = [("P", "d%d" % n, n, d) for n, d in ((1, None), (2, DAY), (3, DAY), (4, dt.date(2020, 1, 1)), (5, dt.date(2019, 1, 1)))]
    frame = spark.createDataFrame(data, "project string, deployment string, deploymentnumber int, startdate date")
    kept = [r["deploymentnumber"] for r in ordered(latest_per_project(frame), "-startdate", "-deploymentnumber").collect()]
    assert kept == [1, 3, 2, 4]
    plan = latest_per_project(frame)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_date_mismatch_flags_missing_dates(spark):
    data = [("P", "a", 1, DAY, DAY), ("P", "b", 2, None, DAY), ("P", "c", 3, DAY, DAY), ("P", "c2", 3, dt.date(2021, 1, 8), DAY)]
    t = Tables({"deployments": spark.createDataFrame(data, "project string, deployment string, deploymentnumber int, startdate date, enddate date")})
    found = sorted((r["deploymentnumber"], r["deployments"], r["numstarts"]) for r in t["deployment_date_mismatch"].collect())
    assert found == [(2, "b", 0), (3, "c;c2", 2)]


@pytest.mark.parametrize(
    "percent, total, played, finished, column",
    [(0.1, 100, 50, False, "started"), (0.25, 100, 50, False, "quarter"), (0.49999, 100, 50, False, "quarter"), (0.499991, 100, 50, False, "half"),
     (0.749991, 100, 50, False, "threequarters"), (0.95, 100, 50, False, "completed"), (0.1, 100, 95, False, "completed"), (0.1, 100, 50, True, "completed"),
     (0.1, 100, 90, False, None), (0.4999905, 100, 50, False, None), (0.7499905, 100, 50, False, None)],
)
def test_play_classes_and_their_gaps(spark, percent, total, played, finished, column):
    schema = "packageid string, village string, talkingbookid string, contentid string, totaltime int, percentdone double, timeplayed int, isfinished boolean"
    t = Tables({"playedevents": spark.createDataFrame([("p", "v", "t", "c", total, percent, played, finished)], schema)})
    row = t["logstats_from_played_events"].first()
    counted = [c for c in ("started", "quarter", "half", "threequarters", "completed") if row[c]]
    assert counted == ([column] if column else [])


def usage_tables(spark):
    """Package names with an underscore: the pattern side matches other packages too."""
    return Tables({
        "deployments": spark.createDataFrame([("P", "D1", 1, "One", DAY, DAY), ("P", "D1-B", 1, "Two", DAY, DAY)], "project string, deployment string, deploymentnumber int, deploymentname string, startdate date, enddate date"),
        "packagesindeployment": spark.createDataFrame([("P", "d1", "a_1", DAY, "EN"), ("P", "D1", "a_1", DAY, "EN"), ("P", "D1-B", "AX1", DAY, "EN")], "project string, deployment string, contentpackage string, startdate date, languagecode string"),
        "languages": spark.createDataFrame([("en", "English", "P")], "languagecode string, language string, projectcode string"),
        "contentinpackage": spark.createDataFrame([("P", "A_1", "c1", "k", 1), ("P", "AX1", "c1", "k", 2)], "project string, contentpackage string, contentid string, categoryid string, position int"),
        "categories": spark.createDataFrame([("k", "P", "General-Health")], "categoryid string, projectcode string, categoryname string"),
        "contentmetadata2": spark.createDataFrame([("c1", "P", "Song", "en", 30, "f", None, None)], "contentid string, project string, title string, languagecode string, duration_sec int, format string, sdg_goals string, sdg_targets string"),
        "recipients": spark.createDataFrame([("r1", "P", "x", None, "c", "r", "d", "v", "g", "a", "s")], "recipientid string, project string, partner string, affiliate string, country string, region string, district string, communityname string, groupname string, agent string, supportentity string"),
        "playstatistics": spark.createDataFrame(
            [(dt.datetime(2021, 1, 2), "P", p, "r1", "c1", tb, 90, 3) for p, tb in (("a_1", "t1"), ("a_1", "t1"), ("ax1", "t2"))],
            "timestamp timestamp_ntz, project string, contentpackage string, recipientid string, contentid string, talkingbookid string, played_seconds int, completed int")
        .selectExpr("*", "1 AS threequarters", "1 AS half", "1 AS quarter", "1 AS started", "'x' AS tbcdid", "timestamp AS deployment_timestamp", "'u' AS deployment_uuid"),
    })


def test_usage_with_wildcard_names_equals_the_literal_join(spark):
    t = usage_tables(spark)
    for name in ("deployments", "packagesindeployment", "languages", "contentinpackage", "categories", "contentmetadata2", "recipients", "playstatistics", "package_tbs_used", "usage_info", "production_info"):
        t[name].createOrReplaceTempView(f"v_{name}")
    literal = spark.sql("""
        SELECT DISTINCT s.timestamp, s.project, s.contentpackage, s.talkingbookid, d.deployment, k.position
        FROM v_playstatistics s JOIN v_contentmetadata2 m ON m.contentid = s.contentid AND m.project = s.project
        JOIN v_contentinpackage k ON s.contentpackage ILIKE k.contentpackage AND k.contentid = s.contentid
        JOIN v_packagesindeployment p ON p.project = s.project AND p.contentpackage ILIKE s.contentpackage
        JOIN v_deployments d ON d.project = s.project AND d.deployment = p.deployment""")
    found = t["usage_info"].select(*literal.columns)
    assert found.count() == literal.count() > 3
    assert found.exceptAll(literal).count() == 0
    produced = spark.sql("""
        SELECT d.deployment, p.contentpackage AS package, k.contentid FROM v_deployments d
        JOIN v_packagesindeployment p ON p.project = d.project AND p.deployment ILIKE d.deployment
        JOIN v_contentinpackage k ON k.project = d.project AND k.contentpackage ILIKE p.contentpackage""")
    made = t["production_info"].select(*produced.columns)
    assert made.exceptAll(produced).count() == 0 and made.count() == produced.count() > 0
    by_message = spark.sql("""
        SELECT u.contentpackage, max(q.package_tbs_used) AS tbs, sum(u.completions) AS completions
        FROM v_usage_info u JOIN v_package_tbs_used q ON q.project = u.project AND q.contentpackage ILIKE u.contentpackage
        GROUP BY u.contentpackage""")
    got = t["usage_by_message"].select("contentpackage", F.col("num_package_tbs").alias("tbs"), "completions")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, by_message.collect()))
    assert t["usage_by_package_category"].count() == 2


def test_several_names_per_number_multiply_minutes(spark):
    info = [("P", d, 1, DAY, "p", "en", "English", "k", "n", c, "f", 60, "t") for d in ("a", "b") for c in ("c1", "c2")]
    schema = "project string, deployment string, deploymentnumber int, startdate date, package string, languagecode string, language string, categoryid string, categoryname string, contentid string, format string, duration_sec int, title string"
    t = Tables({"production_info": spark.createDataFrame(info, schema)})
    assert production_by_deployment(t).first()["duration_minutes"] == 16.0
    row = production_by_deployment(t, fix_fanout=True).first()
    assert (row["duration_minutes"], row["num_messages"], row["deployment"]) == (4.0, 2, "a;b")


def test_stored_tables_win_over_marts(spark):
    t = Tables({"projects": spark.createDataFrame([("A", "x", 1)], "projectcode string, project string, id int")})
    assert t["program_info"].first()["description"] == "x"
    changed = t.with_table("program_info", spark.createDataFrame([("A", "y")], "project string, description string"))
    assert changed["program_info"].first()["description"] == "y"
    with pytest.raises(KeyError):
        t["nothing"]
