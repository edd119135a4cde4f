"""Reports over allsources: figures of packages, devices and messages from one pass over the plays."""

import threading

import pytest

import fieldcast.plans  # noqa: F401
from fieldcast.bindings import domain_tables
from fieldcast.sinks import reports
from fieldcast.tables import Tables
from test_summaries import sources

PLAYS = [
    # project, package, village, device, message, seconds, effective, completed
    ("P", "K", "v", "t1", "a", 3600, 2, 1), ("P", "K", "w", "t1", "a", 3600, 2, 1), ("P", "K", "v", "t1", "b", None, 1, 0),
    ("P", "K", "v", "t2", "a", 60, 1, 1), ("P", "K", "v", None, "b", 60, 1, 1), ("P", "K", "v", "t3", "other", 60, 1, 1),
    ("P", "K", "v", "t3", "unlisted", 60, 1, 1), ("Q", "K", "v", "t1", "a", 60, 0, 0),
]


@pytest.fixture
def tables(spark):
    def table(columns, *rows):
        return spark.createDataFrame(list(rows), columns)

    return Tables({
        "allsources_s": table(
            "project string, contentpackage string, village string, talkingbook string, contentid string, played_seconds_max long, "
            "effectivecompletions_max long, completed_max long", *PLAYS,
        ),
        "contentinpackage": table(
            "project string, contentpackage string, contentid string, categoryid string, position int",
            ("P", "K", "a", "c", 1), ("P", "K", "a", "c", 1), ("P", "K", "b", "c", 2), ("Q", "K", "other", "c", 3),
        ),
        "contentmetadata2": table(
            "project string, contentid string, title string, format string, duration_sec int",
            ("P", "a", "one", "song", 60), ("Q", "a", "one", "song", 60), ("P", "b", "two", "song", 120), ("P", "other", "three", "song", 120),
        ),
        "categories": table("projectcode string, categoryid string, categoryname string", ("P", "c", "Farm"), ("Q", "c", "Health")),
        "packagesindeployment": table(
            "project string, contentpackage string, deployment string, packagename string, startdate string",
            ("P", "K", "D", "first", "2020"), ("P", "K", "D", "second", "2020"),
        ),
    })


def test_package_stats_in_one_pass(spark, tables):
    """A device of two villages counts once, one without a name in the shares only, a message of another project's list in msgs only."""
    frame = tables["package_stats"]
    rows = sorted(frame.collect(), key=lambda r: r["packagename"])
    assert [r["packagename"] for r in rows] == ["first", "second"]
    row = rows[0].asDict()
    assert (row["msgs"], row["tbcount"], row["completed"], row["hoursplayed"], row["duration_min"]) == (3, 3, 5, 2.1, 8)
    # t1 played both messages of its own list, t2 and the nameless one half of them, t3 none
    shares = ("tbsplayingallmsgspct", "tbsplayinghalfnotallmsgspct", "tbsplayinglessthanhalfmsgspct")
    assert [row[c] for c in shares] == [0.33, 0.67, None]
    assert "Expand" not in frame._jdf.queryExecution().executedPlan().toString()


def test_messages_of_each_device_in_one_pass(tables):
    frame = tables["msgs_played_each_tb"]
    found = sorted(map(tuple, frame.select("project", "contentpackage", "talkingbook", "village", "msgsplayed", "msgstotal").collect()), key=str)
    assert found == sorted([
        ("P", "K", "t1", "v", 2, 2), ("P", "K", "t1", "w", 1, 2), ("P", "K", "t2", "v", 1, 2), ("P", "K", None, "v", 1, 2),
    ], key=str)
    assert "distinct contentid" not in frame._jdf.queryExecution().optimizedPlan().toString()


def _exchanges(frame):
    """Names of the columns of every shuffle that a plan asks for."""
    def walk(node):
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        here = [names] if node.nodeName() == "Exchange" else []
        children = node.children()
        return here + [x for i in range(children.size()) for x in walk(children.apply(i))]

    plan = frame._jdf.queryExecution().executedPlan()
    return walk(plan.initialPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan)


def test_messages_of_a_deployment_are_not_dealt_again(tables):
    """Packages that are listed twice under a deployment count twice; with plays dealt by message no figures move by deployment."""
    found = {r["title"]: r for r in tables["top_msgs_by_deployment"].collect()}
    assert {n: (r["total_completions"], r["total_effective_completions"], r["tbs"], r["pkgtbs"]) for n, r in found.items()} == {
        "one": (6, 10, 2, 3), "two": (2, 4, 1, 3), "three": (2, 2, 1, 3),
    }


def test_sources_are_shuffled_as_rows(spark):
    moved = [names for names in _exchanges(Tables(sources(spark))["allsources"]) if "village" in names and "contentid" in names]
    assert any("counters" in names for names in moved) and not any(n.startswith("buf") for names in moved for n in names)


def test_small_tables_are_stored(spark):
    t = domain_tables(spark, "/root/testdata/sf0.001")
    for name in ("communities", "categories", "packagesindeployment"):
        assert "Aggregate" not in t[name]._jdf.queryExecution().optimizedPlan().toString(), name
        assert "Join" not in t[name]._jdf.queryExecution().optimizedPlan().toString(), name


def test_reports_are_written_side_by_side(spark, tmp_path, monkeypatch):
    both = threading.Barrier(2, timeout=30)
    monkeypatch.setattr(reports, "write_csv", lambda frame, path: both.wait())
    reports.write_global_reports({"a": spark.range(1), "b": spark.range(1)}, str(tmp_path))


def test_a_report_that_fails_is_raised(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(reports, "write_csv", lambda frame, path: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        reports.write_global_reports({"a": spark.range(1)}, str(tmp_path))
