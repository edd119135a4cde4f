"""Stored report trees compared by folded hashes, and a whole run of reports."""

import pytest

from fieldcast.operators import compare
from fieldcast.operators.compare import tree_diff
from fieldcast.sinks import reports
from fieldcast.tables import Tables


def write(spark, path, files, **tables):
    for name, rows in tables.items():
        frame = spark.createDataFrame(rows, "project string, n int")
        reports.write_csv(frame.repartition(files), f"{path}/{name}")


def result(spark, tmp_path):
    return {r["report"]: (r["only_old"], r["only_new"], r["same"]) for r in tree_diff(spark, f"{tmp_path}/old", f"{tmp_path}/new").collect()}


ROWS = [("a", 1), ("a", 1), ("b", None), ("c, d", 3), ("project", 4)]


def test_equal_trees_are_read_once(spark, tmp_path, monkeypatch):
    write(spark, tmp_path / "old", 1, same=ROWS, other=ROWS[:1])
    write(spark, tmp_path / "new", 4, same=ROWS[::-1], other=ROWS[:1])
    monkeypatch.setattr(compare, "row_diff", lambda *sides: pytest.fail("rows were compared"))
    assert result(spark, tmp_path) == {"same": (0, 0, True), "other": (0, 0, True)}


def test_differences_are_counted_as_bags(spark, tmp_path):
    write(spark, tmp_path / "old", 2, same=ROWS, changed=ROWS, gone=ROWS, fewer=[("a", 1)] * 3)
    write(spark, tmp_path / "new", 3, same=ROWS, changed=[*ROWS[1:], ("z", 9)], extra=ROWS[:2], fewer=[("a", 1)])
    assert result(spark, tmp_path) == {
        "same": (0, 0, True), "changed": (1, 1, False), "gone": (5, 0, False), "extra": (0, 2, False), "fewer": (2, 0, False)
    }


def test_folders_by_project(spark, tmp_path):
    for side, rows in (("old", ROWS), ("new", [*ROWS, ("b", 7)])):
        frame = spark.createDataFrame(rows, "project string, n int")
        reports.write_project_reports({"r": frame}, f"{tmp_path}/{side}")
    found = result(spark, tmp_path)
    assert found["r/project_dir=b"] == (0, 1, False) and found["r/project_dir=a"] == (0, 0, True) and len(found) == 4


def test_a_report_that_needs_a_table_that_is_absent_is_an_error(spark, tmp_path):
    with pytest.raises(KeyError):
        reports.write_report_run(spark, Tables({}), str(tmp_path), "2020-01-01")
