"""A cross-section of the queries against DuckDB (all of them: ``python tests/compare.py 0.01``)."""

import os

import pytest

import __spark_entry__ as driver
from compare import TESTDATA, difference, duck
from fieldcast.oracle import ORACLE
from fieldcast.queries import QUERIES

SF_DIR = f"{TESTDATA}/sf0.001"
CHOSEN = [
    "deployment_dashboard", "deployments_by_community", "tbnewsn_past_six_months", "production_by_deployment", "usage_info",
    "usage_by_package_category", "allsources", "package_stats", "top_msgs_by_deployment", "src_kv_log", "src_deployments_log",
    "src_a18_metadata", "merge_playstatistics", "upsert", "lookup_warnings", "sink_properties", "uf_bundle_blocks", "uf_chain", "fn_math",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_its_check(spark, con, name):
    assert difference(con, driver.queries()[name](spark, SF_DIR), driver.oracle_sql()[name]) is None


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = driver.queries()["tbnewsn_by_months"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in plan
    assert "o_totalprice" not in plan
