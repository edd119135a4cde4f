"""Domain tables over tables made here: what is scanned for them."""

import datetime

import pytest

from fieldcast.bindings import BINDINGS, NAMES, SMALL, domain_tables
from fieldcast.tables import PATTERN_COLUMNS

TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "ASIA"), (1, None)]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "X", 0), (1, "Y", 1)]),
    "customer": ("c_custkey bigint, c_nationkey int, c_mktsegment string", [(1, 0, "BUILDING"), (2, 1, None), (3, 0, "BUILDING")]),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate date",
        [(k, c, "F", datetime.date(1995, m, 3)) for k, c, m in ((1, 1, 1), (2, 1, 2), (2, 1, 2), (3, 2, 5), (4, None, 5), (5, 3, 12))],
    ),
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int", [(1, "a", "Brand#3", "t", 1), (2, "b", None, "t", 2)]),
}


@pytest.fixture
def folder(spark, tmp_path):
    def write(**changed):
        for name, (schema, data) in {**TABLES, **changed}.items():
            spark.createDataFrame(data, schema).write.mode("overwrite").parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


def test_names_are_looked_up_without_the_facts(spark, folder):
    t = domain_tables(spark, folder())  # there is no lineitem at all
    flags = {(table, column): t.wildcards(table, column) for table in NAMES for column in PATTERN_COLUMNS[table]}
    assert set(flags.values()) == {False}
    assert all(needed != "lineitem" for table in NAMES for needed in NAMES[table][0])


def test_wild_names_are_found(spark, folder):
    customers = ("c_custkey bigint, c_nationkey int, c_mktsegment string", [(1, 0, "A_GRO")])
    parts = (TABLES["part"][0], [(1, "a", "50%", "t", 1)])
    t = domain_tables(spark, folder(customer=customers, part=parts))
    assert t.wildcards("playstatistics", "contentpackage") and t.wildcards("contentinpackage", "contentpackage")
    assert t.wildcards("contentinpackage", "categoryid") and not t.wildcards("contentinpackage", "contentid")
    assert not t.wildcards("tbsdeployed", "deployment")


def test_small_tables_are_stored_once(spark, folder, rows):
    t = domain_tables(spark, folder())
    for name in ("deployments", "packagesindeployment", *SMALL):
        plan = t[name]._jdf.queryExecution().executedPlan().toString()
        assert "o_orderdate" not in plan and "c_mktsegment" not in plan
    assert t["deployments"].inputFiles() and set(t["deployments"].inputFiles()) == set(t["quarters"].inputFiles())
    # two orders lie in the first quarter, one of them twice; the one in May is of a region without a name
    named = t["deployments"].where("project IS NOT NULL").select("project", "deployment", "deploymentnumber")
    assert rows(named) == [("ASIA", "ASIA-1995-1", 1), ("ASIA", "ASIA-1995-4", 4)]
    assert t["deployments"].where("project IS NULL").count() == 1
    assert set(SMALL) <= set(BINDINGS)
