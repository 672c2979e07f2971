"""Shape of the physical plans: shuffles, joins and what reaches the scan."""

from __future__ import annotations

import re

import pytest

from stratakeep.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan: str) -> int:
    return len(re.findall(r"\bExchange hashpartitioning", plan))


@pytest.fixture(scope="module")
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("hub_customer", 1),
        ("link_order_product", 1),
        ("sat_hash_diff", 0),
        ("sat_customer", 1),
        ("sat_link", 1),
        ("latest_per_key", 1),
        ("pit_customer", 1),
        ("cart_adds_drops", 1),
        ("email_explode", 0),
        ("unix_time", 0),
        ("dim_product", 3),
    ],
)
def test_number_of_shuffles(spark, shuffled_joins, name, expected):
    assert shuffles(plan_of(QUERIES[name](spark, SF_DIR))) == expected


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not n.startswith(("job_", "ingest_"))])
def test_no_python_rows_and_no_cross_joins(spark, shuffled_joins, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF", "SinglePartition", "ObjectHash"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["sat_event", "sat_sequenced", "dim_product", "dim_customer_history"])
def test_a_first_step_is_computed_once(spark, name):
    """What several later steps read was written before: the plan scans each
    given table at most once per use of its own columns."""
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    scans = len(re.findall(r"FileScan parquet", plan))
    assert "stratakeep" in plan and scans <= {"sat_event": 3, "sat_sequenced": 3, "dim_product": 2, "dim_customer_history": 4}[name]


def test_filters_and_columns_reach_the_scan(spark, capsys):
    QUERIES["hub_incremental"](spark, SF_DIR).explain("formatted")
    plan = capsys.readouterr().out
    pushed = re.findall(r"PushedFilters: \[(.*)\]", plan)
    read = re.findall(r"ReadSchema: (.*)", plan)
    assert len(pushed) == len(read) == 3
    assert all("o_orderdate" in filters and "IsNotNull(o_custkey)" in filters for filters in pushed)
    assert all("o_custkey" in columns and "o_totalprice" not in columns for columns in read)
