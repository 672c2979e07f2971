"""Every registered query against the same result in SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from stratakeep.operators import ordered
from stratakeep.plans.oracle import ORACLE
from stratakeep.plans.queries import QUERIES
from tests.compare import canonical, oracle_connection

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    got = contract.queries()[name](spark, SF_DIR)
    want = oracle.sql(contract.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    got_rows = canonical(got.columns, got.collect())
    assert got_rows, "no rows"
    assert got_rows == canonical(want.columns, want.fetchall())


@pytest.mark.parametrize(
    "name",
    ["sat_sequenced", "sat_event", "sat_link", "pit_customer", "dim_product", "dim_customer_history", "fact_adds_drops"],
)
def test_query_matches_sql_with_every_key_cut(spark, oracle, monkeypatch, name):
    monkeypatch.setattr(ordered, "MAX_ROWS_PER_TASK", 10)
    got = contract.queries()[name](spark, SF_DIR)
    want = oracle.sql(contract.oracle_sql()[name])
    assert canonical(got.columns, got.collect()) == canonical(want.columns, want.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
