"""Every registered query against its equal SQL."""

import pytest

import __spark_entry__ as driver
from lakewarden.operators import joins
from lakewarden.plans.registry import QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = driver.queries()[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "NestedLoopJoin", *(() if "inventory" in name else ("Python", "Pandas"))):
        assert bad not in plan
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert compare(result, duck, sql) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", ["capture_windows", "file_size_limits", "version_history"])
def test_query_with_split_groups(spark, duck, name, monkeypatch):
    """The same results when nearly every group counts as too large for one task."""
    monkeypatch.setattr("lakewarden.plans.ordered.ROWS_PER_TASK", 2 if name == "capture_windows" else 40)
    result = driver.queries()[name](spark, SF_DIR)
    assert compare(result, duck, driver.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["cidr_lookup", "first_match", "match_rule_paths", "hide_attributes", "policy_violations_long"])
def test_query_with_long_rule_tables(spark, duck, name, monkeypatch):
    """The same results when every rule table counts as too long to compile."""
    monkeypatch.setattr("lakewarden.operators.rules.COMPILED_RULES", 0)
    for operator in (joins.cidr_lookup, joins.first_match):
        monkeypatch.setattr(operator, "__defaults__", (1,))
    result = driver.queries()[name](spark, SF_DIR)
    assert compare(result, duck, driver.oracle_sql()[name]) is None
