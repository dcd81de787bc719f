"""Registered queries against their DuckDB SQL (all that have one), at the smallest scale."""

import pytest

import __spark_entry__ as entry
import check_oracle

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return check_oracle.duck(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, sf, name):
    status, detail = check_oracle.compare(spark, con, QUERIES[name], SQL[name], sf)
    spark.catalog.clearCache()
    assert status == "ok", detail


@pytest.mark.parametrize("name", ["customer_profile", "case_policy", "fairness_gaps", "guardrail_status", "stratified_split_exact",
                                  "permutation_importance_scorecard", "shapley_scorecard", "sensitivity_summary", "classifier_metrics"])
def test_plans_have_no_cross_joins(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    spark.catalog.clearCache()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
