"""Every query of the engine itself against its SQL in DuckDB, over the smallest given tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__
import compare
from stopmetrics.verification import oracle
from stopmetrics.verification import queries as registered

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SMALL).exists(), reason="the given tables are not here")


def test_every_query_has_its_sql():
    assert set(registered.queries()) == set(oracle.oracle_sql())
    assert set(registered.queries()) <= set(__spark_entry__.queries())


@needs_tables
@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert compare.compare(spark, name, SMALL) == ""


@needs_tables
def test_plans_stay_distributed(spark):
    """No Python in the plan, no cross join, and the deduplication limits each key before its shuffle."""
    known = __spark_entry__.queries()
    for name in ("fct_daily_delays", "executive_summary", "value_distribution", "hub_propagation", "null_rates"):
        plan = known[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
            assert word not in plan, (name, word)
    plan = known["fct_daily_delays"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    assert __spark_entry__.entry(spark).count() > 0
