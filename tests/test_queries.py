"""Every registered query against its SQL check on the smallest tables."""

from __future__ import annotations

import pytest
from compare import difference, open_tables, type_difference
from conftest import SMALL

import __spark_entry__ as contract
from orelake.workload import CHECKS, QUERIES


@pytest.fixture(scope="module")
def tables():
    return open_tables(SMALL)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_same_rows_as_sql(spark, tables, name):
    frame = QUERIES[name](spark, SMALL)
    check = tables.sql(CHECKS[name])
    assert type_difference(frame, check) is None
    assert difference(frame.toPandas(), check.df()) is None


def test_contract_is_complete(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    unchecked = set(contract.queries()) - set(contract.oracle_sql())
    # Only operators that SQL cannot state have no check; their tests compare with brute force.
    assert all(name == "pipeline" or name.startswith("op") for name in unchecked)
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("ml_")))
def test_plans_hold_no_product_join_and_no_python(spark, plan_of, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan
