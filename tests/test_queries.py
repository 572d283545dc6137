"""Every registered query against its SQL twin, and what its plan must not hold."""

import pytest
from conftest import plan_of
from oracle_check import compare, oracle_connection

import __spark_entry__ as entry
from oracle_queries import ORACLE
from tradeweave.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan
    assert compare(df, duck, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_pushdown_and_pruning(spark):
    plan = plan_of(entry.queries()["filter_gt"](spark, SF))
    assert "GreaterThan(l_extendedprice,90000.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double>" in plan
    assert "TakeOrderedAndProject" in plan_of(entry.queries()["topk"](spark, SF))
    grouped = plan_of(entry.queries()["group_multi"](spark, SF))
    assert "partial_sum" in grouped and grouped.count("Exchange") == 1
