"""Every registered query beside its check SQL, on the smallest given tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import compare, open_tables  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

MODELS = [name for name in queries() if name not in oracle_sql()]


@pytest.fixture(scope="module")
def base(small):
    return open_tables(small)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_its_check(spark, small, base, name):
    df = queries()[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    verdict = compare(df, base, oracle_sql()[name])
    assert verdict.startswith("ok") and "types differ" not in verdict, verdict


@pytest.mark.parametrize("name", MODELS)
def test_model_query_runs(spark, small, name):
    assert queries()[name](spark, small).count() > 0


def test_every_check_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
