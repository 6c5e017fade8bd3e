"""Every registered query against its SQL, and the shape of its plan."""

import re

import pytest

import __spark_entry__ as entry_point
import registry.oracles
import registry.queries
from tests.compare import database, difference
from tests.conftest import SF

QUERIES, ORACLES = registry.queries.QUERIES, registry.oracles.ORACLES


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for spec in re.findall(r"windowspecdefinition\((.*?)specifiedwindowframe", plan):
        assert not re.match(r"\S+ (ASC|DESC)", spec), "a window without partitions"
    assert difference(df, con, ORACLES[name]) is None


def test_every_oracle_has_its_query():
    assert set(ORACLES) == set(QUERIES)


def test_entry_has_them_all():
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["step", "stage", "rows_in", "rows_out"] and df.count() == 4
