"""Every registered query against its SQL, and the plans they run with."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from compare import bag, connect
from gridyield.checks.all_cases import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, duck, key):
    df = QUERIES[key](spark, SMALL)
    cursor = duck.execute(ORACLES[key])
    names = [c[0] for c in cursor.description]
    types = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    assert {n: types.get(t) for n, t in df.dtypes} == dict(zip(names, (str(c[1]) for c in cursor.description)))
    assert bag([tuple(r) for r in df.collect()], df.columns) == bag(cursor.fetchall(), names)


def test_every_sql_has_a_query():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and all(0 <= r["mean_cf"] <= 1 for r in rows)


@pytest.mark.parametrize("key", ["solar_cf", "wind_cf", "interp_join_linear", "deaccumulate_zero", "region_annual_mean_snapped",
                                 "mosaic_mean", "multi_year_mean_hourly_axis", "resolution_experiment", "nearest_axis_snap_irregular"])
def test_no_python_and_no_pairing_in_plans(spark, plan, key):
    text = plan(entry.queries()[key](spark, SMALL))
    for word in ("Python", "CartesianProduct", "NestedLoop", "SortAggregate"):
        assert word not in text, word
