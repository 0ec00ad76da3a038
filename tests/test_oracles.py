"""Every query against its DuckDB twin, on the driver's tables."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from checks.inputs import DRIVER_TABLES
from checks.oracles import ORACLES
from checks.queries import QUERIES


# Cross joins, and rows leaving the JVM.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in DRIVER_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        # Six places, and no negative zero.
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_twin(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    twin = duck.execute(ORACLES[name])
    twin_columns = [c[0] for c in twin.description]
    assert sorted(result.columns) == sorted(twin_columns)
    ours, theirs = bag(result.columns, result.collect()), bag(twin_columns, twin.fetchall())
    assert sum(ours.values()) == sum(theirs.values())
    assert not ours - theirs, (list((ours - theirs))[:2], list((theirs - ours))[:2])
