"""Every registered query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as driver
from ledgerstream.plans import oracles, queries

ORACLES = oracles.ORACLES
QUERIES = queries.QUERIES
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in ("events", "orders"):
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def comparable(records):
    def plain(value):
        if isinstance(value, float):
            return None if math.isnan(value) else round(value, 6)
        return value
    return sorted((tuple(plain(v) for v in r) for r in records), key=repr)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= driver.queries().keys() and ORACLES.keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, duck, name):
    found = QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    relation = duck.sql(ORACLES[name])
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: DUCK_TYPES[t] for c, t in found.dtypes} == types
    expected = relation.select(*columns).fetchall()
    actual = comparable(tuple(r) for r in found.select(*columns).collect())
    assert actual and actual == comparable(expected)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.endswith("_stream")])
def test_plans_stay_in_the_engine(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Exchange SinglePartition"):
        assert operator not in plan


def test_entry(spark):
    alerts = driver.entry(spark)
    assert alerts.count() > 0 and "urgency_level" in alerts.columns
