"""Every registered query against its SQL twin, on whole tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from kinelane.plans.catalog import QUERIES
from kinelane.plans.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def ordered(rows):
    def key(row):
        return [(v is None, str(type(v)), v if v is not None else 0) for v in row]

    return sorted(rows, key=key)


def same(left, right):
    if isinstance(left, float) and isinstance(right, float):
        return left == right or math.isclose(left, right, rel_tol=1e-12)
    return type(left) is type(right) and left == right


def test_each_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = entry.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    twin = duck.sql(entry.oracle_sql()[name])
    assert sorted(twin.columns) == columns
    picked = ", ".join(f'"{c}"' for c in columns)
    expected = ordered(twin.query("t", f"SELECT {picked} FROM t").fetchall())
    actual = ordered(tuple(r) for r in result.select(*columns).collect())
    assert len(actual) == len(expected)
    for got, wanted in zip(actual, expected):
        assert all(same(a, b) for a, b in zip(got, wanted)), (got, wanted)


def test_entry(spark):
    assert entry.entry(spark).count() == 8
