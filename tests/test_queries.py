"""Every registered query against its expected SQL on the smallest tables."""
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from oreleaf.plans.catalog import QUERIES
from oreleaf.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_each_query_has_expected_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    expected = duck.execute(ORACLE[name])
    names = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(names)
    assert _rows(df.columns, df.collect()) == _rows(names, expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
