"""Every registered query against its SQL twin in DuckDB."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from tramline.demo import oracle
from tramline.demo import queries as registered

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=repr_key)


def repr_key(row):
    return [(v is None, float(v) if isinstance(v, (int, float)) else 0.0, str(v)) for v in row]


def test_every_query_has_a_twin():
    assert registered.QUERIES.keys() == oracle.ORACLE.keys()


@pytest.mark.parametrize("name", list(registered.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, expected)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
