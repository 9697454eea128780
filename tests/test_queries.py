"""Every registered query against its SQL in DuckDB, value by value."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    for row in rows:
        for value in row:
            assert not isinstance(value, decimal.Decimal), "decimals differ in scale between engines"
    # as text: 1, 1.0 and -0.0, 0.0 are equal in Python but not as results
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    ours = QUERIES[name](spark, sf_dir)
    theirs = duck.execute(ORACLES[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = _rows(columns, theirs.fetchall())
    assert expected, "the oracle found nothing, so it shows nothing"
    assert _rows(ours.columns, [tuple(r) for r in ours.collect()]) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    assert rows
    for row in rows:
        assert all(not (isinstance(v, float) and math.isnan(v)) and v is not None for v in row)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert registry.entry(spark).count() == 10
