"""Every registered query against its SQL counterpart."""

import pytest
from oracle_compare import duckdb_on, oracle_rows, spark_rows

import __spark_entry__ as contract
from catalog.oracle import ORACLE
from catalog.queries import QUERIES

SF = "/root/testdata/sf0.01"

# Results that hold rows at this scale, so that an empty match proves nothing by accident.
NEVER_EMPTY = set(QUERIES)


@pytest.fixture(scope="module")
def con():
    with duckdb_on(SF) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF))
    assert rows or name not in NEVER_EMPTY
    expected_columns, expected = oracle_rows(con, ORACLE[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    for got, want in zip(rows, expected):
        assert got == want


def test_entry(spark):
    assert contract.entry(spark).count() > 0


SPARK_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


@pytest.mark.parametrize("name", sorted(n for n in ORACLE if not n.startswith("stream_")))
def test_types(spark, con, name):
    described = con.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    expected = {column: SPARK_TYPE[kind] for column, kind, *_ in described}
    assert dict(QUERIES[name](spark, "/root/testdata/sf0.001").dtypes) == expected
