"""Every named query against its SQL counterpart, value by value."""

import os

import duckdb
import pytest

from __spark_entry__ import entry
from visitlens.plans.oracle import all_sql as oracle_sql
from visitlens.plans.registry import all_queries as queries

TABLES = ["events", "customer", "nation", "part"]
KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def expected(sql, sf_dir, tables=TABLES):
    con = duckdb.connect()
    for table in tables:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = con.execute(sql)
    types = {column[0]: KINDS.get(str(column[1]), str(column[1])) for column in result.description}
    names = list(types)
    return types, sorted((tuple(sorted(zip(names, row))) for row in result.fetchall()), key=repr)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_matches_sql(spark, name):
    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    types, rows = expected(oracle_sql()[name], sf_dir)
    found = queries()[name](spark, sf_dir)
    assert dict(found.dtypes) == types
    got = sorted((tuple(sorted(row.asDict().items())) for row in found.collect()), key=repr)
    assert got == rows
    assert rows


def test_entry_runs(spark):
    row = entry(spark).collect()[0]
    assert row.session_count == 21
