"""Corpus queries that SQL can express, against their SQL."""

import duckdb
import pytest

from traitweave.llm.oracle import oracle_sql
from traitweave.llm.queries import queries

SQL = oracle_sql()


@pytest.mark.parametrize("name", SQL)
def test_query(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    df = queries()[name](spark, sf_dir)
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    cursor = connection.execute(SQL[name])
    order = [[d[0] for d in cursor.description].index(c) for c in df.columns]
    assert len(order) == len(cursor.description)
    assert got == sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
