"""Every registered query against its SQL, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from checks.queries import output_path, registered

QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in ("orders", "lineitem", "events", "supplier"):
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


COHORT = registered()


def test_every_cohort_query_has_its_sql():
    assert set(COHORT) <= set(SQL)


class _Cluster:
    """A session on a cluster without a shared folder, as far as output_path looks."""

    class conf:  # noqa: N801
        get = staticmethod(lambda name, default=None: default)

    class sparkContext:  # noqa: N801
        master = "spark://somewhere:7077"


def test_sinks_need_a_shared_folder_on_a_cluster():
    with pytest.raises(ValueError, match="checkpoint"):
        output_path(_Cluster, "result")


def test_entry(spark):
    df = entry_points.entry(spark)
    assert len(df.columns) == 116
    assert df.count() > 0


@pytest.mark.parametrize("name", COHORT)
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    cursor = duck.execute(SQL[name])
    order = [[d[0] for d in cursor.description].index(c) for c in df.columns]
    assert len(order) == len(cursor.description)
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert got == expected
