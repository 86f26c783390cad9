"""The participant tables and the queries on them, on rows of their own."""

import datetime

import duckdb
import pytest

import __spark_entry__ as entry_points


@pytest.fixture
def own_tables(spark, tmp_path):
    """Writes the three driver tables: lines (order, part, supplier, flag), orders (order, customer), events (event, user)."""

    def write(lines=(), orders=(), events=()) -> str:
        day = datetime.datetime(2024, 1, 1)
        tables = {
            "orders": ([(o, c, "F", 100.0) for o, c in orders], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"),
            "lineitem": (
                [(o, p, s, 1, flag) for o, p, s, flag in lines],
                "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string",
            ),
            "events": ([(e, day, u, "signup", 1.0) for e, u in events], "event_id long, ts timestamp, user_id long, event_type string, value double"),
        }
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def result(spark, sf_dir: str, name: str) -> dict:
    """The rows of a query by id, the same as those of its SQL."""
    df = entry_points.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    duck = duckdb.connect()
    for table in ("orders", "lineitem", "events"):
        duck.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet/*.parquet'")
    cursor = duck.execute(entry_points.oracle_sql()[name])
    order = [[d[0] for d in cursor.description].index(c) for c in df.columns]
    assert sorted(got, key=repr) == sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    return {r[0]: r[1:] for r in got}


EVENTS = [(1, 10), (9, 11), (16, 11), (2, 12), (12, 13)]


def test_acts_of_all_events_count(spark, own_tables):
    # before, only events 16, 32 and so on were read, and users 10 and 13 had named none
    found = result(spark, own_tables(events=EVENTS), "code_set_flag")
    assert found == {10: (True,), 11: (False,), 12: (False,), 13: (True,)}


def test_self_harm_by_acts_of_all_events(spark, own_tables):
    found = result(spark, own_tables(events=EVENTS), "self_harm_questionnaire")
    assert found[10][-1] is True and found[13][-1] is True


def test_diagnoses_take_one_exchange_of_lines(spark, own_tables):
    # before, equal lines were dropped in an exchange of their own
    lines = [(1, 431, 1, "R")] * 50 + [(2, 432, 1, "R"), (2, 431, 1, "N"), (3, 431, 1, "R"), (9, 431, 1, "R")]
    sf_dir = own_tables(lines=lines, orders=[(1, 10), (2, 10), (2, 11), (3, 12), (4, 13)])
    assert result(spark, sf_dir, "icd10_flag") == {10: (True,), 11: (False,), 12: (True,)}
    plan = entry_points.queries()["icd10_flag"](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Aggregate(") == 2  # partial and final of the sets, no fold of lines
