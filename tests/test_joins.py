"""Both join modes against a brute-force full outer join."""

import itertools
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from traitweave.operators.joins import hot_ids, join_tables, outer_join, stack_join


def brute_force(tables):
    """Per id the product of each table's rows; rows without an id on their own."""
    found = Counter()
    for eid in {e for rows in tables for e, _ in rows if e is not None}:
        sides = [[v for e, v in rows if e == eid] or [None] for rows in tables]
        found.update((eid, *combination) for combination in itertools.product(*sides))
    for k, rows in enumerate(tables):
        for eid, value in rows:
            if eid is None:
                found[(None, *(value if j == k else None for j in range(len(tables))))] += 1
    return found


def frames(spark, tables):
    return [spark.createDataFrame(rows, f"eid bigint, c{k} string") for k, rows in enumerate(tables)]


def rows_of(df, n):
    return Counter(tuple(r) for r in df.select("eid", *[f"c{k}" for k in range(n)]).collect())


MESSY = [
    [(1, "a0"), (1, "a1"), (1, "a0"), (2, "a"), (3, None), (None, "n0"), (None, "n1"), (7, "a")] + [(9, "hot")] * 12,
    [(1, "b0"), (3, "b"), (3, "b"), (4, "b"), (None, "n0"), (9, "b")],
    [(1, "c0"), (1, "c1"), (5, "c"), (7, "c"), (None, None)] + [(9, f"c{i}") for i in range(5)],
    [(4, "d"), (6, "d0"), (6, "d0"), (6, "d2"), (6, "d3"), (9, "d")],
]


@pytest.mark.parametrize("hot_rows", [None, 1, 2, 3, 1000])
def test_outer_join_of_any_ids(spark, hot_rows):
    joined = outer_join(frames(spark, MESSY), hot_rows)
    assert joined.columns == ["eid", "c0", "c1", "c2", "c3"]
    assert rows_of(joined, 4) == brute_force(MESSY)


def test_hot_ids_are_few(spark):
    found = hot_ids([f.filter("eid is not null") for f in frames(spark, MESSY)], 3)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 3, 1, 2, 0), (6, 0, 0, 0, 4), (9, 12, 1, 5, 1)]


def test_fragments_spread_a_hot_id(spark):
    """An id with a third of all rows meets its partner in many tasks, without shuffling by id alone."""
    many = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("eid"), F.col("id").cast("string").alias("c0")
    )
    few = spark.range(1000).select(F.col("id").alias("eid"), F.lit("y").alias("c1"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = outer_join([many, few], hot_rows=500)
        per_task = joined.filter("eid = 0").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in per_task) == 10_000
        assert len(per_task) > 1
        assert joined.count() == 30_000 + 1000 - 667
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copies_of_one_row_are_all_kept(spark):
    many = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("eid"), F.lit("x").alias("c0")
    )
    few = spark.createDataFrame([(0, "y"), (0, "y"), (0, "z"), (50_000, "w")], "eid bigint, c1 string")
    counts = outer_join([many, few], hot_rows=500).groupBy("eid", "c0", "c1").count()
    assert {tuple(r) for r in counts.filter("eid = 0 OR c0 IS NULL").collect()} == {
        (0, "x", "y", 20_000),
        (0, "x", "z", 10_000),
        (50_000, None, "w", 1),
    }
    assert counts.filter("eid <> 0").count() == 20_001


CLEAN = [
    [(1, "a"), (2, "a"), (3, None)],
    [(2, "b"), (4, "b")],
    [(5, "c"), (1, "c"), (2, None)],
]


def test_stack_equals_outer(spark):
    tables = frames(spark, CLEAN)
    assert rows_of(stack_join(tables), 3) == rows_of(outer_join(tables), 3) == brute_force(CLEAN)
    assert rows_of(join_tables(tables, "stack"), 3) == rows_of(join_tables(tables), 3) == brute_force(CLEAN)


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_packed_outer_join_of_any_ids(spark, hot_rows):
    assert rows_of(join_tables(frames(spark, MESSY), "outer", hot_rows), 4) == brute_force(MESSY)


def test_stack_keeps_types_and_arrays(spark):
    a = spark.createDataFrame([(1, [1, 2], True, 3), (2, [], None, None)], "eid int, x array<int>, f boolean, n int")
    b = spark.createDataFrame([(1, ["q"], False), (3, None, True)], "eid int, y array<string>, g boolean")
    joined = join_tables([a, b], "stack")
    assert joined.dtypes == [
        ("eid", "int"), ("x", "array<int>"), ("f", "boolean"), ("n", "int"), ("y", "array<string>"), ("g", "boolean"),
    ]
    assert sorted(tuple(r) for r in joined.collect()) == [
        (1, [1, 2], True, 3, ["q"], False),
        (2, [], None, None, None, None),
        (3, None, None, None, None, True),
    ]


@pytest.mark.parametrize("extra", [(2, "again"), (None, "nobody")])
def test_stack_refuses_unsound_ids(spark, extra):
    with pytest.raises(PySparkException, match="join_mode='outer'"):
        stack_join(frames(spark, [CLEAN[0] + [extra], CLEAN[1]])).select("c1").collect()


def test_one_table_is_not_joined(spark):
    (only,) = frames(spark, MESSY[:1])
    assert join_tables([only], "stack") is only


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="join_mode"):
        join_tables(frames(spark, CLEAN), "inner")


@pytest.mark.parametrize("hot_rows", [None, 1, 2, 1000])
def test_values_do_not_depend_on_the_number_of_rows(spark, hot_rows):
    left = spark.sql(
        "select 1L eid, d, map('a', 1) m, timestamp'2020-01-01 00:00:00.000001' t, x'FF00' b"
        " from values (-0D), (0D), (0D), (double('NaN')) as v(d)"
    )
    right = spark.sql("select 1L eid, array(-0D, null) r union all select 2L, array()")
    got = outer_join([left, right], hot_rows).collect()
    assert sorted(str(r["d"]) for r in got if r["eid"] == 1) == ["-0.0", "0.0", "0.0", "nan"]
    assert all(r["m"] == {"a": 1} and r["t"].microsecond == 1 and bytes(r["b"]) == b"\xff\x00" for r in got if r["eid"] == 1)
    assert [str(r["r"]) for r in got].count("[-0.0, None]") == 4 and len(got) == 5


@pytest.mark.parametrize("mode", ["outer", "stack"])
def test_join_of_some_ids(spark, mode):
    tables = MESSY if mode == "outer" else CLEAN
    n = len(tables)
    some = spark.createDataFrame([(1, "x"), (9, "y"), (9, "z"), (None, "n"), (77, "absent"), (2, "q")], "who long, other string")
    wanted = [[row for row in rows if row[0] in (1, 9, 2)] for rows in tables]
    joined = join_tables(frames(spark, tables), mode, 3, only=some)
    assert rows_of(joined, n) == brute_force(wanted)
    (single,) = frames(spark, MESSY[:1])
    assert rows_of(join_tables([single], only=some), 1) == Counter(r for r in MESSY[0] if r[0] in (1, 9, 2))
    nobody = some.filter("who = 77")
    assert join_tables(frames(spark, tables), mode, only=nobody).count() == 0


def test_marks_that_collide_change_nothing(spark, monkeypatch):
    monkeypatch.setattr("traitweave.operators.joins.MARKS", 2)
    tables = frames(spark, MESSY)
    some = spark.createDataFrame([(1,), (9,)], "eid long")
    wanted = [[row for row in rows if row[0] in (1, 9)] for rows in MESSY]
    assert rows_of(join_tables(tables, only=some), 4) == brute_force(wanted)
    assert rows_of(outer_join(tables, 2), 4) == brute_force(MESSY)


def test_equal_rows_of_a_hot_id_spread_over_tasks(spark):
    """Copies of one row in several partitions fall into several fragments, and none is lost."""
    many = spark.range(20_000, numPartitions=8).select(F.lit(0).cast("long").alias("eid"), F.lit("x").alias("c0"))
    few = spark.createDataFrame([(0, "y"), (0, "z")], "eid long, c1 string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = outer_join([many, few], hot_rows=2_000)
        tasks = joined.groupBy(F.spark_partition_id()).count().count()
        assert {tuple(r) for r in joined.groupBy("c0", "c1").count().collect()} == {("x", "y", 20_000), ("x", "z", 20_000)}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert tasks > 1


def test_ids_that_are_not_numbers(spark):
    a = spark.createDataFrame([("k", 1), ("k", 2), (None, 3), ("é", 4)], "eid string, c0 int")
    b = spark.createDataFrame([("k", 5)] * 3 + [("", 6)], "eid string, c1 int")
    assert rows_of(outer_join([a, b], 2), 2) == brute_force([[tuple(r) for r in x.collect()] for x in (a, b)])
