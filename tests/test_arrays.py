import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitweave.functions.arrays import (
    contains_any,
    has_at_least,
    intersect_codes,
    merge_visits,
    merge_visits_over_tables,
    pack_cells,
    undotted,
)


def one(df):
    return df.collect()[0][0]


@pytest.mark.parametrize(
    "cells, packed", [((3, None, 1, 3), [3, 1]), ((None, None, None, None), []), ((0, 0, 0, 0), [0])]
)
def test_pack_cells(spark, cells, packed):
    df = spark.createDataFrame([cells], "a int, b int, c int, d int")
    assert one(df.select(pack_cells(["a", "b", "c", "d"]))) == packed


def test_merge_visits(spark):
    df = spark.createDataFrame([([1, 2], [2, 3], None)], "a array<int>, b array<int>, c array<int>")
    assert one(df.select(merge_visits(["a", "b"]))) == [1, 2, 3]
    assert one(df.select(merge_visits(["a", "c"]))) is None
    assert one(df.select(merge_visits_over_tables(["c", "a", "b"]))) == [1, 2, 3]
    assert one(df.select(merge_visits_over_tables(["c", "c"]))) is None


@pytest.mark.parametrize(
    "codes, found",
    [
        (["F42", "F431"], True),
        (["F4311"], False),
        ([], False),
        (None, None),
        (["F42", None], None),
        (["F431", None], True),
        (["F43.1"], False),
    ],
)
def test_contains_any_text(spark, codes, found):
    df = spark.createDataFrame([(codes,)], "c array<string>")
    assert one(df.select(contains_any(F.col("c"), ["F431", "F41"], T.StringType()))) is found


def test_contains_any_follows_the_element_type(spark):
    df = spark.createDataFrame([([12], ["12"], [12])], "n array<bigint>, s array<string>, i array<int>")
    row = df.select(
        contains_any(F.col("n"), [12], T.LongType()),
        contains_any(F.col("s"), [12], T.StringType()),
        contains_any(F.col("i"), ["12"], T.IntegerType()),
        contains_any(F.col("n"), [12]),
    ).collect()[0]
    assert list(row) == [True, True, True, True]


def test_undotted(spark):
    df = spark.createDataFrame([(["F42.0", "F420", None],)], "c array<string>")
    assert one(df.select(undotted(F.col("c")))) == ["F420", "F420", None]


@pytest.mark.parametrize("legacy", ["true", "false"])
def test_intersect_codes(spark, legacy):
    df = spark.createDataFrame([(1, ["a", "b", "b"]), (2, ["c"]), (3, None), (4, [])], "eid int, c array<string>")
    spark.conf.set("spark.sql.legacy.sizeOfNull", legacy)
    try:
        rows = {r.eid: (r.x_codes, r.x) for r in intersect_codes(df, "c", ["b", "a"], "x").collect()}
    finally:
        spark.conf.unset("spark.sql.legacy.sizeOfNull")
    assert rows == {1: (["a", "b"], True), 2: ([], False), 3: (None, None), 4: ([], False)}


def test_has_at_least(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([1],), (None,)], "c array<int>")
    assert [r[0] for r in df.select(has_at_least(F.col("c"), 3)).collect()] == [True, False, None]
