import pytest
from pyspark.sql import functions as F

from traitweave import Score, evaluate
from traitweave.functions.scores import any_true, replace_missing_code, severity_band, total


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_replace_missing_code(spark):
    df = spark.createDataFrame([(-818,), (-121,), (0,), (3,), (None,)], "x bigint")
    assert column(df, replace_missing_code(F.col("x"))) == [0, -121, 0, 3, None]


def test_total_and_any(spark):
    df = spark.createDataFrame([(1, 2, True, None), (1, None, False, None), (1, 1, False, False)], "a int, b int, c boolean, d boolean")
    assert column(df, total([F.col("a"), F.col("b")])) == [3, None, 2]
    assert column(df, any_true([F.col("c"), F.col("d")])) == [True, None, False]


def test_severity_band_edges(spark):
    df = spark.createDataFrame([(v,) for v in (-3, 4, 5, 9, 10, 14, 15, 99, None)], "s int")
    assert column(df, severity_band(F.col("s"), [5, 10, 15], ["Low", "Mild", "Moderate", "Severe"])) == [
        "Low", "Low", "Mild", "Mild", "Moderate", "Moderate", "Severe", "Severe", None,
    ]
    assert column(df, severity_band(F.col("s"), [5], ["No", "Yes"]))[:4] == ["No", "No", "Yes", "Yes"]


def test_score_defaults_to_the_highest_level(spark):
    df = spark.createDataFrame([(1, 4, 5), (2, 4, 6), (3, -818, 10), (4, None, 10), (5, 4, -818)], "eid int, p1 int, p2 int")
    spec = Score("s", fields=[1, 2], levels=[3, 10], labels=["a", "b", "c"])
    rows = {r.eid: (r.s_score, r.s) for r in evaluate(df, spec).collect()}
    assert rows == {1: (9, False), 2: (10, True), 3: (10, True), 4: (None, None), 5: (4, False)}
    assert evaluate(df, spec).columns == ["eid", "p1", "p2", "s_score", "s"]
    assert evaluate(df, spec, severity=True).columns == ["eid", "p1", "p2", "s_score", "s_severity", "s"]


def test_recoding_can_be_limited_and_switched_off(spark):
    df = spark.createDataFrame([(1, -818, -818)], "eid int, p1 int, p2 int")
    kept = Score("k", fields=[1, 2], levels=[1], keep_raw=[2])
    off = Score("o", fields=[1, 2], levels=[1], recode=None)
    row = evaluate(df, kept, off).collect()[0]
    assert (row.k_score, row.o_score, row.p1) == (-818, -1636, -818)


@pytest.mark.parametrize(
    "options",
    [
        {"levels": []},
        {"levels": [5, 3]},
        {"levels": [3, 5], "labels": ["a", "b"]},
        {"levels": [3], "fields": []},
    ],
)
def test_unsound_scores_are_refused(options):
    with pytest.raises(ValueError):
        Score("s", **{"fields": [1], **options})
