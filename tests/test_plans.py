"""What the physical plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

from traitweave import CohortEngine
from traitweave.operators.joins import stack_join
from traitweave.phenotypes import CATALOGUE, STANDARD_RUN
from traitweave.session import tune
from traitweave.sources.writers import write_bucketed
from checks.assessment import assessment_tables


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The participant tables as parquet files, with a column no phenotype reads."""
    tune(spark)
    home = tmp_path_factory.mktemp("cohort")
    tables = {}
    for name, df in assessment_tables(spark, sf_dir).items():
        df.withColumn("p99999", F.lit(1)).write.parquet(str(home / name))
        tables[name] = spark.read.parquet(str(home / name))
    return CohortEngine({n: t.drop("p99999") if n != "asm_touch" else t for n, t in tables.items()})


def plan_of(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in ("adaptive.enabled", "maxMetadataStringLength", "debug.maxToStringFields"):
            spark.conf.unset(f"spark.sql.{name}")


def test_stacking_shuffles_once(stored):
    plan = plan_of(stored.query(*STANDARD_RUN, join_mode="stack"))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "Join" not in plan
    # flags and scores are computed at the scans: no array travels
    exchanged = plan[plan.index("Exchange hashpartitioning") :]
    assert "arrays_overlap" in exchanged
    assert "arrays_overlap" not in plan[: plan.index("Exchange hashpartitioning")]


def test_scans_read_only_the_fields_needed(stored):
    plan = plan_of(stored.query(CATALOGUE["ptsd"], join_mode="stack"))
    schemas = re.findall(r"ReadSchema: struct<([^>]*(?:<[^>]*>)?[^>]*)>", plan)
    assert len(schemas) == 3
    online = next(s for s in schemas if "p20497" in s)
    assert sorted(re.findall(r"p\d+", online)) == ["p20494", "p20495", "p20496", "p20497", "p20498", "p20508"]
    assert "p41271" not in plan
    assert "p99999" not in plan


def test_one_table_needs_no_shuffle(stored):
    plan = plan_of(stored.query(CATALOGUE["probable_depression"]))
    assert "Exchange" not in plan
    assert "p99999" not in plan


def test_outer_join_broadcasts_only_the_marks(stored):
    """The marks are hashes of a fixed number of values; ids and rows are never broadcast."""
    spark = stored.get_table(1200).sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(stored.query(CATALOGUE["ptsd"]))
        simple = plan_of(stored.query(CATALOGUE["ptsd"], hot_rows=None))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    sent = [lines[i + 1] for i, line in enumerate(lines) if "BroadcastExchange" in line]
    assert len(sent) == 1 and "__axes" in sent[0]
    assert "functions=[max_by(" in plan  # one id for each mark
    assert "BroadcastExchange" not in simple
    assert "Join" not in simple


def scans(plan):
    return len(re.findall(r"FileScan parquet", plan))


@pytest.mark.parametrize("specs", [[CATALOGUE["ptsd"]], STANDARD_RUN])
def test_outer_join_reads_each_table_three_times_at_most(stored, specs):
    """For the rows, for the ids alone, and for the rows without an id."""
    stacked = scans(plan_of(stored.query(*specs, join_mode="stack")))
    outer = plan_of(stored.query(*specs))
    assert scans(outer) <= 3 * stacked
    ids_only = re.findall(r"ReadSchema: struct<eid:bigint>", outer)
    assert len(ids_only) == stacked
    simple = plan_of(stored.query(*specs, hot_rows=None))
    assert scans(simple) <= 2 * stacked
    assert len(re.findall("Exchange hashpartitioning", simple)) == 1


def test_stack_join_refuses_missing_ids_before_the_shuffle(spark):
    tables = [spark.createDataFrame([(1, k)], f"eid long, c{k} int") for k in range(2)]
    plan = plan_of(stack_join(tables))
    below = plan[plan.index("Exchange hashpartitioning(eid") :]
    assert "present and unique" in below


def test_no_python_in_any_plan(stored):
    for mode in ("outer", "stack"):
        plan = plan_of(stored.query(*STANDARD_RUN, CATALOGUE["insomnia"], CATALOGUE["neuroticism"], join_mode=mode))
        assert "Python" not in plan
        assert "Arrow" not in plan
        assert "CartesianProduct" not in plan


def test_ids_are_sorted_out_below_every_exchange(stored):
    """Of a join for some ids, only rows that passed the semi-join on the marks are exchanged."""
    spark = stored.get_table(1200).sparkSession
    some = spark.range(100).select(F.col("id").alias("eid"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for mode in ("stack", "outer"):
            plan = plan_of(stored.query(CATALOGUE["ptsd"], join_mode=mode, hot_rows=None, only=some)).splitlines()
            depth = [len(re.match(r"[^A-Z(*]*", line).group()) for line in plan]
            for i, line in enumerate(plan):
                if "FileScan parquet" not in line:
                    continue
                above, at = [], depth[i]
                for k in range(i - 1, -1, -1):
                    if depth[k] < at:
                        above.append(plan[k])
                        at = depth[k]
                exchange = next(k for k, x in enumerate(above) if "Exchange hashpartitioning" in x)
                assert any("LeftSemi" in x and "__mark" in x for x in above[:exchange])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_join_without_exchange(spark, sf_dir):
    tables = {}
    for name, df in assessment_tables(spark, sf_dir).items():
        write_bucketed(df, f"plan_{name}", buckets=6, mode="overwrite")
        tables[name] = spark.table(f"plan_{name}")
    try:
        bucketed = CohortEngine(tables, colocated=True)
        for options in ({"join_mode": "stack"}, {"hot_rows": None}):
            assert "Exchange" not in plan_of(bucketed.query(*STANDARD_RUN, **options))
        # the look for frequent ids exchanges what it found, never rows
        looked = plan_of(bucketed.query(CATALOGUE["ptsd"]))
        assert not re.findall(r"Exchange hashpartitioning\(eid", looked)
        got = bucketed.query(CATALOGUE["ptsd"]).collect()
        expected = CohortEngine(assessment_tables(spark, sf_dir)).query(CATALOGUE["ptsd"], join_mode="stack").collect()
        assert sorted(got, key=str) == sorted(expected, key=str)
    finally:
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS plan_{name}")
