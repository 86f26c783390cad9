"""The catalogue as data: what it creates, and what its specs promise."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import oracle
from traitweave import CohortEngine
from traitweave.functions.naming import field_column
from traitweave.operators.levels import levels
from traitweave.operators.specs import CodeSet
from traitweave.phenotypes import CATALOGUE, STANDARD_RUN
from traitweave.plans.columns import plan_columns, source_fields
from checks.assessment import assessment_tables


def test_size():
    assert len(CATALOGUE) == 57
    assert len(source_fields(STANDARD_RUN)) == 73
    assert [len(level) for level in levels(STANDARD_RUN)][0] == 10
    assert levels(STANDARD_RUN)[2:] == [["depression"], oracle.CHILDREN["depression"]]


def test_children_are_those_of_the_sql():
    found = {s.name: [c.name for c in s.children] for s in CATALOGUE.values() if s.children}
    assert found == oracle.CHILDREN


def test_standard_run_columns(spark, sf_dir):
    df = CohortEngine(assessment_tables(spark, sf_dir)).query(*STANDARD_RUN, join_mode="stack")
    assert len(df.columns) == 116
    per_request = dict(self_harm=9, eating_disorder=9, depression=21, bipolar=12, anxiety=11, alcohol_abuse=11, substance_abuse_non_alcoholic=11, schizophrenia=9, ptsd=9, ocd=9)
    assert list(per_request) == [s.name for s in STANDARD_RUN]
    position = 1
    for name, n in per_request.items():
        assert df.columns[position + n - 1] == name
        position += n
    assert df.columns[-4:] == [f"level_{k}_derived_phenotypes" for k in range(4)]
    visit = df.columns.index("probable_depression_score_0")
    assert df.columns[visit : visit + 3] == ["probable_depression_score_0", "probable_depression_0", "probable_depression_score_1"]
    created = {p.strip() for k in oracle.COMPOSITES for p in oracle.COMPOSITES[k]} | set(oracle.STANDARD_RUN)
    created -= {"verbal_interview_insomnia", "touch_screen_insomnia", *(f"verbal_interview_insomnia_{i}" for i in range(4))}
    assert set(df.columns[1:-4]) == created


@pytest.fixture(scope="module")
def blank_types():
    types = {}
    for spec in CATALOGUE.values():
        for number in spec.fields:
            text = number in (41270, 41271)
            array = isinstance(spec, CodeSet) or number in (6156, 20548, 20554, 20002)
            element = T.StringType() if text else T.LongType()
            for visit in range(spec.visits) if spec.visits else [None]:
                types[field_column(number, visit)] = T.ArrayType(element) if array else element
    return types


def test_promises_hold_for_absent_participants(spark, blank_types):
    """Columns declared null for absent participants are null on a row of nulls; the others are as worked out."""
    planned = plan_columns(list(CATALOGUE.values()), blank_types, severity=True)
    row = spark.range(1).select(*[F.lit(None).cast(t).alias(c) for c, t in blank_types.items()])
    from traitweave.plans.columns import create

    blank = create(row, planned).collect()[0]
    worked_out = spark.range(1).select(*[p.absent().alias(p.name) for p in planned]).collect()[0]
    for p in planned:
        assert blank[p.name] == worked_out[p.name]
        if p.null_if_absent:
            assert blank[p.name] is None, p.name
    assert blank["probable_depression_score_0"] == 0
    assert blank["probable_depression"] is False
