import pytest
from pyspark.sql import functions as F

from traitweave import AnyOf, CodeSet, CohortEngine, EqualsOne, FlagRule, Score, evaluate
from traitweave.operators.levels import levels
from traitweave.plans.columns import plan_columns, walk

A1 = EqualsOne("a1", fields=[1])
B2 = EqualsOne("b2", fields=[2])
EITHER = AnyOf("either", children=[A1, B2])


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "ta": spark.createDataFrame([(1, 1), (2, 0), (3, None)], "eid bigint, p1 int"),
        "tb": spark.createDataFrame([(2, 1), (3, 0), (4, 0), (5, 1)], "eid bigint, p2 int"),
        "tc": spark.createDataFrame([(1, 9, "x")], "eid bigint, p3 int, p3_hierarchy string"),
    }


def by_id(df, *columns):
    return {r.eid: tuple(r[c] for c in columns) for r in df.collect()}


@pytest.mark.parametrize("mode", ["outer", "stack"])
def test_three_valued_any_over_tables(tables, mode):
    df = CohortEngine(tables).query(EITHER, join_mode=mode)
    assert df.columns == ["eid", "a1", "b2", "either", "level_0_derived_phenotypes", "level_1_derived_phenotypes"]
    assert by_id(df, "a1", "b2", "either") == {
        1: (True, None, True),
        2: (False, True, True),
        3: (None, False, None),
        4: (None, False, None),
        5: (None, True, True),
    }
    assert by_id(df, "level_0_derived_phenotypes", "level_1_derived_phenotypes")[1] == (["either"], ["a1", None])
    assert by_id(df, "level_1_derived_phenotypes")[3] == ([None],)
    compact = CohortEngine(tables).query(EITHER, join_mode=mode, compact_levels=True)
    assert by_id(compact, "level_0_derived_phenotypes", "level_1_derived_phenotypes")[3] == ([], [])
    assert by_id(compact, "level_1_derived_phenotypes")[5] == (["b2"],)


@pytest.mark.parametrize("mode", ["outer", "stack"])
def test_a_rule_that_is_never_null_has_a_value_for_absent_participants(tables, mode):
    seen = FlagRule("seen", fields=[1], rule=lambda scope: scope.field(1).isNotNull(), helpers={"kind": lambda scope: F.when(scope.field(1) == 1, "one").otherwise("other")})
    number = Score("number", fields=[1], levels=[5], scorer=lambda scope: F.coalesce(scope.field(1), F.lit(7)))
    df = CohortEngine(tables).query(seen, number, B2, join_mode=mode)
    assert by_id(df, "kind", "seen", "number_score", "number", "b2") == {
        1: ("one", True, 1, False, None),
        2: ("other", True, 0, False, True),
        3: ("other", False, 7, True, False),
        4: ("other", False, 7, True, False),
        5: ("other", False, 7, True, True),
    }


def test_request_order_and_repetition_do_not_change_values(tables):
    engine = CohortEngine(tables)
    first = by_id(engine.query(EITHER, A1), "a1", "b2", "either")
    assert by_id(engine.query(A1, EITHER), "a1", "b2", "either") == first
    assert by_id(engine.query(EITHER, A1), "a1", "b2", "either") == first


def test_source_columns_can_be_kept(tables):
    engine = CohortEngine(tables)
    for mode in ("outer", "stack"):
        df = engine.query(EITHER, return_only_created_columns=False, join_mode=mode)
        assert df.columns[:6] == ["eid", "p1", "p2", "a1", "b2", "either"]
        assert by_id(df, "p1", "p2")[2] == (0, 1)


def test_get_table_reads_only_what_is_asked(tables):
    engine = CohortEngine(tables)
    assert engine.get_table(3).columns == ["eid", "p3"]
    assert engine.get_source_table(EITHER).columns == ["eid", "p1", "p2"]
    assert by_id(engine.get_table(1, 3), "p1", "p3") == {1: (1, 9), 2: (0, None), 3: (None, None)}


@pytest.fixture(scope="module")
def visits(spark):
    """Field 20 with its visits in two tables, one visit native and one element missing."""
    return {
        "early": spark.createDataFrame(
            [(1, 7, None, 8, 7), (2, None, None, None, None), (3, 5, 5, None, 6)],
            "eid bigint, p20_i0_a0 int, p20_i0_a1 int, p20_i1_a0 int, p20_i1_a1 int",
        ),
        "later": spark.createDataFrame([(1, 9), (4, 5)], "eid bigint, p20_i2_a0 int"),
    }


@pytest.mark.parametrize("mode", ["outer", "stack"])
def test_array_field_over_two_tables(visits, mode):
    df = CohortEngine(visits).get_table(20, join_mode=mode)
    assert by_id(df, "p20_i0", "p20_i1", "p20_i2", "p20") == {
        1: ([7], [8, 7], [9], [7, 8, 9]),
        2: ([], [], None, []),
        3: ([5], [6], None, [5, 6]),
        4: (None, None, [5], [5]),
    }
    spec = CodeSet("five", fields=[20], codes=[5])
    per_visit = CodeSet("five_told", fields=[20], codes=[5], visits=3)
    flags = CohortEngine(visits).query(spec, per_visit, join_mode=mode)
    assert by_id(flags, "five", "five_told_0", "five_told_1", "five_told_2", "five_told") == {
        1: (False, False, False, False, False),
        2: (False, False, False, None, None),
        3: (True, True, False, None, True),
        4: (True, None, None, True, True),
    }
    assert not [c for c in flags.columns if c.startswith("__")]


def test_array_field_in_one_table_merges_before_the_join(visits):
    early = {"early": visits["early"]}
    assert by_id(CohortEngine(early).get_table(20), "p20") == {1: ([7, 8],), 2: ([],), 3: ([5, 6],)}


def test_visits_of_other_kinds(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, None, 0), (3, 0, 0), (4, None, 1)], "eid int, p1_i0 int, p1_i1 int")
    equals = EqualsOne("e", fields=[1], visits=2)
    rule = FlagRule("r", fields=[1], visits=2, helpers={"h": lambda s: s.field(1) + 1}, rule=lambda s: s.column("h") == 2)
    both = evaluate(df, equals, rule)
    assert sorted(both.columns) == sorted("eid p1_i0 p1_i1 e_0 e_1 e h_0 r_0 h_1 r_1 r".split())
    expected = {1: (True, False, True), 2: (None, False, None), 3: (False, False, False), 4: (None, True, True)}
    assert by_id(both, "e_0", "e_1", "e") == expected
    assert by_id(both, "r_0", "r_1", "r") == expected


def test_normalized_codes(spark):
    df = spark.createDataFrame([(1, ["F42.0"]), (2, ["F420"]), (3, ["F42"]), (4, None)], "eid int, p1 array<string>")
    dotted, plain = CodeSet("dotted", fields=[1], codes=["F42.0"]), CodeSet("plain", fields=[1], codes=["F420"])
    exact = by_id(evaluate(df, dotted, plain), "dotted", "plain")
    assert exact == {1: (True, False), 2: (False, True), 3: (False, False), 4: (None, None)}
    loose = evaluate(df, dotted, plain, normalize_codes=True)
    assert by_id(loose, "dotted", "plain") == {1: (True, True), 2: (True, True), 3: (False, False), 4: (None, None)}
    assert loose.columns == ["eid", "p1", "dotted", "plain"]
    engine = CohortEngine({"t": df, "u": df.select("eid", F.lit(1).alias("p2"))})
    for mode in ("outer", "stack"):
        assert by_id(engine.query(dotted, B2, normalize_codes=True, join_mode=mode), "dotted")[2] == (True,)


def test_evaluate_takes_existing_columns_as_they_are(spark):
    df = spark.createDataFrame([(1, 0, True)], "eid int, p2 int, a1 boolean")
    assert by_id(evaluate(df, EITHER), "a1", "b2", "either") == {1: (True, False, True)}


def test_from_database(spark, tables):
    spark.sql("CREATE DATABASE IF NOT EXISTS study")
    tables["ta"].write.saveAsTable("study.ta", mode="overwrite")
    tables["tb"].write.saveAsTable("study.tb", mode="overwrite")
    spark.range(1).write.saveAsTable("study.other", mode="overwrite")
    whole = CohortEngine.from_database(spark, "study")
    assert sorted(whole.catalogue.columns) == ["ta", "tb"]
    listed = CohortEngine.from_database(spark, "study", {"ta": ["eid", "p1"], "tb": ["eid", "p2"], "gone": ["eid", "p99"]})
    for engine in (whole, listed):
        assert by_id(engine.query(EITHER), "either")[2] == (True,)


def test_levels_keep_repeats():
    top = AnyOf("top", children=[EITHER, A1])
    assert levels([top, A1]) == [["top", "a1"], ["either", "a1"], ["a1", "b2"]]


def test_errors(spark, tables):
    engine = CohortEngine(tables)
    with pytest.raises(ValueError, match="no phenotype"):
        engine.query()
    with pytest.raises(ValueError, match="no table holds field 77"):
        engine.query(EqualsOne("x", fields=[77]))
    with pytest.raises(ValueError, match="two different phenotypes are named a1"):
        engine.query(A1, EqualsOne("a1", fields=[2]))
    engine.query(A1, EqualsOne("a1", fields=[1]))
    with pytest.raises(ValueError, match="p1_i0"):
        evaluate(spark.createDataFrame([(1, 1)], "eid int, p1_i0 int"), A1)
    with pytest.raises(ValueError, match="list its phenotype as a child"):
        engine.query(FlagRule("r", fields=[1], rule=lambda scope: scope.column("b2")))
    with pytest.raises(ValueError, match="needs an array"):
        engine.query(CodeSet("c", fields=[1], codes=[1]))
    with pytest.raises(ValueError, match="comes from two tables"):
        CohortEngine({"x": tables["ta"], "y": tables["ta"]}).query(A1)
    with pytest.raises(ValueError, match="create a column named s"):
        engine.query(Score("n", fields=[1], levels=[1], score_name="s"), Score("m", fields=[1], levels=[1], score_name="s"))


@pytest.mark.parametrize(
    "make",
    [
        lambda: FlagRule("r", fields=[1]),
        lambda: CodeSet("c", fields=[1], codes=[]),
        lambda: CodeSet("c", fields=[1, 2], codes=[1]),
        lambda: EqualsOne("e", fields=[]),
        lambda: AnyOf("a"),
        lambda: AnyOf("a", children=["b"]),
        lambda: EqualsOne("", fields=[1]),
        lambda: EqualsOne("e", fields=[1], visits=0),
    ],
)
def test_unsound_specs_are_refused(make):
    with pytest.raises(ValueError):
        make()


def test_circles_are_found():
    first = AnyOf("first", fields=[1])
    second = AnyOf("second", children=[first])
    object.__setattr__(first, "children", (second,))
    with pytest.raises(ValueError, match="first -> second -> first"):
        walk([first])


def test_planned_reads_decide_the_table(spark):
    types = {"p1": spark.range(1).schema[0].dataType, "p2": spark.range(1).schema[0].dataType}
    planned = {p.name: p for p in plan_columns([EITHER], types)}
    assert planned["a1"].reads == ("p1",)
    assert planned["either"].reads == ("a1", "b2")
    assert list(planned) == ["a1", "b2", "either"]


def test_rules_over_visits_and_cells(spark):
    df = spark.createDataFrame([(1, 3, 5, 7, 8), (2, 4, 4, None, 7), (3, None, 1, 7, 9)], "eid int, p1_i0 int, p1_i1 int, p2_i0_a0 int, p2_i0_a1 int")
    rule = FlagRule(
        "rose",
        fields=[1, 2],
        visits=2,
        helpers={
            "change": lambda scope: scope.field(1) - scope.field(1, visit=0),
            "second_cell": lambda scope: scope.field(2, visit=0, element=1),
            "seven": lambda scope: scope.any_code(2, [7], visit=0),
        },
        rule=lambda scope: scope.column("change") > 0,
    )
    got = CohortEngine({"t": df}).query(rule)
    assert by_id(got, "change_0", "change_1", "second_cell_1", "seven_1", "rose") == {
        1: (0, 2, 8, True, True),
        2: (0, 0, 7, True, False),
        3: (None, None, 9, True, None),
    }
    with pytest.raises(ValueError, match="no column p1_i4 for field 1"):
        CohortEngine({"t": df}).query(FlagRule("f", fields=[1], rule=lambda scope: scope.field(1, visit=4) == 1))
    with pytest.raises(ValueError, match="exists on a visit only"):
        CohortEngine({"t": df}).query(FlagRule("f", fields=[2], rule=lambda scope: scope.field(2, element=0) == 1))


def test_recode_per_field(spark):
    df = spark.createDataFrame([(1, -818, 2), (2, 1, -818), (3, None, 0)], "eid int, p1 int, p2 int")
    calls = []

    def reverse(item):
        calls.append(1)
        return F.when(item == -818, 9).otherwise(4 - item)

    one = Score("one", fields=[1, 2], levels=[3], recode={1: reverse})
    two = Score("two", fields=[1], levels=[9], recode={1: reverse})
    got = CohortEngine({"t": df}).query(one, two)
    assert by_id(got, "one_score", "two_score", "two") == {1: (11, 9, True), 2: (-815, 3, False), 3: (None, None, None)}
    assert not [c for c in got.columns if c.startswith("__")]
    planned = plan_columns([one, two], {"p1": df.schema["p1"].dataType, "p2": df.schema["p2"].dataType})
    assert sum("recoded" in p.name for p in planned) == 1  # shared by both scores
    with pytest.raises(ValueError, match="recode names fields it does not read: 7"):
        Score("x", fields=[1], levels=[1], recode={7: reverse})


def test_a_recode_that_fills_nulls_reaches_absent_participants(tables):
    filled = Score("filled", fields=[1], levels=[1], recode={1: lambda item: F.coalesce(item, F.lit(2))})
    for mode in ("outer", "stack"):
        got = CohortEngine(tables).query(filled, B2, join_mode=mode)
        assert by_id(got, "filled_score") == {1: (1,), 2: (0,), 3: (2,), 4: (2,), 5: (2,)}


def test_a_broken_promise_is_an_error(tables):
    rule = lambda scope: F.coalesce(scope.field(1) == 1, F.lit(False))
    wrong = FlagRule("wrong", fields=[1], rule=rule, null_if_absent=True)
    with pytest.raises(ValueError, match="null_if_absent does not hold: wrong"):
        CohortEngine(tables).query(wrong, B2)
    kept = FlagRule("kept", fields=[1], rule=lambda scope: scope.field(1) == 1, null_if_absent=True)
    for _ in range(2):
        assert by_id(CohortEngine(tables).query(kept, B2), "kept")[5] == (None,)
    assert len(kept.kept_promises) == 1
