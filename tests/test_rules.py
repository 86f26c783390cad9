"""Clinical rules on whole grids of answers, against three-valued logic in plain Python."""

import itertools

from pyspark.sql import functions as F

from traitweave import evaluate
from traitweave.operators.specs import AnyOf
from traitweave.phenotypes import CATALOGUE


def and_(*xs):
    return False if False in xs else None if None in xs else True


def or_(*xs):
    return True if True in xs else None if None in xs else False


def not_(x):
    return None if x is None else not x


def is_(x, *values):
    return None if x is None else x in values


def at_least(x, k):
    return None if x is None else x >= k


def num(x):
    return None if x is None else int(x)


def plus(*xs):
    return None if None in xs else sum(xs)


def grid(spark, values):
    """A frame with every combination of the values, and the rows as dictionaries."""
    names = list(values)
    rows = list(itertools.product(*values.values()))
    types = ", ".join(f"{n} {'array<int>' if any(isinstance(v, list) for v in values[n]) else 'int'}" for n in names)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"eid int, {types}")
    return df, [dict(zip(names, r)) for r in rows]


def evaluated(df, spec, *columns):
    found = evaluate(df, spec).select("eid", *columns).collect()
    return [tuple(r)[1:] for r in sorted(found)]


def test_probable_depression(spark):
    yes = [1, 0, None]
    values = {4598: yes, 4609: [1, None], 4620: [1, 2, None], 4631: yes, 2090: yes, 2100: yes, 5375: [1, 2, 3, None], 5386: [1, 2, None]}
    named = {f"p{f}_i{i}": (v if i == 0 else [None]) for i in range(4) for f, v in values.items()}
    df, rows = grid(spark, named)

    def score(r):
        p = {f: r[f"p{f}_i0"] for f in values}
        down = and_(is_(p[4598], 1), is_(p[4609], 1))
        one = or_(
            and_(down, is_(p[4620], 1), or_(is_(p[2090], 1), is_(p[2100], 1))),
            and_(is_(p[4631], 1), is_(p[5386], 1), at_least(p[5375], 2)),
        )
        long = or_(and_(down, at_least(p[4620], 2)), and_(is_(p[4631], 1), at_least(p[5386], 2), at_least(p[5375], 3)))
        if one:
            return 1
        if and_(long, is_(p[2090], 1), not_(is_(p[2100], 1))):
            return 2
        return 3 if and_(long, is_(p[2100], 1)) else 0

    got = evaluated(df, CATALOGUE["probable_depression"], "probable_depression_score_0", "probable_depression_0", "probable_depression_1", "probable_depression")
    expected = [(s, s >= 1, False, s >= 1) for s in map(score, rows)]
    assert got == expected
    assert {s for s, *_ in expected} == {0, 1, 2, 3}


def test_lifetime_depression(spark):
    values = {20446: [1, 0, None], 20441: [1, 0, None], 20436: [2, 3, 4, None], 20439: [1, 2], 20440: [3, None], 20449: [1, 0], 20536: [0, 3, None], 20532: [1, 0], 20435: [1], 20450: [1, 0, None], 20437: [0, 1]}
    df, rows = grid(spark, {f"p{f}": v for f, v in values.items()})

    def flag(r):
        p = {f: r[f"p{f}"] for f in values}
        symptoms = plus(
            *[num(is_(p[f], 1)) for f in (20446, 20441, 20449, 20532, 20435, 20450, 20437)], num(is_(p[20536], 1, 2, 3))
        )
        return and_(
            or_(is_(p[20446], 1), is_(p[20441], 1)), is_(p[20436], 3, 4), is_(p[20439], 2, 3), is_(p[20440], 2, 3), at_least(symptoms, 5)
        )

    got = [x for (x,) in evaluated(df, CATALOGUE["lifetime_depression"], "lifetime_depression")]
    assert got == [flag(r) for r in rows]
    assert {True, False, None} == set(got)


def test_probable_bipolar(spark):
    values = {4642: [1, 0, -818, None], 4653: [1, 0, None], 6156: [None, [], [1, 2], [1, 2, 3]], 5663: [13, 12, None], 5674: [12, 11, -818, None]}
    df, rows = grid(spark, {f"p{f}_i{i}": (v if i == 2 else [[1]] if f == 6156 else [None]) for i in range(4) for f, v in values.items()})

    def score(r):
        p = {f: r[f"p{f}_i2"] for f in values}
        enough = None if p[6156] is None else len(p[6156]) >= 3
        two = and_(or_(is_(p[4642], 1), is_(p[4653], 1)), enough, is_(p[5663], 13)) is True
        return plus(int(two), num(is_(p[5674], 12)))

    got = evaluated(df, CATALOGUE["probable_bipolar"], "probable_bipolar_score_2", "probable_bipolar_2", "probable_bipolar")
    # the other visits are unanswered, so their flags are null and the union is true or null
    assert got == [(s, at_least(s, 1), True if at_least(s, 1) else None) for s in map(score, rows)]


def test_life_time_bipolar(spark):
    values = {"depression": [1, 0, None], "p20501": [1, 0, -818, None], "p20502": [1, None], "p20548": [None, [1, 2, 3], [1, 2, 3, 4]], "p20492": [3, 2, None], "p20493": [12, 11, -818, None]}
    df, rows = grid(spark, values)
    df = df.withColumn("depression", F.col("depression") == 1)

    def score(r):
        enough = None if r["p20548"] is None else len(r["p20548"]) >= 4
        two = and_(is_(r["depression"], 1), or_(is_(r["p20501"], 1), is_(r["p20502"], 1)), enough, is_(r["p20492"], 3))
        return plus(int(two is True), num(is_(r["p20493"], 12)))

    got = evaluated(df, CATALOGUE["life_time_bipolar"], "life_time_bipolar_score", "life_time_bipolar")
    assert got == [(s, at_least(s, 1)) for s in map(score, rows)]


def test_substance_use(spark):
    values = {"p20453": [0, 1, 2, 3, 4, 5, None], "p20454": [1, 2, 3, 4, 5, None], "p20002": [None, [], [784], [785], [53, 1]], "p20456": [1, 0, None], "p20503": [1, 0, None]}
    df, rows = grid(spark, values)

    def group(r):
        use, often = r["p20453"], r["p20454"]
        if use == 4:
            return {1: 3, 2: 4, 3: 5, 4: 6}.get(often)
        return {0: 0, 1: 1, 2: 1, 3: 2}.get(use)

    def flag(r):
        told = None if r["p20002"] is None else bool({785, 48, 53} & set(r["p20002"]))
        return or_(told, is_(r["p20456"], 1), is_(r["p20503"], 1), is_(group(r), 6))

    spec = CATALOGUE["questionnaire_substance_abuse_non_alcoholic"]
    got = evaluated(df, spec, "cannabis_use_group", spec.name)
    assert got == [(group(r), flag(r)) for r in rows]
    assert not [c for c in evaluate(df, spec).columns if c.startswith("__")]


def test_self_harm(spark):
    values = {"p20480": [1, 0, None], "p20479": [1, 0, None], "p20483": [1, 0, None], "p20554": [None, [], [2], [6], [2, None]]}
    df, rows = grid(spark, values)

    def flag(r):
        acts = r["p20554"]
        named = None if acts is None else True if {1, 3, 4, 5, 6} & set(acts) else None if None in acts else False
        return or_(is_(r["p20480"], 1), is_(r["p20479"], 1), named, is_(r["p20483"], 1))

    assert evaluated(df, CATALOGUE["questionnaire_self_harm"], "questionnaire_self_harm") == [(flag(r),) for r in rows]


def test_audit(spark):
    ones = {f"p{f}": [2] for f in (20403, 20416, 20413, 20407, 20412, 20409)}
    values = {"p20414": [0, 4, -818, None], "p20408": [5, None], "p20411": [0, 1, 2, -818, None], "p20405": [0, 1, 2, None]} | ones
    df, rows = grid(spark, values)

    def score(r):
        def item(f):
            return None if r[f] is None else 0 if r[f] == -818 else r[f]

        counted = [None if item(f) is None else item(f) - 1 for f in ["p20414", "p20408", *ones]]
        return plus(*counted, *[{2: 4, 1: 2}.get(item(f), 0) for f in ("p20411", "p20405")])

    got = evaluated(df, CATALOGUE["audit_score"], "audit_score_score", "audit_score")
    assert got == [(s, at_least(s, 15)) for s in map(score, rows)]


def test_touch_screen_insomnia_and_any(spark):
    df = spark.createDataFrame([(0, 1, True), (1, 2, False), (2, None, None), (3, 1, None), (4, None, True)], "eid int, p1200 int, p7 boolean")
    spec = AnyOf("either", fields=[7], children=[CATALOGUE["touch_screen_insomnia"]])
    assert evaluated(df, spec, "touch_screen_insomnia", "either") == [
        (False, True), (True, True), (None, None), (False, None), (None, True),
    ]
