"""Clinical rules that are more than a code list or a sum.

The field numbers, answer codes and cut-offs are fixed values of the
questionnaires; each rule lists the fields it reads next to it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from traitweave.functions.arrays import has_at_least
from traitweave.functions.scores import total
from traitweave.operators.scope import Scope


def _yes(scope: Scope, field: int) -> Column:
    return scope.field(field) == 1


def _as_number(flag: Column) -> Column:
    return flag.cast("int")


def _met(condition: Column) -> Column:
    """The condition as a two-valued flag: unknown counts as not met."""
    return F.coalesce(condition, F.lit(False))


PROBABLE_DEPRESSION_FIELDS = [4598, 4609, 4620, 2090, 2100, 4631, 5375, 5386]


def probable_depression_score(scope: Scope) -> Column:
    """0 none, 1 single episode, 2 recurrent moderate, 3 recurrent severe; never null.

    Low mood: a week of it (4598) lasting two weeks (4609) in 4620 episodes.
    Loss of interest: a week of it (4631) lasting 5375 weeks in 5386 episodes.
    Help was sought from a GP (2090) or a psychiatrist (2100).
    """
    low_mood = _yes(scope, 4598) & _yes(scope, 4609)
    mood_episodes = scope.field(4620)
    no_interest = _yes(scope, 4631)
    weeks, interest_episodes = scope.field(5375), scope.field(5386)
    gp, psychiatrist = _yes(scope, 2090), _yes(scope, 2100)

    single = (low_mood & (mood_episodes == 1) & (gp | psychiatrist)) | (
        no_interest & (interest_episodes == 1) & (weeks >= 2)
    )
    recurrent = (low_mood & (mood_episodes >= 2)) | (no_interest & (interest_episodes >= 2) & (weeks > 2))
    return F.when(single, 1).when(recurrent & gp & ~psychiatrist, 2).when(recurrent & psychiatrist, 3).otherwise(0)


LIFETIME_DEPRESSION_FIELDS = [20446, 20441, 20436, 20439, 20440, 20449, 20536, 20532, 20435, 20450, 20437]


def lifetime_depression(scope: Scope) -> Column:
    """A core symptom that took much of most days and impaired life, with five symptoms in all.

    The symptom count is null as soon as one of the eight answers is.
    """
    sadness, lost_interest = _yes(scope, 20446), _yes(scope, 20441)
    symptoms = [
        sadness,
        lost_interest,
        _yes(scope, 20449),
        scope.field(20536).isin(1, 2, 3),
        _yes(scope, 20532),
        _yes(scope, 20435),
        _yes(scope, 20450),
        _yes(scope, 20437),
    ]
    return (
        (sadness | lost_interest)
        & scope.field(20436).isin(3, 4)
        & scope.field(20439).isin(2, 3)
        & scope.field(20440).isin(2, 3)
        & (total([_as_number(s) for s in symptoms]) >= 5)
    )


PROBABLE_BIPOLAR_FIELDS = [4642, 4653, 6156, 5663, 5674]


def probable_bipolar_score(scope: Scope) -> Column:
    """1 for type II, one more if the episode also caused problems (5674); null if 5674 is."""
    type_two = (
        (_yes(scope, 4642) | _yes(scope, 4653)) & has_at_least(scope.field(6156), 3) & (scope.field(5663) == 13)
    )
    return _as_number(_met(type_two)) + _as_number(scope.field(5674) == 12)


LIFE_TIME_BIPOLAR_FIELDS = [20501, 20502, 20548, 20492, 20493]


def mania_answered(scope: Scope) -> Column:
    """Mania or irritability, for a while of the longest kind."""
    return (_yes(scope, 20501) | _yes(scope, 20502)) & (scope.field(20492) == 3)


def several_mania_symptoms(scope: Scope) -> Column:
    return has_at_least(scope.field(20548), 4)


def mania_caused_problems(scope: Scope) -> Column:
    return scope.field(20493) == 12


def life_time_bipolar_score(scope: Scope) -> Column:
    """Like the score above from the online answers, for participants with the depression flag."""
    type_two = scope.column("depression") & scope.column("mania") & scope.column("symptoms")
    return _as_number(_met(type_two)) + _as_number(scope.column("problems"))


SUBSTANCE_FIELDS = [20453, 20454, 20002, 20456, 20503]
# Interview codes of substance dependency.
DEPENDENCY_CODES = [785, 48, 53]


def cannabis_use_group(scope: Scope) -> Column:
    """0 never, 1 once or a few times, 2 more, 3 to 6 most, by frequency (20454); else null."""
    use, frequency = scope.field(20453), scope.field(20454)
    return (
        F.when(use == 0, 0)
        .when(use.isin(1, 2), 1)
        .when(use == 3, 2)
        .when((use == 4) & (frequency == 1), 3)
        .when((use == 4) & (frequency == 2), 4)
        .when((use == 4) & (frequency == 3), 5)
        .when((use == 4) & (frequency == 4), 6)
    )


def substance_dependency_told(scope: Scope) -> Column:
    return scope.any_code(20002, DEPENDENCY_CODES)


def substance_addiction_answered(scope: Scope) -> Column:
    return _yes(scope, 20456) | _yes(scope, 20503)


def substance_use(scope: Scope) -> Column:
    return (
        scope.column("dependency_told")
        | scope.column("addiction_answered")
        | (scope.column("cannabis_use_group") == 6)
    )


SELF_HARM_FIELDS = [20480, 20483, 20479, 20554]
# Answers that name an act of self-harm.
SELF_HARM_ACTS = [1, 3, 4, 5, 6]


def self_harm_answered(scope: Scope) -> Column:
    return _yes(scope, 20480) | _yes(scope, 20479) | _yes(scope, 20483)


def self_harm_acts_named(scope: Scope) -> Column:
    return scope.any_code(20554, SELF_HARM_ACTS)


def questionnaire_self_harm(scope: Scope) -> Column:
    return scope.column("answered") | scope.column("acts_named")


AUDIT_FIELDS = [20414, 20403, 20416, 20413, 20407, 20412, 20409, 20408, 20411, 20405]
# The two items answered no / not in the last year / in the last year.
AUDIT_THREE_WAY_FIELDS = [20411, 20405]


def audit_score(scope: Scope) -> Column:
    """Items count from one, the three-way items 0, 2 or 4 points (0 if unanswered)."""

    def points(field: int) -> Column:
        item = scope.field(field)
        if field in AUDIT_THREE_WAY_FIELDS:
            return F.when(item == 2, 4).when(item == 1, 2).otherwise(0)
        return item - 1

    return total([points(f) for f in AUDIT_FIELDS])


INSOMNIA_FIELD = 1200


def touch_screen_insomnia(scope: Scope) -> Column:
    return scope.field(INSOMNIA_FIELD) >= 2
