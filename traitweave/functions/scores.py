"""Score expressions: missing codes, sums, thresholds and severity bands."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from traitweave.functions.naming import sql_name

# The answer code that means "missing", and what it counts as.
MISSING_CODE = -818
MISSING_VALUE = 0


def replace_missing_code(item: Column) -> Column:
    """The missing code counts as zero; null and everything else stay as they are."""
    return F.when(item == MISSING_CODE, MISSING_VALUE).otherwise(item)


def replaced_missing_code(name: str) -> str:
    """:func:`replace_missing_code` of a named column as SQL text."""
    return f"CASE WHEN {sql_name(name)} = {MISSING_CODE} THEN {MISSING_VALUE} ELSE {sql_name(name)} END"


def total(items: Sequence[Column]) -> Column:
    """Sum of the items, null as soon as one of them is null."""
    return reduce(add, items)


def any_true(flags: Sequence[Column]) -> Column:
    """Three-valued OR: true wins over null, null wins over false."""
    return reduce(or_, flags)


def at_least_level(index: int = -1) -> Callable[[Column, Sequence[int]], Column]:
    """Flag rule 'score reaches levels[index]'; by default the highest level."""

    def flag(score: Column, levels: Sequence[int]) -> Column:
        return score >= levels[index]

    return flag


def severity_band(score: Column, levels: Sequence[int], labels: Sequence[str]) -> Column:
    """Label of the half-open band a score falls in: below levels[0], [levels[0], levels[1]), ...

    A null score has no label.
    """
    band = F.when(score < levels[0], labels[0])
    for upper, label in zip(levels[1:], labels[1:-1]):
        band = band.when(score < upper, label)
    return band.when(score >= levels[-1], labels[-1])
