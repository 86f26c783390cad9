"""Which labels are true at each level of the phenotype tree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from traitweave.functions.naming import sql_literal, sql_name
from traitweave.operators.specs import Phenotype


def levels(specs: Sequence[Phenotype]) -> list[list[str]]:
    """Names per level: the requested phenotypes, their children, and so on, repeats kept."""
    found = []
    current = list(specs)
    while current:
        found.append([spec.name for spec in current])
        current = [child for spec in current for child in spec.children]
    return found


def level_labels(names: Sequence[str], compact: bool = False) -> Column:
    """Array of the names whose flag is true, in order.

    Names that are not true (false or null) leave one null at the place of the
    first of them, unless ``compact`` is set.
    """
    true_names = ", ".join(f"CASE WHEN {sql_name(name)} THEN {sql_literal(name)} END" for name in names)
    labels = F.expr(f"array_distinct(array({true_names}))")
    return F.array_compact(labels) if compact else labels


def level_column(level: int) -> str:
    return f"level_{level}_derived_phenotypes"
