"""Phenotypes of large participant cohorts as plain Spark DataFrames."""

from traitweave.operators.specs import AnyOf, CodeSet, EqualsOne, FlagRule, Phenotype, Score
from traitweave.plans.engine import CohortEngine, evaluate

__all__ = ["AnyOf", "CodeSet", "CohortEngine", "EqualsOne", "FlagRule", "Phenotype", "Score", "evaluate"]
