"""Turn specs into the list of columns to create, and create them in layers."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitweave.functions.arrays import undotted
from traitweave.operators.scope import AbsentScope, Recode, RowScope
from traitweave.operators.specs import Phenotype, Step


@dataclass(frozen=True)
class Planned:
    """One column to create: its expression, what it reads, its value without any input."""

    name: str
    column: Column
    reads: Sequence[str]
    visible: bool
    null_if_absent: bool
    absent: Callable[[], Column] = field(repr=False, compare=False)
    promise: tuple[Phenotype, tuple] | None = None


def source_fields(specs: Iterable[Phenotype]) -> set[int]:
    """Field numbers the specs and everything below them read."""
    fields: set[int] = set()
    for spec in walk(specs):
        fields.update(spec.fields)
    return fields


def walk(specs: Iterable[Phenotype], skip: Collection[str] = ()) -> list[Phenotype]:
    """Every spec once, children before parents; names in ``skip`` are left out with all below them."""
    seen: dict[str, Phenotype] = {}
    path: list[str] = []

    def visit(spec: Phenotype) -> None:
        if spec.name in skip:
            return
        if spec.name in path:
            raise ValueError("phenotypes build on each other in a circle: " + " -> ".join([*path, spec.name]))
        if spec.name in seen:
            if seen[spec.name] is not spec and seen[spec.name] != spec:
                raise ValueError(f"two different phenotypes are named {spec.name}")
            return
        path.append(spec.name)
        for child in spec.children:
            visit(child)
        path.pop()
        seen[spec.name] = spec

    for spec in specs:
        visit(spec)
    return list(seen.values())


def plan_columns(
    specs: Sequence[Phenotype],
    types: Mapping[str, T.DataType],
    *,
    skip: Collection[str] = (),
    severity: bool = False,
    normalize_codes: bool = False,
) -> list[Planned]:
    """The columns the specs create on a row with the given source columns, in creation order."""
    planned: dict[str, Planned] = {}
    named = cache(F.col)

    def absent(name: str) -> Column:
        return planned[name].absent()

    def plain_codes(source: str) -> str:
        name = f"__{source}_undotted"
        if name not in planned:
            planned[name] = Planned(
                name,
                undotted(F.col(source)),
                (source,),
                visible=False,
                null_if_absent=True,
                absent=lambda: F.lit(None).cast(types[source]),
            )
        return name

    recoded: dict[tuple[str, Recode], str] = {}

    def recode_once(source: str, recode: Recode) -> str:
        """The column of an item as one recode leaves it, whoever asks for it."""
        if (source, recode) not in recoded:
            name = recoded[source, recode] = f"__{source}_recoded_{len(recoded)}"
            planned[name] = Planned(
                name,
                recode(F.col(source)),
                (source,),
                visible=False,
                null_if_absent=False,
                absent=cache(lambda: recode(F.lit(None).cast(types[source]))),
            )
        return recoded[source, recode]

    def add(step: Step, spec: Phenotype) -> None:
        if step.name in planned:
            raise ValueError(f"two phenotypes create a column named {step.name}")
        shared = recode_once if step.recode_once else None
        scope = RowScope(types, step, planned, named, plain_codes if normalize_codes else None, shared)
        column = step.build(scope)
        planned[step.name] = Planned(
            step.name,
            column,
            tuple(scope.reads),
            step.visible,
            step.null_if_absent and all(planned[r].null_if_absent for r in scope.reads if r in planned),
            absent=cache(lambda: step.build(AbsentScope(types, step, absent))),
            promise=(spec, (step.name, tuple((r, str(types[r])) for r in scope.reads if r in types))) if step.promised else None,
        )

    for spec in walk(specs, skip):
        for step in spec.steps(severity=severity):
            add(step, spec)
    return list(planned.values())


def check_promises(planned: Iterable[Planned], spark: SparkSession) -> None:
    """Work out, on a row of nulls, every column that is promised to be null there; a broken promise is an error.

    The row is a local one, so that no job runs. A spec that has kept its promises on columns of the same types is
    not asked again.
    """
    promised = [p for p in planned if p.promise and p.promise[1] not in p.promise[0].kept_promises]
    if not promised:
        return
    nothing = spark.sql("SELECT * FROM VALUES (1) AS t(one)")
    (row,) = nothing.select(*[p.absent().isNotNull().alias(p.name) for p in promised]).collect()
    broken = [p.name for p in promised if row[p.name]]
    if broken:
        raise ValueError(f"null_if_absent does not hold: {', '.join(broken)} has a value where all answers are null")
    for p in promised:
        p.promise[0].kept_promises.add(p.promise[1])


def layers(planned: Iterable[Planned]) -> list[list[Planned]]:
    """Group columns so that each group only reads sources and earlier groups."""
    depth: dict[str, int] = {}
    groups: list[list[Planned]] = []
    for p in planned:
        depth[p.name] = 1 + max((depth.get(r, -1) for r in p.reads), default=-1)
        if depth[p.name] == len(groups):
            groups.append([])
        groups[depth[p.name]].append(p)
    return groups


def create(df: DataFrame, planned: Iterable[Planned]) -> DataFrame:
    """Add the columns, one projection per layer."""
    for layer in layers(planned):
        df = df.withColumns({p.name: p.column for p in layer})
    return df
