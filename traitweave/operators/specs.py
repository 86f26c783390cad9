"""Phenotype specs: frozen descriptions of derived columns.

A spec names the fields it reads, the phenotypes it builds on and the steps
that create its columns. Specs hold no state and never see a DataFrame, so the
same object can be used in any number of queries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import Column

from traitweave.functions import scores
from traitweave.operators.scope import Recode, Scope

Rule = Callable[[Scope], Column]

_NOTHING: Mapping = MappingProxyType({})


@dataclass(frozen=True)
class Step:
    """One column to create.

    ``null_if_absent`` says that the value is null whenever all inputs are null;
    where it is unset, the value for participants without any input is worked
    out by evaluating the expression on nulls. ``promised`` says that it was set
    by the author of a rule; it is then checked when the query is planned.
    """

    name: str
    build: Rule
    visit: int | None = None
    visible: bool = True
    null_if_absent: bool = False
    promised: bool = False
    recodes: Mapping[int, Recode] = field(default_factory=lambda: _NOTHING)
    recode_once: bool = False
    local_names: Mapping[str, str] = field(default_factory=lambda: _NOTHING)


def on_visit(name: str, visit: int | None) -> str:
    return name if visit is None else f"{name}_{visit}"


@dataclass(frozen=True, kw_only=True)
class Phenotype:
    """Base of all specs.

    With ``visits=n`` the spec is evaluated once per visit as ``<name>_0`` to
    ``<name>_<n-1>`` and ``<name>`` is true if it was true on any of them.

    ``parts`` are intermediate results that are not output; rules and scorers
    read them back with ``scope.column``. A rule over several tables is cheaper
    in parts, one per table: then only the parts travel through the join, not
    the answers. ``null_if_absent`` is a promise that everything the spec
    computes is null for a participant all of whose answers are null, which
    spares a marker for the table in the join; it is checked on a row of nulls, and a
    wrong one fails the query. The kinds below that need no promise ignore it.
    """

    name: str = field(kw_only=False)
    fields: Sequence[int] = ()
    children: Sequence[Phenotype] = ()
    visits: int | None = None
    parts: Mapping[str, Rule] = field(default_factory=lambda: _NOTHING)
    null_if_absent: bool = False

    def __post_init__(self):
        #: Promises that were found to hold when a query was planned.
        object.__setattr__(self, "kept_promises", set())
        object.__setattr__(self, "fields", tuple(self.fields))
        object.__setattr__(self, "children", tuple(self.children))
        if not isinstance(self.name, str) or not self.name:
            raise ValueError("a phenotype needs a name")
        if self.visits is not None and self.visits < 1:
            raise ValueError(f"{self.name}: visits must be at least 1")
        for child in self.children:
            if not isinstance(child, Phenotype):
                raise ValueError(f"{self.name}: child {child!r} is not a phenotype")
        self._validate()

    def _validate(self) -> None:
        pass

    def steps(self, severity: bool = False) -> Iterator[Step]:
        """The columns of this spec in the order they are created, children excluded."""
        if self.visits is None:
            yield from self._visit_steps(None, severity)
            return
        for visit in range(self.visits):
            yield from self._visit_steps(visit, severity)
        names = [on_visit(self.name, visit) for visit in range(self.visits)]
        yield Step(self.name, lambda scope: scores.any_true([scope.column(n) for n in names]), null_if_absent=True)

    def _visit_steps(self, visit: int | None, severity: bool) -> Iterator[Step]:
        raise NotImplementedError

    def _part_names(self, visit: int | None) -> dict[str, str]:
        return {part: f"__{on_visit(self.name, visit)}_{part}" for part in self.parts}

    def _part_steps(
        self, visit: int | None, recodes: Mapping[int, Recode] = _NOTHING, recode_once: bool = False
    ) -> Iterator[Step]:
        for part, name in self._part_names(visit).items():
            yield Step(
                name,
                self.parts[part],
                visit,
                visible=False,
                null_if_absent=self.null_if_absent,
                promised=self.null_if_absent,
                recodes=recodes,
                recode_once=recode_once,
            )


@dataclass(frozen=True, kw_only=True)
class EqualsOne(Phenotype):
    """A yes/no field: true where the answer is 1."""

    def _validate(self) -> None:
        if len(self.fields) != 1:
            raise ValueError(f"{self.name}: exactly one field is needed")

    def _visit_steps(self, visit, severity):
        yield Step(
            on_visit(self.name, visit), lambda scope: scope.field(self.fields[0]) == 1, visit, null_if_absent=True
        )


@dataclass(frozen=True, kw_only=True)
class CodeSet(Phenotype):
    """True where one array field holds any code of a list."""

    codes: Sequence[int | str] = ()

    def _validate(self) -> None:
        object.__setattr__(self, "codes", tuple(self.codes))
        if len(self.fields) != 1:
            raise ValueError(f"{self.name}: exactly one field is needed")
        if not self.codes:
            raise ValueError(f"{self.name}: the code list is empty")

    def _visit_steps(self, visit, severity):
        yield Step(
            on_visit(self.name, visit),
            lambda scope: scope.any_code(self.fields[0], self.codes),
            visit,
            null_if_absent=True,
        )


@dataclass(frozen=True, kw_only=True)
class AnyOf(Phenotype):
    """Three-valued OR over boolean fields and the flags of the children."""

    def _validate(self) -> None:
        if not self.fields and not self.children:
            raise ValueError(f"{self.name}: neither fields nor children to combine")

    def _visit_steps(self, visit, severity):
        def flag(scope: Scope) -> Column:
            fields = [scope.field(f) for f in self.fields]
            return scores.any_true(fields + [scope.column(c.name) for c in self.children])

        yield Step(on_visit(self.name, visit), flag, visit, null_if_absent=True)


@dataclass(frozen=True, kw_only=True)
class FlagRule(Phenotype):
    """A flag given by a function of the scope.

    ``helpers`` become output columns of their own, created before the flag; the
    rule reads them with ``scope.column``. On repeated visits they carry the
    visit number like the flag itself.
    """

    rule: Rule | None = None
    helpers: Mapping[str, Rule] = field(default_factory=lambda: _NOTHING)

    def _validate(self) -> None:
        if not callable(self.rule):
            raise ValueError(f"{self.name}: a rule is needed, a function of the scope that returns a Column")

    def _visit_steps(self, visit, severity):
        helpers = {name: on_visit(name, visit) for name in self.helpers}
        for name, build in self.helpers.items():
            yield Step(
                helpers[name], build, visit, null_if_absent=self.null_if_absent, promised=self.null_if_absent
            )
        yield from self._part_steps(visit)
        yield Step(
            on_visit(self.name, visit),
            self.rule,
            visit,
            null_if_absent=self.null_if_absent,
            promised=self.null_if_absent,
            local_names={**helpers, **self._part_names(visit)},
        )


def sum_of_fields(spec: Score, scope: Scope) -> Column:
    return scores.total([scope.field(f) for f in spec.fields])


@dataclass(frozen=True, kw_only=True)
class Score(Phenotype):
    """A numeric score, a flag on it and, on request, the severity band.

    Items pass through ``recode`` first (the missing code counts as zero), but
    for those in ``keep_raw``; ``recode=None`` leaves all of them alone. A mapping
    from field to recode treats items differently and leaves those it does not
    name alone; an item that several specs recode alike is worked out once. The
    score is the sum of the items unless a ``scorer`` is given.
    """

    levels: Sequence[int] = ()
    labels: Sequence[str] | None = None
    scorer: Rule | None = None
    recode: Recode | Mapping[int, Recode] | None = scores.replace_missing_code
    keep_raw: Sequence[int] = ()
    to_flag: Callable[[Column, Sequence[int]], Column] = scores.at_least_level()
    score_name: str | None = None
    severity_name: str | None = None

    def _validate(self) -> None:
        object.__setattr__(self, "levels", tuple(self.levels))
        object.__setattr__(self, "keep_raw", tuple(self.keep_raw))
        if not self.levels or list(self.levels) != sorted(set(self.levels)):
            raise ValueError(f"{self.name}: score levels must be given in ascending order")
        if self.labels is not None:
            object.__setattr__(self, "labels", tuple(self.labels))
            if len(self.labels) != len(self.levels) + 1:
                raise ValueError(f"{self.name}: {len(self.levels)} levels need {len(self.levels) + 1} labels")
        if not self.fields and self.scorer is None:
            raise ValueError(f"{self.name}: neither fields to sum nor a scorer")
        if isinstance(self.recode, Mapping):
            unknown = sorted(set(self.recode) - set(self.fields))
            if unknown:
                raise ValueError(f"{self.name}: recode names fields it does not read: {', '.join(map(str, unknown))}")
        if self.score_name is None:
            object.__setattr__(self, "score_name", f"{self.name}_score")
        if self.severity_name is None:
            object.__setattr__(self, "severity_name", f"{self.name}_severity")

    def _recodes(self) -> Mapping[int, Recode]:
        if self.recode is None:
            return _NOTHING
        each = self.recode if isinstance(self.recode, Mapping) else dict.fromkeys(self.fields, self.recode)
        return {f: recode for f, recode in each.items() if f not in self.keep_raw}

    def _visit_steps(self, visit, severity):
        score_name = on_visit(self.score_name, visit)
        recodes = self._recodes()
        plain_sum = self.scorer is None and set(recodes.values()) <= {scores.replace_missing_code}
        shared = isinstance(self.recode, Mapping)
        yield from self._part_steps(visit, recodes, shared)
        yield Step(
            score_name,
            self.scorer or (lambda scope: sum_of_fields(self, scope)),
            visit,
            null_if_absent=self.null_if_absent or plain_sum,
            promised=self.null_if_absent and not plain_sum,
            recodes=recodes,
            recode_once=shared,
            local_names=self._part_names(visit),
        )
        if severity and self.labels is not None:
            yield Step(
                on_visit(self.severity_name, visit),
                lambda scope: scores.severity_band(scope.column(score_name), self.levels, self.labels),
                visit,
                null_if_absent=True,
            )
        yield Step(
            on_visit(self.name, visit),
            lambda scope: self.to_flag(scope.column(score_name), self.levels),
            visit,
            null_if_absent=self.null_if_absent or self.to_flag is Score.to_flag,
            promised=self.null_if_absent and self.to_flag is not Score.to_flag,
        )
