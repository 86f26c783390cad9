"""What a phenotype's expression sees of one participant row.

A spec never touches a DataFrame: it is handed a scope and returns a Column.
``RowScope`` names the columns of the row and notes which ones were read;
``AbsentScope`` answers null to everything and so gives the value a column has
for a participant who is in none of the tables it reads.
"""

from __future__ import annotations

from collections.abc import Callable, Container, Iterable, Mapping
from typing import TYPE_CHECKING

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitweave.functions.arrays import code_text, contains_any
from traitweave.functions.naming import field_column, sql_name
from traitweave.functions.scores import replace_missing_code, replaced_missing_code

if TYPE_CHECKING:
    from traitweave.operators.specs import Step

Recode = Callable[[Column], Column]
#: Stands for the visit a spec is being evaluated on.
HERE = -1


class Scope:
    """Access to fields and to columns created before, for one step of a spec.

    ``types`` are the source columns of the row. ``step`` says on which visit
    fields are read, how they are recoded, and under which short names the spec
    knows its own columns.
    """

    def __init__(self, types: Mapping[str, T.DataType], step: Step):
        self._types = types
        self._step = step

    @property
    def visit(self) -> int | None:
        return self._step.visit

    def field(self, number: int, visit: int | None = HERE, element: int | None = None) -> Column:
        """The field, with the spec's recoding applied.

        It is read on the current visit unless another is named (None: the
        column without a visit); ``element`` names one cell of a multi-valued answer.
        """
        return self._recoded(self._resolve(number, visit, element), self._step.recodes.get(number))

    def any_code(self, number: int, codes: Iterable[int | str], visit: int | None = HERE) -> Column:
        """Whether the array field holds at least one of the codes, on the current visit unless another is named."""
        name = self._resolve(number, visit)
        type_ = self._types[name]
        if not isinstance(type_, T.ArrayType):
            raise ValueError(f"column {name} holds {type_.simpleString()}, but a code list needs an array")
        return self._match(name, list(codes), type_.elementType)

    def column(self, name: str) -> Column:
        """A column created before this one: a child's flag, a score, a helper."""
        return self._created(self._step.local_names.get(name, name))

    def _created(self, name: str) -> Column:
        raise NotImplementedError

    def _source(self, name: str) -> Column:
        raise NotImplementedError

    def _match(self, name: str, codes: list[int | str], element: T.DataType) -> Column:
        return contains_any(self._source(name), codes, element)

    def _recoded(self, name: str, recode: Recode | None) -> Column:
        return recode(self._source(name)) if recode else self._source(name)

    def _resolve(self, number: int, visit: int | None = HERE, element: int | None = None) -> str:
        visit = self.visit if visit == HERE else visit
        if element is not None and visit is None:
            raise ValueError(f"field {number}: element {element} exists on a visit only")
        name = field_column(number, visit, element)
        if name in self._types:
            return name
        family = sorted(c for c in self._types if c == f"p{number}" or c.startswith(f"p{number}_"))
        hint = f"; the field's columns are {', '.join(family)}" if family else ""
        raise ValueError(f"no column {name} for field {number}{hint}")


class RowScope(Scope):
    def __init__(
        self,
        types: Mapping[str, T.DataType],
        step: Step,
        created: Container[str],
        named: Callable[[str], Column] = F.col,
        plain_codes: Callable[[str], str] | None = None,
        shared_recode: Callable[[str, Recode], str] | None = None,
    ):
        super().__init__(types, step)
        self._shared_recode = shared_recode
        self._known = created
        self._named = named
        self._plain_codes = plain_codes
        self.reads: list[str] = []

    def _created(self, name: str) -> Column:
        if name not in self._known and name not in self._types:
            raise ValueError(
                f"{self._step.name} reads column {name} before anything creates it; list its phenotype as a child"
            )
        return self._source(name)

    def _recoded(self, name: str, recode: Recode | None) -> Column:
        if recode is replace_missing_code and self._shared_recode is None:
            self._source(name)
            return F.expr(replaced_missing_code(name))  # one call to the JVM in place of ten
        if recode is None or self._shared_recode is None:
            return super()._recoded(name, recode)
        return self._source(self._shared_recode(name, recode))

    def _source(self, name: str) -> Column:
        if name not in self.reads:
            self.reads.append(name)
        return self._named(name)

    def _match(self, name: str, codes: list[int | str], element: T.DataType) -> Column:
        if self._plain_codes is not None and isinstance(element, T.StringType):
            name, codes = self._plain_codes(name), [str(c).replace(".", "") for c in codes]
        self._source(name)
        return F.expr(f"arrays_overlap({sql_name(name)}, {code_text(codes, element)})")


class AbsentScope(Scope):
    def __init__(self, types: Mapping[str, T.DataType], step: Step, absent: Callable[[str], Column]):
        super().__init__(types, step)
        self._absent = absent

    def _created(self, name: str) -> Column:
        return self._source(name) if name in self._types else self._absent(name)

    def _source(self, name: str) -> Column:
        return F.lit(None).cast(self._types[name])
