"""How fields become column names.

A field is a number. Its column is ``p<field>``, followed by ``_i<visit>`` when
it was measured on repeated visits and by ``_a<element>`` when one answer is
spread over several columns.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

EID = "eid"

_FIELD_NUMBER = re.compile(r"^p(\d+)(?:_|$)")
_ADDRESS = re.compile(r"^p(\d+)(?:_i(\d+)(?:_a(\d+))?)?$")
_CELL = re.compile(r"^p(\d+)_i(\d+)_a(\d+)$")


def field_column(field: int | str, visit: int | None = None, element: int | None = None) -> str:
    """Column name of a field; a string is taken as a column name already.

    An element only exists within a visit, so it is left out without one.
    """
    if isinstance(field, str):
        return field
    name = f"p{field}"
    if visit is not None:
        name += f"_i{visit}"
        if element is not None:
            name += f"_a{element}"
    return name


def field_number(column: str) -> int | None:
    """Field number a column belongs to; None for the key, hierarchy columns and others."""
    if column == EID or "hierarchy" in column:
        return None
    match = _FIELD_NUMBER.match(column)
    return int(match.group(1)) if match else None


def address(column: str) -> tuple[int, int | None, int | None]:
    """Field, visit and element of a field's column; parts it does not name are None."""
    match = _ADDRESS.match(column)
    if not match:
        return field_number(column), None, None
    field, visit, element = match.groups()
    return int(field), None if visit is None else int(visit), None if element is None else int(element)


def sql_name(column: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + column.replace("`", "``") + "`"


def sql_literal(value: int | str) -> str:
    """An integer or string as SQL text."""
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True, order=True)
class Cell:
    """One element column of a multi-valued answer."""

    field: int
    visit: int
    element: int

    @classmethod
    def parse(cls, column: str) -> Cell | None:
        match = _CELL.match(column)
        return cls(*map(int, match.groups())) if match else None

    @property
    def column(self) -> str:
        return field_column(self.field, self.visit, self.element)
