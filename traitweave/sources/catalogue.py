"""Which table holds which field."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitweave.functions.naming import EID, address, field_number

#: Columns of a stored catalogue: one row per column of a participant table.
STORED = "table string, column string, field int, instance int, element int"


@dataclass(frozen=True)
class FieldCatalogue:
    """Index from field numbers to the tables and columns that hold them.

    A field may be spread over tables, for instance one per visit.
    """

    columns: Mapping[str, tuple[str, ...]]
    by_field: Mapping[int, Mapping[str, tuple[str, ...]]]

    @classmethod
    def of(cls, columns: Mapping[str, Iterable[str]]) -> FieldCatalogue:
        """Build from the column names of each table."""
        listed = {table: tuple(sorted(set(names))) for table, names in sorted(columns.items())}
        by_field: dict[int, dict[str, list[str]]] = {}
        for table, names in listed.items():
            for name in names:
                number = field_number(name)
                if number is not None:
                    by_field.setdefault(number, {}).setdefault(table, []).append(name)
        return cls(listed, {f: {t: tuple(c) for t, c in held.items()} for f, held in by_field.items()})

    def tables_holding(self, *fields: int) -> list[str]:
        """Every table that holds at least one column of one of the fields."""
        self.require(fields)
        return sorted({table for f in fields for table in self.by_field[f]})

    def columns_of(self, table: str, *fields: int) -> list[str]:
        """The key and all columns of the fields (every visit and element) in one table."""
        held = (self.by_field.get(f, {}).get(table, ()) for f in sorted(set(fields)))
        return [EID, *(name for names in held for name in names)]

    def holding(self, fields: Iterable[int]) -> FieldCatalogue:
        """The part of the catalogue a query of the fields needs; here all of it."""
        return self

    def entries(self, spark: SparkSession) -> DataFrame:
        """The catalogue as a frame that can be stored; columns that belong to no field are left out."""
        rows = [
            (table, column, *address(column))
            for table, names in self.columns.items()
            for column in names
            if field_number(column) is not None
        ]
        return spark.createDataFrame(rows, STORED)

    def require(self, fields: Iterable[int]) -> None:
        fields = set(fields)
        if not fields:
            raise ValueError("no field is requested")
        unknown = sorted(fields - set(self.by_field))
        if unknown:
            raise ValueError("no table holds field " + ", ".join(map(str, unknown)))


@dataclass(frozen=True)
class StoredCatalogue:
    """A catalogue in a table (``table``, ``column``, ``field``, ``instance``, ``element``).

    Only the rows of the fields a query reads are fetched, and only the tables
    they name are ever opened. Those must have exactly the columns of the fields
    that the catalogue lists; a stale catalogue is an error, not a lost visit.
    """

    entries: DataFrame

    def holding(self, fields: Iterable[int]) -> FieldCatalogue:
        wanted = sorted(set(fields))
        rows = self.entries.filter(F.col("field").isin(wanted)).select("table", "column").collect()
        columns: dict[str, list[str]] = {}
        for table, column in rows:
            columns.setdefault(table, []).append(column)
        return FieldCatalogue.of(columns)

    def check(self, tables: Mapping[str, DataFrame], found: FieldCatalogue, fields: Iterable[int]) -> None:
        for table in found.columns:
            there = {c for c in tables[table].columns if field_number(c) in set(fields)}
            listed = set(found.columns[table])
            if there != listed:
                wrong = ", ".join(sorted(there ^ listed))
                raise ValueError(f"the catalogue and table {table} do not agree on {wrong}")
