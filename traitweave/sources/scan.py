"""Reading the fields a query needs, table by table."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from traitweave.functions.arrays import merge_visits, pack_cells
from traitweave.functions.naming import Cell, field_column
from traitweave.sources.catalogue import FieldCatalogue


@dataclass(frozen=True)
class FieldScan:
    """The scanned tables, their column types and the arrays still to be merged over tables."""

    frames: Mapping[str, DataFrame]
    types: Mapping[str, T.DataType]
    home: Mapping[str, str]
    merges: Mapping[str, list[str]] = field(default_factory=dict)


def scan_fields(tables: Mapping[str, DataFrame], catalogue: FieldCatalogue, fields: set[int]) -> FieldScan:
    """Read only the columns of the fields in each table that holds any, element columns packed.

    Element columns ``p<f>_i<n>_a<m>`` give one array per visit and one array
    over all visits. The latter is made here when one table holds all visits; if
    not, it is left to be made after the tables are joined.
    """
    visits: dict[int, dict[str, list[str]]] = defaultdict(lambda: defaultdict(list))
    frames: dict[str, DataFrame] = {}
    for table in catalogue.tables_holding(*fields):
        columns = catalogue.columns_of(table, *fields)
        cells: dict[str, list[Cell]] = defaultdict(list)
        for cell in sorted(c for c in map(Cell.parse, columns) if c):
            cells[field_column(cell.field, cell.visit)].append(cell)
        for packed, members in cells.items():
            visits[members[0].field][table].append(packed)
        frame = tables[table].select(*columns)
        if cells:
            frame = frame.withColumns(
                {packed: pack_cells([c.column for c in members]) for packed, members in cells.items()}
            )
        frames[table] = frame

    merges: dict[str, list[str]] = {}
    for number, holders in visits.items():
        merged = field_column(number)
        if len(holders) == 1:
            ((table, packed),) = holders.items()
            frames[table] = frames[table].withColumn(merged, merge_visits(packed))
        else:
            packed = [name for names in holders.values() for name in names]
            merges[merged] = sorted(packed, key=lambda name: int(name.rpartition("_i")[2]))

    types: dict[str, T.DataType] = {}
    home: dict[str, str] = {}
    for table, frame in frames.items():
        for column in frame.schema.fields[1:]:
            if column.name in home:
                raise ValueError(f"column {column.name} comes from two tables, {home[column.name]} and {table}")
            types[column.name] = column.dataType
            home[column.name] = table
    for merged, packed in merges.items():
        types[merged] = types[packed[0]]
    return FieldScan(frames, types, home, merges)
