"""The query engine: tables and specs in, one lazy DataFrame out."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitweave.functions.arrays import merge_visits_over_tables
from traitweave.functions.naming import EID
from traitweave.operators.joins import HOT_ROWS, join_tables
from traitweave.operators.levels import level_column, level_labels, levels
from traitweave.operators.specs import Phenotype
from traitweave.plans.columns import Planned, check_promises, create, plan_columns, source_fields
from traitweave.sources.catalogue import FieldCatalogue, StoredCatalogue
from traitweave.sources.scan import FieldScan, scan_fields


class CohortEngine:
    """Phenotype queries over participant tables split by column.

    ``tables`` maps table names to DataFrames with a column ``eid``.
    """

    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        catalogue: Mapping[str, Iterable[str]] | StoredCatalogue | None = None,
        colocated: bool = False,
    ):
        """``colocated``: the tables are bucketed by id into the same number of buckets, see ``write_bucketed``."""
        self._tables = tables
        self._colocated = colocated
        if isinstance(catalogue, StoredCatalogue):
            self.catalogue = catalogue
        else:
            self.catalogue = FieldCatalogue.of(catalogue or {name: df.columns for name, df in tables.items()})

    @classmethod
    def from_database(
        cls,
        spark: SparkSession,
        database: str | None = None,
        catalogue: Mapping[str, Iterable[str]] | DataFrame | str | None = None,
        colocated: bool = False,
    ) -> CohortEngine:
        """Engine over the tables of a database; those without an ``eid`` are left out.

        With a ``catalogue`` only the tables a query needs are ever looked up. It
        is a mapping from table name to column names, or a stored catalogue: a
        frame of its entries, or the name of the table that holds them.
        """
        if isinstance(catalogue, str):
            catalogue = spark.table(_qualified(database, catalogue))
        if isinstance(catalogue, DataFrame):
            return cls(_TablesByName(spark, database), StoredCatalogue(catalogue), colocated)
        if catalogue is not None:
            return cls(_TablesByName(spark, database, catalogue), catalogue, colocated)
        found = {t.name: spark.table(_qualified(database, t.name)) for t in spark.catalog.listTables(database)}
        return cls({name: df for name, df in found.items() if EID in df.columns}, colocated=colocated)

    def scan(self, *fields: int) -> FieldScan:
        """Pruned scans of the tables that hold the fields."""
        catalogue = self.catalogue.holding(fields)
        catalogue.require(fields)
        if isinstance(self.catalogue, StoredCatalogue):
            self.catalogue.check(self._tables, catalogue, fields)
        return scan_fields(self._tables, catalogue, set(fields))

    def get_table(
        self, *fields: int, join_mode: str = "outer", hot_rows: int | None = HOT_ROWS, only: DataFrame | None = None
    ) -> DataFrame:
        """All columns of the fields and the arrays packed from them, one row per participant."""
        scan = self.scan(*fields)
        joined = join_tables(list(scan.frames.values()), join_mode, hot_rows, only, self._colocated)
        return _merge_arrays(joined, scan)

    def get_source_table(
        self, *specs: Phenotype, join_mode: str = "outer", hot_rows: int | None = HOT_ROWS, only: DataFrame | None = None
    ) -> DataFrame:
        """``get_table`` of every field the specs and the phenotypes below them read."""
        return self.get_table(*source_fields(specs), join_mode=join_mode, hot_rows=hot_rows, only=only)

    def query(
        self,
        *specs: Phenotype,
        return_only_created_columns: bool = True,
        join_mode: str = "outer",
        hot_rows: int | None = HOT_ROWS,
        only: DataFrame | None = None,
        severity: bool = False,
        compact_levels: bool = False,
        normalize_codes: bool = False,
    ) -> DataFrame:
        """One row per participant: the id, every column the specs create, and the labels per level.

        Columns that only depend on one table are computed where that table is
        scanned, so that flags and scores travel through the join in place of
        the code arrays and answers they come from.

        ``join_mode='outer'`` takes any ids; ``'stack'`` is the faster way for
        ids that are unique in every table, and fails if they are not. With
        ``only``, a frame of ids, just these participants are read.
        """
        if not specs:
            raise ValueError("no phenotype is requested")
        scan = self.scan(*source_fields(specs))
        planned = _merge_steps(scan) + plan_columns(
            specs, scan.types, severity=severity, normalize_codes=normalize_codes
        )
        check_promises(planned, next(iter(scan.frames.values())).sparkSession)
        early, late = _split_by_table(planned, scan)

        wanted = {p.name for p in planned if p.visible} | {r for p in late for r in p.reads}
        if not return_only_created_columns:
            wanted |= set(scan.home)
        frames, filled = [], []
        for table, frame in scan.frames.items():
            columns = early.get(table, [])
            # a participant who is not in this table still has a value in these columns
            defaulted = [p for p in columns if p.name in wanted and not p.null_if_absent]
            kept = [c for c in frame.columns[1:] if c in wanted] + [p.name for p in columns if p.name in wanted]
            frame = create(frame, columns)
            if defaulted and len(scan.frames) > 1:
                frame = frame.withColumn(_marker(table), F.lit(True))
                kept.append(_marker(table))
                filled += [(p, _marker(table)) for p in defaulted]
            frames.append(frame.select(EID, *kept))

        df = join_tables(frames, join_mode, hot_rows, only, self._colocated)
        if filled:
            df = df.withColumns({p.name: F.when(F.col(m), F.col(p.name)).otherwise(p.absent()) for p, m in filled})
        df = create(df, late)

        tree = levels(specs)
        created = [p.name for p in planned if p.visible]
        sources = [] if return_only_created_columns else [*scan.home, *scan.merges]
        return df.select(
            EID,
            *sources,
            *created,
            *[level_labels(names, compact_levels).alias(level_column(k)) for k, names in enumerate(tree)],
        )


def evaluate(
    df: DataFrame, *specs: Phenotype, severity: bool = False, normalize_codes: bool = False
) -> DataFrame:
    """Add the specs' columns to any frame that has the fields they read.

    A phenotype whose column the frame already has is taken as it is.
    """
    types = {c.name: c.dataType for c in df.schema.fields}
    planned = plan_columns(specs, types, skip=df.columns, severity=severity, normalize_codes=normalize_codes)
    hidden = [p.name for p in planned if not p.visible]
    return create(df, planned).drop(*hidden)


def _merge_steps(scan: FieldScan) -> list[Planned]:
    return [
        Planned(
            name,
            merge_visits_over_tables(visits),
            tuple(visits),
            visible=False,
            null_if_absent=True,
            absent=lambda name=name: F.lit(None).cast(scan.types[name]),
        )
        for name, visits in scan.merges.items()
    ]


def _merge_arrays(df: DataFrame, scan: FieldScan) -> DataFrame:
    return create(df, _merge_steps(scan))


def _split_by_table(planned: Sequence[Planned], scan: FieldScan) -> tuple[dict[str, list[Planned]], list[Planned]]:
    """Columns computable at the scan of one table, and those that need the joined row."""
    home: dict[str, str | None] = dict(scan.home)
    early: dict[str, list[Planned]] = defaultdict(list)
    late: list[Planned] = []
    for p in planned:
        tables = {home[r] for r in p.reads}
        home[p.name] = tables.pop() if len(tables) == 1 else None
        if home[p.name] is None:
            late.append(p)
        else:
            early[home[p.name]].append(p)
    return early, late


def _marker(table: str) -> str:
    return f"__in_{table}"


def _qualified(database: str | None, table: str) -> str:
    return f"`{database}`.`{table}`" if database else f"`{table}`"


class _TablesByName(Mapping):
    """Tables of a catalogue, looked up in the metastore when they are read."""

    def __init__(self, spark: SparkSession, database: str | None, names: Iterable[str] = ()):
        self._spark = spark
        self._database = database
        self._names = list(names)

    def __getitem__(self, name: str) -> DataFrame:
        return self._spark.table(_qualified(self._database, name))

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)
