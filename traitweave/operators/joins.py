"""Full outer join of participant tables on the participant id.

Two ways to the same rows, both by stacking the tables: their rows become rows of one frame, with a column per table
that holds the row as a struct, and meet in a single exchange by id.

``outer_join`` makes no assumption about the id: ids that occur several times
in a table multiply rows, and rows without an id match nothing and are kept.
Neither kind may pile up in one task.

``stack_join`` needs ids that are present and unique within each table and
fails if they are not.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitweave.functions.naming import EID, sql_name

JOIN_MODES = ("outer", "stack")
#: Formats of to_json that keep every digit of a time.
EXACT_TEXT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


#: An id whose rows in all tables multiply to more than this is joined in fragments. Rows of other ids are gathered by
#: id, so this is also the most rows of one table that one id may bring into a list.
HOT_ROWS = 10_000
#: At most so many ids are joined in fragments, and so many hashes of ids are looked up before an exchange: lists of
#: some ten megabytes that are broadcast.
MARKS = 1 << 17


def join_tables(
    frames: Sequence[DataFrame],
    mode: str = "outer",
    hot_rows: int | None = HOT_ROWS,
    only: DataFrame | None = None,
    colocated: bool = False,
) -> DataFrame:
    """Full outer join of the tables; a single table is taken as it is.

    ``only`` is a frame of ids: just their rows are joined. ``colocated`` says that every table is bucketed by id
    into the same number of buckets, so that no exchange is needed.
    """
    if mode not in JOIN_MODES:
        raise ValueError(f"join_mode must be one of {', '.join(JOIN_MODES)}, not {mode!r}")
    columns = [[c for c in frame.columns if c != EID] for frame in frames]
    repeated = [c for c, n in Counter(c for names in columns for c in names).items() if n > 1]
    if repeated:
        raise ValueError(f"column {repeated[0]} comes from two tables")
    if only is not None:
        frames = rows_of_ids(frames, only)
    if len(frames) == 1:
        return frames[0]
    if mode == "stack":
        return stack_join(frames, colocated)
    return outer_join(frames, hot_rows, colocated)


def rows_of_ids(frames: Sequence[DataFrame], only: DataFrame) -> list[DataFrame]:
    """The rows of each table whose id is among those of ``only``, sorted out before anything is exchanged.

    The ids are first compared by a hash of ``MARKS`` values, which are few enough to be broadcast whatever the
    number of ids; what passes is joined with the ids themselves.
    """
    ids = only.select(F.col(only.columns[0]).alias(EID)).filter(F.col(EID).isNotNull()).distinct()
    marks = F.broadcast(ids.select(_mark()).distinct())
    kept = []
    for frame in frames:
        few = frame.withColumn("__mark", _mark()).join(marks, "__mark", "left_semi").drop("__mark")
        kept.append(few.join(ids, EID, "left_semi"))
    return kept


def outer_join(frames: Sequence[DataFrame], hot_rows: int | None = HOT_ROWS, colocated: bool = False) -> DataFrame:
    """Full outer equi-join of any number of tables.

    Rows are gathered by id, and an id gives the product of its lists, one list
    per table. Before, ids are counted (a scan of the id column alone, with
    map-side combining), and those with a product over ``hot_rows`` are known at
    the scan: their rows form a grid with an axis per table. Each axis is cut
    into fragments, a row falls into one of its own axis and is copied to all
    cells of the grid with that fragment. So each combination meets in exactly
    one cell, a cell makes some ``hot_rows`` rows, and cells are gathered apart
    from each other. Rows without an id match nothing and are not exchanged.
    ``hot_rows=None`` spares the count where ids are known to repeat little.
    """
    if hot_rows is not None and hot_rows < 1:
        raise ValueError("hot_rows must be at least 1")
    n = len(frames)
    stacked = _stacked(frames)
    rows = stacked.filter(F.col(EID).isNotNull())
    if hot_rows is None:
        result = _products(rows, [EID], n, colocated)
    else:
        rows = _in_cells(rows, _marked(frames, hot_rows), n, hot_rows)
        result = _products(rows, [EID, "__cell"], n, colocated)
    if any(f.schema[EID].nullable for f in frames):
        missing = stacked.filter(F.col(EID).isNull())
        result = result.unionByName(missing.select(EID, *[_row(k) for k in range(n)]))
    return _unpacked(result, frames)


def _mark() -> Column:
    """A hash by which ids are told apart early."""
    return F.pmod(F.xxhash64(EID), F.lit(MARKS)).cast("int").alias("__mark")


def _row(table: int) -> str:
    return f"__row_{table}"


def _stacked(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows in one frame: the id, the number of the table, and the row in that table's column."""
    rows = []
    for k, frame in enumerate(frames):
        row = F.struct(F.lit(k).alias("__table"), *[c for c in frame.columns if c != EID]).alias(_row(k))
        # renamed to itself, for Spark only sees equal partitionings of a union's inputs through columns made anew
        rows.append(frame.select(F.col(EID).alias(EID), F.lit(k).alias("__table"), row))
    return reduce(lambda above, below: above.unionByName(below, allowMissingColumns=True), rows)


def _unpacked(joined: DataFrame, frames: Sequence[DataFrame]) -> DataFrame:
    columns = [(k, c) for k, frame in enumerate(frames) for c in frame.columns if c != EID]
    return joined.selectExpr(EID, *[f"{_row(k)}.{sql_name(c)} AS {sql_name(c)}" for k, c in columns])


def _products(rows: DataFrame, keys: Sequence[str], n: int, colocated: bool = False) -> DataFrame:
    """Rows brought together by the keys: the product of the rows of all tables that have any.

    A table whose axis is cut has rows of the id, if not in this cell: without any here there is no combination.
    """
    gathered = (rows if colocated else rows.repartition(*keys)).groupBy(*keys)
    cut = "__axes" in rows.columns
    axes = [F.first("__axes").alias("__axes")] if cut else []
    lists = gathered.agg(*[F.collect_list(_row(k)).alias(_row(k)) for k in range(n)], *axes)
    if cut:
        filled = " AND ".join(f"(size({_row(k)}) > 0 OR __axes[{k}] = 1)" for k in range(n))
        lists = lists.filter(f"__axes IS NULL OR ({filled})")
    for k in range(n):
        lists = lists.withColumn(_row(k), F.explode_outer(_row(k)))
    return lists.select(EID, *[_row(k) for k in range(n)])


def _marked(frames: Sequence[DataFrame], hot_rows: int) -> DataFrame:
    """Ids to be joined in fragments, at most one for each of ``MARKS`` hashes: the one with the largest product.

    This bounds the list whatever the tables hold. An id that gives way to a larger one is joined like all others.
    """
    n = len(frames)
    largest = F.max_by(F.struct(EID, *[_rows_in(k) for k in range(n)]), F.expr(_product_of(n)))
    found = hot_ids([f.filter(F.col(EID).isNotNull()) for f in frames], hot_rows)
    return found.groupBy(_mark()).agg(largest.alias("id")).select("id.*")


def _in_cells(rows: DataFrame, marked: DataFrame, n: int, hot_rows: int) -> DataFrame:
    """Every row with the cell it is gathered in, once for each of its cells; ids that are not marked have one.

    The fragment of a row depends on its content and the number of its partition. Both are the same when a task runs
    again after a loss, and equal rows of different partitions fall into different fragments.
    """
    several = " + ".join(f"CAST({_rows_in(k)} > 1 AS INT)" for k in range(n))
    cuts = f"power(({_product_of(n)}) / {hot_rows}, 1D / greatest({several}, 1))"
    axes = ", ".join(f"CAST(greatest(least(ceil({cuts}), {_rows_in(k)}), 1) AS BIGINT)" for k in range(n))
    hot = marked.selectExpr(EID, f"array({axes}) AS __axes")
    content = F.coalesce(*[F.to_json(_row(k), EXACT_TEXT) for k in range(n)])
    hash_ = F.when(F.col("__axes").isNotNull(), F.xxhash64(content, F.spark_partition_id()))
    return (
        rows.join(F.broadcast(hot), EID, "left")
        .withColumns(
            {
                "__hash": hash_,
                "__own": F.expr("element_at(__axes, __table + 1)"),
                "__below": F.expr("aggregate(slice(__axes, 1, __table), 1L, (a, x) -> a * x)"),
                "__all": F.expr("aggregate(__axes, 1L, (a, x) -> a * x)"),
            }
        )
        .withColumn("__other", F.expr("explode(sequence(0L, coalesce(__all div __own, 1L) - 1))"))
        .withColumn(
            "__cell",
            F.expr("__other % __below + pmod(__hash, __own) * __below + (__other div __below) * __below * __own"),
        )
        .select(EID, "__cell", "__axes", *[_row(k) for k in range(n)])
    )


def hot_ids(frames: Sequence[DataFrame], hot_rows: int) -> DataFrame:
    """Ids with more than ``hot_rows`` rows in the result, and their rows in each of the tables."""
    return _counts(frames).filter(F.expr(f"{_product_of(len(frames))} > {hot_rows}"))


def _counts(frames: Sequence[DataFrame]) -> DataFrame:
    """How many rows each id has in each of the tables.

    Counted on the map side first, so a frequent id reaches the shuffle as one
    row per task.
    """
    ids = [f.select(F.col(EID).alias(EID), F.lit(k).alias("__table")) for k, f in enumerate(frames)]
    counts = [F.expr(f"count_if(__table = {k}) AS {_rows_in(k)}") for k in range(len(frames))]
    return reduce(DataFrame.union, ids).groupBy(EID).agg(*counts)


def _product_of(n: int) -> str:
    return " * ".join(f"greatest({_rows_in(k)}, 1D)" for k in range(n))


def _rows_in(table: int) -> str:
    return f"__rows_{table}"


def stack_join(frames: Sequence[DataFrame], colocated: bool = False) -> DataFrame:
    """Full outer join by folding the stacked rows of each id into one.

    Rows are brought together by id before they are aggregated, since ids are
    unique within a table and a map-side aggregation would combine nothing. A
    missing id fails the query at the scan, before rows without one pile up in a
    task; an id that occurs twice in one table fails it after the shuffle.
    """
    tables = range(len(frames))
    message = "stacking tables needs ids that are present and unique in each table; use join_mode='outer'"
    present = F.assert_true(F.col(EID).isNotNull(), F.lit(message)).isNull()
    stacked = _stacked([frame.filter(present) if frame.schema[EID].nullable else frame for frame in frames])
    folded = (
        (stacked if colocated else stacked.repartition(EID))
        .groupBy(EID)
        .agg(
            *[F.first(_row(k), ignorenulls=True).alias(_row(k)) for k in tables],
            *[F.expr(f"count_if(__table = {k}) AS {_rows_in(k)}") for k in tables],
        )
    )
    sound = F.greatest(*[_rows_in(k) for k in tables]) <= 1
    return _unpacked(folded.filter(F.assert_true(sound, F.lit(message)).isNull()), frames)
