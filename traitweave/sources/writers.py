"""Writing results from the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_bucketed(
    df: DataFrame, table: str, buckets: int, mode: str = "errorifexists", path: str | None = None, key: str = "eid"
) -> None:
    """A table bucketed and sorted by the participant id.

    Tables with the same number of buckets are joined without an exchange by an
    engine that is told so (``colocated=True``). Rows are brought to their bucket
    before they are written, so that each bucket is one file. ``path`` makes it an
    external table there.
    """
    placed = df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key).format("parquet")
    (placed.option("path", path) if path else placed).saveAsTable(table)


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    arrays: str = "json",
    separator: str = "|",
    null_text: str | None = None,
) -> None:
    """CSV files with a header; arrays, which CSV lacks, become text.

    ``arrays='json'`` writes JSON and loses nothing. ``arrays='joined'`` joins the
    elements with ``separator`` for readers that want plain text: nulls are left
    out unless ``null_text`` stands in for them, and an element that holds the
    separator cannot be told from two.
    """
    flat_csv_frame(df, arrays, separator, null_text).write.mode(mode).csv(path, header=True)


def flat_csv_frame(
    df: DataFrame, arrays: str = "json", separator: str = "|", null_text: str | None = None
) -> DataFrame:
    """The frame with every array column as text."""
    if arrays not in ("joined", "json"):
        raise ValueError(f"arrays must be 'joined' or 'json', not {arrays!r}")

    def flat(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.ArrayType):
            return column
        if arrays == "json":
            return F.to_json(column).alias(field.name)
        return F.array_join(column, separator, null_text).alias(field.name)

    return df.select(*[flat(f) for f in df.schema.fields])
