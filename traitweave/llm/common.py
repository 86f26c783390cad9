"""Helpers shared by the corpus operators: row keys, shared scratch tables, hashing of bytes in numpy."""

from __future__ import annotations

import pickle
import sys
import uuid
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"
#: Bytes of text handled at once in numpy; arrays of eight bytes a byte stay near 10 MB.
SLICE_BYTES = 1 << 20


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else. Pure ASCII text takes the fast way of lower()."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_LOWER)
    )


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`id`, `text` (null: empty) and the two-part key (`k1`, `k2`) of a row: hashes of its id and of its text.

    Rows with the same id and the same text share a key; everything computed for a key holds for each of them.
    The key is never null, so rows without an id take part in every join.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(id_col)).alias("k1"),
        F.xxhash64(text).alias("k2"),
        text.alias("text"),
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir, else one below the warehouse in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def shipped(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of a value together with the code of its classes, so that executors need no copy of this package.
    Tasks read it with `received`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared: Broadcast):
    return pickle.loads(shared.value)


def kept_in_worker(key: str, make: Callable[[], object]):
    """What `make` gives, made once for all tasks of a Python worker; what was kept under another key goes.

    Code that travels with the plan has no module of its own in the worker that could keep it.
    """
    holder = sys.modules.setdefault("kept_in_worker", ModuleType("kept_in_worker"))
    if getattr(holder, "key", None) != key:
        holder.key = holder.value = None
        holder.value = make()
        holder.key = key
    return holder.value


def cut(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """Written to the shared folder and read again: computed once, and safe when executors are lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def few(df: DataFrame) -> DataFrame:
    """`df` from at most four tasks a core. For tables of ids, of which a task has so few rows that starting it and
    writing its file takes longer; rows stay as they are dealt, and a task goes through its partitions one by one."""
    return df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)


def drop(*tables: DataFrame | None) -> None:
    """Deletes tables of `cut` that nothing reads any more."""
    for table in tables:
        if table is not None:
            spark = table.sparkSession
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, column: str, target: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about `target` bytes of text each; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + target, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values one after another, and where each begins (one more entry than values)."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    kind = np.int64 if column.type in (pa.large_string(), pa.large_binary()) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the entropy of 64-bit numbers over all bits."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Polynomial hash, modulo 2^64, of any stretch of a byte buffer from its prefix sums."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.symbol = rng.integers(1, 2**64 - 1, 256, dtype=np.uint64)
        self.base = int(rng.integers(2**62, 2**63, dtype=np.uint64)) | 1
        self.power = self.inverse = np.ones(1, np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(self.power) <= len(data):
            n = max(len(data) + 1, 2 * SLICE_BYTES)
            self.power = _powers(self.base, n)
            self.inverse = _powers(pow(self.base, -1, 2**64), n)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.symbol[data] * self.power[: len(data)], out=sums[1:])
        return sums

    def between(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of the bytes from start to stop, for arrays of both."""
        return mix((sums[stop] - sums[start]) * self.inverse[start] + (stop - start).astype(np.uint64))

    def grams(self, sums: np.ndarray, length: int) -> np.ndarray:
        """Hash of each stretch of `length` bytes."""
        n = max(0, len(sums) - length)
        return mix((sums[length:] - sums[:n]) * self.inverse[:n])


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def sliding(ufunc: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum of each `width` neighbours, from prefix and suffix extremes of blocks."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    if width == 1:
        return x.copy()
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, x[-1], x.dtype)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    before = ufunc.accumulate(grid, axis=1).ravel()
    after = ufunc.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return ufunc(after[:n], before[width - 1 : width - 1 + n])


def byte_letters() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones themselves, the others in order
    from U+0100 on."""
    printable = {b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
