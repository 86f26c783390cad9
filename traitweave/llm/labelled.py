"""Bounded samples of labelled rows for fitting classifiers on the driver, and n-gram hashing shared by them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitweave.llm.common import Rolling

#: More different labels than this are an error, for they are counted on the driver.
MOST_LABELS = 10_000


def remainder(id_col: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; -1 for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % divisor, F.lit(-1))


def fraction(id_col: Column) -> Column:
    """A number from 0 to 1 that depends on the id alone."""
    return F.pmod(F.xxhash64(id_col, F.lit("sample")), F.lit(1_000_000)) / 1_000_000


def examples(rows: DataFrame, id_col: str, text_col: str, label_col: str, rows_wanted: int, by_label: bool) -> list[tuple[str, object]]:
    """About `rows_wanted` (text, label) pairs, chosen by a hash of the id, in the order of their ids.

    `by_label`: as many of each label, as far as they go; else in the proportion of the labels. By chance a sample may
    have more than its size; of more than twice its size the rows with the least hashes stay. Rows without text or
    label are left out, and no text is too long.
    """
    rows = rows.select(id_col, text_col, label_col)
    usable = rows.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in usable.groupBy(label_col).count().limit(MOST_LABELS + 1).collect()}
    if not counts:
        return []
    if len(counts) > MOST_LABELS:
        raise ValueError(f"column {label_col} has more than {MOST_LABELS} different labels")
    each = rows_wanted / len(counts) if by_label else rows_wanted * 1.0
    total = sum(counts.values())
    share = {k: each / (n if by_label else total) for k, n in counts.items()}
    chosen = None
    for label, wanted in share.items():
        one = (F.col(label_col) == F.lit(label)) & (fraction(F.col(id_col)) < wanted)
        chosen = one if chosen is None else chosen | one
    picked = usable.filter(chosen).orderBy(fraction(F.col(id_col)), id_col).limit(2 * rows_wanted).collect()
    picked.sort(key=lambda r: (str(r[0]), r[1]))
    return [(r[1], r[2]) for r in picked]


class GramBuckets:
    """Buckets of all n-grams of byte strings that lie one after another, n-grams over two strings left out."""

    def __init__(self, sizes: tuple[int, ...], bits: int, seed: int) -> None:
        self.sizes, self.shift = sizes, np.uint64(64 - bits)
        self.rolling = Rolling(seed)

    def __call__(self, data: np.ndarray, at: np.ndarray):
        """For each size: buckets, and the string of each."""
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        sums = self.rolling.prefix(data)
        for n in self.sizes:
            hashes = self.rolling.grams(sums, n)
            if not len(hashes):
                continue
            own = row[: len(hashes)]
            inside = own == row[n - 1 : n - 1 + len(hashes)]
            yield ((hashes + np.uint64(n * 0x9E3779B97F4A7C15 % 2**64)) >> self.shift)[inside].astype(np.int64), own[inside]
