"""Line dedup: lines that stand in several documents stay only in the document with the largest id.

Two Bloom filters, one for line hashes seen once and one for those seen twice, are kept in parts: each task of a
shuffle of bare 8-byte hashes owns one part of the hash space. The twice-seen filter, of a fixed size that is a
parameter, is the only thing that is broadcast. A hash found twice in one slice of text is shipped twice and then no
more by that task, so that a line of a third of all documents is no hot key. Lines the filter holds are suspects; only
these are shuffled as text for the exact count of their documents. If a corpus outgrows the filter, more lines become
suspects; results stay exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitweave.llm.common import Rolling, cut, flat, keyed, mix, slices

#: Bits of the twice-seen filter: 2^27 is 16 MB, good for some 15 million different lines; 2^32 at most.
FILTER_BITS = 1 << 27
#: Parts of the filter, each built by one task.
PARTS = 64
PROBES = 4
#: Hashes that a task remembers to have shipped twice; one that is forgotten is shipped again, with the same result.
REMEMBERED = 200_000
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
TO_LOWER = np.frombuffer(LOWER, np.uint8)
STRIPPED = b" \t\n\x0b\x0c\r"


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Per row of `docs`: id, text (the kept lines joined by \\n), n_lines (before dropping), n_dropped.

    A line's key is the line without ASCII white space at both ends and with A-Z lower-cased. Keys of at least
    `min_chars` code points found in at least `min_docs` documents lose all their lines except in the document
    with the largest id. Null or empty text is one empty line. Rows that are equal in id and text count as one
    document and get the same result; a null id is smaller than all others. Other columns are not read.
    """
    rows = keyed(docs, id_col, text_col)
    drop = _dropped_lines(rows, min_chars, min_docs, filter_bits)
    return rows.join(drop, ["k1", "k2"], "left").select(
        "id",
        _without(F.col("text")).alias("text"),
        F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs`, all rows and columns, with the texts that `dedup_lines` gives; null text stays null."""
    drop = _dropped_lines(keyed(docs, id_col, text_col), **options)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(id_col).alias("k1"), F.xxhash64(text).alias("k2"))
    rows = rows.join(drop, ["k1", "k2"], "left")
    return rows.select(
        *(_without(F.col("row")[c]).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns)
    )


def _without(text: Column) -> Column:
    left = F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains("drop", i))
    return F.when(F.col("drop").isNull(), text).otherwise(F.array_join(left, "\n"))


def _dropped_lines(rows: DataFrame, min_chars: int = 20, min_docs: int = 3, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Numbers of the lines to drop by row key."""
    if filter_bits & (filter_bits - 1) or not PARTS * 8 <= filter_bits <= 1 << 32:
        raise ValueError("filter_bits must be a power of two, from 512 to 2^32")
    spark = rows.sparkSession
    hashes = rows.select("text").mapInArrow(_line_hashes(min_chars), "hash long, part int")
    parts = hashes.repartition(PARTS, "part").mapInArrow(_twice_seen(filter_bits // PARTS), "part int, bits binary")
    seen = np.zeros((PARTS, filter_bits // PARTS // 8), np.uint8)
    for r in parts.collect():
        seen[r["part"]] |= np.frombuffer(r["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(seen)

    kind = rows.schema["id"].dataType.simpleString()
    suspects = cut(rows.mapInArrow(_suspects(shared, min_chars), f"id {kind}, k1 long, k2 long, key binary, lines array<int>"))
    counted = suspects.groupBy("key").agg(F.count_distinct("k1", "k2").alias("n_docs"), F.max("id").alias("keeper"))
    # A table by the time it is joined: only a join of two shuffles can be split where a line is hot.
    counted = cut(counted.filter(F.col("n_docs") >= min_docs))
    drop = suspects.join(counted, "key").filter(~F.col("id").eqNullSafe(F.col("keeper")))
    return drop.groupBy("k1", "k2").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("drop"))


class LineScan:
    """Lines of many texts at once: where they begin and end without outer white space, and their hash."""

    def __init__(self) -> None:
        self.rolling = Rolling()
        self.white = np.zeros(256, bool)
        self.white[list(STRIPPED)] = True

    def __call__(self, column: pa.Array, min_chars: int) -> tuple[np.ndarray, ...]:
        """The text's number, the line's number in it, start, stop and hash of all lines that are long enough."""
        data, at = flat(column)
        # lines end before each \n and at the end of each text
        feeds = np.flatnonzero(data == 10)
        ends = np.concatenate([feeds, at[1:]])
        doc = np.concatenate([np.searchsorted(at[1:], feeds, side="right"), np.arange(len(column))])
        order = np.lexsort((ends, doc))
        doc, ends = doc[order], ends[order]
        first = np.searchsorted(doc, doc, side="left")
        number = np.arange(len(ends)) - first
        starts = np.where(number == 0, at[doc], np.concatenate([[0], ends[:-1] + 1]))
        # next and last byte that is not white
        solid = np.flatnonzero(~self.white[data]) if len(data) else np.zeros(0, np.int64)
        low, high = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
        full = high > low
        doc, number, low, high = doc[full], number[full], low[full], high[full]
        starts, ends = solid[low], solid[high - 1] + 1
        chars = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
        enough = chars[ends] - chars[starts] >= min_chars
        doc, number, starts, ends = doc[enough], number[enough], starts[enough], ends[enough]
        sums = self.rolling.prefix(TO_LOWER[data])
        return doc, number, starts, ends, self.rolling.between(sums, starts, ends)


def probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bits of a part that a hash sets, a row for each probe; the top bits have named the part."""
    step = mix(hashes) | np.uint64(1)
    return np.stack([(hashes + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)]).astype(np.int64)


def part_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.int64) % PARTS


def _line_hashes(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, shipped = LineScan(), np.zeros(0, np.uint64)
        for batch in batches:
            for piece in slices(batch, "text"):
                doc, _, _, _, hashes = scan(piece.column(0), min_chars)
                # a line that one document repeats is no sign of another document
                order = np.lexsort((hashes, doc))
                doc, hashes = doc[order], hashes[order]
                keep = hashes[np.concatenate([[True], (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])])[: len(doc)]]
                own, counts = np.unique(keep, return_counts=True)
                new = ~np.isin(own, shipped)
                own, counts = own[new], np.minimum(counts[new], 2)
                shipped = np.concatenate([shipped, own[counts == 2]])[-REMEMBERED:]
                keep = np.repeat(own, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keep.view(np.int64)), pa.array(part_of(keep).astype(np.int32))], ["hash", "part"]
                )

    return run


def _twice_seen(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            hashes = batch.column(0).to_numpy().view(np.uint64)
            parts = batch.column(1).to_numpy()
            for part in np.unique(parts):
                once, twice = filters.setdefault(int(part), (np.zeros(bits, bool), np.zeros(bits, bool)))
                own, counts = np.unique(hashes[parts == part], return_counts=True)
                at = probes(own, bits)
                again = (counts > 1) | once[at].all(axis=0)
                twice[at[:, again]] = True
                once[at] = True
        for part, (_, twice) in filters.items():
            packed = np.packbits(twice).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([packed], pa.binary())], ["part", "bits"])

    return run


def _suspects(shared, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, seen = LineScan(), shared.value
        bits = seen.shape[1] * 8
        for batch in batches:
            for piece in slices(batch, "text"):
                doc, number, starts, ends, hashes = scan(piece.column("text"), min_chars)
                at, part = probes(hashes, bits), part_of(hashes)
                held = ((seen[part, at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)
                data = flat(piece.column("text"))[0].tobytes()
                found: dict[tuple[int, bytes], list[int]] = {}
                for d, n, a, b in zip(*(x[held].tolist() for x in (doc, number, starts, ends)), strict=True):
                    found.setdefault((d, data[a:b].translate(LOWER)), []).append(n)
                rows = pa.array([d for d, _ in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(c).take(rows) for c in ("id", "k1", "k2")]
                    + [pa.array([k for _, k in found], pa.binary()), pa.array(list(found.values()), pa.list_(pa.int32()))],
                    ["id", "k1", "k2", "key", "lines"],
                )

    return run
