"""Suffix-array dedup: bytes covered by a string of `length` bytes that also starts anywhere else.

Sorting the suffix of every byte of a corpus would ship each text hundreds of times. Two equal strings of `length`
bytes agree on the bytes they hold, so they also agree on the place of the stretch of `gram` bytes with the
smallest hash in them. Only suffixes at such places (one byte in some seventy) are taken, and of these only those
whose leading gram stands at two places. A suffix travels with the bytes before it, so that a match may begin before
it.

1. Anchors of all texts, hash of their gram, counted; anchors with a repeated gram are candidates.
2. The context of a candidate (all bytes a match through it can hold) is hashed. Equal contexts are copies: they are
   covered at every place, and one of them stands for all from here on. This takes out hot groups of copies.
3. Contexts that share a gram but differ are range-partitioned by their leading bytes (Spark samples the splitters).
   Each bucket sorts the suffixes and the reversed prefixes by multikey quicksort, level by level and eight
   bytes at a time. Neighbours with long common prefixes form intervals; two contexts in the same intervals
   hold the same string. Equal leading bytes never fall into two buckets, so no match crosses a boundary.
4. If more than `max_group` different contexts share a gram (a short passage in a third of all texts), the group is
   not gathered: each of its strings is hashed and counted over the cluster. The result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitweave.llm.common import Rolling, cut, flat, keyed, sliding, slices

#: Leading bytes by which suffixes are dealt into buckets.
LEAD = 32
#: Different contexts of one gram that one bucket sorts; larger groups are counted string by string.
MAX_GROUP = 20_000


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 400,
    gram: int = 0,
    max_group: int = MAX_GROUP,
) -> DataFrame:
    """Per row of `docs`: id, n_bytes, spans (maximal removed runs, from and to), kept (binary, the bytes left).

    Texts are UTF-8 bytes; null counts as empty; matches never cross texts, may overlap, and are judged on the
    input. Rows with the same id and text are two texts, each a copy of the other. Texts shorter than `length` lose
    nothing. Ids may be null, repeated or of any type. Other columns are not read.
    """
    gram = gram or max(1, length * 16 // 25)
    rows = keyed(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    light = rows.select("k1", "k2", "text")
    anchors = light.mapInArrow(_anchors(length, gram), "k1 long, k2 long, at int, gram long")
    # Counts are tables by the time they are joined: only a join of two shuffles can be split where a gram is hot.
    repeated = cut(anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"))
    candidates = anchors.join(repeated, "gram", "left_semi")
    places = candidates.groupBy("k1", "k2").agg(F.collect_set("at").alias("places"))
    contexts = cut(
        light.join(places, ["k1", "k2"]).mapInArrow(
            _contexts(length, gram), "k1 long, k2 long, at int, gram long, context binary"
        )
    )
    # One row for each different context; the first place it stands at is its representative.
    different = cut(
        contexts.groupBy("context").agg(
            F.count(F.lit(1)).alias("n"), F.first("gram").alias("gram"), F.min(F.struct("k1", "k2", "at")).alias("first")
        )
    )
    copies = contexts.join(different.filter("n > 1").select("context"), "context", "left_semi")
    whole = copies.select(
        "k1", "k2", (F.col("at") - (length - gram)).alias("start"), (F.col("at") + length).alias("stop")
    )
    sizes = cut(different.groupBy("gram").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
    mixed = cut(different.join(sizes, "gram").select("gram", "size", "n", "first.*"))
    listed = mixed.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "gram", "size", "n")).alias("places"))
    suffixes = light.join(listed, ["k1", "k2"]).mapInArrow(
        _suffixes(length, gram, max_group), "lead binary, gram long, before binary, after binary, single boolean, k1 long, k2 long, at int"
    )
    buckets = suffixes.repartitionByRange("lead").mapInArrow(_sorted_matches(length, gram), "k1 long, k2 long, start int, stop int")
    found = whole.unionByName(buckets)
    if not mixed.filter(F.col("size") > max_group).isEmpty():
        strings = light.join(listed, ["k1", "k2"]).mapInArrow(
            _strings(length, gram, max_group), "string binary, k1 long, k2 long, start int"
        )
        twice = strings.groupBy("string").agg(F.count_distinct("k1", "k2", "start").alias("n")).filter("n > 1")
        found = found.unionByName(
            strings.join(twice, "string", "left_semi").select("k1", "k2", "start", (F.col("start") + length).alias("stop"))
        )
    spans = found.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "stop")).alias("found"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.join(spans, ["k1", "k2"], "left").select("id", "text", "found").mapInArrow(
        _removed, f"id {kind}, n_bytes long, spans array<struct<start:int,stop:int>>, kept binary"
    )


def multikey_order(strings: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte strings (rows, zero-padded, with their sizes) and the common prefix of each with the one before.

    Multikey quicksort, level by level: all groups of strings that agree so far are split at once by their next
    eight bytes; strings that are alone in their group take no further part. Bytes past the end of a string are
    equal to nothing.
    """
    n, width = strings.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = strings
    symbols = padded.view(">u8")
    order, group, common = np.argsort(sizes, kind="stable"), np.zeros(n, np.int64), np.zeros(n, np.int64)
    active = np.arange(n)  # places in the order whose strings are not told apart yet
    for level in range(symbols.shape[1]):
        if len(active) < 2:
            break
        key = symbols[order[active], level].astype(np.uint64)
        turn = np.lexsort((key, group[active]))
        order[active] = order[active][turn]
        key, own = key[turn], group[active]  # groups are intervals of places and keep them
        same = np.concatenate([[False], own[1:] == own[:-1]])
        differs = np.concatenate([[0], key[1:] ^ key[:-1]]).astype(np.uint64)
        equal = same & (differs == 0)
        split = same & ~equal
        bits = np.zeros(len(active), np.int64)
        bits[split] = 63 - np.floor(np.log2(differs[split].astype(np.longdouble))).astype(np.int64)
        common[active[split]] = level * 8 + bits[split] // 8
        common[active[equal]] = (level + 1) * 8
        begins = np.where(equal, 0, active)
        group[active] = np.maximum.accumulate(begins)
        stays = equal | np.concatenate([equal[1:], [False]])
        active = active[stays]
    sizes = sizes[order]
    common[1:] = np.minimum(common[1:], np.minimum(sizes[1:], sizes[:-1]))
    common[:1] = 0
    return order, common


def _anchor_places(data: np.ndarray, at: np.ndarray, length: int, gram: int, rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """Places whose gram has the smallest hash in some string of `length` bytes, ties included, and the hashes."""
    n, width = len(data), length - gram + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = np.repeat(at[1:], np.diff(at))
    hashes = rolling.grams(rolling.prefix(data), gram) | np.uint64(1)
    inside = ends[: len(hashes)] >= np.arange(len(hashes)) + gram
    smallest = sliding(np.minimum, np.where(inside, hashes, np.uint64(2**64 - 1)), width)
    smallest[ends[: len(smallest)] < np.arange(len(smallest)) + length] = 0
    best = np.zeros(len(hashes) + width - 1, np.uint64)
    best[width - 1 : width - 1 + len(smallest)] = smallest
    places = np.flatnonzero((sliding(np.maximum, best, width) == hashes) & inside)
    return places, hashes[places]


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            for piece in slices(batch, "text"):
                data, at = flat(piece.column("text"))
                places, hashes = _anchor_places(data, at, length, gram, rolling)
                row = np.searchsorted(at, places, side="right") - 1
                keys = [pa.array(piece.column(k).to_numpy()[row]) for k in ("k1", "k2")]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array((places - at[row]).astype(np.int32)), pa.array(hashes.view(np.int64))],
                    ["k1", "k2", "at", "gram"],
                )

    return run


def _contexts(length: int, gram: int):
    before = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, short = xxhash.xxh3_128_digest, xxhash.xxh3_64_intdigest
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            columns = (batch.column(c).to_pylist() for c in ("k1", "k2", "text", "places"))
            for k1, k2, text, places in zip(*columns, strict=True):
                for at in places:
                    low = max(0, at - before)
                    out[0].append(k1)
                    out[1].append(k2)
                    out[2].append(at)
                    out[3].append(short(text[at : at + gram]) - (1 << 63))
                    out[4].append(digest(text[low : at + length], at - low))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["k1", "k2", "at", "gram", "context"]
            )

    return run


def _suffixes(length: int, gram: int, max_group: int):
    before = length - gram
    names = ["lead", "gram", "before", "after", "single", "k1", "k2", "at"]
    kinds = (pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.int64(), pa.int64(), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("k1", "k2", "text", "places"))
            for k1, k2, text, places in zip(*columns, strict=True):
                for p in places:
                    at = p["at"]
                    if p["size"] <= max_group:
                        after = text[at : at + length]
                        left = text[max(0, at - before) : at]
                        out.append((after[:LEAD], p["gram"], left, after, p["n"] == 1, k1, k2, at))
            for start in range(0, len(out), 20_000):
                part = list(zip(*out[start : start + 20_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(part, kinds, strict=True)], names)

    return run


def _strings(length: int, gram: int, max_group: int):
    before = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("k1", "k2", "text", "places"))
            for k1, k2, text, places in zip(*columns, strict=True):
                large = [p["at"] for p in places if p["size"] > max_group]
                starts = sorted({s for at in large for s in range(max(0, at - before), min(at, len(text) - length) + 1)})
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([digest(text[s : s + length]) for s in starts], pa.binary()),
                        pa.array([k1] * len(starts), pa.int64()),
                        pa.array([k2] * len(starts), pa.int64()),
                        pa.array(starts, pa.int32()),
                    ],
                    ["string", "k1", "k2", "start"],
                )

    return run


def _sorted_matches(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        table = pa.Table.from_batches(held).sort_by("gram").combine_chunks()
        grams = table.column("gram").to_numpy()
        ends = np.append(np.flatnonzero(grams[1:] != grams[:-1]) + 1, len(grams))
        start = 0
        while start < len(grams):  # whole groups, some thousand rows at once
            stop = int(ends[min(np.searchsorted(ends, start + 5_000), len(ends) - 1)])
            yield _matches(table.slice(start, stop - start), length, gram)
            start = stop

    return run


def _matches(table: pa.Table, length: int, gram: int) -> pa.RecordBatch:
    """For each context that stands at one place only: the bytes of it that some other context here holds too."""
    after, after_size = _matrix(table.column("after"), length)
    before, before_size = _matrix(table.column("before"), length - gram, reverse=True)
    order, common = multikey_order(after, after_size)
    back_order, back_common = multikey_order(before, before_size)
    n = table.num_rows
    least, most = np.full(n, length), np.full(n, -1)
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(length - gram + 1):
        # strings that begin d bytes before the suffix: equal when both parts lie in the same intervals
        right[order] = np.cumsum(common < length - d)
        left[back_order] = np.cumsum(back_common < d)
        fits = np.flatnonzero((after_size >= length - d) & (before_size >= d))
        _, which, counts = np.unique(right[fits] * (n + 1) + left[fits], return_inverse=True, return_counts=True)
        hit = fits[counts[which] > 1]
        least[hit] = np.minimum(least[hit], d)
        most[hit] = d
    # all these strings hold the gram, so that together they are one run
    hit = np.flatnonzero((most >= 0) & table.column("single").to_numpy())
    at = table.column("at").to_numpy()[hit]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(table.column("k1").to_numpy()[hit]),
            pa.array(table.column("k2").to_numpy()[hit]),
            pa.array((at - most[hit]).astype(np.int32)),
            pa.array((at - least[hit] + length).astype(np.int32)),
        ],
        ["k1", "k2", "start", "stop"],
    )


def _matrix(column: pa.ChunkedArray, width: int, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Strings as rows of equal width, zero-padded, and their sizes."""
    data, at = flat(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
    sizes = np.diff(at)
    place = np.arange(max(1, width))[None, :]
    held = place < sizes[:, None]
    source = (at[1:, None] - 1 - place) if reverse else (at[:-1, None] + place)
    rows = np.zeros(held.shape, np.uint8)
    rows[held] = data[source[held]]
    return rows, sizes


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    for batch in batches:
        sizes, spans, kept = [], [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist(), strict=True):
            runs: list[list[int]] = []
            for start, stop in sorted((max(0, f["start"]), min(len(text), f["stop"])) for f in found or ()):
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], stop)
                else:
                    runs.append([start, stop])
            edges = [0, *(x for r in runs for x in r), len(text)]
            sizes.append(len(text))
            spans.append([{"start": a, "stop": b} for a, b in runs])
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
            ["id", "n_bytes", "spans", "kept"],
        )
