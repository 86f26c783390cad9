"""Packing token sequences of fixed capacity by linear grouping.

Lengths are whole numbers up to the capacity, so a histogram of the pieces holds all that a packing needs to know,
however many pieces there are. Lengths over an eighth of the capacity are sorted and cut into groups of equal
cardinality, and each is rounded up to the largest of its group. For these few sizes column generation solves the
linear program over configurations (which sizes share a sequence). Configurations are used as often as the program
says, rounded down; their places are given to actual pieces of the group, the last one to the longest piece that fits
the room the true lengths leave. All other pieces go by decreasing length into the fullest sequences with room for them (best fit).

At scale: a task tokenises its documents and numbers its pieces within each length; the counts of the tasks, added up
in order, make these numbers unique over all tasks. The plan maps numbers to places in intervals: "the pieces of
length 300 with numbers 5,000 to 9,000 go two by two into sequences from 700 on, at offset 1,400". Runs of sequences
with the same contents are handled as one, so the plan grows with the number of lengths, not of pieces. A length that
a third of all pieces have is a few intervals. No piece passes the driver.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitweave.llm.common import byte_letters, cut, kept_in_worker, slices

#: Groups of the linear grouping; lengths up to capacity / SMALL are packed by best fit alone.
GROUPS, SMALL = 64, 8
#: Words remembered by a worker; characters of the longest that is; characters of text taken at once.
REMEMBERED, LONGEST, STRETCH = 500_000, 40, 1 << 20
MOST_PIVOTS = 5_000
#: Fixed value: how the word tokenizer splits a text before its merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for characters before U+0250. There are no marks among them, so that such texts are in normal form.
_LETTER, _NUMBER, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
WIDE = re.compile(r"[^\x00-\u024f]").search
LATIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+").findall
#: A tokenizers file without what comes before its merges.
NOTHING_BEFORE = {"normalizer": None, "pre_tokenizer": None, "post_processor": None, "added_tokens": []}
#: Shares of the program's sequences that are tried; what they leave goes to best fit. The fewest sequences win.
SHARES = (0.3, 0.65, 1.0)


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The place of every piece of every document.

    `tokenizer` is the text of a tokenizers file that drops white space. A document is its ids (no special ones added)
    and `end_id`; one longer than `capacity` is cut into pieces of that length and a last one. Columns: `id`, `piece`
    (from 0), `start` (ids of the document before it), `length`, `ids_crc32` (of the ids as unsigned 32-bit
    little-endian), `sequence_id` (from 0, without gaps), `offset` (place there, gapless from 0); with `with_ids` also
    `ids`. Null and empty texts are the `end_id` alone. Repeated rows are packed once each; rows without an id
    like others. Which of several pieces of one length gets which place is not defined. Other columns are left out.
    """
    spark = docs.sparkSession
    pieces = cut(_pieces(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids))
    counts = cut(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    plan = _plan_table(spark, plan_packing(histogram, capacity))
    # not more rows than some 50 a length, so at most 100,000 at a capacity of 2048: small enough to broadcast
    number = pieces.join(bases, ["part", "length"]).withColumn("number", F.col("base") + F.col("nth"))
    inside = (F.col("number") >= F.col("first_number")) & (F.col("number") < F.col("last_number"))
    placed = number.join(F.broadcast(plan), (F.col("length") == F.col("of_length")) & inside)
    k = F.col("number") - F.col("first_number")
    return placed.select(
        "id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_sequence") + F.floor(k / F.col("each"))).alias("sequence_id"),
        (F.col("first_offset") + (k % F.col("each")) * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []),
    )


# ------------------------------------------------------------------ the plan


@dataclass(frozen=True)
class Interval:
    """Pieces of one length, numbers from `first` to before `last`, `each` of them in a sequence, one after another."""

    length: int
    first: int
    last: int
    sequence: int
    each: int
    offset: int


class Packing:
    """A packing under construction: runs of sequences with equal contents, and the intervals so far."""

    def __init__(self, histogram: dict[int, int], capacity: int) -> None:
        self.left = dict(histogram)
        self.given = dict.fromkeys(histogram, 0)
        self.capacity = capacity
        self.sequences = 0
        self.intervals: list[Interval] = []
        self.open: dict[int, list[tuple[int, int]]] = {}  # room → runs (first sequence, how many)
        self.rooms: list[int] = []  # the keys of `open`, ascending
        self.lengths = sorted(histogram)  # of which pieces are left

    def longest(self, room: int, but: dict[int, int]) -> int:
        """The longest of the pieces that are left, `but` some, and fit; 0 if none does."""
        at = bisect.bisect_right(self.lengths, room) - 1
        while at >= 0 and self.left[self.lengths[at]] <= but.get(self.lengths[at], 0):
            at -= 1
        return self.lengths[at] if at >= 0 else 0

    def put(self, length: int, pieces: int, sequence: int, each: int, offset: int) -> None:
        first = self.given[length]
        self.intervals.append(Interval(length, first, first + pieces, sequence, each, offset))
        self.given[length] += pieces
        self.left[length] -= pieces
        if not self.left[length]:
            del self.lengths[bisect.bisect_left(self.lengths, length)]

    def new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def offer(self, room: int, first: int, n: int) -> None:
        if room and n:
            if room not in self.open:
                self.open[room] = []
                bisect.insort(self.rooms, room)
            self.open[room].append((first, n))

    def take(self, length: int) -> tuple[int, int, int]:
        """The run (room, first, n) with the least room for a piece; a new sequence is a run of its own."""
        at = bisect.bisect_left(self.rooms, length)
        if at == len(self.rooms):
            n = -(-self.left[length] // (self.capacity // length))
            return self.capacity, self.new(n), n
        room = self.rooms[at]
        first, n = self.open[room].pop()
        if not self.open[room]:
            del self.open[room], self.rooms[at]
        return room, first, n

    def best_fit(self) -> None:
        """All pieces that are left, by decreasing length."""
        for length in sorted(self.left, reverse=True):
            while pieces := self.left[length]:
                room, first, n = self.take(length)
                each = room // length
                full = min(n, pieces // each)
                if full:
                    self.put(length, full * each, first, each, self.capacity - room)
                    self.offer(room - each * length, first, full)
                rest = self.left[length]
                if full < n and rest:  # fewer than `each` are left: they share the next sequence
                    self.put(length, rest, first + full, each, self.capacity - room)
                    self.offer(room - rest * length, first + full, 1)
                    full += 1
                self.offer(room, first + full, n - full)


def plan_packing(histogram: dict[int, int], capacity: int, groups: int = GROUPS) -> list[Interval]:
    """Places for as many pieces of each length as the histogram says."""
    pieces = {length: n for length, n in histogram.items() if n}
    large = sorted((length for length in pieces if length * SMALL > capacity), reverse=True)
    demand, least = equal_groups([(length, pieces[length]) for length in large], groups)
    program = configurations(demand, capacity)
    tried = []
    for share in SHARES:
        packing = Packing(pieces, capacity)
        for configuration, amount in program:
            _use(packing, configuration, int(share * amount + 1e-6), least)
        packing.best_fit()
        tried.append(packing)
    return min(tried, key=lambda packing: packing.sequences).intervals


def equal_groups(lengths: list[tuple[int, int]], groups: int) -> tuple[dict[int, int], dict[int, int]]:
    """Lengths (descending, with counts) in groups of equal cardinality: by the largest length of a group, its pieces
    and its least length. Groups with the same largest length are one."""
    total, done, size = sum(n for _, n in lengths), 0, 0
    demand: dict[int, int] = {}
    least: dict[int, int] = {}
    group = -1
    for length, n in lengths:
        while n:
            if done * groups // total > group:
                group = done * groups // total
                size = length
            some = min(n, -(-(group + 1) * total // groups) - done)
            demand[size] = demand.get(size, 0) + some
            least[size] = length
            done += some
            n -= some
    return demand, least


def configurations(demand: dict[int, int], capacity: int) -> list[tuple[list[int], float]]:
    """Which sizes share a sequence, and in how many sequences: the linear program over all configurations, by
    column generation. Large pieces first."""
    sizes = sorted(demand, reverse=True)
    if not sizes:
        return []
    need = np.array([demand[s] for s in sizes], float)
    columns = np.diag([float(capacity // s) for s in sizes])
    for _ in range(MOST_PIVOTS):
        price = np.linalg.solve(columns.T, np.ones(len(sizes)))
        value, column = richest(sizes, price, capacity)
        if value <= 1 + 1e-7:
            break
        amount, step = np.linalg.solve(columns, need), np.linalg.solve(columns, column)
        ratio = np.where(step > 1e-9, np.maximum(amount, 0) / np.where(step > 1e-9, step, 1), np.inf)
        columns[:, int(ratio.argmin())] = column
    amount = np.linalg.solve(columns, need)
    return [
        ([s for s, k in zip(sizes, columns[:, j], strict=True) for _ in range(int(round(k)))], float(amount[j]))
        for j in range(len(sizes))
    ]


def richest(sizes: list[int], price: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of the greatest total price: a knapsack, one layer for each further piece."""
    best, layers = np.zeros(capacity + 1), []
    for _ in range(capacity // min(sizes)):
        nxt, chosen = best.copy(), np.full(capacity + 1, -1)
        for i, size in enumerate(sizes):
            if price[i] > 0:
                total = best[: capacity + 1 - size] + price[i]
                better = np.flatnonzero(total > nxt[size:] + 1e-12) + size
                nxt[better], chosen[better] = total[better - size], i
        layers.append(chosen)
        best = nxt
    column, room = np.zeros(len(sizes)), capacity
    for chosen in reversed(layers):
        i = chosen[room]
        if i >= 0:
            column[i] += 1
            room -= sizes[i]
    return float(best[capacity]), column


def _use(packing: Packing, configuration: list[int], times: int, least: dict[int, int]) -> None:
    """New sequences of one configuration. Its places get the longest pieces that are left in their groups, and the
    last place the longest piece that fits the room the true lengths leave."""
    while times:
        want: dict[int, int] = {}
        room = packing.capacity
        for size in configuration[:-1]:
            length = packing.longest(size, want)
            if length < least[size]:
                return
            want[length] = want.get(length, 0) + 1
            room -= length
        length = packing.longest(room, want)
        if not length:
            return
        want[length] = want.get(length, 0) + 1
        n = min([times] + [packing.left[length] // k for length, k in want.items()])
        first, offset = packing.new(n), 0
        for length, k in want.items():
            packing.put(length, n * k, first, k, offset)
            offset += length * k
        packing.offer(packing.capacity - offset, first, n)
        times -= n


def _plan_table(spark: SparkSession, intervals: list[Interval]) -> DataFrame:
    schema = "of_length long, first_number long, last_number long, first_sequence long, each long, first_offset long"
    rows = [(i.length, i.first, i.last, i.sequence, i.each, i.offset) for i in intervals]
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------------ tokens


class Words(dict):
    """Ids of the words that come before the merges, as bytes; a dict of those seen lately.

    In a text of Latin characters nothing of the tokenizer's normalisation is left to do but to lower the case, and
    `LATIN_WORDS` splits it as the tokenizer does; new words then go straight to the merges, all of a slice together.
    Other texts go through the tokenizer as they are. When the dict is full, a new one begins, and what is still asked
    for moves over from the one before.
    """

    def __init__(self, tokenizer: str, merges: str, added: list[str] | None) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.added = tokenizer, added
        self.merges = Tokenizer.from_str(merges)
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.before: dict[str, bytes] = {}

    @staticmethod
    def parts(tokenizer: str) -> tuple[str, str, list[str] | None]:
        """What tasks get: the tokenizer, its merges alone, and the added tokens, which send a text that has one to the
        tokenizer itself. None sends all texts there, if the tokenizer is not the one whose split is known."""
        own = json.loads(tokenizer)
        splits = [p["pattern"].get("Regex") for p in (own["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"]
        kinds = [n["type"] for n in (own["normalizer"] or {}).get("normalizers", [])]
        known = splits == [SPLIT] and kinds == ["NFC", "Replace", "Lowercase"]
        return tokenizer, json.dumps(own | NOTHING_BEFORE), [t["content"] for t in own["added_tokens"]] if known else None

    @cached_property
    def whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.tokenizer)

    def _plain(self, text: str, small: str) -> bool:
        """Whether a text and its lower case are of Latin characters, without added tokens."""
        if self.added is None or any(token in text for token in self.added):
            return False
        try:
            small.encode("latin-1")
        except UnicodeEncodeError:
            return not WIDE(small)
        return True

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if any(len(text) > STRETCH for text in texts):
            return [b"".join(self._short([part])[0] for part in stretches(text)) for text in texts]
        return self._short(texts)

    def _short(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = []
        words: list[str] = []
        ends = [0]
        for text in texts:
            small = text.lower()
            if self._plain(text, small):
                out.append(None)
                words += LATIN_WORDS(small)
            else:
                out.append(np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
            ends.append(len(words))
        if len(self) > REMEMBERED:
            self.before = dict(self)
            self.clear()
        ids = list(map(self.get, words))
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            new = list({words[i] for i in missing})
            self._learn(new)
            for i in missing:
                ids[i] = self[words[i]]
            for word in new:
                if len(word) > LONGEST:
                    del self[word]
        return [b"".join(ids[i:j]) if x is None else x for x, i, j in zip(out, ends, ends[1:])]

    def _learn(self, words: list[str]) -> None:
        before = {w: x for w in words if (x := self.before.get(w)) is not None}
        self.update(before)
        new = [w for w in words if w not in before]
        if new:
            inputs = [w if w.isascii() and w.isalpha() else w.encode().decode("latin-1").translate(self.letters) for w in new]
            encoded = self.merges.encode(inputs, is_pretokenized=True, add_special_tokens=False)
            ids, of = np.array(encoded.ids, "<u4"), np.array(encoded.word_ids, np.int64)
            raw, ends = ids.tobytes(), (np.searchsorted(of, np.arange(len(new)), side="right") * 4).tolist()
            self.update((w, raw[i:j]) for w, i, j in zip(new, [0, *ends[:-1]], ends, strict=True))


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """Parts of a long text, cut at white space."""
    start, n = 0, len(text)
    space = re.compile("[ \t\n\r]")
    while n - start > size:
        found = space.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.end()
    yield text[start:]


def _pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str, with_ids: bool
) -> DataFrame:
    """Pieces with the task that made them (`part`) and their number within that task and length (`nth`)."""
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = ("piece", "start", "length", "ids_crc32", "part", "nth")
    kinds = (T.IntegerType(), *[T.LongType()] * 3, T.IntegerType(), T.LongType())
    fields = [T.StructField("id", given.schema["id"].dataType), *map(T.StructField, names, kinds)]
    schema = T.StructType(fields + [T.StructField("ids", T.ArrayType(T.LongType()))] * with_ids)
    shared = docs.sparkSession.sparkContext.broadcast(Words.parts(tokenizer))
    key = hashlib.sha256(tokenizer.encode()).hexdigest()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept_in_worker(key, lambda: Words(*shared.value))
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows in slices(batch, "text"):
                yield cut_up(rows, words, part, seen)

    def cut_up(rows: pa.RecordBatch, words: Words, part: int, seen: np.ndarray) -> pa.RecordBatch:
        source, piece, length, crc, ids = [], [], [], [], []
        for i, data in enumerate(words.encode(rows.column("text").to_pylist())):
            data += end
            for k, at in enumerate(range(0, len(data), 4 * capacity)):
                part_of = data[at : at + 4 * capacity]
                source.append(i)
                piece.append(k)
                length.append(len(part_of) // 4)
                crc.append(zlib.crc32(part_of))
                if with_ids:
                    ids.append(np.frombuffer(part_of, "<u4").astype(np.int64))
        lengths = np.array(length, np.int64)
        order = np.argsort(lengths, kind="stable")
        among = np.empty(len(order), np.int64)
        ranked = lengths[order]
        among[order] = np.arange(len(order)) - np.searchsorted(ranked, ranked)
        nth = seen[lengths] + among
        seen[:] += np.bincount(lengths, minlength=capacity + 1)
        columns = [
            rows.column("id").take(pa.array(source, pa.int64())),
            pa.array(piece, pa.int32()),
            pa.array(np.array(piece, np.int64) * capacity),
            pa.array(lengths),
            pa.array(crc, pa.int64()),
            pa.array(np.full(len(source), part, np.int32)),
            pa.array(nth),
        ]
        columns += [pa.array(ids, pa.list_(pa.int64()))] * with_ids
        return pa.RecordBatch.from_arrays(columns, schema.names)

    return given.mapInArrow(run, schema)
