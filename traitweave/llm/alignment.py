"""Alignment of the tokens of two tokenizers over the same bytes.

Tokens of both are intervals of a text's bytes. All intervals of a batch are sorted by start, a running maximum of
their ends is kept, and a group begins wherever a start reaches that maximum: there tokens of both have ended. Every
token of one tokenizer is linked with every token of the other in its group, and a pair of ids is counted by the
documents that hold it linked.

At scale: texts are tokenised once, stretch by stretch, and stretches seen lately are looked up. A new one that is a
Latin word with something after it is put together from the word and the rest, where no token reaches from one into the
other. What is stored for each text is the ids of its links, a pair once with its number of occurrences. Pairs are counted with map-side combining, so one that is in every document reaches the shuffle as a row
per task. The counts go back to the documents in two ways: those of the most frequent pairs, at most ``FREQUENT`` of
them, as broadcast arrays; the others, none of which is frequent, by a join. So no hot pair is shuffled and nothing
unbounded is broadcast.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitweave.llm.common import byte_letters, cut, kept_in_worker, slices

#: Pairs whose counts are broadcast (16 bytes each).
FREQUENT = 2_000_000
#: An id pair is one number: the A id times this, plus the B id.
SHIFT = 1 << 32
SPACE_MARK = "▁"
#: Texts are handled in slices of so many bytes, and longer ones in parts.
TEXT_BYTES = 1 << 20
#: Stretches remembered by a worker, and characters of the longest that is.
REMEMBERED, LONGEST = 150_000, 64
#: Stretches that are tokenised together, and words that are one text for the tokenizers.
TOGETHER, JOINED = 5_000, 200
#: A space between something that is no white space and a letter. A token of both tokenizers begins there, and both put
#: a space before a text, so the stretches between such spaces can be encoded as texts of their own.
BETWEEN = re.compile(r" (?<=\S )(?=[^\W\d_])")
LATIN = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
#: ASCII characters other than letters. Words of A end before them.
SIGN = r"[\x00-@\[-`{-\x7f]"
#: A word of Latin letters and what may follow it.
PLAIN = re.compile(f"([{LATIN}]+)({SIGN}.*)?", re.S).fullmatch
#: The word after which the rest of other words is learnt.
STAND_IN = "a"
#: Where the numbers of a text lie in one number: A tokens, B tokens, groups, links. Python's numbers do not overflow.
SHIFTS, FIELD = (0, 48, 96, 144), (1 << 48) - 1


def align(
    docs: DataFrame,
    a_json: str,
    b_model: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
    with_groups: bool = False,
) -> DataFrame:
    """For each document: `id`, `n_a` and `n_b` (tokens), `n_groups`, `n_links`, `n_best` (links whose pair is counted
    as often as any pair of its A id), `count_sum` (of the counts of all links), `groups_sha256` (of its groups, written
    ``a1,a2|b1;a3|b2,b3``) and, `with_groups`, that text itself as `groups`.

    `a_json` is the text of a byte-level tokenizers file, which encodes a space and the text, `b_model` the bytes of a
    SentencePiece model that adds the space itself. Special tokens are not added, and their names in a text are plain
    text. A text that is null or empty, or whose tokens' bytes are not the space and the text for both, has no tokens:
    zeros, and the empty string for groups and hash. Repeated rows count once each; rows without an id like others.
    An empty table gives no rows. Other columns are left out.
    """
    linked = cut(linked_ids(docs, a_json, b_model, id_col, text_col, with_groups))
    each = linked.select(F.explode(F.arrays_zip("a", "b")).alias("pair")).select("pair.a", "pair.b")
    pairs = cut(each.groupBy("a", "b").agg(F.count("*").alias("documents")))
    top = pairs.groupBy("a").agg(F.max("documents").alias("top"))
    counted = pairs.join(top, "a").select("a", "b", "documents", (F.col("documents") == F.col("top")).alias("best"))
    counted = cut(counted)
    least = _least_frequent(counted, frequent)
    head = counted.filter(F.col("documents") >= least).toPandas()
    found = linked.mapInArrow(_look_up(linked, head), _looked_up_schema(linked))
    rare = counted.filter(F.col("documents") < least)
    if least > 1:
        found = _add_rare(linked, found, rare)
    return found.drop("row")


def _least_frequent(counted: DataFrame, frequent: int) -> int:
    """The least power of two that is reached by the counts of at most `frequent` pairs; 1 if all pairs are few."""
    size = F.floor(F.log2("documents")).cast("int").alias("size")
    sizes = {r["size"]: r["count"] for r in counted.groupBy(size).count().collect()}  # one row per power of two
    total, power = 0, 63
    while power >= 0 and total + sizes.get(power, 0) <= frequent:
        total += sizes.get(power, 0)
        power -= 1
    return 1 << (power + 1)


def _look_up(linked: DataFrame, head):
    """Adds up the counts of the frequent pairs of each document."""
    pair = head["a"].to_numpy(np.int64) * SHIFT + head["b"].to_numpy(np.int64)
    order = np.argsort(pair)
    columns = [pair[order], head["documents"].to_numpy(np.int64)[order], head["best"].to_numpy(bool)[order]]
    shared = linked.sparkSession.sparkContext.broadcast(columns)
    names = _looked_up_schema(linked).names[:-2]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, documents, best = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                batch = whole.slice(start, 200)
                a, b, times = (batch.column(n).flatten().to_numpy(zero_copy_only=False) for n in ("a", "b", "times"))
                wanted = a.astype(np.int64) * SHIFT + b
                row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("a").offsets.to_numpy()))
                at = np.searchsorted(pair, wanted)
                known = at < len(pair)
                known[known] = pair[at[known]] == wanted[known]
                at, row, times = at[known], row[known], times[known]
                sums, bests = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
                np.add.at(sums, row, times * documents[at])
                np.add.at(bests, row, times * best[at])
                columns = [batch.column(n) for n in names] + [pa.array(bests), pa.array(sums)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "n_best", "count_sum"])

    return run


def _looked_up_schema(linked: DataFrame) -> T.StructType:
    kept = [f for f in linked.schema.fields if f.name not in ("a", "b", "times")]
    return T.StructType([*kept, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])


def _add_rare(linked: DataFrame, found: DataFrame, rare: DataFrame) -> DataFrame:
    """The counts of all other pairs, joined by pair and added up by row."""
    each = linked.select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("p"))
    sums = (
        each.select("row", "p.a", "p.b", "p.times")
        .join(rare, ["a", "b"])
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("best").cast("long")).alias("rare_best"),
            F.sum(F.col("times") * F.col("documents")).alias("rare_sum"),
        )
    )
    joined = found.join(sums, "row", "left")
    return joined.withColumns(
        {
            "n_best": F.col("n_best") + F.coalesce("rare_best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("rare_sum", F.lit(0)),
        }
    ).select(found.columns)


# ------------------------------------------------------------------ tokens and links


def linked_ids(
    docs: DataFrame, a_json: str, b_model: bytes, id_col: str, text_col: str, with_groups: bool = False
) -> DataFrame:
    """For each document its numbers, its groups and its linked pairs: ids `a` and `b` of each distinct pair and
    `times`, how often it is linked. `row` tells rows apart."""
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    numbers = [T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")]
    texts = [T.StructField(n, T.StringType()) for n in ("groups_sha256", *["groups"] * with_groups)]
    lists = [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("a", "b", "times")]
    schema = T.StructType([given.schema["id"], given.schema["row"], *numbers, *texts, *lists])
    shared = docs.sparkSession.sparkContext.broadcast((a_json, b_model))
    key = hashlib.sha256(a_json.encode() + b_model).hexdigest()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept_in_worker(key, lambda: Stretches(Tokenizers(*shared.value)))
        for batch in batches:
            for rows in slices(batch, "text", TEXT_BYTES):
                found = _aligned(rows.column("text").to_pylist(), known, with_groups)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("row"), *_columns(found, with_groups)], schema.names
                )

    return given.mapInArrow(run, schema)


class Text:
    """The numbers, groups and links of a text, added up from its stretches in turn."""

    def __init__(self) -> None:
        self.numbers = 0
        self.digest = hashlib.sha256()
        self.groups: list[bytes] = []
        self.pair, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, found: list[Stretch], keep_groups: bool) -> None:
        numbers, groups, links = zip(*found, strict=True) if found else ((), (), ())
        written = b";".join(groups)
        self.digest.update((b";" if self.numbers else b"") + written)
        self.groups += [written] * keep_groups
        self.numbers += sum(numbers)
        pairs = np.sort(np.frombuffer(b"".join(links), np.int64))
        first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])[: len(pairs)])
        pair, times = pairs[first], np.diff(np.append(first, len(pairs)))
        if len(self.pair):
            pair, of = np.unique(np.concatenate([self.pair, pair]), return_inverse=True)
            times = np.bincount(of, np.concatenate([self.times, times]), len(pair)).astype(np.int64)
        self.pair, self.times = pair, times


def _aligned(texts: list[str | None], known: Stretches, keep_groups: bool = False) -> list[Text | None]:
    """Texts with tokens of both tokenizers for all their bytes; None for the others."""
    if len(texts) == 1 and texts[0] and len(texts[0]) > TEXT_BYTES:
        return [_in_parts(texts[0], known, keep_groups)]
    out: list[Text | None] = []
    for found in known.of([text or "" for text in texts]):
        total = Text() if found and all(found) else None
        if total:
            total.add(found, keep_groups)
        out.append(total)
    return out


def _in_parts(text: str, known: Stretches, keep_groups: bool) -> Text | None:
    total = Text()
    for part in parts(text):
        (found,) = known.of([part])
        if not all(found):
            return None
        total.add(found, keep_groups)
    return total


def _columns(found: list[Text | None], with_groups: bool) -> list[pa.Array]:
    """The columns after `row` of `linked_ids`."""
    nothing = np.zeros(0, np.int64)
    numbers = [[t.numbers >> shift & FIELD if t else 0 for t in found] for shift in SHIFTS]
    pair = np.concatenate([t.pair if t else nothing for t in found]) if found else nothing
    times = np.concatenate([t.times if t else nothing for t in found]) if found else nothing
    offsets = pa.array(np.cumsum([0, *(len(t.pair) if t else 0 for t in found)]).astype(np.int32))
    return [
        *(pa.array(n, pa.int64()) for n in numbers),
        pa.array([t.digest.hexdigest() if t else "" for t in found], pa.string()),
        *[pa.array([b";".join(t.groups).decode() if t else "" for t in found], pa.string())] * with_groups,
        *(pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (pair // SHIFT, pair % SHIFT, times)),
    ]


#: Of a stretch of text: its numbers in one, its groups as text, and the pair of each of its links. Plain tuples of plain
#: values are left alone by the garbage collector.
Stretch = tuple[int, bytes, bytes]


class Stretches(dict):
    """The alignment of stretches of text seen lately; None for those whose tokens' bytes differ from the text.

    New stretches of a text are tokenised and grouped together. When the dict is full, a new one begins, and what is
    still asked for moves over from the one before.
    """

    def __init__(self, tokenizers: Tokenizers) -> None:
        super().__init__()
        self.tokenizers = tokenizers
        self.before: dict[str, Stretch | None] = {}

    def of(self, texts: list[str]) -> list[list[Stretch | None]]:
        """The stretches of each text in order; an empty text has none."""
        split = [(BETWEEN.split(text) if self.tokenizers.apart else [text]) if text else [] for text in texts]
        if len(self) > REMEMBERED:
            self.before = dict(self)
            self.clear()
        collects = gc.isenabled()
        gc.disable()  # many values are made here and no cycles
        try:
            new = self._missing(set().union(*split))
            self._make(new)
            found = [list(map(self.__getitem__, stretches)) for stretches in split]
        finally:
            if collects:
                gc.enable()
        for stretch in new:
            if len(stretch) > LONGEST:
                del self[stretch]
        return found

    def _missing(self, wanted: set[str]) -> set[str]:
        """The stretches not seen lately; those in the dict before move over."""
        absent = wanted.difference(self)
        new = absent.difference(self.before)
        self.update((s, self.before[s]) for s in absent - new)
        return new

    def _make(self, new: set[str]) -> None:
        """Puts stretches together from words and what follows them, and learns what these lack."""
        if not self.tokenizers.ends_at_sign:
            self._learn(list(new), self.tokenizers)
            return
        words, others, both = set(), set(), []
        for stretch in new:
            m = PLAIN(stretch) if len(stretch) <= LONGEST else None
            if not m:
                others.add(stretch)
            elif not m[2]:
                words.add(stretch)
            elif m[1] == STAND_IN:
                others.add(stretch)
            else:
                both.append((stretch, m[1], STAND_IN + m[2]))
        if both:
            words |= self._missing({STAND_IN, *(word for _, word, _ in both)})
            others |= self._missing({rest for _, _, rest in both})
        self._learn(list(words), self.tokenizers.words)
        self._learn(list(others), self.tokenizers)
        for stretch, word, rest in both:
            self[stretch] = _joined(self[word], self[STAND_IN], self[rest])

    def _learn(self, new: list[str], tokenize: Callable[[list[str]], tuple[Tokens, Tokens]]) -> None:
        for start in range(0, len(new), TOGETHER):
            part = new[start : start + TOGETHER]
            a, b = tokenize(part)
            links = Links(a, b, len(part))
            numbers = [x.tolist() for x in (a.counts, b.counts, links.n_groups, links.n_links)]
            written, stops = links.written(self.tokenizers.decimals)
            pairs, ends = links.pair.tobytes(), (np.cumsum(links.n_links) * 8).tolist()
            each = zip(part, *numbers, [0, *stops[:-1]], stops, [0, *ends[:-1]], ends, strict=True)
            for stretch, n_a, n_b, n_groups, n_links, begin, stop, first, end in each:
                number = n_a | n_b << 48 | n_groups << 96 | n_links << 144
                self[stretch] = (number, written[begin : stop - 1], pairs[first:end]) if stop > begin else None


def _joined(word: Stretch | None, other: Stretch | None, other_and_rest: Stretch | None) -> Stretch | None:
    """A word and what follows it, told from another word and that word with the same after it."""
    if not (word and other and other_and_rest):
        return None
    number, groups, pairs = other_and_rest
    return word[0] + number - other[0], word[1] + groups[len(other[1]) :], word[2] + pairs[len(other[2]) :]


@dataclass(frozen=True)
class Tokens:
    """Tokens of many texts one after another: ids, numbers of bytes, and how many belong to each text."""

    ids: np.ndarray
    sizes: np.ndarray
    counts: np.ndarray


class Tokenizers:
    def __init__(self, a_json: str, b_model: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer, pre_tokenizers

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = byte_letters()
        own = json.loads(a_json)
        before = own["pre_tokenizer"] or {}
        #: The merges alone, of words between spaces, where what comes before them is known to be the split of words and
        #: nothing else.
        known = own["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        bare = {"pre_tokenizer": None, "post_processor": None, "added_tokens": []}
        self.merges = Tokenizer.from_str(json.dumps(own | bare)) if known and not before.get("add_prefix_space") else None
        if self.merges:
            self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = {byte: letter for letter, byte in letters.items()}
        added = self.a.get_added_tokens_decoder().values()
        special = {t.content: t.content.encode() for t in added}
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for piece, i in vocabulary.items():
            self.a_bytes[i] = special.get(piece) or bytes(letters[c] for c in piece)
        self.b_bytes = [self._b_piece(i) for i in range(self.b.get_piece_size())]
        #: Whether no B piece goes on after a space, so that stretches are independent.
        self.apart = not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", self.b.id_to_piece(i)) for i in range(len(self.b_bytes)))
        #: Whether no token reaches from a Latin word into a sign after it, so that both are independent.
        crossing = re.compile(f"[{LATIN}]{SIGN}")
        pieces = [i for i in range(len(self.b_bytes)) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        within = self.merges and all(t.special for t in added) and not any(crossing.search(self.b.id_to_piece(i)) for i in pieces)
        self.ends_at_sign = bool(within and self.apart)
        self.decimals = decimals(max(len(self.a_bytes), len(self.b_bytes)))
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)

    def _b_piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE_MARK, " ").encode()

    def __call__(self, texts: list[str]) -> tuple[Tokens, Tokens]:
        """The tokens of each text, none where the bytes of one tokenizer's differ from the text."""
        raw = [(" " + text).encode() for text in texts]
        a = self._a_ids(texts)
        b = self.b.encode(texts, num_threads=1)
        found = self._tokens(a, self.a_sizes), self._tokens(b, self.b_sizes)
        if self._same(raw, *found):
            return found
        for i, text in enumerate(raw):
            if b"".join(map(self.a_bytes.__getitem__, a[i])) != text or b"".join(map(self.b_bytes.__getitem__, b[i])) != text:
                a[i], b[i] = [], []
        return self._tokens(a, self.a_sizes), self._tokens(b, self.b_sizes)

    def _a_ids(self, texts: list[str]) -> list[list[int]]:
        """A ids of a space and each text."""
        return [e.ids for e in self.a.encode_batch([" " + text for text in texts], add_special_tokens=False)]

    def words(self, words: list[str]) -> tuple[Tokens, Tokens]:
        """The tokens of each Latin word. A space stands before each of them, so many are one text for both, and the
        bytes tell which tokens are whose; for A they are words already and go straight to the merges."""
        a, b, ends = [], [], []
        for start in range(0, len(words), JOINED):
            part = words[start : start + JOINED]
            text = " ".join(part)
            if not text.isascii():
                bare = (" " + text).encode().decode("latin-1").translate(self.letters)
                written = bare.split(self.letters[32])[1:]
            else:
                written = part
            a += self.merges.encode_batch_fast([" ".join([self.letters[32] + w for w in written])], add_special_tokens=False)[0].ids
            b += self.b.encode(text)
            ends += [len(w) + 1 for w in written]
        ends = np.cumsum(ends)
        raw = (" " + " ".join(words)).encode()
        found = []
        for given, sizes, pieces in ((a, self.a_sizes, self.a_bytes), (b, self.b_sizes, self.b_bytes)):
            ids = np.array(given, np.int64)
            stops = np.cumsum(sizes[ids])
            last = np.searchsorted(stops, ends)
            whole = b"".join(map(pieces.__getitem__, given)) == raw and np.array_equal(stops[last], ends)
            if not whole:
                return self(words)
            found.append(Tokens(ids, sizes[ids], np.diff(last, prepend=-1)))
        return found[0], found[1]

    def _same(self, raw: list[bytes], a: Tokens, b: Tokens) -> bool:
        """Whether all tokens of both have the bytes of the texts, told from all texts at once."""
        wanted, joined = np.array([len(x) for x in raw]), b"".join(raw)
        for tokens, pieces in ((a, self.a_bytes), (b, self.b_bytes)):
            row = np.repeat(np.arange(len(raw)), tokens.counts)
            if not np.array_equal(np.bincount(row, tokens.sizes, len(raw)), wanted):
                return False
            if b"".join(map(pieces.__getitem__, tokens.ids.tolist())) != joined:
                return False
        return True

    @staticmethod
    def _tokens(ids: list[list[int]], sizes: np.ndarray) -> Tokens:
        counts = np.array([len(x) for x in ids], np.int64)
        joined = np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum()))
        return Tokens(joined, sizes[joined], counts)


def groups_of(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and of each B token, numbered over all texts in order.

    The bytes of all texts are one line; a token is the interval of its bytes there.
    """
    ends = np.concatenate([np.cumsum(a.sizes), np.cumsum(b.sizes)])
    starts = ends - np.concatenate([a.sizes, b.sizes])
    order = np.lexsort((-ends, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[: len(a.ids)], group[len(a.ids) :]


class Links:
    """Groups and links of the tokens of `n` texts; `pair` holds the pair of each link, text by text."""

    def __init__(self, a: Tokens, b: Tokens, n: int) -> None:
        self.a, self.b, self.n = a, b, n
        a_group, b_group = groups_of(a, b)
        n_groups = int(a_group[-1]) + 1 if len(a_group) else 0
        self.a_in, self.b_in = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
        self.row = np.empty(n_groups, np.int64)
        self.row[a_group] = np.repeat(np.arange(n), a.counts)
        self.n_groups = np.bincount(self.row, minlength=n)
        self.n_links = np.bincount(self.row, self.a_in * self.b_in, n).astype(np.int64)

        # every A token meets all B tokens of its group
        meets = self.b_in[a_group]
        left = np.repeat(np.arange(len(a.ids)), meets)
        place = np.arange(len(left)) - np.repeat(np.cumsum(meets) - meets, meets)
        right = (np.cumsum(self.b_in) - self.b_in)[a_group[left]] + place
        self.pair = a.ids[left] * SHIFT + b.ids[right]

    def texts(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        most = max((int(x.ids.max()) for x in (self.a, self.b) if len(x.ids)), default=0)
        written, stops = self.written(decimals(most + 1))
        return [written[i:j][:-1].decode() for i, j in zip([0, *stops[:-1]], stops, strict=True)]

    def written(self, decimals: np.ndarray) -> tuple[bytes, list[int]]:
        """The groups of all texts: ids in order, each with its separator, and where those of each text stop."""
        total = self.a_in + self.b_in  # in each group its A tokens, then its B tokens
        begins = np.cumsum(total) - total
        ids = np.empty(int(total.sum()), np.int64)
        a_first, b_first = np.cumsum(self.a_in) - self.a_in, np.cumsum(self.b_in) - self.b_in
        ids[np.repeat(begins - a_first, self.a_in) + np.arange(len(self.a.ids))] = self.a.ids
        ids[np.repeat(begins + self.a_in - b_first, self.b_in) + np.arange(len(self.b.ids))] = self.b.ids
        letters = decimals[ids]
        marks = letters[:, -1]
        marks[begins + self.a_in - 1] = ord("|")
        marks[begins + total - 1] = ord(";")
        held = letters != 0
        sizes = np.add.reduceat(held.sum(1), begins) if len(begins) else begins
        stops = np.cumsum(np.bincount(self.row, sizes, self.n).astype(np.int64)).tolist()
        return letters[held].tobytes(), stops


def decimals(n: int) -> np.ndarray:
    """The numbers below `n` in decimal, each a row of bytes with a comma at its end and zero bytes between."""
    digits = np.arange(n).astype("S")
    rows = np.full((n, digits.itemsize + 1), ord(","), np.uint8)
    rows[:, :-1] = digits.view(np.uint8).reshape(n, -1)
    return rows


def parts(text: str, size: int = TEXT_BYTES) -> Iterator[str]:
    """A long text in parts of some `size` characters, without the spaces between them."""
    start = 0
    while len(text) - start > size:
        found = BETWEEN.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.end()
    yield text[start:]
