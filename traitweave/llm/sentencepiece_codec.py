"""SentencePiece encoding and decoding with the pieces and scores of a model file.

An Aho-Corasick automaton over the pieces reads a stretch of text once; at each position it follows the output links
to all pieces that end there and relaxes the best score (Viterbi). No piece holds a space mark after another
character, so stretches that begin at a space mark are independent: repeated ones are looked up, and the short new
ones of a slice of texts go through the automaton side by side in numpy. Long stretches and those with characters that
no piece has go through it one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from traitweave.llm.common import received, shipped, slices

#: Stands for a space in pieces.
MARK = "▁"
#: Stretches remembered by a task; bytes of the longest that is remembered and taken side by side with others.
REMEMBERED, LONGEST = 400_000, 48
#: What SentencePiece takes off the worst score for a character without a piece.
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Pieces:
    """Text, score and kind of each piece by id; kinds: n(ormal), b(yte), or - for what never stands for text."""

    texts: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: str

    @classmethod
    def load(cls, path: str) -> Pieces:
        """Read on the driver, from a model file with byte fallback; tasks get the pieces with the plan."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        silent = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
        return cls(
            tuple(model.id_to_piece(i) for i in ids),
            tuple(model.get_score(i) for i in ids),
            "".join("-" if silent[i] else "b" if model.is_byte(i) else "n" for i in ids),
        )


class Encoder(dict):
    """Ids of a stretch of text, as little-endian 32-bit bytes; a dict of the stretches seen so far."""

    def __init__(self, pieces: Pieces) -> None:
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        normal = [i for i, kind in enumerate(pieces.kinds) if kind == "n"]
        for i in normal:
            self.automaton.add_word(pieces.texts[i], (len(pieces.texts[i]), pieces.scores[i], i))
        self.automaton.make_automaton()
        self.table = ByteAutomaton({pieces.texts[i].encode(): (i, pieces.scores[i]) for i in normal})
        self.known = {pieces.texts[i] for i in normal if len(pieces.texts[i]) == 1}
        self.unknown = min(pieces.scores[i] for i in normal) - UNKNOWN_PENALTY
        self.bytes = {int(pieces.texts[i][3:5], 16): i for i, kind in enumerate(pieces.kinds) if kind == "b"}
        if len(self.bytes) < 256:
            raise ValueError("the model has no byte fallback; some texts could not be encoded without loss")
        if any(re.search(f"[^{MARK}]{MARK}", pieces.texts[i]) for i in normal):
            raise ValueError("the model has pieces over several words")
        apart = "" if any("\n" in pieces.texts[i] for i in normal) else "\n"
        self.stretches = re.compile(f"{MARK}*[^{MARK}{apart}]+|{MARK}+" + "|\n+" * bool(apart)).findall
        self.mark = np.array([self.bytes[b] for b in MARK.encode()], "<i4").tobytes()

    def __missing__(self, stretch: str) -> bytes:
        ids = np.array(self.best_path(stretch), "<i4").tobytes()
        if len(stretch) <= LONGEST and len(self) < REMEMBERED:
            self[stretch] = ids
        return ids

    def learn(self, stretches: set[str]) -> None:
        """Remember the stretches that are short and new."""
        if len(self) + len(stretches) > REMEMBERED:
            self.clear()
        new = [s for s in stretches if s not in self and len(s) <= LONGEST and self.known.issuperset(s)]
        new = sorted(((b, s) for s in new if len(b := s.encode()) <= LONGEST), key=lambda x: -len(x[0]))
        for start in range(0, len(new), 20_000):
            part = new[start : start + 20_000]
            self.update(zip((s for _, s in part), self.table.best_paths([b for b, _ in part]), strict=True))

    def split(self, text: str) -> list[list[str]]:
        """The stretches of a text, in parts between which a space mark of the text itself stood."""
        if not text:
            return []
        first, *rest = text.split(MARK)
        return [self.stretches(part.replace(" ", MARK)) for part in (MARK + first, *rest)]

    def best_path(self, stretch: str) -> list[int]:
        n = len(stretch)
        best, back = [0.0] + [-np.inf] * n, [(0, 0)] * (n + 1)
        strange = [i for i, c in enumerate(stretch) if c not in self.known]
        strange.reverse()
        for end, (size, score, piece) in self.automaton.iter(stretch):
            while strange and strange[-1] <= end:  # characters without a piece of their own, before this place
                i = strange.pop()
                if best[i] + self.unknown > best[i + 1]:
                    best[i + 1], back[i + 1] = best[i] + self.unknown, (i, -1)
            total = best[end + 1 - size] + score
            if total > best[end + 1]:
                best[end + 1], back[end + 1] = total, (end + 1 - size, piece)
        for i in reversed(strange):
            if best[i] + self.unknown > best[i + 1]:
                best[i + 1], back[i + 1] = best[i] + self.unknown, (i, -1)
        ids: list[int] = []
        at = n
        while at:
            start, piece = back[at]
            ids += [piece] if piece >= 0 else [self.bytes[b] for b in reversed(stretch[start:at].encode())]
            at = start
        return ids[::-1]

    def __call__(self, texts: list[str | None]) -> list[bytes | None]:
        """Ids of whole texts. A space mark in a text itself is written as bytes, so that it comes back."""
        found = [None if text is None else self.split(text) for text in texts]
        self.learn({s for parts in found if parts for part in parts for s in part})
        look = self.__getitem__
        return [None if parts is None else self.mark.join([b"".join(map(look, p)) for p in parts]) for parts in found]


class ByteAutomaton:
    """Aho-Corasick over the bytes of pieces, as tables: next state, and the chain of pieces that end at a state."""

    def __init__(self, pieces: dict[bytes, tuple[int, float]]) -> None:
        children: list[dict[int, int]] = [{}]
        level, ends = [0], {}
        for text, value in pieces.items():
            state = 0
            for byte in text:
                if byte not in children[state]:
                    children[state][byte] = len(children)
                    children.append({})
                    level.append(level[state] + 1)
                state = children[state][byte]
            ends[state] = (len(text), *value)
        n = len(children)
        self.next = np.zeros((n, 256), np.int32)
        fail = np.zeros(n, np.int32)
        #: At a state: the longest piece that ends there (0: none), and the state of the next shorter one.
        self.head, self.link = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.size, self.piece, self.score = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n)
        for state, value in ends.items():
            self.size[state], self.piece[state], self.score[state] = value
        own = np.zeros(n, bool)
        own[list(ends)] = True
        for state in sorted(range(n), key=level.__getitem__):  # the shorter states, such as fail[state], come first
            if state:
                self.link[state] = self.head[fail[state]]
                self.head[state] = state if own[state] else self.link[state]
                self.next[state] = self.next[fail[state]]
            for byte, child in children[state].items():
                fail[child] = self.next[state, byte] if state else 0
                self.next[state, byte] = child

    def best_paths(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, all of characters that are pieces; the longest text comes first."""
        n, sizes = len(texts), np.array([len(t) for t in texts])
        width = int(sizes[0])
        letters = np.zeros((n, width), np.uint8)
        letters[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(texts), np.uint8)
        letters = np.ascontiguousarray(letters.T)
        best, back = np.full((width + 1, n), -np.inf), np.zeros((width + 1, n), np.int32)
        best[0] = 0
        state = np.zeros(n, np.int32)
        running = np.searchsorted(-sizes, -np.arange(width), side="left")  # texts longer than t
        for t in range(width):
            state = self.next[state[: running[t]], letters[t, : running[t]]]
            ending, row = self.head[state], np.arange(running[t])
            top, last = best[t + 1], back[t + 1]
            while True:
                some = np.flatnonzero(ending)
                if not len(some):
                    break
                ending, row = ending[some], row[some]
                total = best[t + 1 - self.size[ending], row] + self.score[ending]
                better = total > top[row]
                top[row[better]] = total[better]
                last[row[better]] = ending[better]
                ending = self.link[ending]
        steps, row, at = [], np.arange(n), sizes.copy()
        while len(row):
            ending = back[at, row]
            steps.append((row, self.piece[ending]))
            at = at - self.size[ending]
            row, at = row[at > 0], at[at > 0]
        counts = np.bincount(np.concatenate([r for r, _ in steps]), minlength=n)
        ends = np.cumsum(counts)
        ids = np.zeros(ends[-1], "<i4")
        for k, (row, piece) in enumerate(steps):
            ids[ends[row] - 1 - k] = piece
        raw, cuts = ids.tobytes(), (ends * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]


def encode(docs: DataFrame, pieces: Pieces, text_col: str = "text", out_col: str = "tokens") -> DataFrame:
    """`docs` with the ids of its texts in `out_col` (array<int>); a column of that name is replaced.

    Null text gives null, empty text no ids. Any text comes back from `decode` byte for byte. Characters without a
    piece are written as bytes. Rows stay in their partitions; nothing is shuffled.
    """
    shared = shipped(docs.sparkSession, pieces)
    return _replaced(docs, out_col, T.ArrayType(T.IntegerType()), text_col, lambda: _encoder(received(shared)))


def decode(tokens: DataFrame, pieces: Pieces, tokens_col: str = "tokens", out_col: str = "decoded") -> DataFrame:
    """`tokens` with the text of its ids in `out_col`. Ids of control pieces give nothing; ids that are not in the
    model are an error; bytes that are no UTF-8 become U+FFFD. Null gives null."""
    shared = shipped(tokens.sparkSession, pieces)
    return _replaced(tokens, out_col, T.StringType(), tokens_col, lambda: _decoder(received(shared)))


def _encoder(pieces: Pieces):
    encoder = Encoder(pieces)

    def run(column: pa.Array) -> pa.Array:
        ids = encoder(column.to_pylist())
        ends = np.cumsum([0, *(0 if x is None else len(x) // 4 for x in ids)])
        offsets = pa.array(ends.astype(np.int32), mask=np.array([x is None for x in ids] + [False]))
        values = pa.array(np.frombuffer(b"".join(x for x in ids if x), "<i4"))
        return pa.ListArray.from_arrays(offsets, values)

    return run


def _decoder(pieces: Pieces):
    def raw(text: str, kind: str) -> bytes:
        return b"" if kind == "-" else bytes([int(text[3:5], 16)]) if kind == "b" else text.replace(MARK, " ").encode()

    table = [raw(t, k) for t, k in zip(pieces.texts, pieces.kinds, strict=True)]

    def run(column: pa.Array) -> pa.Array:
        out: list[str | None] = []
        for ids in column:
            if not ids.is_valid:
                out.append(None)
                continue
            text = b"".join(map(table.__getitem__, ids.values.to_numpy(zero_copy_only=False).tolist()))
            out.append(text.removeprefix(b" ").decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    return run


def _replaced(df: DataFrame, out_col: str, kind: T.DataType, source: str, make) -> DataFrame:
    rest = [c for c in df.columns if c != out_col]
    at = df.columns.index(source)
    schema = T.StructType([*(df.schema[c] for c in rest), T.StructField(out_col, kind)])
    kept = [df.columns.index(c) for c in rest]
    arrow = pa.list_(pa.int32()) if isinstance(kind, T.ArrayType) else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            parts = slices(batch, source) if pa.types.is_string(batch.schema.field(at).type) else _rows(batch)
            for piece in parts:
                columns = [piece.column(i) for i in kept] + [work(piece.column(at)).cast(arrow)]
                yield pa.RecordBatch.from_arrays(columns, [*rest, out_col])

    return df.mapInArrow(run, schema)


def _rows(batch: pa.RecordBatch, n: int = 500) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, n):
        yield batch.slice(start, n)
