"""Quality classifier: naive Bayes support vectors on n-gram indicators.

Indicators of hashed n-grams (of the bytes, and of the shape of the words: kinds of characters, doubled punctuation,
repeated words) are scaled by the log ratio of their counts in the two classes. A linear model with hinge loss is
fitted by dual coordinate descent on a bounded sample; a logistic curve on held-out examples turns its margin into a
probability. Whole texts are scored where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitweave.llm.common import Rolling, flat, received, shipped, slices
from traitweave.llm.labelled import GramBuckets, examples, fraction

BITS = 16
BYTE_GRAMS, SHAPE_GRAMS = (3,), (2, 4, 6)
#: Labelled texts for fitting.
SAMPLE = 5_000
#: Texts whose indicators are held at once.
ROWS = 256

SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[97:123], SHAPE[65:91], SHAPE[48:58] = ord("x"), ord("X"), ord("9")
SHAPE[[9, 11, 12, 13]] = ord(" ")
SHAPE[128:] = 0  # letters beyond ASCII: neither case nor kind is known from the byte
REPEATED = ord("=")


@dataclass(frozen=True)
class QualityModel:
    """weights: of each indicator, before the row is scaled to length one; squares: of the log ratios."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float


class Indicators:
    def __init__(self) -> None:
        self.bytes = GramBuckets(BYTE_GRAMS, BITS, seed=21)
        self.shapes = GramBuckets(SHAPE_GRAMS, BITS, seed=22)
        self.rolling = Rolling(23)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Text and bucket of each n-gram, repeats included."""
        data, at = flat(column)
        found = [*self.bytes(data, at), *self.shapes(*self._shape(data, at))]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([r for _, r in found]), np.concatenate([b for b, _ in found])

    def _shape(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        shape = SHAPE[data]
        white = (shape == 32) | (shape == 10)
        edge = np.concatenate([[True], (row[1:] != row[:-1]) | white[:-1]])[: len(data)]
        starts = np.flatnonzero(edge & ~white)
        last = np.concatenate([(row[1:] != row[:-1]) | white[1:], [True]])[: len(data)]
        ends = np.flatnonzero(last & ~white) + 1
        if len(starts):
            words = self.rolling.between(self.rolling.prefix(data), starts, ends)
            again = np.concatenate([[False], (words[1:] == words[:-1]) & (row[starts[1:]] == row[starts[:-1]])])
            shape[starts[again]] = REPEATED
        keep = shape != 0
        shape, row = shape[keep], row[keep]
        same = np.concatenate([[False], (shape[1:] == shape[:-1]) & (row[1:] == row[:-1])])[: len(shape)]
        third = same & np.concatenate([[False], same[:-1]])[: len(shape)]
        plain = (shape == ord("x")) | (shape == ord("X")) | (shape == ord("9")) | (shape == 32) | (shape == 10)
        keep = ~(same & plain) & ~third
        sizes = np.bincount(row[keep], minlength=len(at) - 1)
        return shape[keep], np.concatenate([[0], np.cumsum(sizes)])


def fit(pairs: list[tuple[str, int]], cost: float = 1.0, rounds: int = 15, seed: int = 5) -> QualityModel:
    """From (text, 0 or 1) pairs; every fifth pair only fits the logistic curve. Without pairs all scores are 0.5."""
    if not pairs:
        nothing = np.zeros(1 << BITS, np.float32)
        return QualityModel(nothing, nothing + 1, 0.0, 1.0, 0.0)
    indicators = Indicators()
    label = np.array([1 if good else 0 for _, good in pairs])
    rows: list[np.ndarray] = []  # held on the driver; each text goes when its row is made
    pairs = pairs[::-1]
    while pairs:
        rows.append(np.unique(indicators(pa.array([pairs.pop()[0]]))[1]).astype(np.uint16))
    held = np.arange(len(rows)) % 5 == 4
    learn = np.flatnonzero(~held)
    counts = np.ones((2, 1 << BITS))
    for i in learn:
        counts[label[i], rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    weight, bias = _hinge([rows[i] for i in learn], 2 * label[learn] - 1, ratio, cost, rounds, seed)
    model = QualityModel((weight * ratio).astype(np.float32), (ratio**2).astype(np.float32), bias, 1.0, 0.0)
    check = np.flatnonzero(held) if held.any() else learn
    margin = np.array([_margin(model, rows[i]) for i in check])
    slope, shift = _logistic(margin, label[check])
    return QualityModel(model.weights, model.squares, bias, slope, shift)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE
) -> QualityModel:
    """Fit on a sample of the rows of `labels` and their texts. Null labels and ids are left out; if no row is left,
    nothing is known and every text scores one half. The sample of ids is bounded and small, so it is broadcast to
    the texts."""
    usable = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(id_col, label_col)
    total = usable.count()
    if not total:
        return fit([])
    hashed = fraction(F.col(id_col))
    chosen = usable.filter(hashed < sample / total).orderBy(hashed, id_col, label_col).limit(2 * sample)
    texts = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)
    return fit(examples(texts, id_col, text_col, label_col, 2 * sample, by_label=False))


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id, score from 0 to 1 (higher: the good label is likelier). Null text counts as empty; empty
    texts get the score of a text without n-grams. Other columns are not read."""
    shared = shipped(docs.sparkSession, model)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(_score(shared), f"id {rows.schema['id'].dataType.simpleString()}, score double")


def filter_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of `docs`, all columns, whose score is at least `least`; scored and filtered in one pass."""
    shared = shipped(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators, model = Indicators(), received(shared)
        for batch in batches:
            for piece in slices(batch, text_col):
                yield piece.filter(pa.array(_scores(indicators, piece.column(text_col), model) >= least))

    return docs.mapInArrow(run, docs.schema)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators, model = Indicators(), received(shared)
        for batch in batches:
            for piece in slices(batch, "text"):
                scores = _scores(indicators, piece.column("text"), model)
                yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(scores)], ["id", "score"])

    return run


def _scores(indicators: Indicators, column: pa.Array, model: QualityModel) -> np.ndarray:
    tables = np.stack([model.weights, model.squares], axis=1)
    sums = []
    for start in range(0, len(column), ROWS):
        part = column.slice(start, ROWS)
        row, bucket = indicators(part)
        if len(row) * 16 < len(part) << BITS:
            key = np.unique(row << BITS | bucket)
            row, bucket = key >> BITS, key & ((1 << BITS) - 1)
            sums.append(np.stack([np.bincount(row, t[bucket], minlength=len(part)) for t in tables.T], axis=1))
        else:
            seen = np.zeros((len(part), 1 << BITS), np.float32)
            seen[row, bucket] = 1
            sums.append(seen @ tables)
    total = np.concatenate(sums).astype(float) if sums else np.zeros((0, 2))
    margin = total[:, 0] / np.sqrt(np.maximum(total[:, 1], 1e-9)) + model.bias
    return 1 / (1 + np.exp(-np.clip(model.slope * margin + model.shift, -500, 500)))


def _margin(model: QualityModel, buckets: np.ndarray) -> float:
    return float(model.weights[buckets].sum() / np.sqrt(max(model.squares[buckets].sum(), 1e-9)) + model.bias)


def _hinge(rows: list[np.ndarray], sign: np.ndarray, ratio: np.ndarray, cost: float, rounds: int, seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for hinge loss; rows are scaled to length one and have a constant for the bias."""
    rng = np.random.default_rng(seed)
    # The scaled values are made anew at each visit: all of them would take several times the memory of the rows.
    length = np.array([max(np.sqrt((ratio[r] ** 2).sum()), 1e-9) for r in rows])
    norm = np.array([((ratio[r] / n) ** 2).sum() + 1 for r, n in zip(rows, length, strict=True)])
    dual, weight, bias = np.zeros(len(rows)), np.zeros(len(ratio)), 0.0
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            values = ratio[rows[i]] / length[i]
            slack = sign[i] * (weight[rows[i]] @ values + bias) - 1
            new = min(max(dual[i] - slack / norm[i], 0.0), cost)
            if new != dual[i]:
                step = (new - dual[i]) * sign[i]
                weight[rows[i]] += step * values
                bias += step
                dual[i] = new
    return weight, bias


def _logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton's method, with smoothed targets so that separable examples stay finite."""
    good, bad = label.sum(), len(label) - label.sum()
    target = np.where(label == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -500, 500)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        d = p * (1 - p)
        h = np.array([[(d * margin**2).sum(), (d * margin).sum()], [(d * margin).sum(), d.sum()]]) + np.eye(2) * 1e-3
        change = np.clip(np.linalg.solve(h, g), -2, 2)
        slope, shift = slope - change[0], shift - change[1]
    return float(max(slope, 1e-3)), float(shift)
