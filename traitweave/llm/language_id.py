"""Language ID: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

Subwords are byte n-grams of case-folded letters and single spaces. A text is the mean of its subwords' vectors, which a
linear layer turns into a score for each language. Fitting takes a bounded sample on the driver. For prediction both
layers fold into one table of bucket by language, and whole texts are scored where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitweave.llm.common import flat, received, shipped, slices
from traitweave.llm.labelled import GramBuckets, examples

BITS, WIDTH, SIZES = 15, 16, (1, 2, 3, 4)
#: Labelled texts for fitting, in equal parts of each language.
SAMPLE = 3_000
UNDETERMINED = "und"

FOLD = np.full(256, 32, np.uint8)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class LanguageModel:
    """languages; table: score of each bucket for each language; temperature; least: probability below which to reject."""

    languages: tuple[str, ...]
    table: np.ndarray
    temperature: float
    least: float


class Subwords:
    def __init__(self) -> None:
        self.grams = GramBuckets(SIZES, BITS, seed=11)

    def __call__(self, column: pa.Array):
        data, at = flat(column)
        folded = FOLD[data]
        # capitals of the Latin-1 letters, U+00C0 to U+00DE, have C3 before them
        latin = np.zeros(len(data), bool)
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        folded = np.where(latin, folded + 32, folded).astype(np.uint8)
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        keep = np.ones(len(data), bool)
        keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32)
        sizes = np.bincount(row[keep], minlength=len(at) - 1)
        return self.grams(folded[keep], np.concatenate([[0], np.cumsum(sizes)]))


def fit(pairs: list[tuple[str, str]], seed: int = 3, epochs: int = 6, rate: float = 0.5) -> LanguageModel:
    """From (text, language) pairs; short stretches of each text are learned too. A tenth of the pairs calibrates."""
    if not pairs:
        return LanguageModel((), np.zeros((1 << BITS, 0), np.float32), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    languages = tuple(sorted({language for _, language in pairs}))
    number = {language: i for i, language in enumerate(languages)}
    table = rng.normal(0, 1 / WIDTH, (1 << BITS, WIDTH))
    layer = np.zeros((WIDTH, len(languages)))
    texts, labels = [], []
    for text, language in pairs:
        words = text.split()
        texts.append(text)
        for size in (2, 8):
            start = int(rng.integers(0, max(1, len(words) - size)))
            texts.append(" ".join(words[start : start + size]))
        labels += [number[language]] * 3
    bags = _bags(texts)
    held = np.arange(len(bags)) // 3 % 10 == 0
    learn = np.flatnonzero(~held | (len(pairs) < 20))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(learn):
            buckets, weights = bags[i]
            if not len(buckets):
                continue
            mean = weights @ table[buckets]
            wrong = _softmax(mean @ layer)
            wrong[labels[i]] -= 1
            change = layer @ wrong
            layer -= step * np.outer(mean, wrong)
            table[buckets] -= (step * len(buckets) ** 0.5) * weights[:, None] * change
    scores = table @ layer
    check = [i for i in (np.flatnonzero(held) if held.any() else learn) if len(bags[i][0])]
    logits = np.array([bags[i][1] @ scores[bags[i][0]] for i in check]).reshape(len(check), len(languages))
    truth = np.array([labels[i] for i in check], int)
    temperature = min(np.geomspace(0.2, 10, 30), key=lambda t: _loss(logits / t, truth))
    # rejected: less sure than all but one in a hundred of the right calibration texts
    sure = _softmax(logits / temperature).max(axis=1)[logits.argmax(axis=1) == truth] if len(check) else np.zeros(0)
    least = float(np.quantile(sure, 0.01)) if len(sure) else 0.0
    return LanguageModel(languages, scores.astype(np.float32), float(temperature), least)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> LanguageModel:
    """Fit on a sample of the labelled rows of `docs`; without any, every text is `und` with score 0 and rejected."""
    return fit(examples(docs, id_col, text_col, lang_col, sample, by_label=True))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id, lang_pred, score (calibrated probability), rejected (less sure than the model's bound).

    Text that is null or has no letter is `und` with score 0 and rejected. Whole texts count, whatever their length.
    Other columns are not read.
    """
    shared = shipped(docs.sparkSession, model)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), text.rlike(r"\p{L}").alias("letters"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_predict(shared), f"id {kind}, lang_pred string, score double, rejected boolean")


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords, model = Subwords(), received(shared)
        names = np.array([*model.languages, UNDETERMINED], object)
        for batch in batches:
            for piece in slices(batch, "text"):
                letters = piece.column("letters").to_numpy(zero_copy_only=False)
                if not model.languages:
                    letters, chance = np.zeros(len(letters), bool), np.zeros((len(letters), 1))
                else:
                    chance = _softmax(_logits(subwords, piece.column("text"), model) / model.temperature)
                best = chance.argmax(axis=1)
                best, score = np.where(letters, best, len(names) - 1), np.where(letters, chance.max(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("id"),
                        pa.array(names[best], pa.string()),
                        pa.array(np.clip(score, 0, 1).astype(float)),
                        pa.array(~letters | (score < model.least)),
                    ],
                    ["id", "lang_pred", "score", "rejected"],
                )

    return run


def _logits(subwords: Subwords, column: pa.Array, model: LanguageModel) -> np.ndarray:
    n, width = len(column), len(model.languages)
    total, count = np.zeros((n, width)), np.zeros(n)
    for buckets, row in subwords(column):
        ends = np.searchsorted(row, np.arange(n + 1))
        for k in range(width):
            sums = np.concatenate([[0.0], np.cumsum(model.table[buckets, k], dtype=np.float64)])
            total[:, k] += sums[ends[1:]] - sums[ends[:-1]]
        count += np.diff(ends)
    return total / np.maximum(count, 1)[:, None]


def _bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Different buckets of each text and their shares."""
    subwords, bags = Subwords(), []
    for text in texts:
        found = [b for b, _ in subwords(pa.array([text]))]
        buckets, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, int), np.zeros(0))
        bags.append((buckets, counts / max(1, counts.sum())))
    return bags


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _loss(logits: np.ndarray, truth: np.ndarray) -> float:
    return float(-np.log(_softmax(logits)[np.arange(len(truth)), truth] + 1e-12).mean()) if len(truth) else 0.0
