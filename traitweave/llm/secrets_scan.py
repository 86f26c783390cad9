"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 16 or more key characters with a digit, or what is assigned to a name such as password, of six
or more characters. The forest sees its length, how its kinds of characters and its pairs of letters follow each other,
how much of it dictionary words cover, whether it looks like a path, and the words next to it. It is trained in numpy on
labelled findings of several kinds (`labelled_findings`), whose labels are their kinds.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitweave.llm.common import cut, drop, received, shipped, slices
from traitweave.llm.labelled_findings import WORDS, labelled_findings

CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*[0-9])[A-Za-z0-9_+/-]{16,}={0,2}")
#: Characters before and after a candidate that count as its neighbourhood.
BEFORE, AFTER = 40, 20
NAMES = frozenset("key apikey token secret password passwd pwd auth bearer credential credentials private access".split())
#: What is assigned to the name of a secret, however short and without a digit.
ASSIGNED = re.compile(
    r"(?:key|token|secret|passw(?:or)?d|passphrase|pwd|auth|credentials?)[\"']?\s{0,3}[=:]\s{0,3}[\"']?([^\s\"'<>(),;]{6,200})", re.I
)
PASSWORDS = frozenset("password passwd pwd passphrase secret".split())
PLAIN = frozenset("commit checksum digest path file order version ref sha md id name card account".split())
#: Words of the dictionary and how often they must occur, labelled findings.
DICTIONARY, LEAST_COUNT, LABELLED = 20_000, 5, 4_000
TREES, DEPTH, LEAF = 25, 7, 3


@dataclass(frozen=True)
class Forest:
    """Trees as arrays of nodes: feature (-1: leaf), threshold, left and right node, share of true findings."""

    trees: tuple[tuple[np.ndarray, ...], ...]
    dictionary: frozenset[str]

    def chance(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH + 1):
                f = feature[at]
                below = x[np.arange(len(x)), np.maximum(f, 0)] <= threshold[at]
                at = np.where(f < 0, at, np.where(below, left[at], right[at]))
            total += share[at]
        return total / max(1, len(self.trees))


def features(found: str, before: str, after: str, dictionary: frozenset[str]) -> list[float]:
    n = len(found)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in found]
    letters = re.findall(r"[A-Za-z]+", found)
    covered = 0
    for run in letters:
        low, i = run.lower(), 0
        while i < len(low):
            size = next((k for k in range(min(14, len(low) - i), 3, -1) if low[i : i + k] in dictionary), 0)
            covered += size
            i += size or 1
    words = re.findall(r"[a-z]+", before.lower())[-3:]
    vowels = sum(c in "aeiouAEIOU" for c in found)
    return [
        n,
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n,
        kinds.count("d") / n,
        kinds.count("u") / n,
        len(set(found)) / min(n, 64),
        len(set(zip(found, found[1:], strict=False))) / n,
        vowels / n,
        float(bool(re.fullmatch(r"[0-9a-fA-F]+", found))),
        covered / n,
        found.count("/") / n,
        (found.count("-") + found.count("_")) / n,
        float(bool(NAMES & set(words))),
        float(bool(re.search(r"[=:]\s*[\"']?$", before))),
        float(before[-1:] in ("'", '"') and after[:1] == before[-1:]),
        float(bool(re.search(r"(?:https?:|www\.|[/.])\S*$", before))),
        float(bool(PASSWORDS & set(words))),
        float(bool(PLAIN & set(words))),
        sum(not c.isalnum() and c not in "-_/" for c in found) / n,
        max(len(m[0]) for m in re.finditer(r"(.)\1*", found, re.S)) / n,
        float(bool(re.fullmatch(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", found))),
    ]


def findings(texts: Iterable[str | None]) -> Iterator[tuple[int, int, int, str, str, str]]:
    """Number of the text, start, stop, candidate, what stands before and after."""
    for i, text in enumerate(texts):
        if text:
            spans = [m.span() for m in CANDIDATE.finditer(text)]
            long = iter(spans)
            nearest = next(long, None)
            for m in ASSIGNED.finditer(text):
                a, b = m.span(1)
                while nearest and nearest[1] <= a:
                    nearest = next(long, None)
                if not nearest or nearest[0] >= b:  # not part of a candidate already
                    spans.append((a, b))
            for a, b in sorted(spans):
                yield i, a, b, text[a:b], text[max(0, a - BEFORE) : a], text[b : b + AFTER]


def fit(labelled: list[tuple[str, str, str, bool]], dictionary: Iterable[str] = (), seed: int = 9) -> Forest:
    """From labelled findings: candidate, text before, text after, whether it is a secret."""
    words = frozenset(dictionary)
    rng = np.random.default_rng(seed)
    x = np.array([features(c, b, a, words) for c, b, a, _ in labelled])
    y = np.array([float(true) for *_, true in labelled])
    trees = []
    for _ in range(TREES if len(labelled) else 0):
        drawn = rng.integers(0, len(y), len(y))
        trees.append(_tree(x[drawn], y[drawn], rng))
    return Forest(tuple(trees), words)


def train(docs: DataFrame, text_col: str = "text") -> Forest:
    """Fit on `LABELLED` labelled findings. The dictionary is the most frequent words of all texts, and those of the
    labelled findings."""
    texts = docs.select(F.col(text_col).alias("text"))
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\b([a-z]{4,14})\b"), F.lit(1)))
    # A table, read in few tasks: each sends as many words as the dictionary has to the driver.
    common = cut(texts.select(word.alias("word")).groupBy("word").count().filter(f"count >= {LEAST_COUNT}"))
    dictionary = [r[0] for r in common.orderBy(F.desc("count"), "word").limit(DICTIONARY).collect()]
    drop(common)
    return fit([(c, b, a, secret) for c, b, a, secret, _ in labelled_findings(LABELLED)], [*dictionary, *WORDS])


def scan(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Per row of `docs`: id, n_candidates, secrets (array of start, stop in code points, and chance), redacted text.

    Null text has no findings and stays null. Whole texts are read. Without training findings nothing is a secret.
    Other columns are not read.
    """
    shared = shipped(docs.sparkSession, forest)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    secrets = "array<struct<start:int,stop:int,chance:double>>"
    return rows.mapInArrow(_scan(shared, least), f"id {kind}, n_candidates long, secrets {secrets}, redacted string")


def _scan(shared, least: float):
    spans = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("chance", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = received(shared)
        for batch in batches:
            for piece in slices(batch, "text", 4 << 20):
                texts = piece.column("text").to_pylist()
                found = list(findings(texts))
                x = np.array([features(c, b, a, forest.dictionary) for *_, c, b, a in found])
                chance = forest.chance(x) if len(found) else np.zeros(0)
                counts = np.bincount([f[0] for f in found], minlength=len(texts)) if found else np.zeros(len(texts), int)
                secrets: list[list[dict]] = [[] for _ in texts]
                for (i, a, b, *_), p in zip(found, chance.tolist(), strict=True):
                    if p >= least:
                        secrets[i].append({"start": a, "stop": b, "chance": p})
                for i, own in enumerate(secrets):
                    for s in reversed(own):
                        texts[i] = f"{texts[i][: s['start']]}[secret]{texts[i][s['stop'] :]}"
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(counts.astype(np.int64)), pa.array(secrets, spans), pa.array(texts, pa.string())],
                    ["id", "n_candidates", "secrets", "redacted"],
                )

    return run


def _tree(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    nodes: list[list[float]] = []

    def grow(rows: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, 0, 0, y[rows].mean()])
        if depth == DEPTH or len(rows) < 2 * LEAF or y[rows].min() == y[rows].max():
            return at
        best = (0.0, -1, 0.0)
        for f in rng.choice(x.shape[1], max(1, round(x.shape[1] ** 0.5) + 1), replace=False):
            order = np.argsort(x[rows, f], kind="stable")
            value, label = x[rows[order], f], y[rows[order]]
            n, true = np.arange(1, len(rows)), np.cumsum(label)[:-1]
            rest, rest_true = len(rows) - n, label.sum() - true
            impurity = true * (1 - true / n) + rest_true * (1 - rest_true / rest)
            gain = label.sum() * (1 - label.mean()) - impurity
            gain[(value[1:] == value[:-1]) | (n < LEAF) | (rest < LEAF)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0] + 1e-12:
                best = (gain[k], int(f), (value[k] + value[k + 1]) / 2)
        if best[1] < 0:
            return at
        below = x[rows, best[1]] <= best[2]
        nodes[at][:2] = [best[1], best[2]]
        nodes[at][2] = grow(rows[below], depth + 1)
        nodes[at][3] = grow(rows[~below], depth + 1)
        return at

    grow(np.arange(len(y)), 0)
    table = np.array(nodes)
    return table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3].astype(np.int64), table[:, 4]
