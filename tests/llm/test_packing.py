"""Packing: the plan against its own rules, the tokens against the whole text, the query against brute force."""

import functools
import random
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

from traitweave.llm import packing
from traitweave.llm.queries import WORDS, op13_best_fit_packing

SCHEMA = "doc_id long, text string, length string, part string, ids string"


def laid_out(histogram, capacity):
    """Contents of every sequence of the plan; fails if a piece is missing, twice, overlaps or sticks out."""
    sequences, numbers = defaultdict(list), defaultdict(list)
    for i in packing.plan_packing(histogram, capacity):
        numbers[i.length] += range(i.first, i.last)
        for k in range(i.last - i.first):
            sequences[i.sequence + k // i.each].append((i.offset + k % i.each * i.length, i.length))
    assert {n: sorted(x) for n, x in numbers.items()} == {n: list(range(k)) for n, k in histogram.items() if k}
    for items in sequences.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    return sequences


def best_fit(histogram, capacity):
    found = packing.Packing({n: k for n, k in histogram.items() if k}, capacity)
    found.best_fit()
    return found.sequences


@pytest.mark.parametrize("capacity", [1, 7, 20, 64])
def test_any_histogram(capacity):
    rng = random.Random(capacity)
    for _ in range(100):
        lengths = rng.sample(range(1, capacity + 1), rng.randrange(capacity + 1))
        laid_out({n: rng.choice([0, 1, 2, 50]) for n in lengths}, capacity)


@pytest.mark.parametrize("name", ["halves", "thirds", "uniform", "hot", "skewed"])
def test_hardly_more_sequences_than_best_fit(name):
    rng = np.random.default_rng(5)
    lengths = {
        "halves": rng.uniform(500, 1100, 5000),
        "thirds": rng.uniform(600, 700, 5000),
        "uniform": rng.uniform(1, 2048, 5000),
        "hot": np.where(rng.random(5000) < 0.34, 700, rng.uniform(300, 2048, 5000)),
        "skewed": np.exp(rng.normal(6.6, 0.8, 5000)),
    }[name]
    lengths = np.clip(lengths.astype(int), 1, 2048)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    n = len(laid_out(histogram, 2048))
    assert n <= 1.001 * best_fit(histogram, 2048) + 1
    assert n >= -(-int(lengths.sum()) // 2048)
    if name == "halves":  # where best fit leaves much room, the program does not
        assert n < 0.98 * best_fit(histogram, 2048)


def test_groups_have_equal_cardinality():
    demand, least = packing.equal_groups([(10, 3), (9, 1), (8, 4)], 4)
    assert demand == {10: 4, 8: 4} and least == {10: 9, 8: 8}
    demand, least = packing.equal_groups([(n, 1) for n in range(100, 0, -1)], 10)
    assert set(demand.values()) == {10} and all(size - least[size] == 9 for size in demand)


def test_program_beats_rounding_every_size_alone():
    total = sum(amount for _, amount in packing.configurations({5: 10, 4: 10, 3: 10}, 12))
    assert total == pytest.approx(10)
    assert packing.configurations({}, 12) == []


ODD = [
    "",
    " \n\t ",
    "Hello, World's  END",
    "a<|endoftext|>b <|startoftext|>",
    "é é ́x y z ẛ̣",
    "ÀÉÎ İstanbul ΟΔΟΣ ΟΔΟΣ. ς",
    "x" * 100 + " " + "日本語" * 30,
    "\x1c\x1d a\x85b \x0b\x0c c",
    "don't we'll '' 's 12345 6,7",
    "End. END., Á. Á, x² . ., Ⅷ. á., <|endoftext|>.,",
]


@functools.cache
def tokenizer():
    return Tokenizer.from_file(WORDS)


def whole(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [0]


def test_words_give_the_ids_of_whole_texts(monkeypatch):
    rng = random.Random(3)
    words = packing.Words(*packing.Words.parts(Path(WORDS).read_text("utf-8")))
    texts = ODD + ["".join(rng.choices("aÉ́ \n'.sß1", k=60)) for _ in range(300)]
    latin = "".join(map(chr, range(0x250)))
    texts += [latin, *latin, latin * 2, *("".join(rng.choices(latin, k=40)) for _ in range(300))]
    want = [whole(text)[:-1] for text in texts]

    def got(some):
        return [np.frombuffer(ids, "<u4").tolist() for ids in words.encode(some)]

    assert got(texts) == want
    assert [got([text])[0] for text in texts] == want
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    assert [got([text])[0] for text in texts] == want
    assert got([]) == [] and got([""]) == [[]]
    monkeypatch.setattr(packing, "STRETCH", 5)
    monkeypatch.setattr(packing, "stretches", lambda text: _stretches(text, 5))
    assert got(texts) == want


_stretches = packing.stretches


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    some = [" ".join(rng.choices(["alpha", "Beta,", "gamma", "d"], k=rng.randrange(1, 60))) for _ in range(150)]
    return [None, *ODD, *some, "word " * 9_000, "long " * 5_000, *["the same"] * 100]


@pytest.mark.parametrize("capacity", [2048, 32])
def test_pack(spark, texts, capacity):
    rows = [(i if i != 5 else None, t, "clash", "clash", "clash") for i, t in enumerate(texts)]
    rows += rows[10:12]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    places = packing.pack(docs, Path(WORDS).read_text("utf-8"), capacity=capacity, with_ids=True).collect()
    check_places(places, [(r[0], r[1]) for r in rows], capacity)
    for r in places:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]


def check_places(places, rows, capacity, name="id"):
    expected = defaultdict(int)
    for key, text in rows:
        ids = whole(text)
        for k in range(0, len(ids), capacity):
            piece = ids[k : k + capacity]
            expected[key, k // capacity, k, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += 1
    got, sequences = defaultdict(int), defaultdict(list)
    for r in places:
        got[r[name], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == expected
    for items in sequences.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= capacity
    return sequences


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    sequences = check_places(op13_best_fit_packing(spark, sf_dir).collect(), rows, 2048, "doc_id")
    total = sum(length for items in sequences.values() for _, length in items)
    assert len(sequences) <= 1.02 * total / 2048 + 1


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), Path(WORDS).read_text("utf-8")).collect() == []
