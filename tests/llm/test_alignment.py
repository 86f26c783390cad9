"""Alignment of two tokenizers against brute force over bytes."""

import base64
import collections
import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from traitweave.llm import alignment, common
from traitweave.llm.queries import BYTE_LEVEL, PIECES, op11_cross_tokenizer_alignment

SCHEMA = "doc_id long, text string, a string, b string, row string"
A_JSON, B_MODEL = Path(BYTE_LEVEL).read_text("utf-8"), Path(PIECES).read_bytes()
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(BYTE_LEVEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def a_bytes():
    """The entries by rank, from the file that holds them as plain bytes."""
    lines = Path(BYTE_LEVEL).with_suffix(".tiktoken").read_bytes().splitlines()
    return {int(rank): base64.b64decode(raw) for raw, rank in map(bytes.split, lines)}


def by_hand(text, tokenizers, a_bytes):
    """Groups ([a ids], [b ids]) of one text, found byte by byte."""
    if not text:
        return []
    a, b = tokenizers
    mine = [(i, a_bytes[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
    other = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        other.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    if b"".join(x for _, x in mine) != raw or b"".join(x for _, x in other) != raw:
        return []

    def ends(tokens):
        at, found = 0, []
        for _, x in tokens:
            at += len(x)
            found.append(at)
        return found

    both = set(ends(mine)) & set(ends(other))
    groups = []
    sides = [list(zip((i for i, _ in tokens), ends(tokens))) for tokens in (mine, other)]
    for end in sorted(both):
        taken = []
        for side in sides:
            n = next(k for k, (_, e) in enumerate(side) if e == end) + 1
            taken.append([i for i, _ in side[:n]])
            del side[:n]
        groups.append(tuple(taken))
    return groups


def expected(rows, tokenizers, a_bytes):
    groups = [by_hand(text, tokenizers, a_bytes) for _, text in rows]
    held = collections.Counter()
    links = [collections.Counter((a, b) for x, y in one for a in x for b in y) for one in groups]
    for one in links:
        held.update(set(one))
    top = collections.Counter()
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    out = []
    for (key, _), one, linked in zip(rows, groups, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in one)
        out.append(
            (
                key,
                sum(len(x) for x, _ in one),
                sum(len(y) for _, y in one),
                len(one),
                sum(linked.values()),
                sum(n for (a, b), n in linked.items() if held[a, b] == top[a]),
                sum(n * held[p] for p, n in linked.items()),
                hashlib.sha256(text.encode()).hexdigest() if text else "",
            )
        )
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = ["the", "Étion", "don't", "naïve", "2024", "日本", "x_y", "zoë's", "!!!", "\n", "  ", "aipaoi", "🙂"]
    some = [" ".join(rng.choices(words, k=rng.randrange(1, 50))) for _ in range(80)]
    odd = [None, "", " ", "\n", " lead", "trail ", "two  spaces", "a▁b", "<|endoftext|> <s>", "nul\x00", "é ﬁ", " ", "ﬀ½"]
    return odd + some + ["tab\tand\r\n", "the " * 50, "same text here"] * 3


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 5, 0])
def test_align(spark, tokenizers, a_bytes, texts, frequent):
    rows = [(i if i != 20 else None, t) for i, t in enumerate(texts)] + [(30, texts[30])] * 2
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA).repartition(3)
    found = alignment.align(docs, A_JSON, B_MODEL, frequent=frequent).collect()
    got = sorted((tuple(r[c] for c in ["id", *COLUMNS]) for r in found), key=str)
    assert got == expected(rows, tokenizers, a_bytes)


def test_stretches_and_parts_give_the_tokens_of_the_whole(tokenizers, monkeypatch):
    rng = random.Random(5)
    words = ["the", "Étion", "don't", "naïve", "2024", "aipaoi.", "🙂", "\n", "  ", "x", "Le", "²", "\x1c", "a\u0301", "é"]
    pieces = alignment.Tokenizers(A_JSON, B_MODEL)
    assert pieces.apart
    for k in range(8):
        text = "".join(rng.choices([" ", " ", "", "\n"])[0] + w for w in rng.choices(words, k=400))
        links = alignment.Links(*pieces([text]), 1)
        for size in (100, 1 << 20):
            monkeypatch.setattr(alignment.parts, "__defaults__", (size,))
            monkeypatch.setattr(alignment, "REMEMBERED", 50 * k)
            monkeypatch.setattr(alignment, "TEXT_BYTES", size)
            (got,) = alignment._aligned([text], alignment.Stretches(pieces), True)
            numbers = [got.numbers >> shift & alignment.FIELD for shift in alignment.SHIFTS]
            assert numbers == [len(links.a.ids), len(links.b.ids), links.n_groups[0], links.n_links[0]]
            assert [b";".join(got.groups).decode()] == links.texts()
            assert got.digest.hexdigest() == hashlib.sha256(links.texts()[0].encode()).hexdigest()
            pair, times = np.unique(links.pair, return_counts=True)
            assert got.pair.tolist() == pair.tolist() and got.times.tolist() == times.tolist()
        assert len(list(alignment.parts(text, 100))) > 5


def test_words_with_signs_are_put_together(tokenizers, monkeypatch):
    """Each word is tokenised once and so is what follows words; the result is that of the whole texts."""
    made = []

    class Counted(alignment.Links):
        def __init__(self, a, b, n):
            made.append(n)
            super().__init__(a, b, n)

    monkeypatch.setattr(alignment, "Links", Counted)
    pieces = alignment.Tokenizers(A_JSON, B_MODEL)
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdeinorstu\u00e9\u00df\u00aa\u00b5\u0142", k=rng.randrange(1, 9))) for _ in range(60)] + ["a", "Le"]
    signs = ["", ".", ",", "'s", "'re", "'S", "3", "_x", "$$$", " |", "...", "\n", ".\nThe", "\x1c", "\x00", "  ", "1.", " \u00e9", "\tb", ">"]
    whole = " ".join(w + s for s in signs for w in words)
    found = alignment.Stretches(pieces)
    (got,) = alignment._aligned([whole], found, True)
    assert sum(made) <= len(words) + 5 * len(signs)
    mixed = [" ".join(rng.choice(words) + rng.choice(signs) for _ in range(50)) for _ in range(100)]
    for text, total in [(whole, got), *zip(mixed, alignment._aligned(mixed, found, True), strict=True)]:
        links = alignment.Links(*pieces([text]), 1)
        assert [b";".join(total.groups).decode()] == links.texts() != [""]
        numbers = [total.numbers >> shift & alignment.FIELD for shift in alignment.SHIFTS]
        assert numbers == [len(links.a.ids), len(links.b.ids), links.n_groups[0], links.n_links[0]]
        pair, times = np.unique(links.pair, return_counts=True)
        assert total.pair.tolist() == pair.tolist() and total.times.tolist() == times.tolist()


def test_byte_letters(a_bytes):
    letters = common.byte_letters()
    assert len(letters) == 256 and set(letters.values()) == set(range(256))
    vocabulary = Tokenizer.from_file(BYTE_LEVEL).get_vocab()
    assert all(bytes(letters[c] for c in piece) == a_bytes[i] for piece, i in vocabulary.items() if i in a_bytes)


def test_groups_break_where_both_end():
    def tokens(*sizes):
        return alignment.Tokens(np.arange(len(sizes)), np.array(sizes), np.array([len(sizes)]))

    a, b = alignment.groups_of(tokens(2, 3, 1, 4), tokens(1, 4, 5))
    assert a.tolist() == [0, 0, 1, 1] and b.tolist() == [0, 0, 1]


def test_query(spark, sf_dir, tokenizers, a_bytes):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = op11_cross_tokenizer_alignment(spark, sf_dir).collect()
    got = sorted((tuple(r[c] for c in ["doc_id", *COLUMNS]) for r in found), key=str)
    assert got == expected(rows, tokenizers, a_bytes)


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA), A_JSON, B_MODEL).collect() == []
