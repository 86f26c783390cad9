"""Conversation repair against exhaustive search over all edits."""

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from traitweave.llm import conversation_repair as repair
from traitweave.llm.queries import damaged, op12_conversation_repair

WHITE = " \t\n\x0b\x0c\r"
ROLE = {"u": "user", "a": "assistant"}


def all_repairs(rows, faults):
    """(cost, audit, repaired) of every sequence of edits with at most one insert before each row and two at the end."""
    shape = re.compile(r"(s?(ua)+)?")

    def options(i):
        role, text = rows[i]
        found = [(2, "D", [])]
        if faults[i] not in ("blank", "duplicate"):
            extra = 5 if faults[i] == "truncated" else 0
            found.append((extra, "K", [(role, text)]))
            found += [(extra + 1, "R", [(r, text)]) for r in ROLE.values()]
        return found

    inserts = [(0, "", []), *((5, "I", [(r, "")]) for r in ROLE.values())]
    ends = [*inserts, (10, "II", [("user", ""), ("assistant", "")])]
    slots = []
    for i in range(len(rows)):
        slots += [inserts, options(i)]
    for path in itertools.product(*slots, ends):
        out = [turn for _, _, turns in path for turn in turns]
        if shape.fullmatch("".join(role[:1] or "?" for role, _ in out)):
            yield sum(c for c, _, _ in path), "".join(a for _, a, _ in path), out


def table_of_best(kinds):
    """The best (cost, audit) from state 0 by plain recursion over rows and states."""

    @functools.cache
    def best(i, state):
        found = [(0, "")] if i == len(kinds) and state in (0, 3) else []
        if i < len(kinds):
            for to, cost, letter in repair.edges(kinds[i], state):
                found += [(cost + c, letter + a) for c, a in best(i + 1, to)]
        into = 3 if state == 2 else 2
        if state != 3 or i < len(kinds):  # an insert after an assistant only before further rows
            found += [(5 + c, "I" + a) for c, a in (best_after_insert(i, into))]
        return (min(found),) if found else ()

    @functools.cache
    def best_after_insert(i, state):
        found = [(0, "")] if i == len(kinds) and state == 3 else []
        if i < len(kinds):
            for to, cost, letter in repair.edges(kinds[i], state):
                found += [(cost + c, letter + a) for c, a in best(i + 1, to)]
        if state == 2:
            found += [(5 + c, "I" + a) for c, a in best_after_insert(i, 3)]
        return (min(found),) if found else ()

    return best(0, 0)[0]


def expected(rows):
    """The whole contract for one conversation's rows (turn, role, text) after damage, in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        said = text.strip(WHITE)
        faults.append(
            "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    said = [(role, text) for _, role, text in rows]
    if len(rows) <= 3:
        cost, audit, repaired = min(all_repairs(said, faults), key=lambda x: (x[0], x[1]))
    else:
        kind = {"blank": 1, "duplicate": 1, "truncated": 2, "": 0}
        cost, audit = table_of_best([(kind[f], c) for f, c in zip(faults, initials)])
        repaired = repair.edit(said, audit, 0)
        assert re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] for r, _ in repaired))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, id string, part string, damage string"


def in_order(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1][:32], r[2][:64], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest())
    return sorted(rows, key=key)


@pytest.mark.parametrize("seed", range(3))
def test_search_finds_the_least_audit(seed):
    rng = random.Random(seed)
    kinds = [(f, c) for f in (0, 1, 2) for c in ("s", "u", "a", "x", "")]
    for _ in range(300):
        rows = tuple(rng.choice(kinds) for _ in range(rng.randrange(0, 12)))
        assert repair.cheapest(rows, 0, repair.ENDS, True) == table_of_best(rows)


def random_rows(rng, n):
    texts = ["Fine.", "Fine.", "cut", " \t", "", "So? ", "ä!", "end.\n"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    return [
        (
            rng.choice([None, *range(n)]) if rng.random() < 0.2 else i,
            rng.choice(roles) if rng.random() < 0.4 else ["user", "assistant"][i % 2],
            None if rng.random() < 0.05 else rng.choice(texts) if rng.random() < 0.5 else f"Turn {i} says {rng.random()}.",
        )
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(7)
    found = {k: random_rows(rng, rng.randrange(1, 10)) for k in range(60)}
    found[None] = random_rows(rng, 6)
    found[100] = random_rows(rng, 130)  # a third of the rows
    found[101] = [(i, "user", "Again.") for i in range(40)]
    found[102] = [(None, "assistant", "x" * 30_000)]
    return found


@pytest.mark.parametrize("piece_rows", [512, 3])
def test_repair(spark, conversations, piece_rows):
    rows = [(k, *row, "clash", "clash", "clash") for k, turns in conversations.items() for row in turns]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    pieces = repair.repair(df, piece_rows=piece_rows)
    got = {r["id"]: tuple(r[c] for c in COLUMNS) for r in repair.summary(pieces).collect()}
    blank = lambda x: " " if x is None else x
    want = {k: expected(in_order([(t, blank(r), blank(x)) for t, r, x in turns])) for k, turns in conversations.items()}
    assert got == want
    texts = repair.turns(pieces).filter("id = 101").collect()
    assert len(texts) in (0, 2)


def damaged_by_hand(conv, rows):
    out = []
    for turn, role, text in rows:
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        damage = zlib.crc32(place.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if damage == 4 else role
        text = "" if damage == 1 else re.sub("[.!?]", "", text) if damage == 2 else text
        out += [(turn, role, text)] * (0 if damage == 0 else 2 if damage == 3 else 1)
    return in_order(out)


def test_query(spark, conversations, tmp_path):
    rows = [(k, *row) for k, turns in conversations.items() for row in turns]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == {k: expected(damaged_by_hand(k, turns)) for k, turns in conversations.items()}


def test_all_rows_dropped(spark, tmp_path):
    gone = next((c, t) for c in range(99) for t in range(99) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(*gone, "user", "Hello.")], "conv_id long, turn long, role string, text string")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    (row,) = op12_conversation_repair(spark, str(tmp_path)).collect()
    assert row["conv_id"] == gone[0] and row["audit"] == "" and row["cost"] == row["gaps"] == row["illegal"] == 0
    assert row["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_empty_table(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert repair.summary(repair.repair(nothing)).collect() == []
    assert damaged(nothing.drop("damage")).collect() == []
