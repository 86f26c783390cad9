"""Repair of the turn structure of conversations by cheapest edits.

A good conversation has the role initials ``(s?(ua)+)?``. Each row is kept (cost 0), given the role the pattern expects
(1) or deleted (2, the only choice for blank and duplicate rows), an empty turn may be inserted anywhere (5), and a
truncated row that is not deleted costs 5 more. The edits form a lattice of (rows done, state of the pattern); a
bidirectional Dijkstra search finds the cheapest path through it, and of equally cheap ones the one whose letters
(K, R, D, I) come first in ASCII.

At scale: rows are sorted by range of (conversation, turn), so a long conversation spreads over tasks. A task walks its
rows and closes a piece every ``PIECE_ROWS`` rows. For a conversation that lies within one piece, the search gives the
repair at once. Of the others each piece is searched from each state to each state; those few numbers are put together
per conversation, which chooses the states at the borders, and the pieces are then edited apart from each other. One
task sees one line of some 200 bytes per ``PIECE_ROWS`` rows of a conversation, never its rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitweave.llm.common import WHITE, cut

#: A piece of a conversation is closed at so many rows or characters.
PIECE_ROWS, PIECE_CHARS = 512, 1 << 20
#: States: nothing yet, after system, after user, after assistant; the initials that lead on.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
ROLES = {2: "user", 3: "assistant"}
DELETE, RENAME, INSERT, TRUNCATED = 2, 1, 5, 5
SOUND, UNUSABLE, CUT_OFF = 0, 1, 2
INFINITE = float("inf")

TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
WAY = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("stop", T.IntegerType()),
        T.StructField("cost", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("audit", T.StringType()),
    ]
)
COUNTS = ("n_turns", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """The repaired conversations, in pieces of consecutive rows.

    Columns: `id` (the conversation), `part` and `piece` (their order within it), `whole` (the only piece of its
    conversation), `turns` (array of role and text, after the edits), `audit` (their letters), `cost`, and what was
    found before the edits: `blank`, `duplicate`, `truncated` (the first fault of a row counts), `illegal` (neighbours
    whose role initials are not su, ua or au), `n_turns`, `first_turn`, `last_turn`, `first_role`, `last_role`.

    Rows are taken by turn, nulls first; equal turns by the first 32 characters of the role, the first 64 of the text,
    and then a hash. A null role or text counts as one space, null ids form one conversation, repeated rows are
    duplicates. Rows for which `present` is not true only name their conversation: one without others has a piece
    without turns. An empty table gives no piece. Other columns are left out, whatever their names.
    """
    given = rows.select(
        F.col(conv_col).alias("id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
        F.coalesce(F.lit(True) if present is None else present, F.lit(False)).alias("present"),
    )
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    given = given.select(
        "id",
        "turn",
        "present",
        F.when(F.col("present"), F.col("role")).alias("role"),
        F.when(F.col("present"), F.col("text")).alias("text"),
        F.when(F.col("present"), digest).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    given = cut(given)  # the row numbers below must not change between the two uses
    said = given.filter("present").groupBy("id", "digest")
    first = said.agg(F.min(F.struct("turn", "row"))["row"].alias("first"), F.count("*").alias("copies"))
    first = cut(first.filter("copies > 1").select("digest", F.col("id").alias("first_id"), "first"))
    same = (given["digest"] == first["digest"]) & given["id"].eqNullSafe(first["first_id"])
    order = ["id", "turn", F.substring("role", 1, 32), F.substring("text", 1, 64), "digest", "row"]
    ordered = (
        given.join(first, same, "left")
        .select(
            "id", "turn", "present", "role", "text", given["digest"], "row", (F.col("first") != F.col("row")).alias("again")
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("id", "turn", "present", "role", "text", "again", F.spark_partition_id().alias("part"))
    )
    pieces = cut(ordered.mapInArrow(_pieces(piece_rows), _piece_schema(given.schema["id"].dataType)))
    open_pieces = pieces.filter("NOT whole")
    ways = F.transform("ways", lambda w: w.dropFields("audit"))
    summaries = open_pieces.select("id", "part", "piece", ways.alias("ways"))
    borders = summaries.repartition("id").sortWithinPartitions("id", "part", "piece")
    borders = borders.mapInArrow(_borders, "part int, piece int, start int, stop int, tail string")
    edited = open_pieces.join(borders, ["part", "piece"]).mapInArrow(_edit, _result_schema(pieces))
    return pieces.filter("whole").select(edited.columns).union(edited)


def summary(pieces: DataFrame) -> DataFrame:
    """One row per conversation of `repair`: `id`, `gaps` (turns missing between its least and largest), the counts
    of faults, `cost`, `audit` and `repaired_sha256` (its turns as ``role:text``, joined by line feeds).

    Pieces of a conversation pass through one task in their order, a few at a time; a digest has no other way.
    """
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0))
    counts = [F.col(c) for c in COUNTS[1:]]
    whole = pieces.filter("whole").select(
        "id", gaps.alias("gaps"), *counts, "audit", F.sha2(F.concat_ws("\n", lines), 256).alias("repaired_sha256")
    )
    parted = pieces.filter("NOT whole").repartition("id").sortWithinPartitions("id", "part", "piece")
    return whole.union(parted.mapInArrow(_totals, whole.schema))


def turns(pieces: DataFrame) -> DataFrame:
    """The repaired conversations as rows: `id`, `part`, `piece`, `place` (their order), `role`, `text`."""
    return pieces.select("id", "part", "piece", F.posexplode("turns").alias("place", "turn")).select(
        "id", "part", "piece", "place", "turn.role", "turn.text"
    )


# ------------------------------------------------------------------ the search


def edges(kind: tuple[int, str], state: int) -> list[tuple[int, int, str]]:
    """(state after the row, cost, letter) for each edit of a row with the fault and role initial of `kind`."""
    fault, initial = kind
    found = [(state, DELETE, "D")]
    if fault != UNUSABLE:
        extra = TRUNCATED if fault == CUT_OFF else 0
        if initial in NEXT[state]:
            found.append((NEXT[state][initial], extra, "K"))
        found += [(to, extra + RENAME, "R") for to in NEXT[state].values() if to in ROLES]
    return found


def cheapest(
    kinds: tuple[tuple[int, str], ...], start: int, stops: tuple[int, ...], tail: bool
) -> tuple[int, str] | None:
    """Least cost, and least audit of that cost, from a state before the rows to one of the states after them.

    Nodes are (rows done, state). Forward and reverse heaps take turns until no cheaper or equal path can cross
    between them; then all crossings of least cost are compared by their joined audits. At equal cost the heaps give
    nodes in the order of the rows, so that a node's audit is final when it is taken. Of two equal-cost audits of a
    node none begins with the other, so the least audit is made of least audits. `tail`: turns may be inserted after
    the last row.
    """
    n = len(kinds)

    def ahead(node):
        done, state = node
        if done < n:
            for to, cost, letter in edges(kinds[done], state):
                yield (done + 1, to), cost, letter
        if done < n or tail:
            for to in NEXT[state].values():
                if to in ROLES:
                    yield (done, to), INSERT, "I"

    def behind(node):
        done, state = node
        for before in range(4):
            if done:
                for to, cost, letter in edges(kinds[done - 1], before):
                    if to == state:
                        yield (done - 1, before), cost, letter
            if (done < n or tail) and state in ROLES and state in NEXT[before].values():
                yield (done, before), INSERT, "I"

    costs = [{(0, start): 0}, {(n, s): 0 for s in stops}]
    audits = [{(0, start): ""}, {(n, s): "" for s in stops}]
    taken: list[set] = [set(), set()]
    heaps = [[(0, 0, start)], [(0, -n, s) for s in stops]]
    best = 0 if (0, start) in costs[1] else INFINITE
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, place, state = heapq.heappop(heaps[side])
        node = (-place if side else place, state)
        if node in taken[side]:
            continue
        taken[side].add(node)
        own_cost, own_audit = costs[side], audits[side]
        for to, step, letter in behind(node) if side else ahead(node):
            if to in taken[side]:
                continue
            total = cost + step
            audit = letter + own_audit[node] if side else own_audit[node] + letter
            if total < own_cost.get(to, INFINITE):
                own_cost[to], own_audit[to] = total, audit
                heapq.heappush(heaps[side], (total, -to[0] if side else to[0], to[1]))
                best = min(best, total + costs[1 - side].get(to, INFINITE))
            elif total == own_cost[to] and audit < own_audit[to]:
                own_audit[to] = audit
    if best == INFINITE:
        return None
    found = [audits[0][u] + audits[1][u] for u, cost in costs[0].items() if cost + costs[1].get(u, INFINITE) == best]
    for u, cost in costs[0].items():
        for v, step, letter in ahead(u):
            if cost + step + costs[1].get(v, INFINITE) == best:
                found.append(audits[0][u] + letter + audits[1][v])
    return best, min(found)


def edit(rows: list[tuple[str, str]], audit: str, state: int) -> list[tuple[str, str]]:
    """The rows (role, text) after the edits of an audit that begins in `state`."""
    out, at = [], 0
    for letter in audit:
        if letter == "K":
            out.append(rows[at])
            state = NEXT[state][rows[at][0][:1]]
        elif letter != "D":
            state = next(to for to in NEXT[state].values() if to in ROLES)
            out.append((ROLES[state], "" if letter == "I" else rows[at][1]))
        at += letter != "I"
    return out


def fault_of(text: str, again: bool) -> str:
    """The first fault of a row: blank, duplicate, truncated or none."""
    said = text.strip(WHITE)
    if not said:
        return "blank"
    if again:
        return "duplicate"
    return "" if said[-1] in ".!?" else "truncated"


# ------------------------------------------------------------------ tasks


def _piece_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("part", T.IntegerType()),
            T.StructField("piece", T.IntegerType()),
            T.StructField("whole", T.BooleanType()),
            T.StructField("first_turn", T.LongType()),
            T.StructField("last_turn", T.LongType()),
            *(T.StructField(c, T.LongType()) for c in COUNTS),
            T.StructField("first_role", T.StringType()),
            T.StructField("last_role", T.StringType()),
            T.StructField("audit", T.StringType()),
            T.StructField("turns", T.ArrayType(TURN)),
            T.StructField("ways", T.ArrayType(WAY)),
        ]
    )


def _result_schema(pieces: DataFrame) -> T.StructType:
    return T.StructType([f for f in pieces.schema.fields if f.name != "ways"])


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _pieces(piece_rows: int):
    """Tasks that cut sorted rows into pieces; the first and last conversation of a task may go on in others."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = lru_cache(100_000)(cheapest)
        out, schema = _Rows(), None
        rows: list[tuple] = []
        conversation = number = chars = part = 0
        begun, first = False, True  # whether there is a conversation, and whether it is the first of the task
        opened = False  # whether it has a piece already

        def close(last: bool, go_on: bool) -> None:
            nonlocal number, opened, rows, chars
            whole = not (first or last or opened or go_on)
            out.add(_piece(conversation, part, number, whole, rows, search))
            number, opened, rows, chars = number + 1, go_on, [], 0

        for batch in batches:
            schema = schema or _arrow_schema(_piece_schema(T.NullType())).set(0, pa.field("id", batch.schema.field(0).type))
            part = batch.column(6)[0].as_py() if batch.num_rows else part
            for key, turn, present, role, text, again in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if begun and key != conversation:
                    close(last=False, go_on=False)
                    first = False
                elif len(rows) >= piece_rows or chars >= PIECE_CHARS:
                    close(last=False, go_on=True)
                conversation, begun = key, True
                if present:
                    rows.append((turn, role, text, bool(again)))
                    chars += len(text)
            if len(out) >= 2_000 or out.chars > 4 * PIECE_CHARS:
                yield out.take(schema)
        if begun:
            close(last=True, go_on=False)
            yield out.take(schema)

    return run


class _Rows(list):
    """Rows waiting to become a batch."""

    chars = 0

    def add(self, row: dict) -> None:
        self.append(row)
        self.chars += sum(len(t["text"]) for t in row["turns"])

    def take(self, schema: pa.Schema) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pylist(list(self), schema)
        self.clear()
        self.chars = 0
        return batch


def _piece(key, part: int, number: int, whole: bool, rows: list[tuple], search) -> dict:
    faults = [fault_of(text, again) for _, _, text, again in rows]
    initials = [role[:1] for _, role, _, _ in rows]
    known = [turn for turn, _, _, _ in rows if turn is not None]
    kinds = tuple(
        (UNUSABLE if f in ("blank", "duplicate") else CUT_OFF if f else SOUND, c)
        for f, c in zip(faults, initials, strict=True)
    )
    said = [(role, text) for _, role, text, _ in rows]
    piece = {
        "id": key,
        "part": part,
        "piece": number,
        "whole": whole,
        "first_turn": min(known, default=None),
        "last_turn": max(known, default=None),
        "n_turns": len(set(known)),
        **{name: faults.count(name) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "first_role": initials[0] if rows else None,
        "last_role": initials[-1] if rows else None,
    }
    if whole:
        piece["cost"], piece["audit"] = search(kinds, 0, ENDS, True)
        said = edit(said, piece["audit"], 0)
    else:
        piece["ways"] = _ways(kinds, search)
    piece["turns"] = [{"role": role, "text": text} for role, text in said]
    return piece


def _ways(kinds: tuple, search) -> list[dict]:
    """From each state to each state; `rank` orders the audits that begin in the same state."""
    found = []
    for start in range(4):
        ends = [(stop, way) for stop in range(4) if (way := search(kinds, start, (stop,), False))]
        ranks = {audit: rank for rank, audit in enumerate(sorted(audit for _, (_, audit) in ends))}
        found += [
            {"start": start, "stop": stop, "cost": cost, "rank": ranks[audit], "audit": audit}
            for stop, (cost, audit) in ends
        ]
    return found


def _by_conversation(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bool, dict]]:
    """Rows one by one, and whether a conversation begins with it."""
    before, begun = None, False
    for batch in batches:
        for start in range(0, batch.num_rows, 100):
            for row in batch.slice(start, 100).to_pylist():
                yield not begun or row["id"] != before, row
                before, begun = row["id"], True


def _borders(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states in which each piece begins and ends on the cheapest path through its conversation."""

    def chosen(pieces: list[dict]) -> Iterator[dict]:
        after = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]  # by state: inserts that end the conversation
        rest: list = [cost for cost, _ in after]
        steps = []
        for piece in reversed(pieces):
            best: list = [(INFINITE, 0, 0)] * 4
            for w in piece["ways"]:
                best[w["start"]] = min(best[w["start"]], (w["cost"] + rest[w["stop"]], w["rank"], w["stop"]))
            steps.append([stop for _, _, stop in best])
            rest = [cost for cost, _, _ in best]
        state = 0
        for k, piece in enumerate(pieces):
            stop = steps[-1 - k][state]
            tail = after[stop][1] if k + 1 == len(pieces) else ""
            yield {"part": piece["part"], "piece": piece["piece"], "start": state, "stop": stop, "tail": tail}
            state = stop

    schema = pa.schema(
        [("part", pa.int32()), ("piece", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("tail", pa.string())]
    )
    pieces: list[dict] = []
    out: list[dict] = []
    for begins, row in _by_conversation(batches):
        if begins:
            out += chosen(pieces)
            pieces = []
            if len(out) > 10_000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        pieces.append({"part": row["part"], "piece": row["piece"], "ways": row["ways"]})
    out += chosen(pieces)
    for start in range(0, len(out), 10_000):
        yield pa.RecordBatch.from_pylist(out[start : start + 10_000], schema)


def _edit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits each piece by the audit between its two states."""
    for batch in batches:
        wanted = [n for n in batch.schema.names if n not in ("ways", "start", "stop", "tail")]
        order = ["id", "part", "piece", *[n for n in wanted if n not in ("id", "part", "piece")]]
        schema = pa.schema([batch.schema.field(n) for n in order])
        for at in range(0, batch.num_rows, 20):
            out = []
            for row in batch.slice(at, 20).to_pylist():
                way = next(w for w in row["ways"] if w["start"] == row["start"] and w["stop"] == row["stop"])
                row["audit"] = way["audit"] + row["tail"]
                row["cost"] = way["cost"] + INSERT * len(row["tail"])
                said = [(t["role"], t["text"]) for t in row["turns"]]
                row["turns"] = [{"role": r, "text": t} for r, t in edit(said, row["audit"], row["start"])]
                out.append({n: row[n] for n in order})
            yield pa.RecordBatch.from_pylist(out, schema)


def _totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums, the joined audit and the digest of each conversation, from its pieces in order."""
    schema = None
    total: dict = {}
    out: list[dict] = []

    def finished() -> dict:
        if total["last_turn"] is not None:
            total["gaps"] = total["last_turn"] - total["first_turn"] + 1 - total["n_turns"]
        done = {n: total[n] for n in ("id", "gaps", *COUNTS[1:])}
        return done | {"audit": "".join(total["audit"]), "repaired_sha256": total["digest"].hexdigest()}

    def watched() -> Iterator[pa.RecordBatch]:
        nonlocal schema
        for batch in batches:
            kinds = [("gaps", pa.int64()), *((c, pa.int64()) for c in COUNTS[1:])]
            ends = [("audit", pa.string()), ("repaired_sha256", pa.string())]
            schema = pa.schema([batch.schema.field("id"), *kinds, *ends])
            yield batch

    for begins, row in _by_conversation(watched()):
        if begins:
            if total:
                out.append(finished())
                if len(out) >= 1_000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            total = {"id": row["id"], "gaps": 0, "audit": [], "digest": hashlib.sha256(), "lines": 0}
            total |= dict.fromkeys(("first_turn", "last_turn", "last_role")) | dict.fromkeys(COUNTS, 0)
        for name in COUNTS:
            total[name] += row[name]
        if row["first_turn"] is not None:
            total["n_turns"] -= row["first_turn"] == total["last_turn"]
            total["first_turn"] = row["first_turn"] if total["first_turn"] is None else total["first_turn"]
            total["last_turn"] = row["last_turn"]
        if row["first_role"] is not None:
            if total["last_role"] is not None:
                total["illegal"] += total["last_role"] + row["first_role"] not in ("su", "ua", "au")
            total["last_role"] = row["last_role"]
        total["audit"].append(row["audit"])
        for t in row["turns"]:
            total["digest"].update(("\n" if total["lines"] else "").encode() + f"{t['role']}:{t['text']}".encode())
            total["lines"] += 1
    if total:
        out.append(finished())
        yield pa.RecordBatch.from_pylist(out, schema)
