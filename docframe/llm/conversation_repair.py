"""Conversations with a legal order of roles, by the cheapest edits: Hirschberg's divide and conquer.

A legal conversation is empty, or an optional system turn and then pairs of user and assistant. Rows may be kept (K,
0), given the role user or assistant (R, 3), deleted (D, 4), and empty user or assistant turns inserted (I, 3); rows
that are blank or repeat an earlier row's role and text must go, and a truncated row that stays adds 3. Of the
cheapest edits the one whose letters sort first is taken.

What came before matters only as one of four states: nothing yet, or a last role of system, user or assistant. A
forward vector holds, per state, the least cost of reaching it and the rank of its first-sorting letters among the
four; a backward vector holds the least cost from each state to the end. They meet in the middle: of the states with the
least sum, the one of the lowest rank is the crossing, and both halves are solved alike, so no table of states by rows is
ever kept. Ranks suffice: letters that lead to different states after the same row differ before either ends.

The same meeting is done at three scales, so a conversation needs to fit nowhere. Rows are sorted by ranges of
(conversation, turn); a range's part of a conversation is a piece, cut into blocks of bounded rows and text. Blocks
and pieces are summed up as costs and ranks from state to state, which compose. Crossings of a conversation's pieces
(at most one per range) fix the states at their borders, crossings of a piece's blocks those at theirs, and each block
is then solved by itself.

Rows are ordered by turn, nulls first, rows of one turn by a digest of role and text; equal rows are counted before
they are shuffled and written out one by one only as letters. A null role or text is one space. A null
conversation is one of its own. Roles go by their first character; a role that begins with none of s, u, a can only be
given another or go. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docframe.session import written

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows and characters of a block.
ROWS, CHARS = 1024, 1 << 16
NEVER = 1 << 50
#: Kinds of rows: the role's class (s, u, a, other), plus four if truncated; and a row that must go.
GOES = 8
CLASS = {"s": 0, "u": 1, "a": 2}


class Step(NamedTuple):
    """Least costs from state to state, and of each state's targets the rank of their letters."""

    costs: tuple[tuple[int, ...], ...]
    ranks: tuple[tuple[int, ...], ...]


class Vector(NamedTuple):
    costs: tuple[int, ...]
    ranks: tuple[int, ...]


def following(state: int) -> int:
    """What an inserted or re-roled row turns a state into."""
    return ASSISTANT if state == USER else USER


def _letters(kind: int) -> list[dict[int, tuple[int, str]]]:
    """Per state, the targets of a row of this kind with cost and letters."""
    out = []
    for state in STATES:
        ways = [(DELETE, "D", state)]
        at, inserts = state, 0
        while kind != GOES and inserts <= 2:
            spent, before = INSERT * inserts + (TRUNCATED if kind >= 4 else 0), "I" * inserts
            role = (SYSTEM, USER, ASSISTANT, None)[kind % 4]
            if role == following(at) or (role == SYSTEM and at == START):
                ways.append((spent + KEEP, before + "K", role))
            ways.append((spent + REROLE, before + "R", following(at)))
            at, inserts = following(at), inserts + 1
        best: dict[int, tuple[int, str]] = {}
        for cost, letters, to in sorted(ways):
            best.setdefault(to, (cost, letters))
        out.append(best)
    return out


LETTERS = [_letters(kind) for kind in range(9)]


def _step(ways: list[dict[int, tuple[int, str]]]) -> Step:
    costs = tuple(tuple(w[t][0] if t in w else NEVER for t in STATES) for w in ways)
    ranks = tuple(tuple(sorted(x for _, x in w.values()).index(w[t][1]) if t in w else 3 for t in STATES) for w in ways)
    return Step(costs, ranks)


#: One row of each kind.
SINGLE = [_step(ways) for ways in LETTERS]
#: What it costs to end a conversation in each state.
CLOSING = (0, 2 * INSERT, INSERT, 0)


def begun(state: int) -> Vector:
    return Vector(tuple(0 if s == state else NEVER for s in STATES), (0, 0, 0, 0))


def ended(state: int) -> tuple[int, ...]:
    return begun(state).costs


def _ahead(vector: Vector, step: Step) -> Vector:
    costs, keys = [], []
    for t in STATES:
        cost, rank, s = min((min(NEVER, vector.costs[s] + step.costs[s][t]), vector.ranks[s], s) for s in STATES)
        costs.append(cost)
        keys.append((cost >= NEVER, rank, step.ranks[s][t], t))
    order = sorted(keys)
    return Vector(tuple(costs), tuple(order.index(k) for k in keys))


def _back(costs: tuple[int, ...], step: Step) -> tuple[int, ...]:
    return tuple(min(NEVER, min(step.costs[s][t] + costs[t] for t in STATES)) for s in STATES)


@lru_cache(1 << 14)
def _row_ahead(relative: Vector, kind: int) -> tuple[int, Vector]:
    """Like ``_ahead`` for one row, of a vector whose least cost is 0: what is added, and the new relative vector."""
    new = _ahead(relative, SINGLE[kind])
    least = min(new.costs)
    return least, Vector(tuple(c - least if c < NEVER else NEVER for c in new.costs), new.ranks)


@lru_cache(1 << 14)
def _row_back(relative: tuple[int, ...], kind: int) -> tuple[int, tuple[int, ...]]:
    new = _back(relative, SINGLE[kind])
    least = min(new)
    return least, tuple(c - least if c < NEVER else NEVER for c in new)


def forward(steps: Sequence, vector: Vector) -> Vector:
    """The vector behind ``steps``: kinds of rows (bytes), or summed-up blocks."""
    if not isinstance(steps, bytes):
        for step in steps:
            vector = _ahead(vector, step)
        return vector
    total = min(vector.costs)
    vector = Vector(tuple(c - total if c < NEVER else NEVER for c in vector.costs), vector.ranks)
    for kind in steps:
        added, vector = _row_ahead(vector, kind)
        total += added
    return Vector(tuple(min(NEVER, c + total) for c in vector.costs), vector.ranks)


def backward(steps: Sequence, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs from each state before ``steps`` to the end that ``costs`` prices."""
    if not isinstance(steps, bytes):
        for step in reversed(steps):
            costs = _back(costs, step)
        return costs
    total = min(costs)
    costs = tuple(c - total if c < NEVER else NEVER for c in costs)
    for kind in reversed(steps):
        added, costs = _row_back(costs, kind)
        total += added
    return tuple(min(NEVER, c + total) for c in costs)


def crossing(ahead: Vector, behind: tuple[int, ...]) -> int:
    """The state in which the cheapest edits cross, those whose letters sort first if there are several."""
    return min(STATES, key=lambda s: (ahead.costs[s] + behind[s], ahead.ranks[s]))


def crossings(steps: Sequence, start: int, end: tuple[int, ...]) -> list[int]:
    """The state behind each step of the best edits from ``start`` to the end that ``end`` prices."""
    n = len(steps)
    after = [start] * n
    if not n:
        return after
    after[-1] = crossing(forward(steps, begun(start)), end)
    open_parts = [(0, n, start, after[-1])]
    while open_parts:
        a, b, first, last = open_parts.pop()
        if b - a < 2:
            continue
        middle = (a + b) // 2
        meet = crossing(forward(steps[a:middle], begun(first)), backward(steps[middle:b], ended(last)))
        after[middle - 1] = meet
        open_parts += [(a, middle, first, meet), (middle, b, meet, last)]
    return after


def summed(steps: Sequence) -> Step:
    """Many steps as one."""
    if len(steps) == 1 and not isinstance(steps, bytes):
        return steps[0]
    return _summed_rows(steps) if isinstance(steps, bytes) else _summed(steps)


def _summed(steps: Sequence) -> Step:
    vectors = [forward(steps, begun(s)) for s in STATES]
    return Step(tuple(v.costs for v in vectors), tuple(v.ranks for v in vectors))


# Short conversations are much alike, so those of one task share most of their work.
_summed_rows = lru_cache(1 << 12)(_summed)


@lru_cache(1 << 12)
def edits(kinds: bytes, start: int, end: tuple[int, ...]) -> str:
    """Letters of the best edits of rows of these kinds."""
    out, state = [], start
    for kind, to in zip(kinds, crossings(kinds, start, end), strict=True):
        out.append(LETTERS[kind][state][to][1])
        state = to
    return "".join(out)


def closing(state: int) -> str:
    """Inserts that end a conversation."""
    return "I" * (CLOSING[state] // INSERT)


def replayed(letters: str, state: int, rows: Iterator[tuple[str, str] | None]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired rows; ``rows`` yields None for rows that had to go."""
    for letter in letters:
        role, text = ("", "") if letter == "I" else next(rows) or ("", "")
        if letter == "D":
            continue
        if letter == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        else:
            state = following(state)
            role = NAMES[state]
        yield role, text


# Blocks and pieces as rows


@dataclass
class Part:
    """What a block or a piece tells about itself."""

    step: Step
    first: str  # the initial of its first row's role
    last: str
    rows: int
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    turns: tuple[int, int, int] | None  # first and last turn, and how many

    FORM = struct.Struct("<16q16b")

    def packed(self) -> dict:
        flat = [x for part in self.step for row in part for x in row]
        return {
            "step": self.FORM.pack(*flat),
            "first": self.first,
            "last": self.last,
            "counts": [self.rows, self.blank, self.duplicate, self.truncated, self.illegal],
            "turns": list(self.turns) if self.turns else None,
        }

    @classmethod
    def of(cls, row: dict) -> Part:
        flat = cls.FORM.unpack(row["step"])
        step = Step(*(tuple(tuple(flat[16 * p + 4 * s : 16 * p + 4 * s + 4]) for s in STATES) for p in (0, 1)))
        return cls(step, row["first"], row["last"], *row["counts"], tuple(row["turns"]) if row["turns"] else None)


def illegal(a: str, b: str) -> bool:
    """Whether roles with these initials must not follow each other."""
    return a + b not in ("su", "ua", "au")


def joined(parts: Sequence[Part]) -> Part:
    """Neighbouring parts as one."""
    turns = None
    for part in parts:
        if part.turns and turns:
            turns = (turns[0], part.turns[1], turns[2] + part.turns[2] - (turns[1] == part.turns[0]))
        else:
            turns = turns or part.turns
    borders = sum(illegal(a.last, b.first) for a, b in zip(parts[:-1], parts[1:], strict=True))
    counts = [sum(getattr(p, name) for p in parts) for name in ("rows", "blank", "duplicate", "truncated", "illegal")]
    return Part(summed([p.step for p in parts]), parts[0].first, parts[-1].last, *counts[:4], counts[4] + borders, turns)


PART = "step binary, first string, last string, counts array<long>, turns array<long>"


def _schema(key: pa.DataType) -> pa.Schema:
    longs = pa.list_(pa.int64())
    fields = [("conv_id", key), ("piece", pa.int64()), ("block", pa.int64()), ("step", pa.binary()), ("first", pa.string()), ("last", pa.string()), ("counts", longs), ("turns", longs), ("kinds", pa.binary()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
    return pa.schema(fields)


def _blocks(rows_most: int, chars_most: int):
    """Blocks of sorted rows, and behind the last one of a conversation its piece (block -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId()
        schema, out, held = None, [], 0
        conversation, parts = (), []  # a tuple of the key, so that null is one too
        block: dict = {}

        def fresh() -> None:
            block.update(kinds=bytearray(), roles=[], texts=[], chars=0, first=None, last=None, faults=[0, 0, 0], illegal=0, turns=None)

        def end_block() -> None:
            nonlocal held
            kinds = bytes(block["kinds"])
            part = Part(summed(kinds), block["first"], block["last"], len(kinds), *block["faults"], block["illegal"], block["turns"])
            out.append({"conv_id": conversation[0], "piece": piece, "block": len(parts), **part.packed(), "kinds": kinds, "roles": block["roles"], "texts": block["texts"]})
            held += block["chars"] + len(kinds)
            parts.append(part)
            fresh()

        def end_conversation() -> None:
            if conversation:
                if block["kinds"]:
                    end_block()
                out.append({"conv_id": conversation[0], "piece": piece, "block": -1, **joined(parts).packed(), "kinds": None, "roles": None, "texts": None})
                parts.clear()

        def add(kind: int, role: str, text: str | None, turn: int | None, fault: int | None) -> None:
            initial = role[:1]
            if block["last"] is not None:
                block["illegal"] += illegal(block["last"], initial)
            else:
                block["first"] = initial
            block["last"] = initial
            block["kinds"].append(kind)
            if fault is not None:
                block["faults"][fault] += 1
            if turn is not None:
                a, b, n = block["turns"] or (turn, turn, 1)
                block["turns"] = (a, turn, n + (turn != b))
            if kind != GOES:
                block["roles"].append(role)
                block["texts"].append(text)
                block["chars"] += len(role) + len(text)
            if len(block["kinds"]) >= rows_most or block["chars"] >= chars_most:
                end_block()

        fresh()
        for batch in batches:
            schema = _schema(batch.schema.field("conv_id").type)
            for row in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "fresh", "blank", "cut")), strict=True):
                conv, turn, role, text, n, new, blank, cut = row
                if (conv,) != conversation:
                    end_conversation()
                    conversation = (conv,)
                if new and not blank:
                    add(CLASS.get(role[:1], 3) + 4 * cut, role, text, turn, 2 if cut else None)
                    n -= 1
                for _ in range(n):
                    add(GOES, role, None, turn, 0 if blank else 1)
                if held >= 1 << 22 or len(out) >= 5000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
        end_conversation()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _grouped(batches: Iterator[pa.RecordBatch], key: Sequence[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Neighbouring rows of equal keys, across batches."""
    now, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            at = tuple(row[k] for k in key)
            if rows and at != now:
                yield now, rows
                rows = []
            now = at
            rows.append(row)
    if rows:
        yield now, rows


def _conversations(schema: pa.Schema):
    """States at the borders of a conversation's pieces; with the last one, what the conversation counts and costs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv,), rows in _grouped(batches, ("conv_id",)):
            parts = [Part.of(r) for r in rows]
            whole = joined(parts)
            after = crossings([p.step for p in parts], START, CLOSING)
            cost = whole.step.costs[START][after[-1]] + CLOSING[after[-1]]
            first, last, turns = whole.turns or (0, -1, 0)
            totals = [last - first + 1 - turns, whole.blank, whole.duplicate, whole.truncated, whole.illegal, cost]
            out = [{"conv_id": conv, "piece": r["piece"], "before": a, "after": b, "totals": None} for r, a, b in zip(rows, [START, *after], after, strict=False)]
            out[-1]["totals"] = totals
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _pieces(schema: pa.Schema):
    """Letters of each block, from the states at the borders of its piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, piece), rows in _grouped(batches, ("conv_id", "piece")):
            after = crossings([Part.of(r).step for r in rows], rows[0]["before"], ended(rows[0]["after"]))
            out = [
                {"conv_id": conv, "piece": piece, "block": r["block"], "before": a, "letters": edits(r["kinds"], a, ended(b))}
                for r, a, b in zip(rows, [rows[0]["before"], *after], after, strict=False)
            ]
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _batched(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Many small batches as fewer."""
    held, size = [], 0
    for batch in rows:
        held.append(batch)
        size += batch.num_rows
        if size >= 2000:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _rows_of(block: dict) -> Iterator[tuple[str, str] | None]:
    """(role, text) of a block's rows, None for those that must go."""
    stay = zip(block["roles"], block["texts"], strict=True)
    for kind in block["kinds"]:
        yield None if kind == GOES else next(stay)


def _turns(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                out = replayed(block["letters"], block["before"], _rows_of(block))
                yield pa.RecordBatch.from_pylist([{"conv_id": block["conv_id"], "piece": block["piece"], "block": block["block"], "row": k, "role": r, "text": t} for k, (r, t) in enumerate(out)], schema)

    return run


def _reports(schema: pa.Schema):
    """One row per conversation, its letters and the digest of its repaired rows taken block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None

        def add(rows: Iterator[tuple[str, str]]) -> None:
            for role, text in rows:
                line = f"{role}:{text}".encode("utf-8", "surrogatepass")
                now["sha"].update(line if now["empty"] else b"\n" + line)
                now["empty"] = False

        def end() -> Iterator[pa.RecordBatch]:
            if now:
                row = dict(zip(COUNTS, now["totals"], strict=True)) | {"conv_id": now["conv_id"], "audit": "".join(now["audit"]), "repaired_sha256": now["sha"].hexdigest()}
                yield pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            columns = [batch[c].to_pylist() if c != "texts" else batch[c] for c in REPORT]
            for k in range(batch.num_rows):
                row = {name: values[k].as_py() if name == "texts" else values[k] for name, values in zip(REPORT, columns, strict=True)}
                if now is None or row["conv_id"] != now["conv_id"]:
                    yield from end()
                    now = {"conv_id": row["conv_id"], "sha": hashlib.sha256(), "empty": True, "audit": [], "totals": [0] * len(COUNTS), "open": None}
                if row["letters"] is not None:
                    now["open"] = row
                    now["audit"].append(row["letters"])
                elif row["kinds"] is not None:
                    add(replayed(now["open"]["letters"], now["open"]["before"], _rows_of(row)))
                elif row["totals"] is not None:
                    now["totals"] = row["totals"]
                    now["audit"].append(closing(row["before"]))
                    add(replayed(closing(row["before"]), row["before"], iter(())))
        yield from end()

    return run


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPORT = ("conv_id", "letters", "before", "kinds", "roles", "texts", "totals")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows counted and told apart: conv_id, turn, role, text, n, fresh, blank, cut; sorted by ranges."""
    given = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    given = given.withColumn("digest", F.sha2(F.concat_ws(":", F.char_length("role"), "role", "text"), 256))
    counted = given.groupBy("conv_id", "turn", "digest").agg(F.first("role").alias("role"), F.first("text").alias("text"), F.count("*").alias("n"))
    firsts = given.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("null"))
    firsts = firsts.select("c", "d", F.when(~F.col("null"), F.col("least")).alias("t"), F.lit(True).alias("fresh"))
    same = counted["conv_id"].eqNullSafe(firsts["c"]) & (counted["digest"] == firsts["d"]) & counted["turn"].eqNullSafe(firsts["t"])
    bare = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    ready = counted.join(firsts, same, "left").select(
        "conv_id", "turn", "digest", "role", "text", "n",
        F.coalesce("fresh", F.lit(False)).alias("fresh"),
        (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("digest").asc()]
    return ready.repartitionByRange(*order).sortWithinPartitions(*order).drop("digest")


class Repair:
    """A repaired table: its blocks, and what happens to them."""

    def __init__(self, rows: DataFrame, rows_most: int = ROWS, chars_most: int = CHARS) -> None:
        key = rows.schema["conv_id"].dataType
        name, arrow = key.simpleString(), to_arrow_type(key)
        self.name, self.arrow = name, arrow
        head = [("conv_id", arrow), ("piece", pa.int64())]
        blocks = _ordered(rows).mapInArrow(_blocks(rows_most, chars_most), f"conv_id {name}, piece long, block long, {PART}, kinds binary, roles array<string>, texts array<string>")
        parts = written(blocks, "blocks")
        self.blocks = parts.filter("block >= 0")
        pieces = parts.filter("block = -1").select("conv_id", "piece", "step", "first", "last", "counts", "turns")
        states = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(
            lambda batches, run=_conversations(pa.schema([*head, ("before", pa.int32()), ("after", pa.int32()), ("totals", pa.list_(pa.int64()))])): _batched(run(batches)),
            f"conv_id {name}, piece long, before int, after int, totals array<long>",
        )
        #: conv_id, piece, the states around it, and with a conversation's last piece its counts.
        self.states = written(states, "states")
        inside = self.states.select(F.col("conv_id").alias("c"), F.col("piece").alias("p"), "before", "after")
        steps = self.blocks.select("conv_id", "piece", "block", "step", "first", "last", "counts", "turns", "kinds")
        placed = steps.join(inside, steps["conv_id"].eqNullSafe(inside["c"]) & (steps["piece"] == inside["p"])).drop("c", "p")
        letters = placed.repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "block").mapInArrow(
            lambda batches, run=_pieces(pa.schema([*head, ("block", pa.int64()), ("before", pa.int32()), ("letters", pa.string())])): _batched(run(batches)),
            f"conv_id {name}, piece long, block long, before int, letters string",
        )
        #: conv_id, piece, block, the state before it, and the letters of its edits.
        self.letters = written(letters, "letters")

    def turns(self) -> DataFrame:
        """The repaired rows: conv_id, role, text, in the order of piece, block, row. Inserts that end a conversation come last."""
        name, arrow = self.name, self.arrow
        letters = self.letters.select(F.col("conv_id").alias("c"), F.col("piece").alias("p"), F.col("block").alias("b"), "before", "letters")
        both = self.blocks.join(letters, self.blocks["conv_id"].eqNullSafe(letters["c"]) & (self.blocks["piece"] == letters["p"]) & (self.blocks["block"] == letters["b"]))
        schema = pa.schema([("conv_id", arrow), ("piece", pa.int64()), ("block", pa.int64()), ("row", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        inner = both.select("conv_id", "piece", "block", "before", "letters", "kinds", "roles", "texts").mapInArrow(
            lambda batches: _batched(_turns(schema)(batches)), f"conv_id {name}, piece long, block long, row long, role string, text string"
        )
        last = self.states.filter("totals IS NOT NULL")
        added = F.when(F.col("after") == SYSTEM, F.array(F.lit("user"), F.lit("assistant"))).when(F.col("after") == USER, F.array(F.lit("assistant"))).otherwise(F.array().cast("array<string>"))
        ends = last.select("conv_id", "piece", F.lit(1 << 62).alias("block"), F.posexplode(added).alias("row", "role")).withColumn("row", F.col("row").cast("long"))
        return inner.unionByName(ends.withColumn("text", F.lit("")))

    def reports(self, original: DataFrame) -> DataFrame:
        """Per conversation of ``original``: counts of faults, cost, letters of all edits, SHA-256 of the repaired rows.

        The digest of one conversation is taken by one task, a block at a time, since SHA-256 cannot be divided.
        """
        def row(df: DataFrame, side: int, **known) -> DataFrame:
            kinds = {"piece": "long", "block": "long", "letters": "string", "before": "int", "kinds": "binary", "roles": "array<string>", "texts": "array<string>", "totals": "array<long>"}
            return df.select("conv_id", F.lit(side).alias("side"), *[known.get(n, F.lit(None)).cast(t).alias(n) for n, t in kinds.items()])

        zero, col = F.lit(0), F.col
        parts = [
            row(original.select("conv_id").distinct(), 0, piece=F.lit(-1), block=zero),
            row(self.letters, 0, piece=col("piece"), block=col("block"), letters=col("letters"), before=col("before")),
            row(self.blocks, 1, piece=col("piece"), block=col("block"), kinds=col("kinds"), roles=col("roles"), texts=col("texts")),
            row(self.states.filter("totals IS NOT NULL"), 0, piece=F.lit(1 << 62), block=zero, before=col("after"), totals=col("totals")),
        ]
        together = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
        placed = together.repartition("conv_id").sortWithinPartitions("conv_id", "piece", "block", "side")
        schema = pa.schema([("conv_id", self.arrow), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
        return placed.select(*REPORT).mapInArrow(
            lambda batches: _batched(_reports(schema)(batches)),
            f"conv_id {self.name}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string",
        )


def repair(rows: DataFrame, **sizes: int) -> Repair:
    """The cheapest legal form of each conversation in (conv_id, turn, role, text) rows."""
    return Repair(rows, **sizes)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the faults that a checksum of conversation and turn deals out, for tests of the repair.

    Of 0 to 19: 0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    blank = F.lit(" ")
    deal = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    dealt = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), deal.alias("deal")).filter("deal <> 0")
    return dealt.select(
        "conv_id",
        "turn",
        F.when(F.col("deal") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("deal") == 1, "").when(F.col("deal") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("deal") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def oracle() -> str:
    """The report on damaged conversations in DuckDB's SQL: all least vectors, row by row, with their letters."""
    ways = [f"({kind}, {state}, {to}, {cost}, '{letters}')" for kind, states in enumerate(LETTERS) for state, found in enumerate(states) for to, (cost, letters) in found.items()]
    return f"""
WITH RECURSIVE
table0 AS (SELECT range AS byte, list_reduce([range::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS carried FROM range(256)),
crc AS (SELECT list(carried ORDER BY byte) AS carried FROM table0),
dealt AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
                           lambda c, b: xor(c >> 8, carried[xor(c & 255, b) + 1])), 4294967295) % 20 AS deal
    FROM conversations, crc),
damaged AS (
    SELECT conv_id, turn, CASE WHEN deal = 4 THEN 'user' ELSE role END AS role,
           CASE deal WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM dealt, range(CASE WHEN deal = 3 THEN 2 ELSE 1 END) WHERE deal <> 0),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
           regexp_replace(text, '[\x20\x09-\x0D]+\\z', '') AS bare, left(role, 1) AS initial
    FROM damaged),
repeats AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS seen FROM numbered),
faults AS (
    SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS previous
    FROM repeats),
kinds AS (
    SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 8
                   ELSE CASE initial WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END + CASE WHEN fault = 'truncated' THEN 4 ELSE 0 END END AS kind
    FROM faults),
ways (kind, before, after, cost, letters) AS (VALUES {", ".join(ways)}),
steps AS (
    SELECT conv_id, n, list({{'before': before, 'after': after, 'cost': cost, 'letters': letters,
        'out': CASE letters[-1] WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text ELSE chr(10) || CASE after WHEN 2 THEN 'user:' ELSE 'assistant:' END || text END,
        'inserted': array_to_string(list_transform(range(len(letters) - 1), lambda k: chr(10) || CASE WHEN (before = 2) = (k % 2 = 0) THEN 'assistant:' ELSE 'user:' END), '')}}) AS moves
    FROM kinds JOIN ways USING (kind) GROUP BY conv_id, n),
best AS (
    SELECT conv_id, 0::BIGINT AS n, 0 AS state, 0 AS cost, '' AS audit, '' AS out FROM (SELECT DISTINCT conv_id FROM steps)
    UNION ALL
    (SELECT conv_id, n, state, least.cost, least.audit, least.out
     FROM (SELECT conv_id, n, state, min({{'cost': cost, 'audit': audit, 'out': out}}) AS least
           FROM (SELECT b.conv_id, s.n, m.after AS state, b.cost + m.cost AS cost, b.audit || m.letters AS audit, b.out || m.inserted || m.out AS out
                 FROM best b JOIN steps s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.n = b.n + 1, unnest(s.moves) AS u(m)
                 WHERE m.before = b.state)
           GROUP BY conv_id, n, state))),
ends AS (
    SELECT conv_id, min({{'cost': cost + CASE state WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END,
                         'audit': audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
                         'out': out || CASE state WHEN 1 THEN chr(10) || 'user:' || chr(10) || 'assistant:' WHEN 2 THEN chr(10) || 'assistant:' ELSE '' END}}) AS least
    FROM best JOIN (SELECT conv_id AS c, max(n) AS most FROM kinds GROUP BY conv_id) ON c IS NOT DISTINCT FROM conv_id AND n = most
    GROUP BY conv_id),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (n > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM kinds GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(least.cost, 0)::BIGINT AS cost, coalesce(least.audit, '') AS audit, sha256(coalesce(substr(least.out, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
