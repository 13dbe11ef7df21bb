"""Conversation structure repair: the cheapest edits that give a well-formed sequence of roles.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``: nothing at all, or an
optional system turn and then user and assistant in turn. Edits: Keep 0, Rerole to user or assistant 2,
Delete 3 (the only one for blank turns and for turns that repeat an earlier role and text), Insert an
empty user or assistant turn 2; a truncated turn that stays costs 1 more.

Method: a turn is one of nine symbols (role initial and fault). Runs of equal symbols are collapsed; the
cost from each of four states (nothing yet, after system, after user, after assistant) to the end is
carried back over a run by the binary powers of the symbol's min-plus matrix, which are cached. Then the
choices are unrolled from the front, halving long runs, and among equally cheap edits the least letter wins,
which gives the ASCII-least audit.

Spark sorts each conversation's turns and a task reads them as a stream. A conversation of more than
``PART_ROWS`` turns or ``PART_BYTES`` of text is cut into parts, each with the matrix of its turns; the parts'
matrices (16 numbers each) are folded back in a job of their own, and a second stream unrolls part after
part. No conversation is held whole; its digest, being one SHA-256, is one task's stream.

Defined results: a NULL role or text is one space (so the turn is blank), NULL turns come first, turns with
one number are ordered by role and text, NULL conv_id is a conversation of its own, repeated rows are
duplicates, an empty table gives no rows, further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import written

#: Turns and bytes of text that a part of a conversation may have before it is cut.
PART_ROWS, PART_BYTES = 8192, 8_000_000
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FAR = 1 << 60
WHITE = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a turn of each initial may lead, and the role that an inserted or reroled turn takes in a state.
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
GIVEN = ("user", "user", "assistant", "user")
AFTER = (USER, USER, ASSISTANT, USER)
#: Cost of the insertions that end a conversation.
END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


# --- min-plus algebra over the four states ----------------------------------------------------------


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


def apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(a[i][k] + v[k] for k in range(4)) for i in range(4))


UNIT: Matrix = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))
#: Any number of insertions.
INSERTIONS: Matrix = ((0, FAR, 2, 4), (FAR, 0, 2, 4), (FAR, FAR, 0, 2), (FAR, FAR, 2, 0))


def symbol(initial: str, deleted: bool, truncated: bool) -> str:
    """One of nine: ``x`` for a turn that must go, else s, u, a or o (any other), capital if truncated."""
    if deleted:
        return "x"
    letter = initial if initial in ("s", "u", "a") else "o"
    return letter.upper() if truncated else letter


@lru_cache(maxsize=None)
def edits_of(sym: str, state: int) -> tuple[tuple[str, int, int], ...]:
    """Letter, cost and next state of every edit that uses up a turn."""
    found = [("D", DELETE, state)]
    if sym != "x":
        extra = TRUNCATED * sym.isupper()
        if (state, sym.lower()) in NEXT:
            found.append(("K", KEEP + extra, NEXT[state, sym.lower()]))
        found.append(("R", REROLE + extra, AFTER[state]))
    return tuple(found)


@lru_cache(maxsize=None)
def power(sym: str, bit: int) -> Matrix:
    """The matrix of 2**bit turns of one symbol, insertions before each included."""
    if bit:
        return times(power(sym, bit - 1), power(sym, bit - 1))
    row = [[FAR] * 4 for _ in range(4)]
    for state in range(4):
        for _, cost, to in edits_of(sym, state):
            row[state][to] = min(row[state][to], cost)
    return times(INSERTIONS, tuple(map(tuple, row)))


@lru_cache(maxsize=65536)
def back(sym: str, n: int, least: Vector) -> tuple[Vector, int]:
    """Costs before a run of ``n`` turns from those after it, as differences to the least, and the least."""
    v, bit = least, 0
    while n >> bit:
        if n >> bit & 1:
            v = apply(power(sym, bit), v)
        bit += 1
    low = min(v)
    return tuple(x - low for x in v), low


@lru_cache(maxsize=65536)
def chosen(sym: str, state: int, here: Vector, after: Vector, low: int) -> tuple[str, int]:
    """The least letters of a cheapest way past one turn: insertions before it, then its own edit."""
    letters = ""
    while True:
        ways = [(letter, to) for letter, cost, to in edits_of(sym, state) if cost + after[to] == low + here[state]]
        if here[AFTER[state]] + INSERT == here[state]:
            ways.append(("I", AFTER[state]))
        letter, state = min(ways)
        letters += letter
        if letter != "I":
            return letters, state


def unrolled(sym: str, n: int, state: int, after: Vector) -> Iterator[tuple[str, int]]:
    """(letters, state) for each of ``n`` turns of one symbol, given the costs after them."""
    if n == 1:
        here, low = back(sym, 1, after)
        yield chosen(sym, state, here, after, low)
        return
    right = n // 2
    for letters, to in unrolled(sym, n - right, state, back(sym, right, after)[0]):
        state = to
        yield letters, to
    yield from unrolled(sym, right, state, after)


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(s, len(list(g))) for s, g in groupby(symbols)]


def matrix_of(symbols: str) -> Matrix:
    """The matrix of some turns in order."""
    total = UNIT
    for sym, n in runs(symbols):
        bit = 0
        while n >> bit:
            if n >> bit & 1:
                total = times(total, power(sym, bit))
            bit += 1
    return total


def plan(symbols: str, state: int, after: Vector) -> list[tuple[str, int]]:
    """(letters, state after) for each turn, given the costs behind the last."""
    found, ends = runs(symbols), [_relative(after)]
    for sym, n in reversed(found):
        ends.append(back(sym, n, ends[-1])[0])
    out: list[tuple[str, int]] = []
    for (sym, n), costs in zip(found, reversed(ends[:-1]), strict=True):
        out += unrolled(sym, n, state, costs)
        state = out[-1][1]
    return out


def _relative(v: Vector) -> Vector:
    low = min(v)
    return tuple(x - low for x in v)


def closing(state: int) -> str:
    return "I" * (END[state] // INSERT)


# --- repair of one conversation, part by part -------------------------------------------------------


class Output:
    """The edits of a conversation so far: digest, cost and audit, or the edited turns themselves."""

    def __init__(self, detail: bool):
        self.state, self.cost, self.audit, self.detail = START, 0, [], detail
        self.digest, self.any = hashlib.sha256(), False
        self.turns: list[tuple[str, str, str]] = []

    def _put(self, letter: str, role: str, text: str) -> None:
        if self.detail:
            self.turns.append((letter, role, text))
        if letter != "D":
            self.digest.update(("\n" * self.any + f"{role}:{text}").encode())
            self.any = True

    def add(self, symbols: str, roles: list[str], texts: list[str], after: Vector) -> None:
        for sym, role, text, (letters, to) in zip(symbols, roles, texts, plan(symbols, self.state, after), strict=True):
            self._insert(len(letters) - 1)
            letter = letters[-1]
            for name, cost, _ in edits_of(sym, self.state):
                if name == letter:
                    self.cost += cost
            self._put(letter, GIVEN[self.state] if letter == "R" else role, text)
            self.audit.append(letter)
            self.state = to

    def _insert(self, n: int) -> None:
        for _ in range(n):
            self._put("I", GIVEN[self.state], "")
            self.cost += INSERT
            self.audit.append("I")
            self.state = AFTER[self.state]

    def close(self) -> None:
        self._insert(len(closing(self.state)))


class Tally:
    """Counts of a conversation that need no repair."""

    def __init__(self) -> None:
        self.low = self.high = self.last = None
        self.turns = self.illegal = 0
        self.faults = [0, 0, 0, 0]
        self.initial = ""

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None and turn != self.last:
            self.turns += 1
            self.low, self.high, self.last = turn if self.low is None else self.low, turn, turn
        self.faults[fault] += 1
        pair, self.initial = self.initial + initial, initial
        # an empty role has no initial; the pair is then too short to be a legal one
        self.illegal += self.seen and pair not in ("su", "ua", "au")
        self.seen = True

    seen = False

    def values(self) -> tuple[int, int, int, int, int]:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return gaps, self.faults[1], self.faults[2], self.faults[3], self.illegal


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long"
_ROW = "part int, parts int, symbols string, roles array<string>, texts array<string>, cells array<long>, cost long, audit string, repaired_sha256 string"
_TURN = "step long, edit string, role string, text string"


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _stream(part_rows: int, part_bytes: int, schema: pa.Schema, detail: bool):
    """Sorted turns -> one row for each conversation, and before it the parts of a long one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0
        for conv, rows in _conversations(batches):
            tally, part = Tally(), 0
            symbols, roles, texts, size = [], [], [], 0
            for turn, role, text, fault in rows:
                tally.add(turn, role[:1], fault)
                symbols.append(symbol(role[:1], fault in (1, 2), fault == 3))
                roles.append(role)
                texts.append(text)
                size += len(text)
                if len(symbols) >= part_rows or size >= part_bytes:
                    cells = [x for line in matrix_of("".join(symbols)) for x in line]
                    yield _table([(conv, *[None] * 5, part, None, "".join(symbols), roles, texts, cells, None, None, None)], schema)
                    part, symbols, roles, texts, size = part + 1, [], [], [], 0
            if part:
                if symbols:
                    cells = [x for line in matrix_of("".join(symbols)) for x in line]
                    yield _table([(conv, *[None] * 5, part, None, "".join(symbols), roles, texts, cells, None, None, None)], schema)
                    part += 1
                out.append((conv, *tally.values(), None, part, *[None] * 7))
            else:
                done = Output(detail)
                done.add("".join(symbols), roles, texts, END)
                done.close()
                audit, sha = "".join(done.audit), done.digest.hexdigest()
                edited = ("".join(x[0] for x in done.turns), [x[1] for x in done.turns], [x[2] for x in done.turns]) if detail else (None, None, None)
                out.append((conv, *tally.values(), None, 0, *edited, None, done.cost, audit, sha))
                held += size if detail else 0
            if len(out) >= 2000 or held > part_bytes:
                yield _table(out, schema)
                out, held = [], 0
        yield _table(out, schema)

    return run


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Conversations of a sorted stream, each an iterator of (turn, role, text, fault) of the turns present."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

    for conv, some in groupby(rows(), key=lambda r: r[0]):
        yield conv, (r[2:] for r in some if r[1])


def _fold(key: str, schema: pa.Schema):
    """The costs behind every part of a long conversation, from the parts' matrices."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        after, found = END, []
        for cells in reversed(table["cells"].to_pylist()):
            found.append(list(after))
            after = apply(tuple(tuple(cells[i : i + 4]) for i in range(0, 16, 4)), after)
        return pa.table([table[key], table["part"], pa.array(found[::-1], pa.list_(pa.int64()))], schema=schema)

    return run


def _unroll(schema: pa.Schema, detail: bool):
    """Sorted parts with the costs behind each -> the conversation's row, or a row for each edit."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):  # a part at a time: each may be large
                    yield tuple(c[i].as_py() for c in batch.columns)

        for conv, some in groupby(rows(), key=lambda r: r[0]):
            done, step = Output(detail), 0
            for _, _, symbols, roles, texts, after in some:
                done.add(symbols, roles, texts, tuple(after))
                if detail:
                    yield _table([(conv, step + i, *x) for i, x in enumerate(done.turns)], schema)
                    step += len(done.turns)
                    done.turns = []
            done.close()
            if detail:
                yield _table([(conv, step + i, *x) for i, x in enumerate(done.turns)], schema)
            else:
                yield _table([(conv, done.cost, "".join(done.audit), done.digest.hexdigest())], schema)

    return run


def _sorted_turns(turns: DataFrame, present: Column | None) -> DataFrame:
    """Turns with their first fault (1 blank, 2 duplicate, 3 truncated), conversation by conversation in order.

    The shuffle is by conv_id alone; the window over equal turns and the final sort work within its partitions.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = turns.select(
        "conv_id",
        (F.lit(True) if present is None else present).alias("present"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
    ).repartition("conv_id")
    same = Window.partitionBy("conv_id", "present", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumn("nth", F.row_number().over(same))
    ended = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = (
        F.when(ended == "", 1).when(F.col("nth") > 1, 2).when(~F.right(ended, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    )
    rows = rows.select("conv_id", "present", "turn", "role", "text", fault.alias("fault"))
    return rows.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")


def _parts(turns: DataFrame, present: Column | None, part_rows: int, part_bytes: int, detail: bool) -> tuple[DataFrame, T.StructType, str]:
    kind = turns.schema["conv_id"].dataType
    name = kind.simpleString()
    schema = T.StructType.fromDDL(f"conv_id {name}, {COUNTS}, {_ROW}")
    rows = _sorted_turns(turns, present)
    found = rows.mapInArrow(_stream(part_rows, part_bytes, _arrow(schema), detail), schema)
    return written(found, "repair"), schema, name


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _unrolled_parts(found: DataFrame, name: str, detail: bool) -> DataFrame:
    parts = found.filter(F.col("part").isNotNull())
    costs = T.StructType.fromDDL(f"conv_id {name}, part int, after array<long>")
    after = parts.select("conv_id", "part", "cells").groupBy("conv_id").applyInArrow(_fold("conv_id", _arrow(costs)), costs)
    after = after.select(F.col("conv_id").alias("id"), F.col("part").alias("nth"), "after")
    both = parts.join(after, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("part") == F.col("nth")))
    ordered = both.select("conv_id", "part", "symbols", "roles", "texts", "after").repartition("conv_id")
    ordered = ordered.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part")
    schema = T.StructType.fromDDL(f"conv_id {name}, " + (_TURN if detail else "cost long, audit string, repaired_sha256 string"))
    return ordered.mapInArrow(_unroll(_arrow(schema), detail), schema)


def repaired(turns: DataFrame, present: Column | None = None, part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES) -> DataFrame:
    """A row for each conv_id of ``turns`` (conv_id, turn, role, text): faults, cost, audit and digest of the repair.

    ``present`` marks the rows that count; a conversation without any has zeros, an empty audit and the digest of
    nothing. ``repaired_sha256`` is that of the repaired ``role:text`` joined by newlines.
    """
    found, _, name = _parts(turns, present, part_rows, part_bytes, False)
    counts = [c.split()[0] for c in COUNTS.split(", ")]
    whole = found.filter((F.col("parts") == 0) & F.col("part").isNull())
    columns = ["conv_id", *counts, "cost", "audit", "repaired_sha256"]
    if found.filter(F.col("part").isNotNull()).isEmpty():
        return whole.select(columns)
    long = found.filter(F.col("parts") > 0).select(F.col("conv_id").alias("id"), *counts)
    ends = _unrolled_parts(found, name, False)
    return whole.select(columns).unionByName(ends.join(long, F.col("conv_id").eqNullSafe(F.col("id"))).select(columns))


def repaired_turns(turns: DataFrame, present: Column | None = None, part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES) -> DataFrame:
    """A row for each edit: conv_id, step, edit (K, R, D, I), role and text; without the D rows the repaired conversation."""
    found, _, name = _parts(turns, present, part_rows, part_bytes, True)
    whole = found.filter(F.col("parts") == 0)
    each = whole.select("conv_id", F.posexplode(F.arrays_zip(F.split("symbols", "").alias("edit"), F.col("roles"), F.col("texts"))))
    short = each.filter(F.col("col.edit") != "").select("conv_id", F.col("pos").cast("long").alias("step"), "col.edit", F.col("col.roles").alias("role"), F.col("col.texts").alias("text"))
    return short.unionByName(_unrolled_parts(found, name, True))
