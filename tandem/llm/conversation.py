"""Repair of conversations whose turns are lost, repeated, cut off or in the wrong role.

A conversation is well formed if its role initials are `(s?(ua)+)?`.  Each row is a symbol,
its role's initial and its fault; equal consecutive symbols are a run.  The states are what
the repaired part ends with (nothing, s, u, a).  A symbol is a min-plus matrix between
states: insertions, then the row's own edit.  From the end backwards a run of k rows is
passed by the cached powers M, M^2, M^4, ... of its matrix; the choices are unrolled
forwards, a run by halving, each row taking the ASCII-least edit that keeps the least cost.

Rows are handled in two passes of Spark: the first one carries no texts, only what makes
the symbols; the second one streams the texts of a conversation past its edits, so that no
task holds a conversation's texts.  A conversation is one sequence, and so goes through one
task; that task holds a few bytes for each of its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import ship

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3  # a row's fault; 0: none
OTHER = 3  # roles: s, u, a, any other one
START, S, U, A = range(4)  # states: what the repaired part ends with
NEXT = {(START, 0): S, (START, 1): U, (S, 1): U, (U, 2): A, (A, 1): U}  # a role after a state
ADDED = (U, U, A, U)  # the state after a user or assistant turn is put in
EDITS = "DIKR"  # in ASCII order
DELETE, INSERT, REROLE, UNREPAIRED = 3, 2, 2, 1
SPACES = " \t\n\x0b\x0c\r"

Vector = tuple[int, int, int, int]


def _row_edits(symbol: int) -> dict[str, dict[int, tuple[int, int]]]:
    """For each edit that takes a row: from a state, the state after it and the cost."""
    role, fault = divmod(symbol, 4)
    if fault in (BLANK, DUPLICATE):
        return {"D": {s: (s, DELETE) for s in range(4)}}
    more = UNREPAIRED if fault == TRUNCATED else 0
    return {"D": {s: (s, DELETE) for s in range(4)},
            "K": {s: (t, more) for (s, r), t in NEXT.items() if r == role},
            "R": {s: (t, REROLE + more) for s, t in enumerate(ADDED)}}


def _product(a: tuple[Vector, ...], b: tuple[Vector, ...]) -> tuple[Vector, ...]:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4))


_FAR = 1 << 40


def _inserted() -> tuple[Vector, ...]:
    """The least cost of insertions from state to state."""
    rows = []
    for state in range(4):
        row = [_FAR] * 4
        for k in range(3):
            row[state] = min(row[state], k * INSERT)
            state = ADDED[state]
        rows.append(tuple(row))
    return tuple(rows)


_INSERTED = _inserted()
#: what remains after the last row: insertions up to a well-formed end
END: Vector = tuple(min(row[START], row[A]) for row in _INSERTED)


@cache
def power(symbol: int, k: int) -> tuple[Vector, ...]:
    """The matrix of 2^k rows of the symbol."""
    if k:
        return _product(power(symbol, k - 1), power(symbol, k - 1))
    own = [[_FAR] * 4 for _ in range(4)]
    for way in _row_edits(symbol).values():
        for s, (t, cost) in way.items():
            own[s][t] = min(own[s][t], cost)
    return _product(_INSERTED, tuple(map(tuple, own)))


@cache
def _before(symbol: int, k: int, after: Vector) -> tuple[int, Vector]:
    """Costs before 2^k rows of the symbol from those after them (least 0): the least
    one and how far the others lie above it.  Few such vectors exist, so few are kept."""
    found = [min(c + v for c, v in zip(row, after)) for row in power(symbol, k)]
    least = min(found)
    return least, tuple(c - least for c in found)


def before(symbol: int, count: int, after: Vector) -> tuple[int, Vector]:
    """As `_before`, for ``count`` rows, by the binary digits of the count."""
    cost, k = 0, 0
    while count:
        if count & 1:
            more, after = _before(symbol, k, after)
            cost += more
        count, k = count >> 1, k + 1
    return cost, after


@cache
def _choice(symbol: int, state: int, after: Vector) -> tuple[str, int]:
    """The ASCII-least cheapest edits up to and including a row, and the state after it."""
    step, costs = _before(symbol, 0, after)
    edits, rest, row = "", step + costs[state], _row_edits(symbol)
    while True:
        for edit in EDITS:
            if edit == "I":
                to, cost = ADDED[state], INSERT
                left = step + costs[to]
            elif state in row.get(edit, ()):
                to, cost = row[edit][state]
                left = after[to]
            else:
                continue
            if cost + left == rest:
                break
        edits, state, rest = edits + edit, to, left
        if edit != "I":
            return edits, state


def plan(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """The least cost and the edits of a conversation given as runs (symbol, rows)."""
    low = min(END)
    vector: Vector = tuple(c - low for c in END)
    ends, total = [], low
    for symbol, count in reversed(runs):
        ends.append(vector)  # costs after the run
        more, vector = before(symbol, count, vector)
        total += more
    total += vector[START]
    edits, state = [], START

    def unroll(symbol: int, count: int, after: Vector) -> None:
        nonlocal state
        while count > 1:  # the first half, then go on with the second one
            half = count // 2
            unroll(symbol, half, before(symbol, count - half, after)[1])
            count -= half
        some, state = _choice(symbol, state, after)
        edits.append(some)

    for (symbol, count), after in zip(runs, reversed(ends)):
        unroll(symbol, count, after)
    while END[state]:
        edits.append("I")
        state = ADDED[state]
    return total, "".join(edits)


def symbols(rows: DataFrame) -> DataFrame:
    """What the first pass needs of each row: conv_id, turn, role, digest (of the text),
    copies and symbol, the role's initial * 4 + the first fault of the row's first copy.

    ``rows`` has conv_id, turn, role, text (no nulls in the last two) and copies: that many
    equal rows stand in the row's place, 0 for a lost one."""
    shown = F.rtrim("text", F.lit(SPACES))
    last = F.right(shown, F.lit(1))
    earlier = Window.partitionBy("conv_id", "role", "digest", "alone").orderBy(F.asc_nulls_first("turn"))
    # blank rows are blank, seen before or not: they need no common task
    made = (rows.withColumn("last", last).withColumn("digest", F.unhex(F.sha2("text", 256)))
            .withColumn("alone", F.when((F.col("last") == "") | (F.col("copies") == 0), F.coalesce(F.xxhash64("turn"), F.lit(0)))))
    fault = (F.when(F.col("last") == "", BLANK).when(F.row_number().over(earlier) > 1, DUPLICATE)
             .when(~F.col("last").isin(".", "!", "?"), TRUNCATED).otherwise(0))
    initial = F.left("role", F.lit(1))
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    return made.select("conv_id", "turn", "role", "digest", "copies", "last", "alone").select(
        "conv_id", "turn", "role", "digest", "copies", (role * 4 + fault).cast("int").alias("symbol"))


def _ordered(df: DataFrame, *first: str) -> DataFrame:
    """Each conversation together, its rows by turn (nulls first), role and text digest."""
    order = [F.asc_nulls_first(c) for c in ("conv_id", *first, "turn", "role", "digest")]
    return df.repartition("conv_id").sortWithinPartitions(*order)


def _streamed(rows: DataFrame, schema: str, work: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """``work`` over each partition's rows as tuples, in their order."""
    ship(rows.sparkSession)
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inputs = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        held, size = [], 0
        for row in work(inputs):
            held.append(row)
            size += 64 + sum(len(x) for x in row if isinstance(x, str))
            if size > 1 << 23:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), fields)], schema=fields)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), fields)], schema=fields)

    assert names == fields.names
    return rows.mapInArrow(run, schema)


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _plans(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, counts..., audit) from (conv_id, turn, copies, symbol) in order."""
    legal = {(0, 1), (1, 2), (2, 1)}
    none = object()
    conv, runs, faults = none, [], [0] * 4

    def done() -> tuple:
        roles = [symbol // 4 for symbol, _ in runs]
        illegal = sum((a, b) not in legal for a, b in zip(roles, roles[1:])) + sum(n - 1 for _, n in runs)
        cost, audit = plan(runs)
        gaps = last - first + 1 - turns if turns else 0
        return conv, gaps, *faults[1:], illegal, cost, audit

    for conv_id, turn, copies, symbol in rows:
        if conv_id != conv or conv is none:
            if conv is not none:
                yield done()
            conv, runs, faults, turns, first, last = conv_id, [], [0] * 4, 0, None, None
        if not copies:
            continue
        if turn is not None and turn != last:
            turns, first, last = turns + 1, turn if first is None else first, turn
        role, fault = divmod(symbol, 4)
        for fault in (fault, *[fault if fault == BLANK else DUPLICATE] * (copies - 1)):
            faults[fault] += 1
            symbol = role * 4 + fault
            if runs and runs[-1][0] == symbol:
                runs[-1] = symbol, runs[-1][1] + 1
            else:
                runs.append((symbol, 1))
    if conv is not none:
        yield done()


def plans(rows: DataFrame) -> DataFrame:
    """conv_id (as text), the counts of faults, the least cost and the edits (audit: K keep,
    R rerole, D delete, I insert) of each conversation of ``rows`` (see `symbols`)."""
    narrow = symbols(rows.withColumn("conv_id", F.col("conv_id").cast("string")))
    ready = _ordered(narrow).select("conv_id", F.col("turn").cast("long"), "copies", "symbol")
    return _streamed(ready, f"conv_id string, {COUNTS}, audit string", _plans)


def _together(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The rows of each conversation in order, its plan before them (is_row 0)."""
    kept = rows.where("copies > 0").select(
        F.col("conv_id").cast("string").alias("conv_id"), F.lit(1).alias("is_row"), F.col("turn").cast("long").alias("turn"),
        "role", "text", "copies", F.unhex(F.sha2("text", 256)).alias("digest"))
    first = plans.withColumn("is_row", F.lit(0))
    both = first.unionByName(kept, allowMissingColumns=True)
    return _ordered(both, "is_row").select("is_row", "turn", "role", "text", "copies", *first.drop("is_row").columns)


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(plan's row, step, edit, turn, role, text) for each edit in order; step -1 opens a
    conversation, so that empty ones are seen too."""
    opened, step, state = None, 0, START

    def inserted(upto: str) -> Iterator[tuple]:
        nonlocal step, state
        audit = opened[-1]
        while step < len(audit) and audit[step] == "I" and upto:
            state = ADDED[state]
            yield opened, step, "I", None, "user" if state == U else "assistant", ""
            step += 1

    for is_row, turn, role, text, copies, *head in rows:
        if not is_row:
            if opened:
                yield from inserted("end")
            opened, step, state = tuple(head), 0, START
            yield opened, -1, None, None, None, None
            continue
        for _ in range(copies):
            yield from inserted("row")
            edit = opened[-1][step]
            if edit == "K":
                state = NEXT[state, "sua".index(role[0])]
            elif edit == "R":
                state = ADDED[state]
                role = "user" if state == U else "assistant"
            yield opened, step, edit, turn, role, text
            step += 1
    if opened:
        yield from inserted("end")


def repaired(rows: DataFrame) -> DataFrame:
    """The edits of all conversations of ``rows`` (see `symbols`) as rows in their order:
    conv_id (as text), step, edit, turn (null if inserted), role and text.  Those of edit D
    are no part of the repaired conversation."""
    def work(inputs):
        return ((head[0], step, *rest) for head, step, *rest in _edited(inputs) if step >= 0)

    return _streamed(_together(rows, plans(rows)), "conv_id string, step long, edit string, turn long, role string, text string", work)


def _digests(inputs: Iterator[tuple]) -> Iterator[tuple]:
    opened, total = None, None
    for head, step, edit, _, role, text in _edited(inputs):
        if step < 0:
            if opened:
                yield *opened, total.hexdigest()
            opened, total, begun = head, hashlib.sha256(), False
        elif edit != "D":
            total.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
            begun = True
    if opened:
        yield *opened, total.hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's trial rows: lost (copies 0), emptied, without their full stops,
    doubled (copies 2) or in the user's role, by a hash of conv_id and turn."""
    def known(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text, role = known("text"), known("role")
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def op11(conversations: DataFrame) -> DataFrame:
    """Counts of faults, least cost, edits and a digest of the repaired text of each
    conversation, after the trial damage.

    Null roles and texts are one space; rows without a conv_id are one conversation, whose
    conv_id is null.  Rows of one turn go by role and text digest, equal ones together.
    Conversations all of whose rows are lost have zeros, no edits and the digest of the
    empty string.  An empty table gives none; other columns are not read.  Texts of any
    length are streamed."""
    kind = conversations.schema["conv_id"].dataType
    rows = damaged(conversations)
    out = _streamed(_together(rows, plans(rows)), f"conv_id string, {COUNTS}, audit string, repaired_sha256 string", _digests)
    return out.withColumn("conv_id", F.col("conv_id").cast(kind))
