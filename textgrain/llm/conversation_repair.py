"""Cheapest repairs of damaged conversations by depth-first branch-and-bound.

**Faults.**  Each row has its first fault at most: ``blank`` (no character that is not blank:
space, tab to carriage return), ``duplicate`` (role and text seen earlier in the conversation),
``truncated`` (the last such character is none of ``.!?``).

**Edits.**  A row is kept (``K``, 0), given the role user or assistant (``R``, 1) or deleted
(``D``, 2; required for blank and duplicate rows); an empty turn of user or assistant can be
inserted anywhere (``I``, 5); a truncated row that stays adds 5.  The repaired roles are
``(s?(ua)+)?`` by their initials.  The plan of the smallest cost is taken, of those the one
whose edits are ASCII-least.

**Search.**  A row only counts through its initial and fault, one byte per row.  Suffix lower
bounds say, per place and state of the pattern, what the rest costs at least.  An explicit
stack holds the open nodes; children are opened in ASCII order, so a later node is never
ASCII-less than an earlier one, and both tests are strict: a node goes on only if its cost is
below the one in the dominance table of its place and state, and if its cost and bound are
below the incumbent.  The search ends once the incumbent costs what the bound of the root says.

Conversations are searched where their rows meet, sorted, without their texts: texts are
represented by a digest there, and duplicates are found by a join beforehand.  A second pass
streams the texts along the edits, so a task holds edits of one conversation, never its texts.

Cases: null roles and texts are one space; a role that is empty or has another initial cannot be
kept.  Null turns come first and do not count for gaps; rows of equal turn are taken by role, then
by the SHA-256 of the text.  A null id is a conversation too.  A conversation without rows has
counts of zero, an empty plan and the digest of the empty string.  Texts of any length count
whole.  Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrain.llm.common import parts_of
from textgrain.session import durable

BLANKS = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States of the pattern: nothing yet, after the system turn, an assistant turn is due, complete.
EMPTY, HEADED, OPEN, COMPLETE = range(4)
INITIALS = "sua"
KEPT = {(EMPTY, 0): HEADED, (EMPTY, 1): OPEN, (HEADED, 1): OPEN, (OPEN, 2): COMPLETE, (COMPLETE, 1): OPEN}
# The state after a turn of the role that is due, user or assistant.
GIVEN = (OPEN, OPEN, COMPLETE, OPEN)
DUE = ("user", "user", "assistant", "user")
FINE, MUST_GO, CUT = range(3)
LEGAL = {"su", "ua", "au"}
NO_TURNS = hashlib.sha256(b"").hexdigest()
D, I, K, R = b"DIKR"


def row_edits(symbol: int, state: int) -> list[tuple[int, int, int]]:
    """``(edit, cost, next state)`` of a row, in ASCII order."""
    initial, fault = symbol % 4, symbol // 4
    found = [(D, DELETE, state)]
    if fault != MUST_GO:
        more = TRUNCATED if fault == CUT else 0
        if (state, initial) in KEPT:
            found.append((K, more, KEPT[state, initial]))
        found.append((R, REROLE + more, GIVEN[state]))
    return found


EDITS = [[row_edits(symbol, state) for state in range(4)] for symbol in range(12)]
BEYOND = 1 << 60


def suffix_bounds(symbols: bytes) -> array:
    """What the rows from each place on cost at least, from each of the four states."""
    count = len(symbols)
    bounds = array("q", bytes(32 * (count + 1)))
    after = (0, BEYOND, BEYOND, 0)
    for place in range(count, -1, -1):
        if place < count:
            edits = EDITS[symbols[place]]
            after = tuple(min(cost + after[state] for _, cost, state in edits[k]) for k in range(4))
        # One inserted turn, or two: a user and an assistant.
        empty, headed, is_open, complete = after
        is_open, complete = min(is_open, INSERT + complete), min(complete, INSERT + is_open)
        after = (min(empty, INSERT + is_open), min(headed, INSERT + is_open), is_open, complete)
        bounds[4 * place : 4 * place + 4] = array("q", after)
    return bounds


def cheapest(symbols: bytes) -> tuple[int, str]:
    """``(cost, edits)`` of the cheapest plan, the ASCII-least of those."""
    count, bounds = len(symbols), suffix_bounds(symbols)
    dominance = array("q", [BEYOND]) * (4 * (count + 1))
    # Nothing dearer than the bound of the root is opened: it is met by a plan.
    incumbent, plan = bounds[EMPTY] + 1, b""
    path = bytearray()
    stack = [(0, D, 0, EMPTY, 0)]
    while stack:
        depth, edit, place, state, cost = stack.pop()
        node = 4 * place + state
        if cost >= dominance[node] or cost + bounds[node] >= incumbent:
            continue
        dominance[node] = cost
        if depth:
            del path[depth - 1 :]
            path.append(edit)
        if place == count and state in (EMPTY, COMPLETE):
            incumbent, plan = cost, bytes(path)
            if incumbent == bounds[EMPTY]:
                break
            continue
        children = [(depth + 1, I, place, GIVEN[state], cost + INSERT)]
        if place < count:
            own = [(depth + 1, edit, place + 1, after, cost + more) for edit, more, after in EDITS[symbols[place]][state]]
            children = [own[0], *children, *own[1:]]
        stack += reversed(children)
    return incumbent, plan.decode()


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns with faults put in by a checksum of id and turn; nulls become one space."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = turns.select(
        F.col(conv).alias("__conv"), F.col(turn).alias("__turn"), spaced(role).alias("__role"), spaced(text).alias("__text"),
        (F.crc32(F.encode(F.concat(spaced(conv), F.lit(":"), spaced(turn)), "utf-8")) % 20).alias("__code"),
    )
    code = F.col("__code")
    changed = F.when(code == 1, F.lit("")).when(code == 2, F.regexp_replace("__text", "[.!?]", "")).otherwise(F.col("__text"))
    return rows.filter(code != 0).select(
        F.col("__conv").alias(conv), F.col("__turn").alias(turn), F.when(code == 4, F.lit("user")).otherwise(F.col("__role")).alias(role), changed.alias(text),
        F.explode(F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"),
    ).drop("__copy")


def named_rows(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv, turn, role, text, digest)`` with a space for nulls."""
    filled = turns.select(
        F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    return filled.withColumn("digest", F.sha2("text", 256))


def repair_plans(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of every conversation with rows."""
    ends = F.rtrim("text", F.lit(BLANKS))
    shape = F.when(ends == "", 1).when(F.substring(ends, -1, 1).isin(".", "!", "?"), 0).otherwise(2)
    rows = named_rows(turns, conv, turn, role, text).select("conv", "turn", "role", "digest", shape.alias("shape"))
    # Repeated rows are counted before they are moved; first places come by a join that can be split.
    marks = rows.groupBy("conv", "turn", "role", "digest", "shape").agg(F.count(F.lit(1)).alias("copies"))
    marks = durable(marks)
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = marks.groupBy(F.col("conv").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest")).agg(F.min(place).alias("_first"))
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    known = marks.join(first, same).select(
        "conv", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "shape", "copies", F.col("turn").eqNullSafe(F.col("_first.turn")).alias("new")
    )
    kind = turns.schema[conv].dataType.simpleString()
    placed = known.repartition(parts_of(turns), "conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "digest")
    fields = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
    found = placed.select("conv", "turn", "initial", "shape", "copies", "new").mapInArrow(searched, f"conv {kind}, {fields}")
    return found.withColumnRenamed("conv", conv)


class Marks:
    """What the search needs to know of one conversation."""

    def __init__(self, conv):
        self.conv, self.symbols = conv, bytearray()
        self.counts = [0, 0, 0]
        self.illegal, self.last = 0, None
        self.low = self.high = self.turn = None
        self.turns = 0

    def add(self, turn: int | None, initial: str, shape: int, copies: int, new: bool) -> None:
        if turn is not None and (self.turns == 0 or turn != self.turn):
            self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn
            self.turns += 1
        at = INITIALS.find(initial) if initial else -1
        base = at if at >= 0 else 3
        fresh = 1 if new and shape != 1 else 0
        if fresh:
            self.symbols.append(base + 4 * (CUT if shape == 2 else FINE))
            self.counts[2] += shape == 2
        self.symbols += bytes([base + 4 * MUST_GO]) * (copies - fresh)
        self.counts[0 if shape == 1 else 1] += copies - fresh
        pairs = [(self.last, 1), (initial, copies - 1)]
        self.illegal += sum(n for before, n in pairs if before is not None and before + initial not in LEGAL)
        self.last = initial

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        cost, audit = cheapest(bytes(self.symbols))
        return (self.conv, gaps, *self.counts, self.illegal, cost, audit)


def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Plans of sorted rows ``(conv, turn, initial, shape, copies, new)``, a conversation at a time."""
    now, done, kind, held = None, [], None, 0
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [kind, *[pa.int64()] * 6, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(column, k) for column, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        kind = batch.column(0).type
        for conv, *mark in zip(*(column.to_pylist() for column in batch.columns)):
            if now is None or conv != now.conv:
                if now is not None:
                    done.append(now.row())
                    held += len(now.symbols)
                now = Marks(conv)
            now.add(*mark)
        if held > 1 << 16:
            yield packed(done)
            done, held = [], 0
    if now is not None:
        yield packed([*done, now.row()])


def repaired_turns(turns: DataFrame, plans: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, position, edit, role, text)``: the turns that the plans leave, change or insert.

    The rows of a conversation stand together, in order.
    """
    kind = turns.schema[conv].dataType.simpleString()
    rows = named_rows(turns, conv, turn, role, text).withColumn("kind", F.lit(1))
    heads = plans.select(
        F.col(conv).alias("conv"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit("").alias("digest"), F.lit(0).alias("kind")
    )
    placed = rows.unionByName(heads).repartition(parts_of(turns), "conv")
    placed = placed.sortWithinPartitions("conv", "kind", F.asc_nulls_first("turn"), "role", "digest")
    made = placed.select("conv", "kind", "role", "text").mapInArrow(edited, f"conv {kind}, position bigint, edit string, role string, text string")
    return made.withColumnRenamed("conv", conv)


class Plan:
    """The edits of one conversation and how far its rows have come."""

    def __init__(self, conv, edits: str):
        self.conv, self.edits, self.at, self.state, self.position = conv, edits, 0, EMPTY, 0

    def inserted(self) -> Iterator[tuple]:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
            yield self.turn("I", DUE[self.state], "")

    def turn(self, edit: str, role: str, text: str) -> tuple:
        self.state = KEPT[self.state, INITIALS.index(role[0])]
        self.position += 1
        return self.conv, self.position, edit, role, text

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit, self.at = self.edits[self.at], self.at + 1
        if edit != "D":
            yield self.turn(edit, DUE[self.state] if edit == "R" else role, text)


def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    plan, kind = None, None
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string()]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [kind, *kinds])], ["conv", "position", "edit", "role", "text"])

    for batch in batches:
        kind, done = batch.column(0).type, []
        for conv, is_row, role, text in zip(*(column.to_pylist() for column in batch.columns)):
            if is_row:
                done += plan.row(role, text)
                continue
            if plan is not None:
                done += plan.inserted()
            plan = Plan(conv, text)
        yield packed(done)
    if plan is not None:
        yield packed(list(plan.inserted()))


def turn_digests(repaired: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``(conv, repaired_sha256)`` of ``repaired_turns``: ``role:text`` of every turn, joined by line feeds."""
    kind = repaired.schema[conv].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for value, position, role, text in zip(*(column.to_pylist() for column in batch.columns)):
                if position == 1:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = value, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], batch.column(0).type), pa.array([d[1] for d in done])], ["conv", "sha"])
            kind_of = batch.column(0).type
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind_of), pa.array([digest.hexdigest()])], ["conv", "sha"])

    # A narrow step on the sorted rows: nothing is moved in between.
    made = repaired.select(F.col(conv).alias("conv"), "position", "role", "text").mapInArrow(run, f"conv {kind}, sha string")
    return made.select(F.col("conv").alias(conv), F.col("sha").alias("repaired_sha256"))


def repair_digests(turns: DataFrame, conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Counts, plan and digest of every id in ``conversations``, with or without rows in ``turns``."""
    plans = durable(repair_plans(turns, conv, turn, role, text))
    digests = turn_digests(repaired_turns(turns, plans, conv, turn, role, text), conv)
    ids = conversations.select(F.col(conv).alias("_id")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    planned = ids.join(plans, F.col("_id").eqNullSafe(F.col(conv)), "left").drop(conv)
    whole = planned.join(digests, F.col("_id").eqNullSafe(F.col(conv)), "left")
    return whole.select(
        F.col("_id").alias(conv), *[F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(NO_TURNS)).alias("repaired_sha256"),
    )
