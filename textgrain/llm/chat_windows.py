"""Conversations as training windows of a token budget, cut at turns.

**Windows by prefix sums.**  The tokens of the turns are summed along each conversation.
With a step of half the budget that is left after a reserve for the system turn, a turn
belongs to the window in whose step its last token falls; a turn longer than a step has a
window of its own.  So the new turns of a window stay below two steps.  Every later window
starts with the conversation's system turn and as many preceding turns as the history limit
and the budget allow; these repeated turns are masked, so each assistant turn is a target
once.  Sums run over range-partitioned buckets: one conversation may hold any share of the
rows.

**Template.**  ``<turn ROLE>TEXT</turn>`` and a line feed; backslash and angle brackets of
role and text are escaped with a backslash, so no text can form a mark, and reading back is
exact.

Cases: null role and text are empty; turns are ordered by turn (null first), role, text;
repeated rows are turns of their own; a null conversation id is a conversation.  A system
turn is one whose conversation starts with it.  If the system turn or a single turn does not
fit, the window is kept whole and marked ``over_budget``.  Empty input gives no window.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textgrain.llm.common import parts_of
from textgrain.operators.ordering import BUCKET, range_buckets

BUDGET = 2048
# Of the budget, this part is kept for the system turn, and history repeats at most this part.
SYSTEM_SHARE = 8
HISTORY_SHARE = 8
# Tokens that the marks of a turn count for.
MARK_TOKENS = 4
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"

WINDOW_FIELDS = (
    "first_position bigint, text string, n_tokens bigint, n_repeated bigint, "
    "loss_spans array<struct<start: bigint, end: bigint>>, over_budget boolean"
)
ESCAPED = re.compile(r"[\\<>]")
ESCAPE = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"<turn ((?:[^\\<>]++|\\.)*+)>((?:[^\\<>]++|\\.)*+)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return ESCAPED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return ESCAPE.sub(r"\1", text)


def turns_of(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of every turn of a formatted window."""
    position = 0
    while position < len(formatted):
        found = TURN.match(formatted, position)
        if found is None:
            raise ValueError(f"no turn at {position}: {formatted[position:position + 60]!r}")
        yield unescape(found[1]), unescape(found[2])
        position = found.end()


def word_tokens(text: Column) -> Column:
    """Default count: runs of ASCII word characters, and every other visible character."""
    return F.regexp_count(text, F.lit(r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\r\n]")).cast("long")


def with_prefix_sums(turns: DataFrame, order: list[str], totals: dict[str, Column]) -> DataFrame:
    """Inclusive running sums along each conversation.

    Buckets are ranges of (conversation, order), so at most one conversation of a bucket
    began in an earlier one: the table of carried sums has a row per bucket at most, and
    that is what is broadcast.
    """
    columns = [F.col("conv").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    placed = range_buckets(turns, *columns)
    sums = placed.groupBy("conv", BUCKET).agg(*[F.sum(v).alias(f"_{n}") for n, v in totals.items()])
    earlier = Window.partitionBy("conv").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        F.col("conv").alias("_conv"), F.col(BUCKET).alias("_at"), *[F.sum(f"_{n}").over(earlier).alias(f"_{n}") for n in totals]
    ).filter(F.col(f"_{next(iter(totals))}").isNotNull())
    inner = Window.partitionBy(BUCKET, "conv").orderBy(*columns[1:]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.select("*", *[F.sum(v).over(inner).alias(n) for n, v in totals.items()])
    joined = local.join(F.broadcast(carried), F.col("conv").eqNullSafe(F.col("_conv")) & (F.col(BUCKET) == F.col("_at")), "left")
    return joined.select(
        *turns.columns, *[(F.col(n) + F.coalesce(F.col(f"_{n}"), F.lit(0))).alias(n) for n in totals]
    )


def chat_windows(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    tokens=word_tokens,
) -> DataFrame:
    """One row per window: the conversation id and ``WINDOW_FIELDS``.

    ``first_position`` orders the windows of a conversation, ``n_repeated`` leading turns are
    repeated, ``loss_spans`` are the code points under the loss mask.
    """
    step = max(1, (budget - budget // SYSTEM_SHARE) // 2)
    history = min(step, budget // HISTORY_SHARE)
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("tokens", tokens(F.col("text")) + F.lit(MARK_TOKENS))
    long = F.col("tokens") > step
    summed = with_prefix_sums(
        rows, ["turn", "role", "text"], {"until": F.col("tokens"), "position": F.lit(1), "longs": long.cast("long")}
    ).select(
        "conv", "role", "text", "tokens", "position",
        (F.col("until") - F.col("tokens")).alias("since"),
        F.floor((F.col("until") - 1) / step).cast("long").alias("step"), "longs", long.alias("long"),
    )
    key = ["step", "longs", "long"]
    members = F.struct("position", "role", "text", "tokens", F.lit(False).alias("repeated"))
    # A window's new turns hold less than two steps of tokens, or are one turn.
    windows = summed.groupBy("conv", *key).agg(
        F.collect_list(members).alias("turns"), F.sum("tokens").alias("new"), F.min("since").alias("start"), F.min("position").alias("first_position")
    )
    system = summed.filter((F.col("position") == 1) & (F.col("role") == SYSTEM_ROLE)).select(
        F.col("conv").alias("_conv"), F.struct("position", "role", "text", "tokens", F.lit(True).alias("repeated")).alias("system")
    )
    windows = windows.join(system, F.col("conv").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    windows = windows.withColumn("system", F.when(F.col("first_position") > 1, F.col("system")))
    allowed = F.least(F.lit(history), F.lit(budget) - F.coalesce(F.col("system.tokens"), F.lit(0)) - F.col("new"))
    # A turn that is repeated starts in the step in which the window starts, or in the one before.
    wanted = windows.filter((F.col("start") > 0) & (allowed > 0)).select(
        F.col("conv").alias("_conv"), "first_position", "start", allowed.alias("allowed"), (F.col("system").isNotNull()).alias("has_system"),
        F.explode(F.array(F.floor(F.col("start") / step), F.floor(F.col("start") / step) - 1)).alias("_block"),
    )
    earlier = summed.withColumn("block", F.floor(F.col("since") / step)).drop(*key)
    repeated = (
        earlier.withColumnRenamed("position", "_position")
        .join(wanted, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")))
        .filter((F.col("_position") < F.col("first_position")) & (F.col("start") - F.col("since") <= F.col("allowed")))
        .filter(~(F.col("has_system") & (F.col("_position") == 1)))
        .groupBy("conv", "first_position")
        .agg(F.collect_list(F.struct(F.col("_position").alias("position"), "role", "text", "tokens", F.lit(True).alias("repeated"))).alias("history"))
        .select(F.col("conv").alias("_conv"), F.col("first_position").alias("_first"), "history")
    )
    whole = windows.join(
        repeated, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("first_position") == F.col("_first")), "left"
    ).select(
        "conv", "first_position",
        F.concat(
            F.when(F.col("system").isNotNull(), F.array("system")).otherwise(F.slice("turns", 1, 0)),
            F.array_sort(F.coalesce("history", F.slice("turns", 1, 0))), F.array_sort("turns"),
        ).alias("turns"),
    )
    formatted = whole.mapInArrow(formatter(budget), f"conv {turns.schema[conv].dataType.simpleString()}, {WINDOW_FIELDS}")
    return formatted.withColumnRenamed("conv", conv)


def formatter(budget: int):
    schema = pa.schema([
        ("first_position", pa.int64()), ("text", pa.string()), ("n_tokens", pa.int64()), ("n_repeated", pa.int64()),
        ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("over_budget", pa.bool_()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for first, turns in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts, spans, at = [], [], 0
                for turn in turns:
                    head, body = f"<turn {escape(turn['role'])}>", escape(turn["text"])
                    if turn["role"] == TARGET_ROLE and not turn["repeated"]:
                        spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
                    parts += [head, body, "</turn>\n"]
                    at += len(head) + len(body) + len("</turn>\n")
                total = sum(turn["tokens"] for turn in turns)
                rows.append({"first_position": first, "text": "".join(parts), "n_tokens": total, "n_repeated": sum(t["repeated"] for t in turns), "loss_spans": spans, "over_budget": total > budget})
            made = pa.RecordBatch.from_pylist(rows, schema)
            yield pa.RecordBatch.from_arrays([batch.column(0), *made.columns], ["conv", *made.schema.names])

    return run


def read_windows(windows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Conversations read back from their windows, as digests.

    Per conversation: ``n_turns``, ``turns_sha256`` of role, line feed, text, line feed per
    turn, ``loss_chars`` and ``loss_sha256`` of the unescaped text under the loss mask, and
    ``formatted_chars`` of all its windows.  A digest runs along the whole conversation, so
    its windows pass through one task in order; the task keeps the digest, not the windows.
    """
    kind = windows.schema[conv].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        current, state = nothing, None
        for batch in batches:
            for key, text, repeated, spans in zip(*(c.to_pylist() for c in batch.columns)):
                if key != current or state is None:
                    if state is not None:
                        yield state.row(current)
                    current, state = key, Digest()
                state.add(text, repeated, spans)
        if state is not None:
            yield state.row(current)

    class Digest:
        def __init__(self) -> None:
            self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
            self.n_turns = self.loss_chars = self.formatted = 0

        def add(self, text: str, repeated: int, spans: list[dict]) -> None:
            for number, (role, body) in enumerate(turns_of(text)):
                if number >= repeated:
                    self.turns.update(f"{role}\n{body}\n".encode())
                    self.n_turns += 1
            for span in spans:
                target = unescape(text[span["start"] : span["end"]])
                self.loss.update(target.encode())
                self.loss_chars += len(target)
            self.formatted += len(text)

        def row(self, key) -> pa.RecordBatch:
            values = [[key], [self.n_turns], [self.turns.hexdigest()], [self.loss_chars], [self.loss.hexdigest()], [self.formatted]]
            kinds = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names)

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(windows.schema[conv].dataType)
    ordered = (
        windows.select(F.col(conv).alias("conv"), "text", "n_repeated", "loss_spans", "first_position")
        .repartition(parts_of(windows), "conv")
        .sortWithinPartitions("conv", "first_position")
        .select("conv", "text", "n_repeated", "loss_spans")
    )
    fields = f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return ordered.mapInArrow(read, fields).withColumnRenamed("conv", conv)
