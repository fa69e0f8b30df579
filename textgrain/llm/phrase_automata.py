"""Repeated word passages of a corpus, located by Aho-Corasick automata.

A word is removed if it lies in a window of ``window`` consecutive words whose word sequence
also starts anywhere else, in the same text or another one.

**Confirmed passages.**  Every window is represented by an anchor: of the ``gram``-word runs in
it, the one with the smallest hash.  Equal windows have equal anchors, so only windows around
anchors that occur twice can recur.  Those are counted by a 128-bit hash of their words; of a
window that occurs twice only its first place is kept, and the places of a text that follow
each other at one anchor are cut out as one passage.  Where else a window stands is not kept.

**Sharded automata.**  Texts that share their smallest repeated anchor go to the same block,
of bounded size; a block gets the passages of the anchors that its texts have.  It compiles
their windows into automata over numbers of words, ``AUTOMATON_WINDOWS`` at a time, and streams
all its texts through each.  Every place that an automaton reports is a repeated window, equal
word by word.  What a shared anchor cannot reach has no repeated window and is not streamed.

Texts of equal words are one text: with a second copy, all its words are removed if they fill
a window.  Texts are named by a 128-bit hash of their words.

Cases: words are runs without blanks (space, tab to carriage return), unchanged; a null text
has none.  Shorter texts keep everything; windows never cross texts.  Repeated rows are copies
of each other; a key may be null or repeated.  A text of any length counts whole.  Other
columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgrain.llm.common import BYTE_CODES, mix, parts_of, prefix_hash, released, span_hash, text_runs, word_spans
from textgrain.llm.string_tiling import run_hashes
from textgrain.session import durable, scratch

WINDOW, GRAM = 35, 8
BLOCK_BYTES = 4 << 20
AUTOMATON_WINDOWS = 50_000
OTHER_CODES = mix(np.arange(1, 257, dtype=np.uint64), 91)
PLACE = np.uint64((1 << 32) - 1)
NOTHING = hashlib.sha256(b"").hexdigest()
SPANS = "array<struct<start: int, stop: int>>"


class Words:
    """Words of a run of texts as hashes; ``first[k]`` is the first word of text k."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        starts, ends, self.first = word_spans(raw, offsets)
        self.one = span_hash(prefix_hash(raw), starts, ends)
        self.two = span_hash(prefix_hash(raw, OTHER_CODES), starts, ends)

    def names(self) -> list[bytes]:
        """16 bytes per text, the same for equal word sequences."""
        found = []
        for low, high in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            place = mix(np.arange(high - low, dtype=np.uint64), 92)
            pair = [int(mix((words[low:high] ^ place) * np.uint64(2 * k + 3), 93).sum(dtype=np.uint64)) for k, words in enumerate((self.one, self.two))]
            found.append(b"".join(v.to_bytes(8, "big") for v in pair))
        return found

    def anchors(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
        """``(names, chosen)``: gram hashes, and per window start the place of its anchor or -1."""
        names = run_hashes(self.one, gram)
        number = len(self.one) - window + 1
        if number <= 0:
            return names, np.zeros(0, np.int64)
        keys = (names & ~PLACE) | np.arange(len(names), dtype=np.uint64)
        span = window - gram + 1
        blocks = np.full(-(-len(keys) // span) * span, np.uint64(2**64 - 1), np.uint64)
        blocks[: len(keys)] = keys
        blocks = blocks.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        chosen = (np.minimum(behind[:number], ahead[span - 1 : span - 1 + number]) & PLACE).astype(np.int64)
        inside = np.zeros(number + 1, np.int32)
        long = np.flatnonzero(np.diff(self.first) >= window)
        np.add.at(inside, self.first[long], 1)
        np.add.at(inside, self.first[long + 1] - window + 1, -1)
        chosen[np.cumsum(inside[:number]) <= 0] = -1
        return names, chosen


def scanned(docs: DataFrame, key: str, text: str, window: int, gram: int) -> DataFrame:
    """``(key, code, n, name, sha, size, anchors)`` per row; ``code`` tells rows of a key apart."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, raw, offsets in text_runs(batch.column(2)):
                words = Words(raw, offsets)
                names, chosen = words.anchors(window, gram)
                edge = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1]))) if len(chosen) else np.zeros(0, np.int64)
                places = chosen[edge][chosen[edge] >= 0]
                bounds = np.searchsorted(places, words.first).astype(np.int32)
                digests = [hashlib.sha256(b" ".join(raw[a:b].tobytes().split())).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]
                own = [batch.column(k).slice(start, stop - start) for k in (0, 1)]
                columns = [
                    pa.array(np.diff(words.first).astype(np.int64)), pa.array(words.names(), pa.binary()), pa.array(digests, pa.string()),
                    pa.array(np.diff(offsets).astype(np.int64)), pa.ListArray.from_arrays(bounds, pa.array(names[places].view(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays([*own, *columns], ["key", "code", "n", "name", "sha", "size", "anchors"])

    rows = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text).cast("string")).alias("code"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, code bigint, n bigint, name binary, sha string, size bigint, anchors array<bigint>")


def windows_of(picked: DataFrame, window: int, gram: int) -> DataFrame:
    """``(one, two, anchor, id, start, single)`` of every window around a repeated anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, single = np.asarray(batch.column(0)), np.asarray(batch.column(3).cast(pa.int8()))
            for start, stop, raw, offsets in text_runs(batch.column(1)):
                words = Words(raw, offsets)
                names, chosen = words.anchors(window, gram)
                one, two = run_hashes(words.one, window), run_hashes(words.two, window)
                bounds = np.searchsorted(np.arange(len(chosen)), words.first)
                found = []
                for k in range(stop - start):
                    low, high = bounds[k], max(bounds[k], bounds[k + 1] - window + 1 if k + 1 < stop - start else len(chosen))
                    shared = np.asarray(batch.column(2)[start + k].values)
                    keep = low + np.flatnonzero(chosen[low:high] >= 0)
                    keep = keep[np.isin(names[chosen[keep]].view(np.int64), shared)]
                    found.append((keep, np.full(len(keep), k)))
                at, text = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one[at].view(np.int64)), pa.array(two[at].view(np.int64)), pa.array(names[chosen[at]].view(np.int64)),
                        pa.array(ids[start + text]), pa.array((at - words.first[text]).astype(np.int32)), pa.array(single[start + text].astype(np.int32)),
                    ],
                    ["one", "two", "anchor", "id", "start", "single"],
                )

    return picked.select("id", "text", "shared", "single").mapInArrow(run, "one bigint, two bigint, anchor bigint, id bigint, start int, single int")


def passages(picked: DataFrame, recurring: DataFrame, window: int) -> DataFrame:
    """``(anchor, passage)``: the words of windows ``(anchor, id, start)`` that follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors, found = [], []
            for text, starts, names in zip(*batch.columns):
                words = text.as_py().encode("utf-8").split()
                at, own = np.asarray(starts.values), np.asarray(names.values)
                order = np.argsort(at, kind="stable")
                at, own = at[order], own[order]
                cut = np.flatnonzero((np.diff(at) > 1) | (own[1:] != own[:-1])) + 1
                for low, high in zip([0, *cut.tolist()], [*(cut - 1).tolist(), len(at) - 1]):
                    anchors.append(own[low])
                    found.append(b" ".join(words[at[low] : at[high] + window]))
            yield pa.RecordBatch.from_arrays([pa.array(anchors, pa.int64()), pa.array(found, pa.binary())], ["anchor", "passage"])

    listed = recurring.groupBy("id").agg(F.collect_list(F.struct("start", "anchor")).alias("at"))
    joined = listed.join(picked.select("id", "text"), "id").select("text", "at.start", "at.anchor")
    return joined.mapInArrow(run, "anchor bigint, passage binary")


def with_blocks(singles: DataFrame, block_bytes: int) -> DataFrame:
    """Add ``block`` to ``(id, size, shared)``: texts of one smallest anchor together, dealt when they are many."""
    least = singles.withColumn("least", F.array_min("shared"))
    groups = least.groupBy(F.col("least").alias("_least")).agg(F.ceil(F.sum("size") / F.lit(block_bytes)).cast("long").alias("deals"))
    total = singles.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    blocks = -(-int(total) // block_bytes) + 1
    deal = F.pmod(F.xxhash64("id"), F.col("deals"))
    return least.join(groups, F.col("least") == F.col("_least")).withColumn("block", F.pmod(F.xxhash64("least", deal), F.lit(blocks))).drop("least", "_least", "deals")


class Grams:
    """Numbers of the word runs of a block's texts, which other texts look up."""

    def __init__(self, step: int):
        # Lengths by doubling, the last one from two runs that overlap.
        self.shifts = []
        length = 1
        while length < step:
            shift = min(length, step - length)
            self.shifts.append(shift)
            length += shift
        self.tables: list[pd.Index] = []

    def numbers(self, words: np.ndarray, left: np.ndarray, fit: bool) -> np.ndarray:
        """Per place the number of the run that starts there; -1 at the end of a text or if unknown.

        ``left`` counts the words of the place's text from there on.
        """
        found, length = words, 1
        for level, shift in enumerate(self.shifts):
            length += shift
            after = np.concatenate((found[shift:], np.full(min(shift, len(found)), -1)))
            fine = np.flatnonzero((left >= length) & (found >= 0) & (after >= 0))
            pairs = (found[fine] << 32) | after[fine]
            if fit:
                numbers, known = pd.factorize(pairs)
                self.tables.append(pd.Index(known))
            else:
                numbers = self.tables[level].get_indexer(pairs)
            found = np.full(len(words), -1, np.int64)
            found[fine] = numbers
        return found


def countdown(sizes: np.ndarray) -> np.ndarray:
    """Words left in each text from each of its places on."""
    ends = np.cumsum(sizes)
    return np.repeat(ends, sizes) - np.arange(ends[-1] if len(ends) else 0)


class Block:
    """The texts of a block as numbers, and the places that its automata report.

    A window is read as the runs of ``step`` words that it consists of, a text as ``step``
    interleaved sequences of such runs.  A run is two letters, which keeps the automaton's nodes
    narrow.  Texts go through an automaton only where they have runs of its windows.
    """

    def __init__(self, window: int, limit: int):
        self.window, self.limit = window, limit
        self.step = max(d for d in range(1, min(window, 5) + 1) if window % d == 0)
        self.words: dict[bytes, int] = {}
        self.ids, self.texts, self.numbers = [], [], []
        self.passages, self.waiting = [], 0
        self.runs = None

    def add_text(self, key: int, text: bytes) -> None:
        self.ids.append(key)
        self.texts.append(text)
        words = self.words
        self.numbers.append(np.array([words.setdefault(w, len(words)) for w in text.split()], np.int64))

    def add_passage(self, passage: bytes) -> None:
        get = self.words.get
        self.passages.append(np.array([get(w, -1) for w in passage.split()], np.int64))
        self.waiting += max(0, len(self.passages[-1]) - self.window + 1)
        if self.waiting >= self.limit:
            self.stream()

    def read_texts(self) -> None:
        """Runs of all texts, once; then the order in which the interleaved sequences are read."""
        sizes = np.array([len(n) for n in self.numbers], np.int64)
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        left = countdown(sizes)
        self.grams = Grams(self.step)
        flat = np.concatenate(self.numbers) if len(sizes) else np.zeros(0, np.int64)
        self.runs = self.grams.numbers(flat, left, fit=True)
        text = np.repeat(np.arange(len(sizes)), sizes)
        lane = text * self.step + (np.arange(len(flat)) - self.first[text]) % self.step
        self.order = np.argsort(lane, kind="stable")
        self.lane = lane[self.order]
        self.hits = np.zeros(len(flat) + 1, bool)

    def stream(self) -> None:
        """All texts through an automaton of the waiting passages' windows."""
        if self.runs is None:
            self.read_texts()
        letters = self.window // self.step
        sizes = np.array([len(n) for n in self.passages], np.int64)
        flat = np.concatenate(self.passages) if len(sizes) else np.zeros(0, np.int64)
        self.passages, self.waiting = [], 0
        left = countdown(sizes)
        runs = self.grams.numbers(flat, left, fit=False)
        starts = np.flatnonzero(left >= self.window)
        windows = runs[starts[:, None] + np.arange(0, self.window, self.step)]
        # A window with a run that no text of the block has cannot stand in it.
        windows = windows[(windows >= 0).all(1)]
        if not len(windows):
            return
        used = np.unique(windows)
        base = int(len(used) ** 0.5) + 1
        renumbered = np.searchsorted(used, windows)
        spelled = np.stack((renumbered // base, base + renumbered % base), 2).reshape(len(windows), -1)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
        for word in spelled.tolist():
            automaton.add_word(tuple(word))
        automaton.make_automaton()
        known = np.full(int(max(self.runs.max(initial=-1), used[-1])) + 2, -1)
        known[used] = np.arange(len(used))
        read = known[self.runs[self.order]]  # the last entry serves the number -1
        here = read >= 0
        edge = np.flatnonzero(np.concatenate(([True], (here[1:] != here[:-1]) | (self.lane[1:] != self.lane[:-1]))))
        lengths = np.diff(np.append(edge, len(read)))
        # A stretch of enough known runs, and one letter of its own after it.
        take = np.flatnonzero(here[edge] & (lengths >= letters))
        if not len(take):
            return
        sizes = lengths[take] + 1
        place = np.repeat(edge[take] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        stops = np.cumsum(sizes) - 1
        place[stops] = 0
        codes = read[place]
        stream = np.stack((codes // base, base + codes % base), 1)
        stream[stops] = 2 * base
        ends = np.fromiter((end for end, _ in automaton.iter(tuple(stream.ravel().tolist()))), np.int64)
        self.hits[self.order[place[ends // 2 - letters + 1]]] = True

    def rows(self) -> Iterator[tuple]:
        self.stream()
        for k, (key, text) in enumerate(zip(self.ids, self.texts)):
            starts = np.flatnonzero(self.hits[self.first[k] : self.first[k + 1]])
            if not len(starts):
                continue
            edge = np.flatnonzero(np.diff(starts) > self.window)
            spans = list(zip(starts[np.concatenate(([0], edge + 1))].tolist(), (starts[np.append(edge, len(starts) - 1)] + self.window).tolist()))
            words, kept, at = text.split(), [], 0
            for low, high in spans:
                kept += words[at:low]
                at = high
            kept += words[at:]
            yield key, len(words) - len(kept), [{"start": a, "stop": b} for a, b in spans], b" ".join(kept)


def located(texts: DataFrame, shards: DataFrame, window: int, limit: int) -> DataFrame:
    """``(id, removed, spans, kept)`` of the texts ``(block, id, text)`` in which passages ``(block, passage)`` occur."""
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, None

        def packed() -> Iterator[pa.RecordBatch]:
            rows = [(*row[:3], row[3].decode("utf-8")) for row in block.rows()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["id", "removed", "spans", "kept"])

        for batch in batches:
            for name, is_text, key, body in zip(*batch.columns):
                if block is None or name.as_py() != now:
                    if block is not None:
                        yield from packed()
                    now, block = name.as_py(), Block(window, limit)
                if is_text.as_py():
                    block.add_text(key.as_py(), body.as_py())
                else:
                    block.add_passage(body.as_py())
        if block is not None:
            yield from packed()

    rows = texts.select("block", F.lit(True).alias("is_text"), "id", F.encode("text", "utf-8").alias("body")).unionByName(
        shards.select("block", F.lit(False).alias("is_text"), F.lit(0).cast("bigint").alias("id"), F.col("passage").alias("body"))
    )
    placed = rows.repartition(parts_of(texts), "block").sortWithinPartitions("block", F.desc("is_text"))
    return placed.mapInArrow(run, f"id bigint, removed bigint, spans {SPANS}, kept string")


def phrase_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES, limit: int = AUTOMATON_WINDOWS,
) -> DataFrame:
    """``(key, n_words, n_removed, spans, kept_sha256)`` of every row.

    ``spans`` are the removed runs of words; ``kept_sha256`` is the digest of the words that are
    left, joined by one space.
    """
    spark = docs.sparkSession
    with scratch() as tables:
        rows = tables.keep(durable(scanned(docs, key, text, window, gram)))
        classes = rows.groupBy("name").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("key", "code")).alias("at"), F.first("n").alias("n"), F.first("size").alias("size"), F.first("anchors").alias("anchors")
        )
        classes = tables.keep(durable(classes.withColumn("id", F.monotonically_increasing_id())))
        placed = classes.select("id", F.explode("anchors").alias("anchor"))
        # Counts are written before they are joined, so that a hot anchor's join can be split.
        shared = durable(placed.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("anchor"))
        listed = placed.join(shared, "anchor").groupBy("id").agg(F.collect_set("anchor").alias("shared"))
        chosen = durable(listed.join(classes.select("id", "name", "at", "size", (F.col("copies") == 1).alias("single")), "id"))
        source = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("text")).withColumn("_code", F.xxhash64("text"))
        same = F.col("_key").eqNullSafe(F.col("at.key")) & (F.col("_code") == F.col("at.code"))
        picked = durable(source.join(chosen, same).select("id", "text", "shared", "single", "size"))
        released(spark)
        counted = windows_of(picked, window, gram).groupBy("one", "two").agg(
            # A text with copies counts twice; only texts without are searched for windows.
            F.sum(2 - F.col("single")).alias("k"), F.sum("single").alias("searched"), F.min(F.struct("id", "start", "anchor")).alias("at")
        )
        recurring = durable(counted.filter("k > 1 AND searched > 0").select("at.*"))
        released(spark)
        cut = durable(passages(picked, recurring, window))
        singles = picked.filter("single")
        homes = durable(with_blocks(singles.select("id", "size", "shared"), block_bytes))
        wanted = homes.select("block", F.explode("shared").alias("anchor")).distinct()
        shards = cut.join(wanted, "anchor").select("block", "passage")
        texts = singles.join(homes.select("id", "block"), "id").select("block", "id", "text")
        found = durable(located(texts, shards, window, limit).select("id", "removed", "spans", F.sha2("kept", 256).alias("kept_sha")))
        named = classes.select("name", "id", "copies").join(found, "id", "left").filter((F.col("copies") > 1) | F.col("removed").isNotNull())
        named = tables.keep(durable(named))
    released(spark)
    whole = (F.col("copies") > 1) & (F.col("n") >= window)
    everything = F.array(F.struct(F.lit(0).alias("start"), F.col("n").cast("int").alias("stop")))
    return rows.select("key", "n", "name", "sha").join(named, "name", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_words"), F.when(whole, F.col("n")).otherwise(F.coalesce("removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(whole, everything).otherwise(F.coalesce("spans", F.array().cast(SPANS))).alias("spans"),
        F.when(whole, F.lit(NOTHING)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
    )


def phrase_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``(key, n_words, n_removed, kept_sha256)`` of every row."""
    return phrase_spans(docs, key, text, window).drop("spans")
