"""Benchmark leaks by greedy string tiling.

**Seeds.**  A document and a test item meet if they share a run of ``min_match`` words.  A bit
filter of fixed size, made of all item runs, passes over the documents first; only documents
with a run in it send rows on, and these are joined with the item runs by key.

**Tiling.**  For every pair, the longest common runs of words that do not overlap earlier ones
are marked, longest first; runs of a given length are found by running Karp-Rabin sums over
both sides, with the length halved from round to round.  The share of the item's words under
tiles is its coverage, whatever order the passages stand in.  A document is contaminated if
the coverage of some item reaches ``threshold``.

Words are runs of letters, digits and non-ASCII characters, lower-cased.

Cases: null and empty texts share nothing.  Items with fewer words than ``min_match`` take no
part.  Rows that share a document id are judged together: the best coverage of any of them.
A null document id is an id.  Among items with equal coverage the smallest id is named; items
that share an id count as the better one.  Empty tables give no contamination.  Other columns
are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgrain.llm.common import BYTE_CODES, mix, prefix_hash, span_hash, text_runs, word_spans
from textgrain.session import durable, scratch

MIN_MATCH = 5
THRESHOLD = 0.5
FIRST_LENGTH = 32
FILTER_BITS = 24
FILTER_PARTS = 8

# Everything in ASCII but letters and digits separates words.
SEPARATOR = np.ones(256, bool)
SEPARATOR[128:] = False
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    SEPARATOR[_low:_high] = False


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and per text the number of its first word."""
    starts, ends, first = word_spans(raw, offsets, SEPARATOR)
    return span_hash(prefix_hash(raw, BYTE_CODES), starts, ends), first


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(words) - length + 1, np.uint64)
    for k in range(length):
        sums = sums * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - length + 1 + k]
    return mix(sums)


def filter_places(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - FILTER_BITS)
    return (runs >> shift).astype(np.int64), ((runs << np.uint64(FILTER_BITS)) >> shift).astype(np.int64)


def running_sums(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin sums of all runs of ``length`` words, from one pass of running sums."""
    sums = prefix_words(words)
    power = np.uint64(pow(WORD_BASE, length, 1 << 64))
    return sums[length:] - sums[:-length] * power


WORD_BASE = 0xD1B54A32D192ED03


def prefix_words(words: np.ndarray) -> np.ndarray:
    """``sums[i + 1] = sums[i] * base + words[i]``, by means of inverse powers."""
    powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(words), WORD_BASE, np.uint64))), dtype=np.uint64)
    inverse = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(words), pow(WORD_BASE, -1, 1 << 64), np.uint64))), dtype=np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * inverse[1:], dtype=np.uint64, out=sums[1:])
    return sums * powers


def tiles(item: np.ndarray, text: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """``(place in item, place in text, length)`` of the marked runs, in the order of marking.

    Longest first; equal lengths by place in the item, then in the text.
    """
    found: list[tuple[int, int, int]] = []
    item_marked, text_marked = np.zeros(len(item) + 1, np.int64), np.zeros(len(text) + 1, np.int64)
    length = max(min_match, min(len(item), len(text), FIRST_LENGTH))
    while True:
        heap = []
        if len(item) >= length and len(text) >= length:
            ours, theirs = running_sums(item, length), running_sums(text, length)
            open_item = np.flatnonzero(free_runs(item_marked, length))
            open_text = np.flatnonzero(free_runs(text_marked, length))
            open_text = open_text[np.isin(theirs[open_text], ours[open_item])]
            order = np.argsort(theirs[open_text], kind="stable")
            keys = theirs[open_text][order]
            for i in open_item.tolist():
                low, high = np.searchsorted(keys, ours[i], "left"), np.searchsorted(keys, ours[i], "right")
                for j in open_text[order[low:high]].tolist():
                    if i and j and not item_marked[i - 1] and not text_marked[j - 1] and item[i - 1] == text[j - 1]:
                        continue  # part of a longer run that starts earlier
                    size = common_run(item, text, item_marked, text_marked, i, j)
                    if size >= length:
                        heapq.heappush(heap, (-size, i, j))
        while heap:
            size, i, j = heapq.heappop(heap)
            size = -size
            taken = np.flatnonzero(item_marked[i : i + size] | text_marked[j : j + size])
            if not len(taken):
                item_marked[i : i + size] = 1
                text_marked[j : j + size] = 1
                found.append((i, j, size))
                continue
            # What is left of it between marked words, if still long enough.
            edges = np.concatenate(([-1], taken, [size]))
            for low, high in zip(edges[:-1] + 1, edges[1:]):
                if high - low >= length:
                    heapq.heappush(heap, (int(low - high), i + int(low), j + int(low)))
        if length <= min_match:
            return found
        length = max(min_match, length // 2)


def free_runs(marked: np.ndarray, length: int) -> np.ndarray:
    """Which runs of ``length`` hold no marked word; ``marked`` has one spare entry."""
    sums = np.concatenate(([0], np.cumsum(marked[:-1])))
    return sums[length:] == sums[:-length]


def common_run(item, text, item_marked, text_marked, i: int, j: int) -> int:
    room = min(len(item) - i, len(text) - j)
    differs = (item[i : i + room] != text[j : j + room]) | (item_marked[i : i + room] > 0) | (text_marked[j : j + room] > 0)
    stop = int(differs.argmax()) if room else 0
    return stop if room and differs[stop] else room


def worded(rows: DataFrame, key: str, text: str, min_match: int, bits=None) -> DataFrame:
    """``(key, words, runs)``: word hashes and distinct run hashes; with ``bits``, only of rows with a run in the filter."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, raw, offsets in text_runs(batch.column(1)):
                words, starts = words_of(raw, offsets)
                runs = run_hashes(words, min_match)
                # A run belongs to a text if its last word does.
                owner = np.searchsorted(starts, np.arange(len(runs)), side="right") - 1
                keep = np.arange(len(runs)) + min_match <= starts[np.minimum(owner + 1, len(starts) - 1)]
                if bits is not None:
                    one, two = filter_places(runs)
                    table = bits.value
                    keep &= ((table[one >> 3] >> (one & 7).astype(np.uint8)) & (table[two >> 3] >> (two & 7).astype(np.uint8)) & 1).astype(bool)
                line, held = owner[keep], runs[keep]
                for row in np.unique(line):
                    own = np.unique(held[line == row]) if bits is not None else np.unique(held[np.searchsorted(line, row) : np.searchsorted(line, row, "right")])
                    body = words[starts[row] : starts[row + 1]]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first + int(row), 1), pa.array([body.view(np.int64)], pa.list_(pa.int64())), pa.array([own.view(np.int64)], pa.list_(pa.int64()))], ["key", "words", "runs"]
                    )

    lowered = rows.select(F.col(key).alias("key"), F.lower(F.col(text)).alias("text")).filter(F.col("text").isNotNull())
    return lowered.mapInArrow(run, f"key {kind}, words array<bigint>, runs array<bigint>")


def run_filter(items: DataFrame) -> np.ndarray:
    """Bits of all item runs: a table of fixed size, united from a fixed number of parts."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            for place in filter_places(np.asarray(batch.column(0).flatten()).view(np.uint64)):
                bits[place] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["bits"])

    table = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in items.select("runs").repartition(FILTER_PARTS).mapInArrow(fill, "bits binary").collect():
        table |= np.frombuffer(row["bits"], np.uint8)
    return table


def tiled_pairs(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", min_match: int = MIN_MATCH
) -> DataFrame:
    """``(key, item_key, coverage, n_tiles)`` of every document and item that share a run."""
    tests = durable(worded(items, item_key, item_text, min_match).withColumnsRenamed({"key": "item", "words": "item_words"}))
    bits = docs.sparkSession.sparkContext.broadcast(run_filter(tests))
    found = durable(worded(docs, key, text, min_match, bits).withColumn("row", F.xxhash64("words")))
    pairs = (
        found.select("key", "row", F.explode("runs").alias("run"))
        .join(tests.select("item", F.xxhash64("item_words").alias("item_row"), F.explode("runs").alias("run")), "run")
        .select("key", "row", "item", "item_row")
        .distinct()
    )
    texts = found.dropDuplicates(["key", "row"]).select(F.col("key").alias("_key"), F.col("row").alias("_row"), "words")
    tests = tests.select(F.col("item").alias("_item"), F.xxhash64("item_words").alias("_item_row"), "item_words").dropDuplicates(["_item", "_item_row"])
    full = (
        pairs.join(tests, F.col("item").eqNullSafe(F.col("_item")) & (F.col("item_row") == F.col("_item_row")))
        .join(texts, F.col("key").eqNullSafe(F.col("_key")) & (F.col("row") == F.col("_row")))
        .select("key", "item", "item_words", "words")
    )

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coverage, number = [], []
            for item, words in zip(batch.column(2), batch.column(3)):
                ours = np.asarray(item.values).view(np.uint64)
                marked = tiles(ours, np.asarray(words.values).view(np.uint64), min_match)
                coverage.append(sum(size for _, _, size in marked) / len(ours))
                number.append(len(marked))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(coverage, pa.float64()), pa.array(number, pa.int32())], ["key", "item", "coverage", "n_tiles"])

    kinds = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    tiled = full.mapInArrow(tile, f"key {kinds[0]}, item {kinds[1]}, coverage double, n_tiles int")
    return tiled.withColumnsRenamed({"key": key, "item": item_key})


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    threshold: float = THRESHOLD, min_match: int = MIN_MATCH,
) -> DataFrame:
    """``(key, item_key, coverage, n_tiles, contaminated)`` per row: the item covered best."""
    with scratch() as tables:
        pairs = tiled_pairs(docs, items, key, text, item_key, item_text, min_match)
        best = pairs.groupBy(F.col(key).alias("_key")).agg(
            F.min(F.struct((-F.col("coverage")).alias("less"), F.col(item_key).alias("item"), F.col("n_tiles").alias("n"))).alias("best")
        )
        best = tables.keep(durable(best))
    return docs.select(key).join(best, F.col(key).eqNullSafe(F.col("_key")), "left").select(
        key, F.col("best.item").alias(item_key), F.coalesce(-F.col("best.less"), F.lit(0.0)).alias("coverage"),
        F.coalesce("best.n", F.lit(0)).alias("n_tiles"), (F.coalesce(-F.col("best.less"), F.lit(0.0)) >= threshold).alias("contaminated"),
    )
