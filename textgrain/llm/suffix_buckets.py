"""Repeated byte strings of a corpus by bucket refinement of suffixes.

A byte is removed if it lies in a string of ``width`` bytes that also starts anywhere else,
in the same text or another one.

**Bucket pointers.**  A suffix of interest is a place where such a string can start.  It is
represented by an *anchor*: of the q-grams that begin in its first ``width - q + 1`` bytes, the
one with the smallest hash.  Equal strings have the same anchor at the same distance, so

1. anchors are put into buckets by their q-gram; a bucket with one member is finished;
2. in the buckets that are left, the suffixes before an anchor are taken in blocks of equal
   distance, and the buckets are refined by the identifiers of later offsets: of the bytes
   that all strings of a block share (its core), and of the bytes they cover together;
   a block with a core of its own is finished without, one with a shared cover with matches;
3. only where a shared core holds different covers are the buckets refined down to single
   suffixes, again by identifiers composed of those at later offsets.

Identifiers are 64-bit hashes of the bytes, read for any span from one running sum, so a
refined identifier reuses the earlier ones instead of the text.  Buckets are counted before
the shuffle and joined by joins that can be split: no bucket is gathered anywhere.

Equal texts are one text: with a second copy, everything in it of at least ``width`` bytes is
removed.  Texts are named by a 64-bit hash.

Cases: a null text is empty; texts shorter than ``width`` keep everything; matches never
cross texts.  Repeated rows are copies of each other.  A text of any length counts whole.
Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrain.llm.common import mix, prefix_hash, released, span_hash, text_runs
from textgrain.session import durable, scratch

WIDTH = 200
GRAM = 72
BLOCK = 32
# Texts are taken about this many bytes at a time.
RUN_BYTES = 1 << 20
# Places are numbered within a run of texts by this many bits.
PLACE_BITS = 24


def anchors(raw: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """``(anchor, first, last, sums)``: anchors and the suffixes they stand for, as places of ``raw``."""
    sums = prefix_hash(raw)
    number = len(raw) - width + 1
    nothing = np.zeros(0, np.int64)
    if number <= 0:
        return nothing, nothing, nothing, sums
    inside = np.zeros(len(raw) + 1, np.int32)
    long = np.flatnonzero(np.diff(offsets) >= width)
    inside[offsets[long]] += 1
    inside[offsets[long + 1] - width + 1] -= 1
    valid = np.cumsum(inside[:number]) > 0
    places = np.arange(len(raw) - gram + 1)
    names = span_hash(sums, places, places + gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = (names & ~low) | places.astype(np.uint64)
    span = width - gram + 1
    blocks = np.full(-(-len(keys) // span) * span, np.uint64(2**64 - 1), np.uint64)
    blocks[: len(keys)] = keys
    blocks = blocks.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    chosen = (np.minimum(behind[:number], ahead[span - 1 : span - 1 + number]) & low).astype(np.int64)
    chosen[~valid] = -1
    edge = np.flatnonzero(chosen[1:] != chosen[:-1]) + 1
    first = np.concatenate(([0], edge))
    last = np.concatenate((edge, [number])) - 1
    # A run of suffixes must not go on in the next text: the place of the anchor tells them apart.
    real = chosen[first] >= 0
    return chosen[first[real]], first[real], last[real], sums


def pieces(raw: np.ndarray, offsets: np.ndarray, width: int, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Parts of a run of texts: the run itself, or overlapping pieces of one long text."""
    if len(raw) <= limit:
        yield 0, 0, raw, offsets
        return
    for k in range(len(offsets) - 1):
        start, stop = int(offsets[k]), int(offsets[k + 1])
        for low in range(start, max(start + 1, stop - width + 1), limit):
            part = raw[low : min(stop, low + limit + width - 1)]
            yield k, low - start, part, np.array([0, len(part)], np.int64)


def text_anchors(raw: np.ndarray, offsets: np.ndarray, width: int, gram: int, limit: int = 1 << 22):
    """``(text, anchor, first, last, name)`` with places counted within each text."""
    found = []
    for text, shift, part, bounds in pieces(raw, offsets, width, limit):
        anchor, first, last, sums = anchors(part, bounds, width, gram)
        owner = np.searchsorted(bounds, first, side="right") - 1
        names = span_hash(sums, anchor, anchor + gram)
        move = shift - bounds[owner]
        found.append((owner + text, anchor + move, first + move, last + move, names))
    return [np.concatenate(column) for column in zip(*found)]


def located(rows: DataFrame, width: int, gram: int) -> DataFrame:
    """``(name, text, anchor)`` of every anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = np.asarray(batch.column(0))
            for start, _, raw, offsets in text_runs(batch.column(1), RUN_BYTES):
                owner, anchor, _, _, names = text_anchors(raw, offsets, width, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.view(np.int64)), pa.array(texts[start + owner]), pa.array(anchor.astype(np.int32))], ["name", "text", "anchor"]
                )

    return rows.filter(F.col("n") >= width).select("id", "text").mapInArrow(run, "name bigint, text bigint, anchor int")


def regions(rows: DataFrame, width: int, gram: int) -> DataFrame:
    """The parts of texts around anchors that share a bucket, with these anchors.

    ``rows`` has ``(id, text, shared)``; the result ``(id, start, size, body, anchor, first, last)``.
    """
    kinds = "id bigint, start array<int>, size array<int>, body binary, anchor array<int>, first array<int>, last array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, raw, offsets in text_runs(batch.column(1), RUN_BYTES):
                owner, anchor, first, last, _ = text_anchors(raw, offsets, width, gram)
                bounds = np.searchsorted(owner, np.arange(stop - start + 1))
                columns: list[list] = [[] for _ in range(6)]
                for k in range(stop - start):
                    low, high = bounds[k], bounds[k + 1]
                    keep = np.isin(anchor[low:high], np.asarray(batch.column(2)[start + k].values))
                    p, a, b = (column[low:high][keep] for column in (anchor, first, last))
                    ends = np.maximum.accumulate(b + width) if len(b) else b
                    new = np.concatenate(([True], a[1:] > ends[:-1])) if len(a) else np.zeros(0, bool)
                    starts = a[new]
                    stops = np.append(ends[:-1][new[1:]], ends[-1:]) if len(a) else ends
                    body = raw[offsets[k] : offsets[k + 1]]
                    columns[0].append(starts.astype(np.int32))
                    columns[1].append((stops - starts).astype(np.int32))
                    columns[2].append(b"".join(body[s:e].tobytes() for s, e in zip(starts, stops)))
                    for place, values in zip((3, 4, 5), (p, a, b)):
                        columns[place].append(values.astype(np.int32))
                ints = pa.list_(pa.int32())
                arrays = [pa.array(c, pa.binary() if n == 2 else ints) for n, c in enumerate(columns)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), *arrays], ["id", "start", "size", "body", "anchor", "first", "last"])

    return rows.select("id", "text", "shared").mapInArrow(run, kinds)


class Region:
    """Running sums over the kept parts of a text, addressed by places of the whole text."""

    def __init__(self, start: np.ndarray, size: np.ndarray, body: bytes):
        self.start = start.astype(np.int64)
        self.shift = np.concatenate(([0], np.cumsum(size.astype(np.int64)))) [:-1] - self.start
        self.sums = prefix_hash(np.frombuffer(body, np.uint8))

    def names(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Identifiers of spans that each lie in one part."""
        shift = self.shift[np.searchsorted(self.start, low, side="right") - 1]
        return span_hash(self.sums, low + shift, high + shift)


def blocks(parts: DataFrame, width: int, block: int) -> DataFrame:
    """``(core, cover, id, first, last)``: blocks of suffixes at equal distance from an anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for k in range(batch.num_rows):
                start, size, anchor, first, last = (np.asarray(batch.column(n)[k].values).astype(np.int64) for n in (1, 2, 4, 5, 6))
                if not len(anchor):
                    continue
                region = Region(start, size, batch.column(3)[k].as_py())
                near, far = (anchor - last) // block, (anchor - first) // block
                count = far - near + 1
                item = np.repeat(np.arange(len(anchor)), count)
                level = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count) + near[item]
                p = anchor[item]
                low = np.maximum(first[item], p - level * block - block + 1)
                high = np.minimum(last[item], p - level * block)
                core = mix(region.names(p - level * block, p - level * block - block + 1 + width) ^ level.astype(np.uint64))
                cover = mix(region.names(low, high + width) ^ mix(((p - low) * 4096 + (p - high)).astype(np.uint64), 51))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)), pa.array(cover.view(np.int64)), pa.array(np.full(len(item), ids[k])), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))],
                    ["core", "cover", "id", "first", "last"],
                )

    return parts.select("id", "start", "size", "body", "anchor", "first", "last").mapInArrow(run, "core bigint, cover bigint, id bigint, first int, last int")


def suffixes(parts: DataFrame, width: int) -> DataFrame:
    """``(name, id, first)`` of every single suffix of the wanted blocks ``(low, high)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for k in range(batch.num_rows):
                start, size, low, high = (np.asarray(batch.column(n)[k].values).astype(np.int64) for n in (1, 2, 4, 5))
                region = Region(start, size, batch.column(3)[k].as_py())
                count = high - low + 1
                places = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(region.names(places, places + width).view(np.int64)), pa.array(np.full(len(places), ids[k])), pa.array(places.astype(np.int32))], ["name", "id", "first"]
                )

    return parts.select("id", "start", "size", "body", "low", "high").mapInArrow(run, "name bigint, id bigint, first int")


def repeated_suffixes(rows: DataFrame, width: int, gram: int, block: int) -> DataFrame:
    """``(id, first, last)``: ranges of places where a repeated string starts, per distinct text."""
    # Counts are written before they are joined: both sides of the join are then plain
    # exchanges, of which a hot bucket's can be split.
    shared = durable(located(rows, width, gram).groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("name"))
    found = durable(located(rows, width, gram).join(shared, "name").select("text", "anchor"))
    listed = found.groupBy("text").agg(F.collect_set("anchor").alias("shared"))
    least = rows.groupBy("id").agg(F.min("key").alias("least"))
    chosen = durable(listed.withColumnRenamed("text", "id").join(least, "id"))
    released(rows.sparkSession)
    # One row of each text: of equal texts the one with the smallest key.
    one = rows.join(chosen, "id").filter(F.col("key").eqNullSafe(F.col("least")))
    parts = durable(regions(one, width, gram))
    released(rows.sparkSession)
    # A core with one block is finished; the others are few.
    cores = durable(blocks(parts, width, block).groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("core"))
    held = durable(blocks(parts, width, block).join(cores, "core"))
    covers = held.groupBy("core", "cover").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "first", "last")).alias("at"))
    covers = durable(covers)
    whole = held.join(covers.filter(F.col("n") > 1).select("core", "cover"), ["core", "cover"]).select("id", "first", "last")
    # Buckets with a cover of one block: one block of each cover goes on as single suffixes.
    mixed = covers.groupBy("core").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("m")).filter((F.col("k") > 1) & (F.col("m") == 1)).select("core")
    wanted = covers.join(mixed, "core").select("at.*").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("ranges"))
    wanted = wanted.select("id", F.col("ranges.first").alias("low"), F.col("ranges.last").alias("high"))
    single = durable(suffixes(parts.join(wanted, "id"), width))
    again = durable(single.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("name"))
    found = single.join(again, "name").select("id", "first", F.col("first").alias("last"))
    return whole.unionByName(found)


def merged(first: np.ndarray, last: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed runs ``(start, stop)`` of ranges of starting places."""
    order = np.argsort(first, kind="stable")
    first, ends = first[order].astype(np.int64), np.maximum.accumulate(last[order].astype(np.int64) + width)
    if not len(first):
        return first, ends
    new = np.concatenate(([True], first[1:] > ends[:-1]))
    return first[new], np.append(ends[:-1][new[1:]], ends[-1])


def removal_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int | None = None, block: int = BLOCK) -> DataFrame:
    """All columns of ``docs``, with ``__repeat_spans``: the removed byte ranges ``(start, stop)`` of each text."""
    gram = gram or max(1, min(GRAM, width * 2 // 5))
    block = max(1, min(block, width // 6))  # a core keeps most of the width
    named = docs.withColumn("__repeat_id", F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    rows = named.select(
        F.col("__repeat_id").alias("id"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).alias("n")
    )
    copies = rows.filter(F.col("n") >= width).groupBy("id", "n").agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    whole = copies.select("id", F.lit(0).alias("first"), (F.col("n") - width).cast("int").alias("last"))
    with scratch() as tables:
        ranges = repeated_suffixes(rows, width, gram, block).unionByName(whole)
        listed = ranges.groupBy("id").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
        spans = tables.keep(durable(listed.mapInArrow(spanner(width), "id bigint, spans array<struct<start: int, stop: int>>")))
    released(docs.sparkSession)
    return named.join(spans.select(F.col("id").alias("__repeat_id"), F.col("spans").alias("__repeat_spans")), "__repeat_id", "left").drop("__repeat_id")


def spanner(width: int):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for ranges in batch.column(1):
                pairs = ranges.values
                start, stop = merged(np.asarray(pairs.field("first")), np.asarray(pairs.field("last")), width)
                found.append([{"start": int(a), "stop": int(b)} for a, b in zip(start, stop)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["id", "spans"])

    return run


def kept_bytes(raw: bytes, spans: list[dict] | None) -> bytes:
    if not spans:
        return raw
    parts, at = [], 0
    for span in spans:
        parts.append(raw[at : span["start"]])
        at = span["stop"]
    return b"".join([*parts, raw[at:]])


def removal_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``(key, n_bytes, n_removed, n_spans, kept_sha256)`` of every row."""
    marked = removal_spans(docs.select(key, text), key, text, width)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, numbers, digests = [], [], [], []
            for value, spans in zip(batch.column(1), batch.column(2)):
                raw, own = (value.as_py() or "").encode("utf-8"), spans.as_py() or []
                kept = kept_bytes(raw, own)
                sizes.append(len(raw))
                removed.append(len(raw) - len(kept))
                numbers.append(len(own))
                digests.append(hashlib.sha256(kept).hexdigest())
            counts = [pa.array(c, pa.int64()) for c in (sizes, removed, numbers)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(digests, pa.string())], ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    digested = marked.select(F.col(key).alias("key"), F.col(text).alias("text"), "__repeat_spans").mapInArrow(run, f"key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return digested.withColumnRenamed("key", key)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """All columns of ``docs``, the text without its repeated bytes.

    Only characters that lie wholly in removed bytes go, so the text stays valid UTF-8.
    """
    marked = removal_spans(docs, key, text, width)

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array, spans: pa.Array) -> pa.Array:
        found = []
        for value, own in zip(texts, spans):
            if not value.is_valid or not own.is_valid:
                found.append(value.as_py())
                continue
            raw = value.as_py().encode("utf-8")
            whole = [{"start": after(raw, s["start"]), "stop": before(raw, s["stop"])} for s in own.as_py()]
            found.append(kept_bytes(raw, whole).decode("utf-8"))
        return pa.array(found, pa.string())

    column: Column = cleaned(F.col(text).cast("string"), F.col("__repeat_spans"))
    return marked.withColumn(text, column).select(*docs.columns)


def after(raw: bytes, place: int) -> int:
    """The first character border at or after a place."""
    while place < len(raw) and raw[place] & 0xC0 == 0x80:
        place += 1
    return place


def before(raw: bytes, place: int) -> int:
    """The last character border at or before a place."""
    while place < len(raw) and raw[place] & 0xC0 == 0x80:
        place -= 1
    return place
