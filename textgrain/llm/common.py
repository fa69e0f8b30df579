"""Small helpers of the operators: table reading, Arrow text buffers, vectorised hashes."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# Texts are processed in runs of about this many bytes; a longer text is a run of its own.
CHUNK_BYTES = 2 << 20


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def parts_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column, without copying it; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    if not len(offsets):
        return raw[:0], np.zeros(1, np.int64)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_runs(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``first..last`` with their bytes and offsets, about ``limit`` bytes at a time."""
    raw, offsets = buffers(texts)
    first, count = 0, len(offsets) - 1
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last, raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2 ** 64, kept for the process."""
    if not _POWERS or len(_POWERS[0]) < length:
        size = max(length, CHUNK_BYTES) + 1
        _POWERS[:] = []
        for base in (_MULTIPLIER, _INVERSE):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS.append(np.cumprod(factors, dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = values.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_CODES = BYTE_CODES[LOWER]
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def prefix_hash(raw: np.ndarray, codes: np.ndarray = BYTE_CODES) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` reads the hash of any span from them."""
    powers, _ = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(codes[raw] * powers[: len(raw)], dtype=np.uint64, out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, the same wherever the bytes stand."""
    _, inverse = _powers(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def word_spans(raw: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first)``: words of every text; ``first[i]`` is text i's first word."""
    full = np.zeros(len(raw) + 2, bool)
    full[1:-1] = ~blank[raw]
    cuts = offsets[(offsets > 0) & (offsets < len(raw))]
    before, after = full[:-2].copy(), full[2:].copy()
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(full[1:-1] & ~before)
    ends = np.flatnonzero(full[1:-1] & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class KeyTable:
    """Integer keys with small values, added and looked up as whole arrays (open addressing)."""

    def __init__(self, bits: int = 20):
        self.bits, self.mask = bits, (1 << bits) - 1
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        self.size, self.probes = 0, 1

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """New, distinct keys; values are not negative."""
        keys, values = np.ascontiguousarray(keys, np.int64), np.asarray(values, np.int32)
        self.size += len(keys)
        slots, steps = self.slots(keys), 1
        while len(keys):
            free = np.flatnonzero(self.values[slots] < 0)
            placed = free[np.unique(slots[free], return_index=True)[1]]
            self.keys[slots[placed]], self.values[slots[placed]] = keys[placed], values[placed]
            left = np.ones(len(keys), bool)
            left[placed] = False
            keys, values, slots = keys[left], values[left], (slots[left] + 1) & self.mask
            self.probes = max(self.probes, steps)
            steps += 1

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values; -1 for an unknown key."""
        keys = np.ascontiguousarray(keys, np.int64)
        slots = self.slots(keys)
        found = self.values[slots]
        wrong = np.flatnonzero((found >= 0) & (self.keys[slots] != keys))
        found[wrong] = -1
        for _ in range(self.probes):
            if not len(wrong):
                break
            at = slots[wrong] = (slots[wrong] + 1) & self.mask
            value = self.values[at]
            hit = (value >= 0) & (self.keys[at] == keys[wrong])
            found[wrong[hit]] = value[hit]
            wrong = wrong[~hit & (value >= 0)]
        return found


def released(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished phases: it does once nothing refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
