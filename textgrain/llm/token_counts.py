"""Token counts of a byte-level BPE without encoding most of the text.

**Whole-token shortcut.**  Before any document is read, every vocabulary string is put
through the merges once.  Those that come out as one token form a proven table: whenever a
pre-token of a text is in it, the text gains exactly one token and nothing is merged.  Only
the other pre-tokens are merged, those that are new in a run of texts all at once, and
remembered.

Cases: a null or empty text has 0 bytes and 0 tokens.  Repeated rows are counted each.  An
empty table gives an empty result.  Other columns of the input are ignored.  A text of any
length is counted whole; a pre-token of n characters takes n log n steps.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgrain.llm.common import KeyTable, text_runs

# The split of the vocabulary's byte-level pre-tokenizer.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same classes among the characters below U+0250, for the faster matcher.
LATIN_LETTER = r"A-Za-zªµºÀ-ÖØ-öø-ɏ"
LATIN_NUMBER = r"0-9²³¹¼-¾"
LATIN_SPACE = r"\t-\r \u0085\u00a0"
# At most about this many pre-tokens are remembered in a process.
REMEMBERED = 500_000


@lru_cache
def matchers() -> tuple[re.Pattern, re.Pattern, regex.Pattern]:
    """Beyond-Latin test, the split for Latin text, the split for any text."""
    latin = (
        f" ?[{LATIN_LETTER}]+|'(?:[stmd]|re|ve|ll)| ?[{LATIN_NUMBER}]+"
        f"| ?[^{LATIN_SPACE}{LATIN_LETTER}{LATIN_NUMBER}]+"
        f"|[{LATIN_SPACE}]+(?![^{LATIN_SPACE}])|[{LATIN_SPACE}]+"
    )
    return re.compile("[^\u0000-ɏ]"), re.compile(latin), regex.compile(SPLIT)


def pre_tokens(text: str) -> list[str]:
    beyond, latin, anything = matchers()
    return (anything if beyond.search(text) else latin).findall(text)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself if printable, else the next code from 256 on."""
    symbols, spare = [], 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            symbols.append(chr(byte))
        else:
            symbols.append(chr(spare))
            spare += 1
    return symbols


NEVER = np.int32(1 << 30)
# Pre-tokens of up to this many bytes are merged in batches, longer ones with a heap.
BATCHED_BYTES = 64


def pair_table(ranks: dict[int, int]) -> KeyTable:
    table = KeyTable()
    table.add(np.fromiter(ranks.keys(), np.int64, len(ranks)), np.fromiter(ranks.values(), np.int32, len(ranks)))
    return table


def pair_ranks(table: KeyTable, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of each pair of symbols; NEVER where it does not merge or is padding."""
    keys = left.astype(np.int64) << 20 | right.astype(np.int64)
    found = table.get(keys.ravel()).reshape(keys.shape)
    return np.where(found < 0, NEVER, found)


def batch_counts(raws: list[bytes], table: KeyTable) -> np.ndarray:
    """Tokens of many short pre-tokens at once: every round merges each one's best pair."""
    lengths = np.fromiter(map(len, raws), np.int64, len(raws))
    counts = lengths.copy()
    order = np.argsort(lengths, kind="stable")
    for part in np.array_split(order, max(1, len(order) // 8192)):
        if not len(part) or lengths[part].max() < 2:
            continue
        width = int(lengths[part].max())
        ids = np.full((len(part), width), -1, np.int32)
        ids[np.arange(width) < lengths[part][:, None]] = np.frombuffer(b"".join(raws[i] for i in part), np.uint8)
        best = pair_ranks(table, ids[:, :-1], ids[:, 1:])
        rows = part
        while True:
            at = best.argmin(1)
            line = np.arange(len(rows))
            rank = best[line, at]
            live = np.flatnonzero(rank < NEVER)
            if not len(live):
                break
            rows, ids, best, at, rank = rows[live], ids[live], best[live], at[live], rank[live]
            line = np.arange(len(rows))
            counts[rows] -= 1
            ids[line, at] = 256 + rank
            columns = np.arange(width)
            ids = np.take_along_axis(ids, np.minimum(columns + (columns > at[:, None]), width - 1), 1)
            ids[:, -1] = -1
            pairs = np.arange(width - 1)
            best = np.take_along_axis(best, np.minimum(pairs + (pairs >= at[:, None]), width - 2), 1)
            best[:, -1] = NEVER
            inner = at < width - 1
            best[line[inner], at[inner]] = pair_ranks(table, ids[line[inner], at[inner]], ids[line[inner], at[inner] + 1])
            inner = at > 0
            best[line[inner], at[inner] - 1] = pair_ranks(table, ids[line[inner], at[inner] - 1], ids[line[inner], at[inner]])
    return counts


def merged_by_heap(ids: list[int], ranks: dict[int, int]) -> list[int]:
    """Merge in rank order, leftmost first; rank r makes the symbol 256 + r.

    A heap over a linked list: n log n steps for a pre-token of any length.  ``ranks`` is
    keyed by ``left << 20 | right``.
    """
    after = list(range(1, len(ids))) + [-1]
    ahead = list(range(-1, len(ids) - 1))
    heap = [(ranks[k], i) for i in range(len(ids) - 1) if (k := ids[i] << 20 | ids[i + 1]) in ranks]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i] if ids[i] >= 0 else -1
        if j < 0 or ranks.get(ids[i] << 20 | ids[j]) != rank:
            continue
        ids[i], ids[j] = 256 + rank, -1
        after[i] = after[j]
        if after[j] >= 0:
            ahead[after[j]] = i
        for left in (ahead[i], i):
            if left >= 0 and after[left] >= 0:
                found = ranks.get(ids[left] << 20 | ids[after[left]])
                if found is not None:
                    heapq.heappush(heap, (found, left))
    return [x for x in ids if x >= 0]


class Vocabulary:
    """Merge ranks, the strings that count as special, and the proven whole tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["model"]["merges"]]
        self.byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        made = dict(self.byte_of)
        self.table: KeyTable | None = None
        self.ranks = {}
        for rank, (left, right) in enumerate(pairs):
            self.ranks[made[left] << 20 | made[right]] = rank
            made[left + right] = 256 + rank
        self.specials = sorted((t["content"] for t in model.get("added_tokens", ())), key=len, reverse=True)
        self.whole = self.proven(model["model"]["vocab"])

    def proven(self, vocabulary: dict[str, int]) -> frozenset[str]:
        """Texts of the vocabulary strings that the merges turn into exactly that one token."""
        raws = [bytes(self.byte_of[c] for c in piece) for piece in vocabulary]
        found = []
        for raw, count in zip(raws, self.merge_counts(raws)):
            if count == 1:
                try:
                    found.append(raw.decode("utf-8"))
                except UnicodeDecodeError:  # part of a character: no pre-token can equal it
                    continue
        return frozenset(found)

    def merge_counts(self, raws: list[bytes]) -> np.ndarray:
        """Tokens of each byte string, by merging."""
        if self.table is None:
            self.table = pair_table(self.ranks)
        counts = np.zeros(len(raws), np.int64)
        short = [i for i, raw in enumerate(raws) if len(raw) <= BATCHED_BYTES]
        counts[short] = batch_counts([raws[i] for i in short], self.table)
        for i, raw in enumerate(raws):
            if len(raw) > BATCHED_BYTES:
                counts[i] = len(merged_by_heap(list(raw), self.ranks))
        return counts

    def __getstate__(self):
        return self.__dict__ | {"table": None}


class Counter:
    """Counts texts; keeps the tokens per pre-token, 1 for the proven ones."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known = dict.fromkeys(vocabulary.whole, 1)
        specials = "|".join(map(re.escape, vocabulary.specials))
        self.special = re.compile(specials) if specials else None

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens and special strings: one of these is one token, as the library's default."""
        if self.special is None or not self.special.search(text):
            return pre_tokens(text), 0
        plain = self.special.split(text)
        return [token for part in plain for token in pre_tokens(part)], len(plain) - 1

    def count(self, texts: list[str]) -> list[int]:
        split = [self.split(text) for text in texts]
        new = list(set().union(*(tokens for tokens, _ in split)).difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known = dict.fromkeys(self.vocabulary.whole, 1)
            new = list(set().union(*(tokens for tokens, _ in split)).difference(self.known))
        self.known.update(zip(new, self.vocabulary.merge_counts([t.encode("utf-8") for t in new]).tolist()))
        return [specials + sum(map(self.known.__getitem__, tokens)) for tokens, specials in split]


def token_counts(
    docs: DataFrame, vocabulary_path: str, limit: int = 512, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, n_bytes, n_tokens, over_limit)`` of every row; one narrow pass, no shuffle."""
    # The vocabulary is a fixed file of some 50,000 strings: its size does not follow the data.
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))
    key_type = docs.schema[key].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            numbers: list[int] = []
            for first, last, _, _ in text_runs(texts):
                numbers += counter.count(texts.slice(first, last - first).to_pylist())
            columns = [batch.column(0), pa.array(numbers, pa.int64()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_tokens", "n_bytes"])

    rows = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes")
    )
    counted = rows.mapInArrow(count, f"key {key_type}, n_tokens bigint, n_bytes bigint")
    return counted.select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > F.lit(limit)).alias("over_limit")
    )
