"""SentencePiece encoding and decoding with a streaming lattice.

**Streaming Viterbi.**  The text is read once.  For every position the lattice keeps the one
surviving path as a back pointer to the start of its last piece; a new position looks back
over a window of the longest piece only.  Whenever the paths of all positions in the window
run through one common boundary, everything before it is final: its ids are given out and
its back pointers are dropped.

The vocabulary at hand is a byte-pair model, whose library ids are in general not the path
with the largest sum of scores.  So paths compete by the merge order instead: a piece may
follow another exactly if the merges of the two joined strings give these two pieces.  With
strict priorities that leaves one path per position, the library's own.

Pieces of blanks share one priority, below all others.  So the word behind a run of blanks is
settled first, by the lattice and with the last blank, and what is left of the run gives as many
longest pieces as fit, at once; only the rest is merged, leftmost first.  Short chunks of that
kind, and all of them where a model is not like that, are merged directly.

A boundary between a non-blank and a blank that no piece spans is common to all paths at
once; words between such boundaries are remembered.

Cases: a null or empty text has no ids and decodes to the empty text.  Characters outside the
vocabulary become byte pieces.  The mark U+2581 in a text is a blank, as in the library, so
such a text does not round-trip.  Repeated rows are encoded each; texts of any length are
encoded whole.  Empty tables give empty results.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgrain.llm.common import KeyTable, text_runs

BLANK_MARK = "▁"
# At most about this many words, and pairs of pieces, are remembered in a process.
REMEMBERED = 200_000
REMEMBERED_PAIRS = 100_000
REMEMBERED_LENGTH = 40
# Chunks of up to this many characters are merged directly where they are merged at all.
DIRECT_LENGTH = 40
# Ids that are turned into bytes at a time.
GATHERED = 500_000
CHUNKS = re.compile(f"{BLANK_MARK}*[^{BLANK_MARK}]+|{BLANK_MARK}+")
# The same where a line feed is not in the vocabulary, so that no piece crosses it either.
LINE_CHUNKS = re.compile(f"{BLANK_MARK}*[^{BLANK_MARK}\n]+|{BLANK_MARK}+|\n")


class Pieces:
    """The pieces of a byte-pair SentencePiece model file."""

    def __init__(self, path: str):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.priority: dict[str, float] = {}
        self.raw: list[bytes] = []
        self.byte_ids = [0] * 256
        for number in range(library.get_piece_size()):
            piece = library.id_to_piece(number)
            raw = piece.encode("utf-8")
            if library.is_byte(number):
                raw = bytes([int(piece[3:5], 16)])
                self.byte_ids[raw[0]] = number
            elif library.is_control(number) or library.is_unknown(number):
                raw = b""
            elif not library.is_unused(number):
                self.ids[piece] = number
                self.priority[piece] = library.get_score(number)
            self.raw.append(raw)
        self.longest = max(map(len, self.ids), default=1)
        self.spans_blank = any(BLANK_MARK in piece.lstrip(BLANK_MARK) for piece in self.ids)
        self.blank_run = self.longest_blank_run()
        self.follows: dict[tuple[str, str], bool] = {}
        self.histories: dict[str, list[tuple[float, str, str]] | None] = {}

    def longest_blank_run(self) -> int:
        """Length of the longest piece of blanks if runs of blanks can be settled by it, else 0.

        They can if pieces of several blanks share one priority, below that of all other
        pieces, and hold nothing else.  The leftmost merge then never looks past the longest
        piece before that is built, and nothing can be merged to it afterwards.
        """
        blanks = [p for p in self.ids if len(p) > 1 and not p.strip(BLANK_MARK)]
        if not blanks or self.spans_blank:
            return 0
        others = [p for p in self.ids if len(p) > 1 and p.strip(BLANK_MARK)]
        levels = {self.priority[p] for p in blanks}
        mixed = any(p.startswith(2 * BLANK_MARK) for p in others)
        if len(levels) > 1 or mixed or min((self.priority[p] for p in others), default=np.inf) <= levels.pop():
            return 0
        longest = max(blanks, key=len)
        return len(longest) if self.merged(longest) == [longest] else 0

    def merged(self, text: str, history: list[tuple[float, str, str]] | None = None) -> list[str]:
        """Merge adjacent pieces by priority, leftmost first.

        ``history`` gets the priority of every merge with the first and last part after it.
        """
        if history is None and len(text) > DIRECT_LENGTH:
            return self.merged_by_heap(text)
        parts = list(text)
        get = self.priority.get
        worst = -np.inf
        best = [get(a + b, worst) for a, b in zip(parts, parts[1:])]
        while best and (top := max(best)) > worst:
            i = best.index(top)
            parts[i] += parts.pop(i + 1)
            del best[i]
            if i:
                best[i - 1] = get(parts[i - 1] + parts[i], worst)
            if i < len(best):
                best[i] = get(parts[i] + parts[i + 1], worst)
            if history is not None:
                history.append((top, parts[0], parts[-1]))
        return parts

    def merged_by_heap(self, text: str) -> list[str]:
        """The same for long texts: a heap over a linked list, n log n steps."""
        parts: list[str | None] = list(text)
        after, ahead = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        get, size = self.priority.get, len(parts)
        heap = [(-p, i) for i in range(size - 1) if (p := get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            level, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j == size or get(parts[i] + parts[j]) != -level:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[i] < size:
                ahead[after[i]] = i
            for left in (ahead[i], i):
                if left >= 0 and after[left] < size:
                    found = get(parts[left] + parts[after[left]])
                    if found is not None:
                        heapq.heappush(heap, (-found, left))
        return [part for part in parts if part is not None]

    def history(self, piece: str) -> list[tuple[float, str, str]] | None:
        """How the merges build the piece; None if they build something else."""
        found = self.histories.get(piece, False)
        if found is False:
            steps: list[tuple[float, str, str]] = []
            found = steps if self.merged(piece, steps) == [piece] else None
            self.histories[piece] = found
        return found

    def may_follow(self, left: str, right: str) -> bool:
        """Whether the merges of ``left + right`` give these two; ``left`` may be empty.

        Both sides are built as if alone, the better priority first; the answer is no as
        soon as the two parts at the border would merge.
        """
        steps, more = self.history(left) if left else [], self.history(right)
        if steps is None or more is None:
            return False
        if not left:
            return True
        get, worst = self.priority.get, -np.inf
        if left + right in self.priority:
            return False
        a, b, i, j, ends, size = left[-1], right[0], 0, 0, len(steps), len(more)
        border = get(a + b, worst)
        while i < ends or j < size:
            one = steps[i][0] if i < ends else worst
            two = more[j][0] if j < size else worst
            if border > one and border >= two:
                return False
            if one >= two:
                grown, i = steps[i][2], i + 1
                if grown is not a:
                    a = grown
                    border = get(a + b, worst)
            else:
                grown, j = more[j][1], j + 1
                if grown is not b:
                    b = grown
                    border = get(a + b, worst)
        return border == worst

    def ids_of(self, piece: str) -> list[int]:
        number = self.ids.get(piece)
        return [number] if number is not None else [self.byte_ids[b] for b in piece.encode("utf-8")]


BASE = np.uint64(0x9E3779B97F4A7C15)
NONE, START = -3, -1


class WordLattice:
    """The same lattice over many words at once, one column of positions after the other."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.names = {number: piece for piece, number in pieces.ids.items()}
        self.powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(pieces.longest, BASE, np.uint64))), dtype=np.uint64)
        self.known = KeyTable()
        names = list(pieces.ids)
        self.known.add(np.array([self.prefixes([name])[0, -1] for name in names], np.uint64).view(np.int64), np.array([pieces.ids[n] for n in names]))
        self.follows = KeyTable(21)

    @staticmethod
    def prefixes(words: list[str]) -> np.ndarray:
        """Running hashes of words padded to one length; column i is the hash of i characters."""
        width = max(map(len, words))
        codes = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), np.uint32).reshape(len(words), width)
        sums = np.zeros((len(words), width + 1), np.uint64)
        for i in range(width):
            sums[:, i + 1] = sums[:, i] * BASE + codes[:, i] + np.uint64(1)
        return sums

    def may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) + 2) << 20 | right
        found = self.follows.get(keys)
        new = np.unique(keys[found < 0])
        if len(new):
            if self.follows.size + len(new) > REMEMBERED:
                self.follows.clear()
            check, names = self.pieces.may_follow, self.names
            answers = [check(names.get((k >> 20) - 2, ""), names[k & 0xFFFFF]) for k in new.tolist()]
            self.follows.add(new, np.array(answers, np.int32))
            missing = np.flatnonzero(found < 0)
            found[missing] = np.array(answers, np.int32)[np.searchsorted(new, keys[missing])]
        return found > 0

    def encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids, as packed numbers, of words of vocabulary characters only; others are left out."""
        words = sorted(words, key=len)
        found: dict[str, bytes] = {}
        for first in range(0, len(words), 8192):
            found |= self.encode_batch(words[first : first + 8192])
        return found

    def encode_batch(self, words: list[str]) -> dict[str, bytes]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        sums = self.prefixes(words)
        last = np.full(sums.shape, NONE, np.int32)
        back = np.zeros(sums.shape, np.int32)
        last[:, 0] = START
        for end in range(1, sums.shape[1]):
            lines = np.arange(np.searchsorted(sizes, end), len(words))
            for length in range(min(self.pieces.longest, end), 0, -1):
                start = end - length
                open_ = lines[last[lines, start] != NONE]
                piece = self.known.get((sums[open_, end] - sums[open_, start] * self.powers[length]).view(np.int64))
                open_, piece = open_[piece >= 0], piece[piece >= 0]
                if not len(open_):
                    continue
                fits = self.may_follow(last[open_, start], piece)
                last[open_[fits], end] = piece[fits]
                back[open_[fits], end] = length
                lines = lines[last[lines, end] == NONE]
                if not len(lines):
                    break
        place, line = sizes.copy(), np.arange(len(words))
        columns = []
        while place.any():
            columns.append(np.where(place > 0, last[line, place], NONE))
            place -= np.where(place > 0, np.maximum(back[line, place], last[line, place] == NONE), 0)
        return self.rows(words, np.array(columns[::-1]).T, last, sizes)

    @staticmethod
    def rows(words: list[str], ids: np.ndarray, last: np.ndarray, sizes: np.ndarray) -> dict[str, bytes]:
        whole = last[np.arange(len(words)), sizes] != NONE
        real = ids >= 0
        body = ids[real].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(real.sum(1))).tolist()
        return {word: body[low:high] for word, low, high, fine in zip(words, [0, *ends], ends, whole.tolist()) if fine}


class Lattice:
    """One text, given in any portions; ``feed`` and ``close`` give ids as they become final."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.text = ""  # what is not final yet
        self.back = [0]  # per position of ``text``: length of the last piece of its path
        self.next_look = 4 * pieces.longest
        self.before = ""  # the last final piece

    def feed(self, portion: str) -> list[int]:
        """Extend the paths over a portion; long ones are taken a few windows at a time."""
        size = 4 * self.pieces.longest
        found: list[int] = []
        for start in range(0, len(portion), size):
            self.extend(portion[start : start + size])
            if len(self.text) >= self.next_look:
                found += self.settle()
                self.next_look = len(self.text) + size
        return found

    def extend(self, portion: str) -> None:
        pieces, back, before = self.pieces, self.back, self.before
        known, longest, follows = pieces.ids, pieces.longest, pieces.follows
        first = len(self.text) + 1
        text = self.text = self.text + portion
        for end in range(first, len(text) + 1):
            for start in range(max(0, end - longest), end):
                piece = text[start:end]
                if piece not in known and end - start > 1:
                    continue
                if not start:
                    left = before
                elif back[start]:
                    left = text[start - back[start] : start]
                else:
                    continue
                fits = follows.get((left, piece))
                if fits is None:
                    if len(follows) >= REMEMBERED_PAIRS:
                        follows.clear()
                    fits = follows[left, piece] = pieces.may_follow(left, piece)
                if fits:
                    back.append(end - start)
                    break
            else:
                back.append(0)  # no path ends here

    def settle(self) -> list[int]:
        """Give out what lies before the boundary that all paths of the window share."""
        end = len(self.text)
        paths = [end - k for k in range(min(self.pieces.longest, end)) if self.back[end - k]]
        # Move the furthest path back until all stand on one boundary.
        places = set(paths)
        while len(places) > 1:
            last = max(places)
            places.discard(last)
            places.add(last - self.back[last])
        (common,) = places or {0}
        if common <= 0:
            return []
        return self.give(common)

    def give(self, common: int) -> list[int]:
        cuts = []
        place = common
        while place:
            cuts.append((place - self.back[place], place))
            place -= self.back[place]
        found: list[int] = []
        for start, stop in reversed(cuts):
            found += self.pieces.ids_of(self.text[start:stop])
        self.before = self.text[cuts[0][0] : cuts[0][1]] if cuts else self.before
        self.text, self.back = self.text[common:], [0] + self.back[common + 1 :]
        return found

    def close(self) -> list[int]:
        return self.give(len(self.text))


def encode_chunk(pieces: Pieces, chunk: str) -> list[int]:
    """Ids of a chunk that no piece crosses the ends of."""
    word = chunk.lstrip(BLANK_MARK)
    blanks = len(chunk) - len(word)
    if not word or blanks > 1:
        if len(chunk) <= DIRECT_LENGTH or not pieces.blank_run:
            return [number for piece in pieces.merged(chunk) for number in pieces.ids_of(piece)]
        return behind_blanks(pieces, blanks, word)
    lattice = Lattice(pieces)
    return lattice.feed(chunk) + lattice.close()


def behind_blanks(pieces: Pieces, blanks: int, word: str) -> list[int]:
    """Ids of a run of blanks and the word behind it, if any."""
    found: list[int] = []
    if word:
        lattice = Lattice(pieces)
        found = lattice.feed(BLANK_MARK + word) + lattice.close()
        if found[0] == pieces.ids[BLANK_MARK]:
            found = found[1:]
        else:
            blanks -= 1
    whole, rest = divmod(blanks, pieces.blank_run)
    left = [number for piece in pieces.merged(BLANK_MARK * rest) for number in pieces.ids_of(piece)]
    return [pieces.ids[BLANK_MARK * pieces.blank_run]] * whole + left + found


def packed(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


class Encoder:
    """Encodes texts; remembers the ids of words between boundaries that no piece spans.

    Ids are handled as packed 32-bit numbers: a text's are the words' put together.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.lattice = WordLattice(pieces)
        self.pattern = CHUNKS if "\n" in pieces.ids else LINE_CHUNKS
        self.words: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        marked = BLANK_MARK + text.replace(" ", BLANK_MARK)
        return [marked] if self.pieces.spans_blank else self.pattern.findall(marked)

    def learn(self, chunks: set[str]) -> None:
        """Remember the chunks; the long ones only until the next texts."""
        short = [c for c in chunks if 1 < len(c) <= REMEMBERED_LENGTH and not c.startswith(2 * BLANK_MARK)]
        found = self.lattice.encode(short) if short else {}
        for chunk in chunks:
            if chunk not in found:
                found[chunk] = packed(encode_chunk(self.pieces, chunk))
        self.words |= found

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        split = [self.chunks(text) for text in texts]
        new = set().union(*split).difference(self.words)
        if len(self.words) + len(new) > REMEMBERED:
            self.words = {}
            new = set().union(*split)
        self.learn(new)
        get = self.words.__getitem__
        found = [b"".join(map(get, chunks)) for chunks in split]
        for chunk in new:
            if len(chunk) > REMEMBERED_LENGTH:
                del self.words[chunk]
        return found

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(ids, np.int32).tolist() for ids in self.encode_packed(texts)]


def decode(pieces: Pieces, ids: list[int]) -> str:
    """The text of the ids; the blank that encoding puts in front is taken off."""
    return without_front(b"".join(map(pieces.raw.__getitem__, ids)))


def without_front(raw: bytes) -> str:
    text = raw.decode("utf-8", "replace").replace(BLANK_MARK, " ")
    return text[1:] if text.startswith(" ") else text


def encode_texts(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_bytes, n_tokens, ids)`` of every row; one narrow pass."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Pieces(model_path))
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for first, last, _, offsets in text_runs(texts):
                found = encoder.encode_packed(texts.slice(first, last - first).to_pylist())
                bounds = np.concatenate(([0], np.cumsum([len(ids) // 4 for ids in found]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.frombuffer(b"".join(found), np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(np.diff(offsets)), pa.array(np.diff(bounds).astype(np.int64)), ids], ["key", "n_bytes", "n_tokens", "ids"]
                )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n_bytes bigint, n_tokens bigint, ids array<int>").withColumnRenamed("key", key)


def decode_ids(rows: DataFrame, model_path: str, ids: str = "ids", output: str = "text") -> DataFrame:
    """All columns of ``rows`` and ``output``: the text of the ids, null where these are null."""
    kept = rows.drop(output) if output != ids else rows
    pieces: list[Pieces] = []

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        if not pieces:
            pieces.append(Pieces(model_path))
        return pa.array(decode_lists(pieces[0], column), pa.string())

    return kept.withColumn(output, decoded(F.col(ids)))


def decode_lists(pieces: Pieces, column: pa.Array) -> list[str | None]:
    """Texts of many lists of ids: the bytes of all pieces are gathered in one step."""
    joined = np.frombuffer(b"".join(pieces.raw), np.uint8)
    sizes = np.array([len(raw) for raw in pieces.raw])
    starts = np.cumsum(sizes) - sizes
    found: list[str | None] = []
    bounds = np.asarray(column.offsets).astype(np.int64)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + GATHERED, side="right")) - 1)
        last = min(last, len(column))
        ids = np.asarray(column.values)[bounds[first] : bounds[last]]
        ends = np.concatenate(([0], np.cumsum(sizes[ids])))
        body = joined[np.repeat(starts[ids] - ends[:-1], sizes[ids]) + np.arange(ends[-1])]
        cuts = ends[bounds[first : last + 1] - bounds[first]]
        for row in range(first, last):
            raw = body[cuts[row - first] : cuts[row - first + 1]].tobytes()
            found.append(without_front(raw) if column[row].is_valid else None)
        first = last
    return found
