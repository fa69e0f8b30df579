"""Near-duplicate documents by a chosen-path similarity join.

**Method.**  A document is the set of its word shingles, sketched by ``COORDINATES`` minwise
tokens.  In each of several independent trees a node picks coordinates at random, on average
1 / threshold of them, and hands every document on to the child of its token there: a pair at
the threshold is expected to meet in one child per level.  A node of at most ``NODE_LIMIT``
documents is compared exhaustively.  A larger one branches on, with all of its documents, until
its nodes are small.  ``tree_count`` takes as many trees as the target recall needs at the
deepest level that a tree had to go to.

**Ends of branches.**  Only connectedness is asked for.  A node whose documents are connected
already is finished.  A dense group would never come apart, so the documents of a large node are
also compared in blocks of ``NODE_LIMIT`` that all hold the node's smallest document, twice
with other blocks; that takes time in proportion to the node, and leaves only nodes with
several components.  One that then has at most ``NODE_LIMIT`` documents outside its largest
component is compared by pairs of blocks, so that every two documents of different components
meet: a few blocks for each block of the node.  The others branch on; what is still large at
the ``last_level`` (it follows from the number of documents) is compared by pairs of blocks too.

**Confirmation.**  Within a node the sketches pick connected candidates; their full sets are
then compared, shingle by shingle, as the first 48 bits of 64-bit shingle hashes.  Documents of
one component are not compared again, so a large group costs about one comparison per document,
not one per pair.  The first trees connect most; later ones only look at nodes that hold several
components.  A cluster of candidates that was compared before is not compared again.

Equal sets (a 64-bit digest of the set and its size) are one class from the start, so exact
copies are never compared.

Shingles: A-Z in lower case, words are runs without blanks (space, tab to carriage return);
with fewer words than the shingle length the whole sequence is one shingle.

Cases: a null text and one without words has the empty set and is linked with nothing.
Repeated rows are in one class.  A null key is larger than any other.  Texts of any length
count whole.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgrain.llm.common import LOWER_CODES, mix, parts_of, prefix_hash, released, span_hash, text_runs, word_spans
from textgrain.llm.components import components
from textgrain.llm.string_tiling import run_hashes
from textgrain.session import Scratch, discard, durable, scratch

COORDINATES = 64
# A pair at the threshold meets in one of the trees with this probability, down to the deepest level.
RECALL = 0.995
FIRST_TREES, LEAST_TREES = 3, 12
FIRST_LEVELS, MORE_LEVELS = 2, 4
LEAST_LAST_LEVEL = 10
# Branches end where documents that share this part of their tokens have come apart.
FAMILY_SHARE = 0.6
NODE_LIMIT = 512
# Sketches are candidates down to so many binomial deviations below the threshold: 0.58 for 0.8.
SKETCH_DEVIATIONS = 4.4
# Groups of up to this many members are compared many groups at a time.
SMALL_GROUP = 16
SET_BYTES = 6
# Tables of up to this many rows of a few numbers (some MB at most) are broadcast to tables of texts or sets.
FEW_ROWS = 1 << 16
NODES = "path bigint, name bigint, component bigint"

MULTIPLIERS = mix(np.arange(COORDINATES, dtype=np.uint64), 11) | np.uint64(1)
ADDENDS = mix(np.arange(COORDINATES, dtype=np.uint64), 12)


def sketch_share(percent: int) -> float:
    """The part of their tokens in which the sketches of candidates agree at least."""
    threshold = percent / 100
    return threshold - SKETCH_DEVIATIONS * (threshold * (1 - threshold) / COORDINATES) ** 0.5


def tree_count(percent: int, level: int) -> int:
    """Trees after which a pair at the threshold has met ``level`` levels down with the probability ``RECALL``.

    Its sketches share a binomial part of their tokens, so the chance is an average over it.
    """
    threshold = percent / 100
    second = min(1 / threshold - 1, 1)
    shares = np.arange(math.ceil(sketch_share(percent) * COORDINATES), COORDINATES + 1)
    weights = np.array([math.comb(COORDINATES, k) * threshold**k * (1 - threshold) ** (COORDINATES - k) for k in shares.tolist()])
    shares, apart = shares / COORDINATES, np.zeros(len(shares))
    for _ in range(level):
        # One child, or two; the pair is apart if it misses, or comes apart below, each of them.
        miss = 1 - shares + shares * apart
        apart = (1 - second) * miss + second * miss**2
    trees = LEAST_TREES
    while weights @ apart**trees > (1 - RECALL) * weights.sum():
        trees += 1
    return trees


def last_level(classes: int) -> int:
    """The level at which large nodes are compared by pairs of blocks."""
    return max(LEAST_LAST_LEVEL, math.ceil(math.log(max(classes, 1) / NODE_LIMIT) / -math.log(FAMILY_SHARE)))


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within the text, and where each text starts."""
    starts, ends, first = word_spans(raw, offsets)
    words = span_hash(prefix_hash(raw, LOWER_CODES), starts, ends)
    runs = run_hashes(words, size)
    counts = np.diff(first)
    found = []
    for k in range(len(counts)):
        low, number = int(first[k]), int(counts[k])
        if number >= size:
            own = runs[low : low + number - size + 1].copy()
            own.sort()
            if len(own) > 1:
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif number:
            own = mix(run_hashes(words[low : low + number], number), number)
        else:
            own = runs[:0]
        found.append(own)
    return (np.concatenate(found) if found else runs[:0]), np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int64)


def minwise(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minwise tokens of non-empty sets, one row per set."""
    tokens = np.empty((len(starts), COORDINATES), np.uint32)
    for k in range(COORDINATES):
        tokens[:, k] = np.minimum.reduceat((values * MULTIPLIERS[k] + ADDENDS[k]) >> np.uint64(32), starts)
    return tokens


def set_names(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name per set, the same for equal sets."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values, 21), dtype=np.uint64)))
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def sketches(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``(key, n, name, tokens)`` per row; name and tokens are null for the empty set."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, raw, offsets in text_runs(batch.column(1)):
                values, bounds = shingle_sets(raw, offsets, size)
                sizes = np.diff(bounds)
                empty = sizes == 0
                names = set_names(values, bounds).view(np.int64)
                tokens = np.zeros((last - first, COORDINATES), np.uint32)
                if len(values):
                    tokens[~empty] = minwise(values, bounds[:-1][~empty])
                packed = pa.array([row.tobytes() for row in tokens], pa.binary(), mask=empty)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(sizes), pa.array(names, pa.int64(), mask=empty), packed], ["key", "n", "name", "tokens"]
                )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n bigint, name bigint, tokens binary")


def branched(paths: np.ndarray, owner: np.ndarray, tokens: np.ndarray, levels: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Nodes some levels further down, with the row that each entry belongs to."""
    second = np.uint64(int((1 / threshold - 1) * 2**32))
    for _ in range(levels):
        choice = mix(paths, 31)
        one = (choice % np.uint64(COORDINATES)).astype(np.int64)
        two = (one + 1 + ((choice >> np.uint64(8)) % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
        more = np.flatnonzero((choice >> np.uint64(32)) < second)
        coordinate = np.concatenate((one, two[more]))
        paths, owner = np.concatenate((paths, paths[more])), np.concatenate((owner, owner[more]))
        paths = mix(paths ^ (tokens[owner, coordinate].astype(np.uint64) << np.uint64(8)) ^ coordinate.astype(np.uint64), 32)
    return paths, owner


def packed_tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), COORDINATES)


def roots(classes: DataFrame, trees: range, threshold: float) -> DataFrame:
    """``(path, name, component)``: every class in the nodes of the trees' first levels."""
    seeds = mix(np.array(list(trees), np.uint64), 33)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            owner = np.tile(np.arange(batch.num_rows), len(seeds))
            paths, owner = branched(np.repeat(seeds, batch.num_rows), owner, packed_tokens(batch.column(2)), FIRST_LEVELS, threshold)
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), batch.column(0).take(at), batch.column(1).take(at)], ["path", "name", "component"])

    return classes.select("name", "component", "tokens").mapInArrow(run, NODES)


def children(members: DataFrame, threshold: float) -> DataFrame:
    """``(path, name, component)``: nodes further down, of all members (with their ``tokens``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            paths, owner = np.asarray(batch.column(0)).view(np.uint64), np.arange(batch.num_rows)
            paths, owner = branched(paths, owner, packed_tokens(batch.column(3)), MORE_LEVELS, threshold)
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), batch.column(1).take(at), batch.column(2).take(at)], ["path", "name", "component"])

    return members.select("path", "name", "component", "tokens").mapInArrow(run, NODES)


def unfinished(nodes: DataFrame) -> DataFrame:
    """``(path, name, component, n, least)`` of the nodes that hold several components.

    Each has ``n`` members, of which ``least`` is the smallest.
    """
    sizes = nodes.groupBy("path").agg(
        F.count(F.lit(1)).alias("n"), F.min("name").alias("least"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    several = sizes.filter(F.col("low") < F.col("high")).select("path", "n", "least")
    return nodes.join(several, "path").select("path", "name", "component", "n", "least")


def blocks_with_pivot(members: DataFrame, deal: int) -> DataFrame:
    """``(path, name, component)``: the members of nodes in blocks that all hold the node's smallest."""
    blocks = F.ceil(F.col("n") / F.lit(NODE_LIMIT - 1)).cast("long")
    own = F.pmod(F.xxhash64("name", "path", F.lit(deal)), blocks)
    # Only the smallest member of a node goes to all of its blocks.
    held = F.when(F.col("name") == F.col("least"), F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(F.array(own))
    dealt = members.select("path", "name", "component", F.explode(held).alias("block"))
    return dealt.select(F.xxhash64("path", "block", F.lit(deal)).alias("path"), "name", "component")


def with_outsiders(members: DataFrame) -> DataFrame:
    """Add ``outsiders``, the members outside the node's largest component; nodes of one component go."""
    sizes = members.groupBy("path", "component").agg(F.count(F.lit(1)).alias("held"))
    nodes = sizes.groupBy("path").agg((F.sum("held") - F.max("held")).alias("outsiders"))
    return members.join(nodes.filter("outsiders > 0"), "path").select("path", "name", "component", "outsiders")


def block_pairs(members: DataFrame) -> DataFrame:
    """``(path, name, component)``: groups in which each member outside the largest component meets every member."""
    sizes = members.groupBy("path", "component").agg(F.count(F.lit(1)).alias("held"))
    nodes = sizes.groupBy("path").agg(F.sum("held").alias("all"), F.max(F.struct("held", "component")).alias("top"))
    half, zero = NODE_LIMIT // 2, F.lit(0).cast("long")
    nodes = nodes.select(
        "path", F.col("top.component").alias("major"),
        F.ceil(F.col("all") / F.lit(half)).cast("long").alias("rows"),
        F.ceil((F.col("all") - F.col("top.held")) / F.lit(half)).cast("long").alias("columns"),
    )
    at = members.join(nodes, "path").withColumns({
        "row": F.pmod(F.xxhash64("name", F.lit("row")), F.col("rows")), "column": F.pmod(F.xxhash64("name", F.lit("column")), F.col("columns")),
    })
    one = at.select("path", "name", "component", "row", F.explode(F.sequence(zero, F.col("columns") - 1)).alias("column"))
    two = at.filter(F.col("component") != F.col("major")).withColumnRenamed("row", "own")
    two = two.withColumn("row", F.explode(F.sequence(zero, F.col("rows") - 1))).filter(F.col("row") != F.col("own"))
    pairs = one.unionByName(two.select("path", "name", "component", "row", "column"))
    return pairs.select(F.xxhash64("path", "row", "column", F.lit("pair")).alias("path"), "name", "component")


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches sorted by their first column as runs of whole groups, with the groups' bounds."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(0))
        if kept and kept[-1].column(0)[-1].as_py() != keys[0]:
            yield whole_groups(kept)
            kept = []
        last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if last:
            yield whole_groups([*kept, batch.slice(0, last)])
            kept = []
        kept.append(batch.slice(last))
    if kept:
        yield whole_groups(kept)


def whole_groups(parts: list[pa.RecordBatch]) -> tuple[pa.RecordBatch, np.ndarray]:
    batch = pa.concat_batches(parts)
    keys = np.asarray(batch.column(0))
    return batch, np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def cluster_name(names: np.ndarray, member: np.ndarray) -> np.ndarray:
    """One name per line for the members marked in it, whatever their order."""
    parts = np.where(member, mix(names.view(np.uint64), 41), np.uint64(0))
    return mix(np.bitwise_xor.reduce(parts, axis=-1) + member.sum(-1).astype(np.uint64)).view(np.int64)


def small_clusters(names: np.ndarray, tokens: np.ndarray, share: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Clusters of many groups of one size: ``names`` (groups, size), ``tokens`` (groups, size, coordinates).

    Yields the cluster's name, the group and the place in it of every member, clusters in runs.
    """
    size = names.shape[1]
    near = np.zeros((len(names), size, size), np.float32)
    for i in range(size):
        near[:, i, i] = 1
        for j in range(i):
            near[:, i, j] = near[:, j, i] = (tokens[:, i] == tokens[:, j]).mean(1) >= share
    for _ in range(int(np.ceil(np.log2(size)))):
        near = (near @ near > 0).astype(np.float32)
    first = near.argmax(2)
    for i in range(size - 1):
        member = first == i
        lines = np.flatnonzero(member.sum(1) > 1)
        if len(lines):
            label = cluster_name(names[lines], member[lines])
            at, place = np.nonzero(member[lines])
            yield label[at], lines[at], place


def large_clusters(names: np.ndarray, tokens: np.ndarray, share: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The cluster's name and the place of every member, a cluster at a time."""
    left = np.arange(len(names))
    while len(left):
        queue, left, group = [left[0]], left[1:], [left[0]]
        while queue and len(left):
            near = (tokens[left] == tokens[queue.pop()]).mean(1) >= share
            queue += left[near].tolist()
            group += left[near].tolist()
            left = left[~near]
        if len(group) > 1:
            own = names[group]
            yield np.repeat(cluster_name(own[None], np.ones((1, len(own)), bool)), len(own)), np.array(group)


def several_components(labels: np.ndarray, components: np.ndarray) -> np.ndarray:
    """Marks the members of the clusters (runs of labels) that hold more than one component."""
    starts = np.concatenate(([0], np.flatnonzero(labels[1:] != labels[:-1]) + 1))
    mixed = np.minimum.reduceat(components, starts) != np.maximum.reduceat(components, starts)
    return np.repeat(mixed, np.diff(np.concatenate((starts, [len(labels)]))))


def candidates(nodes: DataFrame, classes: DataFrame, share: float) -> DataFrame:
    """``(cluster, name, component)``: classes of a node that are connected by similar sketches.

    The cluster is named by its members, so what several trees find is there once.  Clusters
    of one component are left out.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in grouped(batches):
            names, owners, tokens = np.asarray(batch.column(1)), np.asarray(batch.column(2)), packed_tokens(batch.column(3))
            sizes = np.diff(bounds)
            found = []
            for size in range(2, SMALL_GROUP + 1):
                starts = bounds[:-1][sizes == size]
                if len(starts):
                    at = starts[:, None] + np.arange(size)
                    found += [(labels, at[line, place]) for labels, line, place in small_clusters(names[at], tokens[at], share)]
            for low, high in zip(bounds[:-1][sizes > SMALL_GROUP].tolist(), bounds[1:][sizes > SMALL_GROUP].tolist()):
                found += [(labels, low + place) for labels, place in large_clusters(names[low:high], tokens[low:high], share)]
            for labels, at in found:
                kept = several_components(labels, owners[at])
                yield pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (labels, names[at], owners[at])], ["cluster", "name", "component"])

    full = nodes.join(classes.select("name", "tokens"), "name").select("path", "name", "component", "tokens")
    placed = full.repartition("path").sortWithinPartitions("path")
    return placed.mapInArrow(compare, "cluster bigint, name bigint, component bigint").distinct()


def few(table: DataFrame) -> DataFrame:
    """A written table as the side of a join: broadcast if it has few rows, shuffled otherwise."""
    return table.hint("broadcast" if table.count() <= FEW_ROWS else "merge")


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``(name, values)``: the sorted shingle hashes of the classes ``(name, key)``, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.asarray(batch.column(0)).view(np.uint64)
            for first, last, raw, offsets in text_runs(batch.column(1)):
                values, bounds = shingle_sets(raw, offsets, size)
                same = np.flatnonzero(set_names(values, bounds) == names[first:last])
                bodies = [(values[bounds[k] : bounds[k + 1]] >> np.uint64(64 - 8 * SET_BYTES)).view(np.uint8).reshape(-1, 8)[:, :SET_BYTES].tobytes() for k in same]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first).take(pa.array(same)), pa.array(bodies, pa.binary())], ["name", "values"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    texts = rows.join(few(wanted), "key").select("name", "text").mapInArrow(run, "name bigint, values binary")
    return texts.groupBy("name").agg(F.first("values").alias("values"))


def unpacked(body: bytes) -> np.ndarray:
    wide = np.zeros((len(body) // SET_BYTES, 8), np.uint8)
    wide[:, :SET_BYTES] = np.frombuffer(body, np.uint8).reshape(-1, SET_BYTES)
    return wide.view(np.uint64).ravel()


def confirmed(clusters: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` of components that the exact similarity connects within each cluster.

    ``clusters`` has ``(cluster, name, component)``: classes of one component are connected
    already and are not compared with each other.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in grouped(batches):
            labels, bodies = np.asarray(batch.column(2)), batch.column(3)
            links = []
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                sets = [unpacked(bodies[i].as_py()) for i in range(low, high)]
                links += linked(labels[low:high].tolist(), labels[low:high].copy(), sets, percent)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    full = sets.join(few(clusters), "name").select("cluster", "name", "component", "values")
    placed = full.repartition("cluster").sortWithinPartitions("cluster", "name")
    return placed.mapInArrow(compare, "a bigint, b bigint")


def linked(owners: list[int], label: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links of the ``owners`` that join the labels of a cluster; equal labels are not compared."""
    sizes = np.array([len(s) for s in sets])
    common = common_counts(sets) if len(sets) > SMALL_GROUP else None
    links = []
    for k in range(len(owners)):
        others = np.flatnonzero(label != label[k])
        others = others[100 * np.minimum(sizes[others], sizes[k]) >= percent * np.maximum(sizes[others], sizes[k])]
        if not len(others):
            continue
        shared = np.array([in_common(sets[o], sets[k]) for o in others]) if common is None else common[k, others]
        for o in others[100 * shared >= percent * (sizes[others] + sizes[k] - shared)]:
            if label[o] != label[k]:
                links.append((owners[k], owners[o]))
                label[label == label[o]] = label[k]
    return links


def common_counts(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Common members of every two sets: products of incidence blocks, ``width`` shared members each."""
    values, member, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(counts > 1) - 1
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = counts[member] > 1
    owner, member = owner[shared], place[member[shared]]
    order = np.argsort(member, kind="stable")
    owner, member = owner[order], member[order]
    common = np.zeros((len(sets), len(sets)), np.int64)
    cuts = np.searchsorted(member, np.arange(0, place[-1] + 1 + width, width))
    for number, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
        block = np.zeros((len(sets), width), np.float32)
        block[owner[low:high], member[low:high] - number * width] = 1
        common += (block @ block.T).astype(np.int64)
    return common


def in_common(one: np.ndarray, two: np.ndarray) -> int:
    """Common members of two sets without repeats."""
    both = np.concatenate((one, two))
    both.sort()
    return int((both[1:] == both[:-1]).sum())


class Search:
    """The classes and the components, ``placed`` (name, component), that the links so far put them in."""

    def __init__(self, docs: DataFrame, classes: DataFrame, key: str, text: str, size: int, percent: int):
        self.docs, self.classes, self.source, self.percent = docs, classes, (key, text, size), percent
        self.placed = durable(classes.select("name", F.col("name").alias("component")))
        self.sets: list[DataFrame] = []
        # The clusters that were compared.
        self.seen: list[DataFrame] = []
        self.last_level = last_level(classes.count())
        # The deepest level that a tree had to go to.
        self.level = FIRST_LEVELS

    def run(self) -> None:
        """All trees; the more of them, the deeper they had to go."""
        done, wanted = 0, FIRST_TREES
        while done < wanted:
            self.trees(range(done, wanted))
            done, wanted = wanted, tree_count(self.percent, self.level)

    def trees(self, trees: range) -> None:
        """Compare the nodes of the trees, level after level until none is left."""
        threshold, level = self.percent / 100, FIRST_LEVELS
        nodes = durable(roots(self.classes.join(self.placed, "name"), trees, threshold))
        pairs = None
        while True:
            self.level = max(self.level, level)
            several = durable(unfinished(nodes))
            discard(nodes)
            large = several.filter(F.col("n") > NODE_LIMIT)
            work = several.filter(F.col("n") <= NODE_LIMIT).select("path", "name", "component")
            branches = not large.isEmpty()
            if branches:
                work = work.unionByName(blocks_with_pivot(large, 0)).unionByName(blocks_with_pivot(large, 1))
            self.compare(work if pairs is None else work.unionByName(pairs))
            if pairs is not None:
                discard(pairs)
            if not branches:
                return
            left = durable(with_outsiders(large.select("path", "name").join(self.placed, "name")))
            discard(several)
            few_outside = F.lit(level >= self.last_level) | (F.col("outsiders") <= NODE_LIMIT)
            pairs = durable(block_pairs(left.filter(few_outside).drop("outsiders")))
            left = left.filter(~few_outside)
            if left.isEmpty():
                self.compare(pairs)
                return
            nodes = durable(children(left.join(self.classes.select("name", "tokens"), "name"), threshold))
            level += MORE_LEVELS

    def compare(self, nodes: DataFrame) -> None:
        """Join the components of classes that meet in the nodes ``(path, name, component)``."""
        with scratch() as tables:
            clusters = candidates(nodes, self.classes, sketch_share(self.percent))
            for seen in self.seen:
                clusters = clusters.join(few(seen), "cluster", "left_anti")
            clusters = durable(clusters)
            if not clusters.isEmpty():
                self.confirm(clusters, tables)
        # The shuffles of the step go before the next one.
        released(self.docs.sparkSession)

    def confirm(self, clusters: DataFrame, tables: Scratch) -> None:
        """Join the components that the full sets of the clusters' members connect."""
        self.seen.append(tables.keep(clusters).select("cluster"))
        links = durable(confirmed(clusters, self.full_sets(clusters, tables), self.percent))
        if links.isEmpty():
            return
        moved = components(links).select(F.col("node").alias("component"), "root")
        placed = self.placed.join(moved, "component", "left").select("name", F.coalesce("root", "component").alias("component"))
        before, self.placed = self.placed, tables.keep(durable(placed))
        discard(before)

    def full_sets(self, clusters: DataFrame, tables: Scratch) -> DataFrame:
        """The sets of the classes in the clusters; those of earlier steps are written already."""
        wanted = clusters.select("name").distinct()
        if self.sets:
            wanted = wanted.join(self.written_sets().select("name"), "name", "left_anti")
        wanted = durable(wanted.join(self.classes.select("name", "key"), "name"))
        if not wanted.isEmpty():
            self.sets.append(tables.keep(durable(full_sets(self.docs, wanted, *self.source))))
        return self.written_sets()

    def written_sets(self) -> DataFrame:
        """One scan of all tables of sets, however many steps wrote one."""
        first = self.sets[0]
        return first.sparkSession.read.schema(first.schema).parquet(*(table._durable_path for table in self.sets))


def near_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` of every row.

    Rows are linked if 100 * intersection >= ``percent`` * union of their shingle sets;
    ``component_id`` is the smallest key that links lead to.
    """
    with scratch() as tables:
        rows = tables.keep(durable(sketches(docs, key, text, size).repartition(parts_of(docs))))
        classes = durable(
            rows.filter(F.col("name").isNotNull()).groupBy("name").agg(F.min("key").alias("key"), F.first("tokens").alias("tokens"))
        )
        search = Search(docs, classes, key, text, size, percent)
        search.run()
        labelled = classes.select("name", "key").join(search.placed, "name")
        least = labelled.groupBy("component").agg(F.min("key").alias("component_id"))
        named = tables.keep(durable(labelled.join(least, "component").select("name", "component_id")))
    return rows.select("key", "n", "name").join(named, "name", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "key").alias("component_id"),
        F.col("key").eqNullSafe(F.coalesce("component_id", "key")).alias("kept"),
    )
