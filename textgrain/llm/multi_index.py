"""Nearest neighbours by cosine through an inverted multi-index.

**Method.**  Vectors are scaled to length 1 and cut into two halves; each half has its own
quantiser of ``centroids`` points, so a vector lies in one of ``centroids ** 2`` cells.  A
query ranks the centroids of both halves by distance and visits cell pairs in order of the
summed distance with a heap, until the visited cells hold enough vectors.  Those are ranked
by the exact cosine of the original vectors, in double precision.

Equal vectors are one index entry that keeps its smallest ids, as many as can be returned,
so a vector that a third of the rows share neither fills the visited cells nor meets in one
task.  Entries of a large first-half cell and many queries are dealt into blocks.

The quantisers are fitted on a bounded sample (``SAMPLE_ROWS``, by hash of the id); every
vector is indexed.  ``share`` of the distinct vectors is visited per query (at least
``least``): directionless data such as random vectors need about half for a recall of 0.9;
clustered data need far less.

Cases: vectors that are null, empty, zero, or hold a null or non-finite component take no
part, nor do null ids and vectors whose length is not the most frequent one (the larger of
equally frequent ones).  Rows that share an id count once, with the smallest vector.  Ties go
to the smaller id.  With fewer candidates all are returned.  An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textgrain.llm.common import parts_of
from textgrain.session import durable

CENTROIDS = 64
SAMPLE_ROWS = 16_384
SAMPLE_VALUES = 4 << 20
ROUNDS = 12
SHARE = 0.5
LEAST = 1000
ENTRY_BLOCK = 4096
QUERY_BLOCK = 2048
# Cosines by matrix product differ from the measure by less than this.
ROUNDING = 1e-9


def usable_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, vec)``: one finite, non-zero vector of the common length per id."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    kept = (
        rows.select(F.col(key).alias("id"), values.alias("vec"))
        .filter(F.col("id").isNotNull() & F.col("vec").isNotNull())
        .filter(F.coalesce(fine_values(F.col("vec")), F.lit(False)))
        .groupBy("id")
        .agg(F.min("vec").alias("vec"))
    )
    kept = durable(kept)
    length = kept.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return kept.filter(F.size("vec") == (length["n"] if length else 0))


def fine_values(values: Column) -> Column:
    largest = float(np.finfo(np.float64).max)
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= largest))
    return (F.size(values) > 0) & finite & F.exists(values, lambda x: x != 0.0)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def squared_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points * points).sum(1)[:, None] + (centres * centres).sum(1)[None] - 2 * points @ centres.T


def quantiser(points: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Centres of k-means on the sample; an empty cluster keeps its centre."""
    source = np.random.default_rng(seed)
    centres = points[source.choice(len(points), min(count, len(points)), replace=False)].copy()
    for _ in range(ROUNDS):
        nearest = squared_distances(points, centres).argmin(1)
        sizes = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def visited_cells(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> np.ndarray:
    """Cells in order of summed distance until they hold ``wanted`` entries; as a boolean grid."""
    by_first, by_second = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    near, far = first[by_first].tolist(), second[by_second].tolist()
    grid = np.zeros(sizes.shape, bool)
    seen = {(0, 0)}
    heap = [(near[0] + far[0], 0, 0)]
    held = 0
    while heap and held < wanted:
        _, a, b = heapq.heappop(heap)
        i, j = by_first[a], by_second[b]
        grid[i, j] = True
        held += int(sizes[i, j])
        for c, d in ((a + 1, b), (a, b + 1)):
            if c < len(near) and d < len(far) and (c, d) not in seen:
                seen.add((c, d))
                heapq.heappush(heap, (near[c] + far[d], c, d))
    return grid


class MultiIndex:
    """Entries with their cells in a written table; quantisers and cell sizes on the driver."""

    def __init__(self, vectors: DataFrame, k: int, centroids: int = CENTROIDS):
        session = vectors.sparkSession
        self.k = k
        # A window limit: of every equal vector, each task sends at most k + 1 ids on.
        within = Window.partitionBy("vec").orderBy("id")
        classes = (
            vectors.withColumn("place", F.row_number().over(within))
            .filter(F.col("place") <= k + 1)
            .groupBy("vec")
            .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        )
        classes = durable(classes)
        width = classes.select(F.size("vec")).first()
        self.width = width[0] if width else 0
        # At most SAMPLE_ROWS vectors and SAMPLE_VALUES numbers come to the driver.
        rows = min(SAMPLE_ROWS, SAMPLE_VALUES // max(1, self.width))
        sample = classes.orderBy(F.xxhash64("vec"), "vec").limit(rows).select("vec").toArrow().column("vec")
        self.empty = len(sample) == 0
        if self.empty:
            return
        points = unit(np.asarray(sample.combine_chunks().flatten()).reshape(len(sample), -1))
        half = (self.width + 1) // 2
        self.half = half
        self.centres = quantiser(points[:, :half], centroids, 1), quantiser(points[:, half:], centroids, 2)
        self.entries = durable(classes.mapInArrow(self.placer(), "i int, j int, vec array<double>, ids array<bigint>"))
        # At most centroids ** 2 rows.
        counts = self.entries.groupBy("i", "j").count().collect()
        self.sizes = np.zeros((len(self.centres[0]), len(self.centres[1])), np.int64)
        for i, j, n in counts:
            self.sizes[i, j] = n
        blocks = np.maximum(1, -(-self.sizes.sum(1) // ENTRY_BLOCK))
        self.blocks = session.createDataFrame([(i, int(n)) for i, n in enumerate(blocks)], "i int, blocks int")

    def placer(self):
        half, (left, right) = self.half, self.centres

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                points = unit(np.asarray(batch.column("vec").flatten()).reshape(batch.num_rows, -1))
                i = squared_distances(points[:, :half], left).argmin(1).astype(np.int32)
                j = squared_distances(points[:, half:], right).argmin(1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), batch.column("vec"), batch.column("ids")], ["i", "j", "vec", "ids"])

        return place

    def router(self, wanted: int):
        half, (left, right), sizes = self.half, self.centres, self.sizes

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                flat = np.asarray(batch.column("vec").flatten()).reshape(batch.num_rows, -1)
                points = unit(flat)
                first, second = squared_distances(points[:, :half], left), squared_distances(points[:, half:], right)
                lines, cells, masks = [], [], []
                for line in range(batch.num_rows):
                    grid = visited_cells(first[line], second[line], sizes, wanted)
                    grid &= sizes > 0
                    for i in np.flatnonzero(grid.any(1)):
                        lines.append(line)
                        cells.append(i)
                        masks.append(np.packbits(grid[i]).tobytes())
                taken = batch.take(pa.array(lines, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [taken.column("id"), taken.column("vec"), pa.array(cells, pa.int32()), pa.array(masks, pa.binary())], ["query_id", "vec", "i", "cells"]
                )

        return route

    def search(self, queries: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
        """``(query_id, rank, vec_id, score)``: the k nearest found per query ``(id, vec)``."""
        fields = "query_id bigint, vec_id bigint, score double"
        if self.empty:
            found = queries.sparkSession.createDataFrame([], fields)
        else:
            wanted = max(least, int(np.ceil(share * self.sizes.sum())))
            number = queries.count()
            query_blocks = max(1, -(-number // QUERY_BLOCK))
            routed = (
                queries.select("id", "vec").repartition(parts_of(queries))
                .mapInArrow(self.router(wanted), "query_id bigint, vec array<double>, i int, cells binary")
                .join(F.broadcast(self.blocks), "i")
                .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int"))
                .drop("blocks")
            )
            entries = (
                self.entries.join(F.broadcast(self.blocks), "i")
                .withColumn("block", F.pmod(F.xxhash64("vec"), F.col("blocks")).cast("int"))
                .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
                .drop("blocks")
            )
            keys = ["i", "block", "part"]
            found = routed.groupBy(*keys).cogroup(entries.groupBy(*keys)).applyInPandas(self.ranker(), fields)
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return (
            found.withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= self.k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
        )

    def ranker(self):
        k, width = self.k, self.sizes.shape[1]

        def rank(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
            if not len(queries) or not len(entries):
                return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
            asked, held = np.stack(queries["vec"].to_numpy()), np.stack(entries["vec"].to_numpy())
            open_cells = np.stack([np.unpackbits(np.frombuffer(m, np.uint8), count=width) for m in queries["cells"]]).astype(bool)
            rough = unit(asked) @ unit(held).T
            rough[~open_cells[:, entries["j"].to_numpy()]] = -np.inf
            # By matrix product, all that can be as near as the last one asked for, the query's
            # own entry besides; the measure itself decides among them.
            place = len(held) - min(k + 1, len(held))
            least = np.partition(rough, place, axis=1)[:, place] - ROUNDING
            norms = np.sqrt((held * held).sum(1))
            ids = entries["ids"].to_numpy()
            rows = []
            for line, name in enumerate(queries["query_id"].to_numpy()):
                chosen = np.flatnonzero(np.isfinite(rough[line]) & (rough[line] >= least[line]))
                dots = (held[chosen] * asked[line]).sum(1)
                scores = dots / (np.sqrt((asked[line] * asked[line]).sum()) * norms[chosen])
                pairs = [(-s, int(v)) for s, c in zip(scores.tolist(), chosen) for v in ids[c] if v != name]
                rows += [(name, v, -s) for s, v in heapq.nsmallest(k, pairs)]
            return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

        return rank


def nearest_neighbours(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5, every: int = 50, share: float = SHARE, least: int = LEAST, centroids: int = CENTROIDS
) -> DataFrame:
    """The ``k`` nearest of every row whose key is divisible by ``every``, itself left out."""
    vectors = durable(usable_vectors(rows, key, vector))
    index = MultiIndex(vectors, k, centroids)
    return index.search(vectors.filter(F.col("id") % every == 0), share, least)
