"""Approximate nearest neighbours by collision-counting hashing.

Every vector is projected on ``projections`` random directions; each single
projection is a sorted array of its own. A query opens a window around its
value in every array. Virtual rehashing widens all windows by a factor per
round, as if the arrays had been hashed anew at a larger radius, and counts
for each vector in how many windows it lies. Vectors whose count reaches the
collision threshold are verified by their exact distance, once. A query ends
when its k-th verified distance is within the round's radius, or when the
windows hold everything.

A vector at distance d falls into a window of half-width ``SPREAD`` * R with
probability P(|N(0,1)| <= SPREAD * R / d): at d <= R that is 0.9 or more, and
the threshold asks for three standard deviations less.

The vectors are dealt into blocks of bounded size by a hash of their id; each
block is indexed where it lies, and the stated query set is sent to each block.
A block gives its k best per query, and the blocks' results are merged.

Nearness is the Euclidean distance in double precision, ties to the smaller
id. Null and zero vectors and those with null or non-finite components take no
part, as query or candidate; vectors of different lengths are not compared; of several
vectors with one vec_id the least counts, alone, on both sides. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 64
SPREAD = 1.645  # window half-width for radius 1
THRESHOLD = 0.79  # share of windows: 0.9 less three deviations of 64 draws
WIDEN = 1.12  # factor of virtual rehashing
BLOCK_VALUES = 1 << 20  # components per block: 8 MB of doubles

FOUND = "query_id long, vec_id long, score double"


class Block:
    """Sorted single-projection arrays over a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int = PROJECTIONS):
        ids, first = np.unique(ids, return_index=True)
        self.ids, self.vectors = ids, vectors[first]
        # the same directions for every block of a length
        lines = np.random.default_rng(vectors.shape[1]).standard_normal((projections, vectors.shape[1]))
        values = lines @ self.vectors.T
        self.lines = lines
        self.order = np.argsort(values, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(values, self.order, axis=1)

    def nearest(self, own: int | None, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest found, nearest first, without ``own``."""
        n, m = len(self.ids), len(self.lines)
        centre = self.lines @ query
        least = max(1, int(THRESHOLD * m))
        counts = np.zeros(n, np.int32)
        pending = np.ones(n, bool)
        if own is not None and (at := np.searchsorted(self.ids, own)) < n and self.ids[at] == own:
            pending[at] = False
        found, dist = np.zeros(0, np.int64), np.zeros(0)
        lo = np.array([np.searchsorted(self.sorted[i], centre[i]) for i in range(m)])
        hi = lo.copy()
        # the first radius: where the windows hold a few vectors each
        gaps = np.sort(np.abs(self.sorted[:, :: max(1, n // 64)] - centre[:, None]), axis=1)
        radius = max(float(np.median(gaps[:, min(gaps.shape[1] - 1, 8)])) / SPREAD, 1e-12)
        while True:
            half = radius * SPREAD
            new = []
            for i in range(m):
                a = np.searchsorted(self.sorted[i], centre[i] - half, "left")
                b = np.searchsorted(self.sorted[i], centre[i] + half, "right")
                new += (self.order[i, a : lo[i]], self.order[i, hi[i] : b])
                lo[i], hi[i] = min(a, lo[i]), max(b, hi[i])
            counts += np.bincount(np.concatenate(new), minlength=n).astype(np.int32)
            ready = np.flatnonzero(pending & (counts >= least))
            if len(ready):
                pending[ready] = False
                gap = self.vectors[ready] - query
                # summed from the first component on, as the measure is written
                dist = np.concatenate([dist, np.sqrt(np.cumsum(gap * gap, axis=1)[:, -1])])
                found = np.concatenate([found, ready])
                best = np.lexsort((self.ids[found], dist))[:k]
                found, dist = found[best], dist[best]
            if not pending.any() or (len(found) == k and dist[-1] <= radius):
                return self.ids[found], dist
            radius *= WIDEN


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v, dim) of the vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    good = (
        ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0.0)
    )
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), good.alias("good")).where(
        "vec_id is not null and good"
    )
    return rows.groupBy("vec_id").agg(F.min("v").alias("v")).select("vec_id", "v", F.size("v").alias("dim"))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k nearest found among ``vectors``."""
    rows = usable(vectors, id_col, vector_col)
    asked = usable(queries, id_col, vector_col)
    total = rows.agg(F.sum(F.col("dim").cast("long"))).first()[0] or 0
    n_blocks = max(1, ceil(total / BLOCK_VALUES))
    data = rows.select(
        "dim", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "vec_id", "v"
    )
    sent = asked.select(
        "dim", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(1).alias("kind"), "vec_id", "v"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by (dim, block, kind): a block's vectors, then its queries.
        key, ids, parts, block = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            dims, blocks, kinds, vec = (batch.column(i).to_numpy() for i in range(4))
            runs = groupby(range(batch.num_rows), key=lambda i: (dims[i], blocks[i], kinds[i]))
            for (dim, number, kind), where in runs:
                where = list(where)
                a, b = where[0], where[-1] + 1
                values = batch.column(4).slice(a, b - a).flatten().to_numpy().reshape(b - a, dim)
                if (dim, number) != key:
                    key, ids, parts, block = (dim, number), [], [], None
                if kind == 0:
                    ids.append(vec[a:b])
                    parts.append(values)
                    continue
                if block is None and ids:
                    block = Block(np.concatenate(ids), np.concatenate(parts))
                    ids, parts = [], []
                if block is None:
                    continue
                out = [(q, *block.nearest(q, x, k)) for q, x in zip(vec[a:b].tolist(), values)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.full(len(i), q) for q, i, _ in out]), pa.int64()),
                        pa.array(np.concatenate([i for _, i, _ in out]), pa.int64()),
                        pa.array(np.concatenate([d for _, _, d in out]), pa.float64()),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    found = (
        data.union(sent)
        .repartition(max(n_blocks, 1), "dim", "block")
        .sortWithinPartitions("dim", "block", "kind")
        .mapInArrow(run, FOUND)
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
