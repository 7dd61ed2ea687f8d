"""Hard-negative mining by angular triangle filtering.

Scores are inner products of integer vectors. For each anchor the best rows of
its own label are its positives; for each positive, the best rows of other
labels whose scores lie within two shares of the positive's are its negatives.

Rows are dealt into blocks by a hash of their id. A block picks some of its
rows, far from one another, as reference directions and stores every row's
angle to each. With the anchor's angles, the triangle inequality gives an
interval for the angle between anchor and row, ``|a - x|`` to ``a + x``; its
cosines, multiplied by the norms and rounded away from the true value, bound
the score. Rows lie in tiles of one label that are near in angle; a tile's extreme
angles and norms bound all its rows. Only tiles, and in them rows, whose bounds
overlap the window of scores that can still enter a result are scored, in
exact integers.

Anchors travel to every block in chunks (the stated query set against all
rows); a block gives its best per anchor, and the blocks' results are merged.
Blocks grow with the data up to a bound, and there are some per core below it.

Order: higher scores first, ties by smaller vec_id. Rows with a null id,
label, vector or component, or a non-finite component, take no part; vectors of
different lengths are not compared; of several rows with one vec_id the least by label and
vector counts, alone. A zero vector scores 0. An anchor with fewer positives
or negatives gives those it has; without any, or without rows, the result is
empty. Products beyond 2**47 are scored in unbounded integers, slowly. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestline.llm.common import discard, written

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score
REFERENCES = 8
TILE = 128
CHUNK = 256  # anchors in a row on their way to the blocks
BLOCK_VALUES = 1 << 21  # components per block: 16 MB of doubles
LEAST_VALUES = 1 << 15  # a block of fewer components is not worth a task
SLACK = 1e-6  # of the product of the norms; rounding of angles and cosines is some 1e-8


class Anchors:
    """A chunk of anchors and, in the second step, their positives."""

    def __init__(self, ids, labels, vectors, counts=(), positive_ids=(), positive_scores=()):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.counts = np.asarray(counts, np.int64)
        self.positive_ids, self.positive_scores = positive_ids, positive_scores


class Block:
    """Rows of a block in tiles, with the angles of each to the block's reference directions."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        units = vectors / np.where(norms > 0, norms, 1.0)[:, None]
        self.references = self._spread(units)
        angles = self._angles(units)
        near = angles.argmin(axis=1)
        order = np.lexsort((ids, angles[np.arange(len(ids)), near], near, labels))
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.norms, self.angles = norms[order], angles[order]
        self.cos, self.sin = np.cos(self.angles), np.sin(self.angles)
        # a tile holds rows of one label
        edges = np.flatnonzero(np.diff(self.labels, prepend=self.labels[:1] - 1))
        stops = np.append(edges[1:], len(ids))
        self.starts = np.concatenate([np.arange(a, b, TILE) for a, b in zip(edges, stops)])
        self.stops = np.append(self.starts[1:], len(ids))
        self.low, self.high = (f.reduceat(self.angles, self.starts, axis=0) for f in (np.minimum, np.maximum))
        self.shortest, self.longest = (f.reduceat(self.norms, self.starts) for f in (np.minimum, np.maximum))
        self.place = np.argsort(np.argsort(self.ids))  # by id, for ties

    @staticmethod
    def _spread(units: np.ndarray) -> np.ndarray:
        """The middle direction, then rows that are far from those before."""
        middle = units.sum(axis=0)
        size = np.linalg.norm(middle)
        chosen = [middle / size if size > 1e-9 else units[0]]
        nearest = units @ chosen[0]
        for _ in range(min(REFERENCES, len(units)) - 1):
            chosen.append(units[int(nearest.argmin())])
            nearest = np.maximum(nearest, units @ chosen[-1])
        return np.stack(chosen)

    def _angles(self, units: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(units @ self.references.T, -1.0, 1.0))

    def prepare(self, anchors: Anchors) -> None:
        a = anchors.vectors
        self.a_norms = np.sqrt((a * a).sum(axis=1))
        self.a_angles = self._angles(a / np.where(self.a_norms > 0, self.a_norms, 1.0)[:, None])
        self.a_cos, self.a_sin = np.cos(self.a_angles), np.sin(self.a_angles)
        largest = float(np.abs(a).max(initial=0)) * float(np.abs(self.vectors).max(initial=0)) * a.shape[1]
        self.exact = largest * (len(self.ids) + 1) < 2.0**62 and largest < 2.0**53

    def tile_bounds(self, tile: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score that any row of the tile can have with each anchor."""
        a, low, high = self.a_angles[which], self.low[tile], self.high[tile]
        least = np.maximum(np.maximum(a - high, low - a), 0.0).max(axis=1)
        most = np.where((a + low <= np.pi) & (a + high >= np.pi), np.pi, np.minimum(a + high, 2 * np.pi - a - low)).min(axis=1)
        up, down = np.cos(least), np.cos(np.maximum(most, least))
        norm, slack = self.a_norms[which], SLACK * (1 + self.a_norms[which] * self.longest[tile])
        up = norm * up * np.where(up > 0, self.longest[tile], self.shortest[tile])
        down = norm * down * np.where(down > 0, self.shortest[tile], self.longest[tile])
        return np.ceil(down - slack), np.floor(up + slack)

    def row_bounds(self, tile: slice, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score of each anchor with each row of the tile."""
        up = down = None
        for r in range(len(self.references)):
            one = np.multiply.outer(self.a_cos[which, r], self.cos[tile, r])
            two = np.multiply.outer(self.a_sin[which, r], self.sin[tile, r])
            up = one + two if up is None else np.minimum(up, one + two)
            down = one - two if down is None else np.maximum(down, one - two)
        norms = np.multiply.outer(self.a_norms[which], self.norms[tile])
        slack = SLACK * (1 + norms)
        return np.ceil(down * norms - slack), np.floor(up * norms + slack)

    def scores(self, anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact integer inner products."""
        if self.exact:
            return (anchors @ rows.T).astype(np.int64)
        whole = np.frompyfunc(int, 1, 1)
        return whole(anchors) @ whole(rows).T

    def overlapping(self, anchors: Anchors, tile: int, which: np.ndarray, least: np.ndarray, most: np.ndarray):
        """(anchors, rows, scores, open) of the part of a tile whose bounds overlap [least, most] of each anchor."""
        low, high = self.tile_bounds(tile, which)
        fits = (high >= least) & (low <= most)
        if not fits.any():
            return None
        which, least, most = which[fits], least[fits], most[fits]
        where = slice(self.starts[tile], self.stops[tile])
        low, high = self.row_bounds(where, which)
        opened = (high >= least[:, None]) & (low <= most[:, None])
        some_a, some_x = opened.any(axis=1), opened.any(axis=0)
        if not some_a.any():
            return None
        which, rows = which[some_a], np.flatnonzero(some_x) + self.starts[tile]
        return which, rows, self.scores(anchors.vectors[which], self.vectors[rows]), opened[np.ix_(some_a, some_x)]

    # A row's rank among all is one integer: the score, then the smaller id.

    def nothing(self):
        return np.int64(-(1 << 62)) if self.exact else -(1 << 400)

    def ranks(self, scores: np.ndarray, rows: np.ndarray) -> np.ndarray:
        n = len(self.ids)
        return scores * n + (n - 1 - self.place[rows])

    def empty(self, *shape: int) -> np.ndarray:
        return np.full(shape, self.nothing(), np.int64 if self.exact else object)

    def unpacked(self, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        """(ids, scores, where) of the ranks in ``best`` that are taken."""
        where = np.nonzero(best > self.nothing())
        ranks, n = best[where], len(self.ids)
        by_id = np.sort(self.ids)
        return by_id[(n - 1 - ranks % n).astype(np.int64)], ranks // n, where

    def positives(self, anchors: Anchors, k: int) -> np.ndarray:
        """The ranks of each anchor's k best other rows of its label."""
        self.prepare(anchors)
        best = self.empty(len(anchors.ids), k)
        most = np.full(len(anchors.ids), np.inf)
        for tile, label in enumerate(self.labels[self.starts].tolist()):
            which = np.flatnonzero(anchors.labels == label)
            if not len(which):
                continue
            least = (best[which, 0] // len(self.ids)).astype(float)
            found = self.overlapping(anchors, tile, which, least, most[which])
            if found is None:
                continue
            which, rows, scores, opened = found
            opened &= anchors.ids[which][:, None] != self.ids[rows]
            ranks = np.where(opened, self.ranks(scores, rows), self.nothing())
            best[which] = np.sort(np.concatenate([best[which], ranks], axis=1), axis=1)[:, -k:]
        return best

    def negatives(self, anchors: Anchors, k: int, low: int, high: int) -> np.ndarray:
        """The ranks of the k best rows of other labels in the window of each anchor's each positive."""
        self.prepare(anchors)
        of = np.repeat(np.arange(len(anchors.ids)), anchors.counts)
        slot = np.arange(len(of)) - np.repeat(np.cumsum(anchors.counts) - anchors.counts, anchors.counts)
        least, most = (np.full((len(anchors.ids), int(anchors.counts.max(initial=0))), v, object) for v in (1, 0))
        for i, j, s in zip(of.tolist(), slot.tolist(), anchors.positive_scores.tolist()):
            least[i, j], most[i, j] = -(-low * s // 100), high * s // 100
        if self.exact:
            least, most = least.astype(np.int64), most.astype(np.int64)
        best = self.empty(*least.shape, k)
        if not least.shape[1]:
            return best
        void = least > most
        for tile, label in enumerate(self.labels[self.starts].tolist()):
            which = np.flatnonzero((anchors.labels != label) & ~void.all(axis=1))
            if not len(which):
                continue
            # what a row must reach to be among the best of a window
            reach = np.maximum(least[which], best[which][:, :, 0] // len(self.ids))
            hull_low = np.where(void[which], np.inf, reach.astype(float)).min(axis=1)
            hull_high = np.where(void[which], -np.inf, most[which].astype(float)).max(axis=1)
            found = self.overlapping(anchors, tile, which, hull_low, hull_high)
            if found is None:
                continue
            which, rows, scores, opened = found
            ranks = self.ranks(scores, rows)
            for j in range(least.shape[1]):
                inside = opened & (scores >= least[which, j][:, None]) & (scores <= most[which, j][:, None])
                inside &= ranks > best[which, j, 0][:, None]
                some = inside.any(axis=1)
                if not some.any():
                    continue
                new = np.where(inside[some], ranks[some], self.nothing())
                at = which[some]
                best[at, j] = np.sort(np.concatenate([best[at, j], new], axis=1), axis=1)[:, -k:]
        return best


def usable(vectors: DataFrame, id_col: str, label: Column, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, dim, v) of the rows that take part; v holds whole numbers as doubles."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.when(~bad, F.transform(v, lambda x: F.floor(x * float(scale)).cast("double"))).alias("v"),
    ).where("vec_id is not null and label is not null and v is not null")
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
    return one.select("vec_id", "r.label", F.size("r.v").alias("dim"), "r.v")


PACKED = ["dim", "block", "kind", "ids", "labels", "v", "counts", "positive_ids", "positive_scores"]


def _dealt(rows: DataFrame, n_blocks: int) -> DataFrame:
    longs = F.array().cast("array<long>")
    return rows.select(
        "dim",
        F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int").alias("block"),
        F.lit(0).alias("kind"),
        F.array("vec_id").alias("ids"),
        F.array("label").alias("labels"),
        "v",
        *[longs.alias(c) for c in PACKED[6:]],
    )


def _sent(anchors: DataFrame, n_blocks: int, n_chunks: int) -> DataFrame:
    """The anchors in chunks, a copy of each chunk for every block."""
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), "vec_id"), F.lit(n_chunks))
    packed = (
        anchors.groupBy("dim", chunk.alias("chunk"))
        .agg(F.array_sort(F.collect_list(F.struct("vec_id", "label", "v", "positive_ids", "positive_scores"))).alias("a"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    )
    return packed.select(
        "dim",
        "block",
        F.lit(1).alias("kind"),
        F.col("a.vec_id").alias("ids"),
        F.col("a.label").alias("labels"),
        F.flatten("a.v").alias("v"),
        F.transform("a.positive_ids", lambda p: F.size(p).cast("long")).alias("counts"),
        F.flatten("a.positive_ids").alias("positive_ids"),
        F.flatten("a.positive_scores").alias("positive_scores"),
    )


def _in_blocks(rows: DataFrame, anchors: DataFrame, n_blocks: int, n_chunks: int, search: Callable, schema: str) -> DataFrame:
    """Run ``search(block, anchors)`` for every block and chunk; it gives a record batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sorted by (dim, block, kind): a block's rows, then its chunks
        key, parts, block = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                dim, number, kind = (batch.column(c)[i].as_py() for c in range(3))
                ids, labels, v, *rest = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in range(3, 9))
                if (dim, number) != key:
                    key, parts, block = (dim, number), [], None
                if kind == 0:
                    parts.append((ids, labels, v))
                    continue
                if block is None and parts:
                    ids_, labels_, values = (np.concatenate(p) for p in zip(*parts))
                    block, parts = Block(ids_, labels_, values.reshape(len(ids_), dim)), []
                if block is not None:
                    yield search(block, Anchors(ids, labels, v.reshape(len(ids), dim), *rest))

    return (
        _dealt(rows, n_blocks)
        .unionByName(_sent(anchors, n_blocks, n_chunks))
        .select(*PACKED)
        .repartition(n_blocks, "dim", "block")
        .sortWithinPartitions("dim", "block", "kind")
        .mapInArrow(run, schema)
    )


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns.values()], names=list(columns))


def mined(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on vec_id, label and dim. For each anchor, its
    ``positives`` best other rows of its label; for each of these the
    ``negatives`` best rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors, id_col, F.col("label") if label is None else label, vector_col, scale), "vectors")
    total = rows.agg(F.sum(F.col("dim").cast("long"))).first()[0] or 0
    spread = min(2 * spark.sparkContext.defaultParallelism, -(-total // LEAST_VALUES))
    n_blocks = max(1, -(-total // BLOCK_VALUES), spread)
    none = F.array().cast("array<long>")
    anchors = rows.where(is_anchor).withColumns({"positive_ids": none, "positive_scores": none})
    n_chunks = max(1, -(-anchors.count() // CHUNK))

    def best_positives(block: Block, asked: Anchors) -> pa.RecordBatch:
        ids, scores, (i, _) = block.unpacked(block.positives(asked, positives))
        return _batch({"anchor_id": asked.ids[i], "positive_id": ids, "score": scores})

    def best_negatives(block: Block, asked: Anchors) -> pa.RecordBatch:
        ids, scores, (i, j, _) = block.unpacked(block.negatives(asked, negatives, low, high))
        at = (np.cumsum(asked.counts) - asked.counts)[i] + j
        return _batch(
            {
                "anchor_id": asked.ids[i],
                "positive_id": asked.positive_ids[at],
                "negative_id": ids,
                "positive_score": asked.positive_scores[at],
                "negative_score": scores,
            }
        )

    found = _in_blocks(rows, anchors, n_blocks, n_chunks, best_positives, "anchor_id long, positive_id long, score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    first = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= positives)
    of_anchor = first.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("at", "positive_id", "score"))).alias("p"))
    asked = written(
        anchors.join(of_anchor, anchors["vec_id"] == of_anchor["anchor_id"]).select(
            "dim", "vec_id", "label", "v", F.col("p.positive_id").alias("positive_ids"), F.col("p.score").alias("positive_scores")
        ),
        "anchors",
    )
    schema = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    found = written(_in_blocks(rows, asked, n_blocks, n_chunks, best_negatives, schema), "negatives")
    discard(rows, asked)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
