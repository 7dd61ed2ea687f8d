"""Histogram gradient boosting of many models at once.

One table holds the training rows of all models (a commodity and horizon each,
say). Objective, regularisation and column and row sampling are those of second-order
tree boosting (Chen and Guestrin, 2016) with squared error: a node of gradient
sum G over n rows has the weight -T(G) / (n + lambda) with T the soft threshold by
alpha, and splits are found from sums of gradients and counts by (model,
node, feature, bin). Rows are binned by their model's quantiles.

The model's measured size decides where its sums are made, not what they are:

- A model of ``TASK_ROWS`` rows or fewer is grown in one task, all such models side
  by side. The task gets binned rows; its arrays hold some 170 bytes for each (29 features).
- Larger models are grown level by level, all of them together: rows are packed
  into blocks of ``BLOCK_ROWS``, every task adds up its blocks' part, the parts meet in
  tasks by (model, node), and each node's best split is taken there, in one Spark job per level. The
  blocks are a persisted RDD of a record each: thousands of short jobs in a row, for
  which an RDD job's start takes a quarter of a DataFrame job's (measured on 8
  blocks of 2.4 MB: 0.06 and 0.24 s). Running predictions are brought up to date
  in the blocks every ``KEEP`` trees and checkpointed every ``CHECKPOINT``; in
  between a job adds the few newest trees by itself. What reaches the driver is a
  row per (model, tree, node).

Gradients are added in integers (units of 1 / ``UNITS``), and rows and columns are
drawn by hashes of the row and the model's name, so that neither the place nor the
partitioning nor the order of the sums changes a tree. (The quantiles are
approximate: their last digits may.)

The trees are a node table: (model, tree, node, feature, threshold, value, gain,
cover), children of node n being 2n + 1 (value below the threshold) and 2n + 2. It
is scored by native expressions (``score``), all models in one pass.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestline.session import checkpoint_dir, discard, ship, written

UNITS = 1 << 16
TASK_ROWS = 1_000_000
CELLS = 1 << 12  # of a joint sum of features
TAKEN_ROWS = 1 << 14  # added up at a time
BLOCK_ROWS = 25_000
KEEP = 4
CHECKPOINT = 48
ACCURACY = 10_000  # of the approximate quantiles
DIRECT_BYTES = 32 << 20  # sums that a task adds up before it hands them on; newest trees that a job carries
TASK_BYTES = 1 << 20  # a level's sums that one task takes splits from
BROADCAST_BYTES = 32 << 20
NODES = (
    "model string, tree int, node int, feature int, feature_name string, threshold double, value double, gain double, cover long"
)
PACKED = "model binary, bins binary, y binary, id binary, f binary"


@dataclass(frozen=True)
class Params:
    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    min_child_weight: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    gamma: float = 0.0
    max_bin: int = 64
    seed: int = 42


@dataclass
class Forest:
    """The trees of some models: ``nodes`` as above, ``bases`` (model, base), and the feature names."""

    nodes: DataFrame
    bases: DataFrame
    features: list[str]
    max_depth: int


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Rows:
    """A block of rows: model numbers, bins by feature, targets, ids and running predictions."""

    def __init__(self, row: tuple[bytes, ...], n_features: int):
        self.model = np.frombuffer(row[0], np.int32)
        self.bins = np.frombuffer(row[1], np.uint8).reshape(n_features, -1)
        self.y = np.frombuffer(row[2], np.float64)
        self.id = np.frombuffer(row[3], np.uint64)
        self.f = np.frombuffer(row[4], np.float64)

    def walked(self, feature: np.ndarray, cut: np.ndarray, steps: int) -> np.ndarray:
        """Each row's node after ``steps`` splits of its model's tree, or the leaf above."""
        n, base = len(self.model), self.model.astype(np.int64) * feature.shape[1]
        node, every, bins = np.zeros(n, np.int64), np.arange(n), self.bins.reshape(-1)
        feature, cut = feature.reshape(-1), cut.reshape(-1)
        for _ in range(steps):
            at = base + node
            f = feature.take(at)
            right = bins.take(np.maximum(f, 0).astype(np.int64) * n + every) > cut.take(at)
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return node

    def after(self, trees: list[tuple], depth: int) -> np.ndarray:
        """The running predictions with the trees that are not yet in them."""
        f = self.f
        for feature, cut, value in trees:
            f = f + value[self.model, self.walked(feature, cut, depth)]
        return f


def drawn_rows(ids: np.ndarray, tree: int, p: Params) -> np.ndarray:
    """Which rows a tree is grown on."""
    if p.subsample >= 1:
        return np.ones(len(ids), bool)
    key = np.uint64((p.seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 & ((1 << 64) - 1))
    return _mixed(ids ^ key) < np.uint64(min(int(p.subsample * 2.0**64), (1 << 64) - 1))


def drawn_columns(name: str, tree: int, n_features: int, p: Params) -> np.ndarray:
    """Which features a model's tree may use."""
    order = np.random.default_rng([p.seed, zlib.crc32(name.encode()), tree]).permutation(n_features)
    return order < max(1, int(p.colsample_bytree * n_features))


class Grown:
    """A tree each of some models, as arrays (model, node)."""

    def __init__(self, n_models: int, p: Params):
        shape = (n_models, (1 << (p.max_depth + 1)) - 1)
        self.feature, self.cut = np.full(shape, -1, np.int16), np.zeros(shape, np.uint8)
        self.value, self.gain = np.zeros(shape), np.zeros(shape)
        self.cover, self.exists = np.zeros(shape, np.int64), np.zeros(shape, bool)
        self.exists[:, 0] = True

    def split(self, got: np.ndarray, depth: int, p: Params) -> bool:
        """Apply the ``SPLIT`` records of a level; whether any node was split."""
        model, node = got["slot"] >> depth, (got["slot"] & ((1 << depth) - 1)) + (1 << depth) - 1
        if depth == 0:
            self.value[model, node], self.cover[model, node] = leaf_values(got["g"] / UNITS, got["h"], p), got["h"]
        at = got["feature"] >= 0
        got, model, node = got[at], model[at], node[at]
        self.feature[model, node], self.cut[model, node], self.gain[model, node] = got["feature"], got["cut"], got["gain"]
        lower = (got["left_g"], got["left_h"])
        for child, g, h in ((1, *lower), (2, got["g"] - lower[0], got["h"] - lower[1])):
            self.exists[model, 2 * node + child] = True
            self.value[model, 2 * node + child] = leaf_values(g / UNITS, h, p)
            self.cover[model, 2 * node + child] = h
        return bool(len(got))

    def rows(self, tree: int, names: Sequence[str], features: Sequence[str], cuts: Sequence) -> pa.RecordBatch:
        """Its rows of the node table."""
        model, node = np.nonzero(self.exists)
        feature, cut = self.feature[model, node], self.cut[model, node]
        split = feature >= 0
        where = list(zip(model.tolist(), feature.tolist(), cut.tolist()))
        columns = [
            pa.array([names[m] for m in model.tolist()], pa.string()),
            pa.array(np.full(len(model), tree, np.int32)),
            pa.array(node.astype(np.int32)),
            pa.array(feature.astype(np.int32), mask=~split),
            pa.array([features[f] if f >= 0 else None for f in feature.tolist()], pa.string()),
            pa.array([float(cuts[m][f][c]) if f >= 0 else None for m, f, c in where], pa.float64()),
            pa.array(self.value[model, node]),
            pa.array(self.gain[model, node], mask=~split),
            pa.array(self.cover[model, node]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in NODES.split(", ")])


def _thresholds(rows: DataFrame, features: Sequence[str], target: str, p: Params) -> list:
    """A row per model: name, number of rows, mean target, and each feature's cuts."""
    shares = F.array(*[F.lit(i / p.max_bin) for i in range(1, p.max_bin)])
    units = F.round(F.col(target) * UNITS).cast("long")
    cuts = [F.percentile_approx(F.col(c).cast("double"), shares, ACCURACY).alias(f"c{i}") for i, c in enumerate(features)]
    return (
        rows.groupBy("model")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(units).alias("total"), *cuts)
        .where("n > 0")
        .orderBy("model")
        .collect()
    )


def _binned(t: pa.Table, cuts: list, n_features: int) -> np.ndarray:
    """The bins (feature, row) of the rows of one model."""
    return np.stack([np.searchsorted(cuts[i], t.column(f"x{i}").to_numpy(), "right").astype(np.uint8) for i in range(n_features)])


def _flat(rows: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """(model, y, id, x0, x1 ...)"""
    return rows.select(
        "model",
        F.col(target).cast("double").alias("y"),
        F.xxhash64("model", target, *features).alias("id"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
    )


def _packed(flat: DataFrame, n_rows: int, n_features: int, names: list[str], cuts: list, bases: np.ndarray) -> DataFrame:
    """Blocks of binned rows, a row each."""
    number = {m: i for i, m in enumerate(names)}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        t = pa.Table.from_batches(parts)
        model = np.array([number[m] for m in t.column("model").to_pylist()], np.int32)
        bins = np.zeros((n_features, len(model)), np.uint8)
        for m in np.unique(model).tolist():
            at = np.flatnonzero(model == m)
            bins[:, at] = _binned(t.take(pa.array(at)), cuts[m], n_features)
        y, ids = t.column("y").to_numpy().astype(np.float64), t.column("id").to_numpy().view(np.uint64)
        out = [model, bins, y, ids, bases[model]]
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in out], names=["model", "bins", "y", "id", "f"])

    return flat.repartitionByRange(max(1, -(-n_rows // BLOCK_ROWS)), "model", "id").mapInArrow(pack, PACKED)


def split_scores(g: np.ndarray, h: np.ndarray, p: Params) -> np.ndarray:
    """T(G)^2 / (n + lambda): twice the loss that a node's weight takes away."""
    t = np.maximum(np.abs(g) - p.reg_alpha, 0.0)
    return t * t / np.maximum(h + p.reg_lambda, 1e-12)


def leaf_values(g: np.ndarray, h: np.ndarray, p: Params) -> np.ndarray:
    t = np.sign(g) * np.maximum(np.abs(g) - p.reg_alpha, 0.0)
    return p.learning_rate * t / np.maximum(h + p.reg_lambda, 1e-12)


# a node's split: feature (-1 if none gains), cut, gain, and the sums of the node and of its lower side
SPLIT = np.dtype([
    ("slot", "i8"), ("feature", "i4"), ("cut", "i4"), ("gain", "f8"), ("g", "i8"), ("h", "i8"), ("left_g", "i8"), ("left_h", "i8"),
])


def best_splits(slots: np.ndarray, g: np.ndarray, h: np.ndarray, columns: np.ndarray, p: Params) -> np.ndarray:
    """The best split of each slot from its sums (slot, feature, bin), as ``SPLIT`` records.

    ``columns`` tells which features the slot's model may use in this tree. Ties go to the
    first feature, then the lowest cut.
    """
    order = np.argsort(~columns.any(axis=0), kind="stable")  # a used feature, which has the node's totals, first
    left_g, left_h = np.cumsum(g[:, order], axis=2), np.cumsum(h[:, order], axis=2)
    all_g, all_h = left_g[:, 0, -1], left_h[:, 0, -1]
    right_g, right_h = all_g[:, None, None] - left_g, all_h[:, None, None] - left_h
    gain = 0.5 * (
        split_scores(left_g / UNITS, left_h, p)
        + split_scores(right_g / UNITS, right_h, p)
        - split_scores(all_g / UNITS, all_h, p)[:, None, None]
    )
    least = max(p.min_child_weight, 1)
    allowed = (left_h >= least) & (right_h >= least) & columns[:, order, None]
    gain = np.where(allowed, gain - p.gamma, -np.inf).reshape(len(slots), -1)
    best, top, every = gain.argmax(axis=1), gain.max(axis=1), np.arange(len(slots))
    f, c = np.divmod(best, g.shape[2])
    out = np.zeros(len(slots), SPLIT)
    found = top > 1e-6
    out["slot"], out["feature"], out["cut"] = slots, np.where(found, order[f], -1), c
    out["gain"], out["g"], out["h"] = np.where(found, top, 0.0), all_g, all_h
    out["left_g"], out["left_h"] = left_g[every, f, c], left_h[every, f, c]
    return out


def _level(
    blocks: RDD,
    tree: int,
    depth: int,
    grown: list[tuple],
    feature: np.ndarray,
    cut: np.ndarray,
    columns: np.ndarray,
    p: Params,
) -> np.ndarray:
    """One job: the best split of every open node at ``depth`` of tree ``tree`` of all models.

    A slot is a model and a node of the level.
    """
    width, n_features = 1 << depth, columns.shape[1]
    first = width - 1  # number of the level's first node
    used = np.flatnonzero(columns.any(axis=0))
    shape = (n_features, p.max_bin)
    slot_bytes = 2 * n_features * p.max_bin * 8

    def sums(records):
        """(slot, sums) of a partition's blocks, added up as far as ``DIRECT_BYTES`` hold them."""
        met: dict[int, np.ndarray] = {}
        for record in records:
            rows = Rows(record, n_features)
            node = rows.walked(feature, cut, depth)
            some = np.flatnonzero((node >= first) & drawn_rows(rows.id, tree, p))
            if not len(some):
                continue
            slots, at = np.unique(rows.model[some].astype(np.int64) * width + node[some] - first, return_inverse=True)
            residual = np.rint((rows.y - rows.after(grown, p.max_depth))[some] * UNITS)
            both = np.zeros((len(slots), 2, *shape), np.int64)
            size, base = len(slots) * p.max_bin, at * p.max_bin
            for f in used:
                key = base + rows.bins[f].take(some)
                # whole numbers in doubles: exact for a block's sums
                both[:, 0, f] = np.bincount(key, residual, size).reshape(-1, p.max_bin)
                both[:, 1, f] = np.bincount(key, minlength=size).reshape(-1, p.max_bin)
            for slot, x in zip(slots.tolist(), both):
                if slot in met:
                    met[slot] += x
                else:
                    met[slot] = x.copy()
            if len(met) * slot_bytes > DIRECT_BYTES:
                yield from met.items()
                met = {}
        yield from met.items()

    def split(parts) -> Iterator[np.ndarray]:
        met: dict[int, np.ndarray] = {}
        for slot, x in parts:
            met[slot] = met[slot] + x if slot in met else x
        if met:
            slots = np.array(sorted(met), np.int64)
            total = np.stack([met[s] for s in slots.tolist()])
            yield best_splits(slots, total[:, 0], total[:, 1], columns[slots // width], p)

    # sums meet in tasks, of which each holds some MB; the driver gets the splits alone
    tasks = min(len(columns) * width, -(-len(columns) * width * slot_bytes // TASK_BYTES))
    found = blocks.mapPartitions(sums).partitionBy(tasks, int).mapPartitions(split).collect()
    return np.concatenate([np.zeros(0, SPLIT), *found])


class Binned:
    """A model's binned rows, and their sums by (feature, bin) in some nodes.

    Features are added up several at a time, two of 64 bins as one of 4096: that takes as long as
    for one of them, and their joint sums hold each one's own. A joint sum has ``cells`` at most.
    """

    def __init__(self, bins: np.ndarray, cells: int, max_bin: int):
        self.bins, self.max_bin = bins, max_bin
        self.n_bins = bins.max(axis=1, initial=0).astype(np.int64) + 1
        self.groups: list[list[int]] = []
        for i in np.argsort(-self.n_bins, kind="stable").tolist():
            room = [s for s in self.groups if self.n_bins[[*s, i]].prod() <= min(cells, CELLS)]
            if room:
                room[0].append(i)
            else:
                self.groups.append([i])
        self.codes = np.empty((bins.shape[1], len(self.groups)), np.uint16)  # by row: a node's rows lie anywhere
        for j, s in enumerate(self.groups):
            code = np.zeros(bins.shape[1], np.uint16)
            for i in s:
                code = code * np.uint16(self.n_bins[i]) + bins[i]
            self.codes[:, j] = code

    def sums(self, nodes: list[np.ndarray], residual: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """The sums (node, gradient or count, feature, bin) of each node's rows."""
        out = np.zeros((len(nodes), 2, len(self.bins), self.max_bin), np.int64)
        groups = [(j, s, self.n_bins[s].tolist()) for j, s in enumerate(self.groups) if columns[s].any()]
        joint = [np.zeros((len(nodes), 2, int(np.prod(shape))), np.int64) for _, _, shape in groups]
        for k, rows in enumerate(nodes):
            for start in range(0, len(rows), TAKEN_ROWS):
                some = rows[start : start + TAKEN_ROWS]
                codes, weights = self.codes.take(some, axis=0), residual.take(some)
                for (j, _, _), x in zip(groups, joint):
                    key = codes[:, j].astype(np.intp)
                    # whole numbers in doubles: exact for the sums of so many rows
                    x[k, 0] += np.bincount(key, weights, x.shape[2]).astype(np.int64)
                    x[k, 1] += np.bincount(key, minlength=x.shape[2])
        for (_, s, shape), x in zip(groups, joint):
            x = x.reshape(len(nodes), 2, *shape)
            for at, i in enumerate(s, 2):
                others = tuple(a for a in range(2, x.ndim) if a != at)
                out[:, :, i, : x.shape[at]] = x.sum(axis=others) if others else x
        return out


def _grown_in_task(name: str, bins: np.ndarray, y: np.ndarray, ids: np.ndarray, base: float, p: Params) -> Iterator[Grown]:
    """The trees of one model whose rows are at hand.

    Of two siblings the one with fewer rows is added up; the other's sums are their parent's without them.
    """
    n_features, n = bins.shape
    binned = Binned(bins, n >> max(0, p.max_depth - 1), p.max_bin)  # no more cells than a deep node may have rows
    f = np.full(n, base)
    for tree in range(p.n_estimators):
        columns = drawn_columns(name, tree, n_features, p)
        used, drawn = np.flatnonzero(columns), drawn_rows(ids, tree, p)
        residual = np.rint((y - f) * UNITS)
        grown, sums = Grown(1, p), {}
        # the rows of each open node and leaf: those that the tree is grown on, and the others
        on, off = {0: np.flatnonzero(drawn)}, {0: np.flatnonzero(~drawn)}
        level = [0] if len(on[0]) else []
        for depth in range(p.max_depth):
            if not level:
                break
            first, parents = (1 << depth) - 1, sums
            fewer = [min(pair, key=lambda i: len(on[i])) for pair in zip(level[::2], level[1::2])] or level
            sums = dict(zip(fewer, binned.sums([on[i] for i in fewer], residual, columns)[:, :, used]))
            for i in level:
                if i not in sums:
                    sums[i] = parents[(i - 1) // 2] - sums[i + 1 if i % 2 else i - 1]
            total = np.stack([sums[i] for i in level])
            got = best_splits(np.array(level) - first, total[:, 0], total[:, 1], np.ones((len(level), len(used)), bool), p)
            got = got[got["feature"] >= 0] if depth else got
            got["feature"] = np.where(got["feature"] >= 0, used[got["feature"]], -1)
            grown.split(got, depth, p)
            level = []
            for slot, feature, cut in got[got["feature"] >= 0][["slot", "feature", "cut"]].tolist():
                node = slot + first
                for parts in (on, off):
                    rows = parts.pop(node)
                    right = bins[feature].take(rows) > cut
                    parts[2 * node + 1], parts[2 * node + 2] = rows.compress(~right), rows.compress(right)
                level += [2 * node + 1, 2 * node + 2]
        for parts in (on, off):
            for node, rows in parts.items():
                f[rows] += grown.value[0, node]
        yield grown


def _by_model(flat: DataFrame, n_features: int, names: list[str], cuts: list) -> DataFrame:
    """Binned rows of models, a row for each model and batch."""
    number = {m: i for i, m in enumerate(names)}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            model = np.array([number[m] for m in t.column("model").to_pylist()], np.int32)
            for m in np.unique(model).tolist():
                mine = t.take(pa.array(np.flatnonzero(model == m)))
                y, ids = mine.column("y").to_numpy().astype(np.float64), mine.column("id").to_numpy()
                out = [pa.array([a.tobytes()], pa.binary()) for a in (_binned(mine, cuts[m], n_features), y, ids)]
                yield pa.RecordBatch.from_arrays([pa.array([names[m]]), *out], names=["model", "bins", "y", "id"])

    return flat.mapInArrow(pack, "model string, bins binary, y binary, id binary")


def _small_models(binned: DataFrame, features: list[str], names: list[str], cuts: list, bases: np.ndarray, p: Params) -> DataFrame:
    """The node table of models of bounded size, a model per task."""
    number = {m: i for i, m in enumerate(names)}

    def grow(t: pa.Table) -> pa.Table:
        name = t.column("model")[0].as_py()
        m = number[name]
        bins, y, ids = ([x.as_buffer() for x in t.column(c)] for c in ("bins", "y", "id"))
        bins = np.concatenate([np.frombuffer(x, np.uint8).reshape(len(features), -1) for x in bins], axis=1)
        y, ids = (np.concatenate([np.frombuffer(x, kind) for x in parts]) for parts, kind in ((y, np.float64), (ids, np.uint64)))
        trees = _grown_in_task(name, bins, y, ids, float(bases[m]), p)
        return pa.Table.from_batches([g.rows(i, [name], features, [cuts[m]]) for i, g in enumerate(trees)])

    return binned.repartitionByRange(len(names), "model").groupBy("model").applyInArrow(grow, NODES)


def _large_models(
    flat: DataFrame, n_rows: int, features: list[str], names: list[str], cuts: list, bases: np.ndarray, p: Params
) -> DataFrame:
    """The node table of models of any size, a job per level of all of them."""
    spark = flat.sparkSession
    table = written(_packed(flat, n_rows, len(features), names, cuts, bases), "blocks")
    checkpoint_dir(spark)
    blocks = table.rdd.map(lambda r: tuple(bytes(x) for x in r)).persist(StorageLevel.MEMORY_AND_DISK)
    blocks.count()
    keep = max(1, min(KEEP, DIRECT_BYTES // (len(names) * (11 << (p.max_depth + 1)))))
    newest, out = [], []
    for tree in range(p.n_estimators):
        columns = np.stack([drawn_columns(m, tree, len(features), p) for m in names])
        grown = Grown(len(names), p)
        for depth in range(p.max_depth):
            got = _level(blocks, tree, depth, newest, grown.feature, grown.cut, columns, p)
            if not len(got) or not grown.split(got, depth, p):
                break
        newest.append((grown.feature, grown.cut, grown.value))
        out.append(grown.rows(tree, names, features, cuts))
        if len(newest) == keep and tree + 1 < p.n_estimators:
            blocks, newest = _brought_up(blocks, newest, p, len(features), (tree + 1) % CHECKPOINT < keep), []
    blocks.unpersist()
    discard(table)
    return spark.createDataFrame(pa.Table.from_batches(out)).selectExpr(
        *[f"cast({c.split()[0]} as {c.split()[1]})" for c in NODES.split(", ")]
    )


def fit(rows: DataFrame, features: Sequence[str], target: str, params: Params) -> Forest:
    """Fit one model per value of ``model`` on its rows; features and target are not null."""
    spark, p, features = rows.sparkSession, params, list(features)
    ship(spark)
    found = _thresholds(rows, features, target, p)
    bases = [(r["model"], r["total"] / UNITS / r["n"]) for r in found]
    forest = Forest(spark.createDataFrame([], NODES), spark.createDataFrame(bases, "model string, base double"), features, p.max_depth)
    flat, parts, binned = _flat(rows, features, target), [], []
    for large in (False, True):
        chosen = [r for r in found if (r["n"] > TASK_ROWS) == large]
        if not chosen:
            continue
        names = [r["model"] for r in chosen]
        cuts = [[np.unique(np.array(r[f"c{i}"], float)) for i in range(len(features))] for r in chosen]
        base = np.array([b for m, b in bases if m in set(names)])
        mine = flat.where(F.col("model").isin(names))
        if large:
            parts.append(_large_models(mine, sum(r["n"] for r in chosen), features, names, cuts, base, p))
        else:
            # written, as it is read twice: for the range of each task, and by the tasks
            binned.append(written(_by_model(mine, len(features), names, cuts), "binned"))
            parts.append(_small_models(binned[0], features, names, cuts, base, p))
    if parts:
        forest.nodes = written(parts[0] if len(parts) == 1 else parts[0].union(parts[1]), "nodes")
    discard(*binned)
    return forest


def _brought_up(blocks: RDD, grown: list[tuple], p: Params, n_features: int, checkpoint: bool) -> RDD:
    """The blocks with the newest trees in their running predictions."""

    def add(record: tuple[bytes, ...]) -> tuple[bytes, ...]:
        return (*record[:4], Rows(record, n_features).after(grown, p.max_depth).tobytes())

    new = blocks.map(add).persist(StorageLevel.MEMORY_AND_DISK)
    if checkpoint:
        new.checkpoint()
    new.count()
    blocks.unpersist()
    return new


# Scoring


def packed_models(forest: Forest) -> DataFrame:
    """(model, base, feature, threshold, below, value, roots): a model's trees as arrays over its nodes.

    ``below`` is the place of a node's lower child; the other child is next to it.
    """
    at = F.row_number().over(Window.partitionBy("model").orderBy("tree", "node")) - 1
    placed = forest.nodes.select("model", "tree", "node", "feature", "threshold", "value", at.alias("at"))
    child = placed.where(F.col("node") % 2 == 1).select(
        "model", "tree", F.expr("(node - 1) div 2").cast("int").alias("node"), F.col("at").alias("below")
    )
    linked = placed.join(child, ["model", "tree", "node"], "left")
    rows = F.array_sort(F.collect_list(F.struct("at", "node", "feature", "threshold", "below", "value"))).alias("n")
    packed = linked.groupBy("model").agg(rows)
    return packed.join(forest.bases, "model").select(
        "model",
        "base",
        *[F.col(f"n.{c}").alias(c) for c in ("feature", "threshold", "below", "value")],
        F.transform(F.filter("n", lambda x: x["node"] == 0), lambda x: x["at"]).alias("roots"),
    )


def _prediction(x: Column, depth: int) -> Column:
    feature, threshold, below, value = (F.col(f"_m.{c}") for c in ("feature", "threshold", "below", "value"))

    def step(node: Column, _: Column) -> Column:
        right = F.when(F.get(x, F.get(feature, node)) < F.get(threshold, node), 0).otherwise(1)
        return F.coalesce(F.get(below, node) + right, node)  # a leaf has nothing below it

    def leaf(root: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), root, step)

    total = F.aggregate(F.col("_m.roots"), F.col("_m.base"), lambda sum_, root: sum_ + F.get(value, leaf(root)))
    complete = ~F.exists(x, lambda v: v.isNull())
    return F.when(complete, total)


def score(df: DataFrame, forest: Forest, model: Column, prediction: str = "prediction") -> DataFrame:
    """``df`` with the prediction of the model that the column ``model`` names; null without one or with null features.

    The models come in one join, broadcast when the node table's size allows it.
    """
    trees = packed_models(forest)
    trees = trees.select(F.col("model").alias("_model"), F.struct(*[c for c in trees.columns if c != "model"]).alias("_m"))
    if forest.nodes.count() * 32 <= BROADCAST_BYTES:
        trees = F.broadcast(trees)
    # the features' array is a column, made once a row and not in every step of a tree
    x = F.array(*[F.col(c).cast("double") for c in forest.features])
    joined = df.withColumns({"_key": model, "_x": x}).join(trees, F.col("_key") == F.col("_model"), "left")
    return joined.withColumn(prediction, _prediction(F.col("_x"), forest.max_depth)).drop("_key", "_x", "_model", "_m")


def importances(forest: Forest, top: int | None = 10) -> DataFrame:
    """(feature, importance): mean gain of a feature's splits, as shares of one, largest first."""
    spark = forest.nodes.sparkSession
    names = spark.createDataFrame([(n,) for n in forest.features], "feature string")
    gains = (
        forest.nodes.where("feature_name is not null")
        .groupBy(F.col("feature_name").alias("feature"))
        .agg(F.round(F.avg("gain"), 6).alias("gain"))
    )
    total = gains.agg(F.nullif(F.sum("gain"), F.lit(0.0))).scalar()
    shares = names.join(gains, "feature", "left")
    share = F.coalesce(F.col("gain") / total, F.lit(0.0))
    out = shares.select("feature", F.round(share, 6).alias("importance")).orderBy(F.desc("importance"), "feature")
    return out.limit(top) if top else out
