"""Grouped boosting against a naive computation, and saved models."""

import datetime as dt
import pickle

import numpy as np
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from harvestline.operators import boosting, models, registry
from harvestline.session import checkpoint_dir

P = boosting.Params(
    n_estimators=4, max_depth=3, learning_rate=0.3, min_child_weight=4, reg_alpha=0.5, reg_lambda=2.0, gamma=0.1, max_bin=16
)
FEATURES = ["a", "b", "c"]


def data(n=600, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        a, b, c = float(rng.integers(0, 12)), round(float(rng.normal()), 2), float(rng.integers(0, 2))
        m = "xyz"[i % 3]
        y = 10 * (a > 5) + (4 if m == "x" else -4) * c + b + 100 * (m == "z")
        out.append((m, a, b, c, round(y, 3)))
    return out


SCHEMA = "model string, a double, b double, c double, y double"


def naive(rows, p, cuts):
    """{(tree, node): (feature, threshold, value)} of one model, by recursion over lists of rows."""
    y = np.array([r[4] for r in rows])
    x = np.array([r[1:4] for r in rows])
    units = boosting.UNITS
    f = np.full(len(y), np.round(y * units).sum() / units / len(y))
    out = {}

    def weight(g, h):
        return np.sign(g) * max(abs(g) - p.reg_alpha, 0) / (h + p.reg_lambda)

    def loss(g, h):
        return max(abs(g) - p.reg_alpha, 0) ** 2 / (h + p.reg_lambda)

    for tree in range(p.n_estimators):
        r = np.rint((y - f) * units)
        step = np.zeros(len(y))

        def grow(node, at, depth):
            g, h = r[at].sum() / units, len(at)
            best = (1e-6, None)
            if depth < p.max_depth:
                for i in range(3):
                    for c in cuts[i]:
                        low = at[x[at, i] < c]
                        high = at[x[at, i] >= c]
                        if min(len(low), len(high)) < p.min_child_weight:
                            continue
                        gl, gh = r[low].sum() / units, r[high].sum() / units
                        gain = 0.5 * (loss(gl, len(low)) + loss(gh, len(high)) - loss(g, h)) - p.gamma
                        if gain > best[0]:
                            best = (gain, (i, c, low, high))
            if best[1] is None:
                step[at] = p.learning_rate * weight(g, h)
                out[tree, node] = (None, None, p.learning_rate * weight(g, h))
                return
            i, c, low, high = best[1]
            out[tree, node] = (i, c, None)
            grow(2 * node + 1, low, depth + 1)
            grow(2 * node + 2, high, depth + 1)

        grow(0, np.arange(len(y)), 0)
        f = f + step
    return out, f


@pytest.fixture(scope="module")
def fitted(spark):
    df = spark.createDataFrame(data(), SCHEMA)
    return df, boosting.fit(df, FEATURES, "y", P)


def cuts_of(spark, df, model):
    (row,) = [r for r in boosting._thresholds(df, FEATURES, "y", P) if r["model"] == model]
    return [sorted(set(row[f"c{i}"])) for i in range(3)]


@pytest.mark.parametrize("model", ["x", "y", "z"])
def test_trees_equal_a_naive_computation(spark, fitted, model):
    df, forest = fitted
    want, f = naive([r for r in data() if r[0] == model], P, cuts_of(spark, df, model))
    got = {(n.tree, n.node): n for n in forest.nodes.where(F.col("model") == model).collect()}
    assert set(got) == set(want)
    for k, (feature, threshold, value) in want.items():
        assert (got[k].feature, got[k].threshold) == (feature, threshold), k
        if feature is None:
            assert got[k].value == pytest.approx(value, abs=1e-9)


def walk(nodes, bases, model, x):
    total = bases[model]
    for tree in range(P.n_estimators):
        n = nodes[model, tree, 0]
        while n.feature is not None:
            n = nodes[model, tree, 2 * n.node + (1 if x[n.feature] < n.threshold else 2)]
        total += n.value
    return total


def test_scores_in_one_pass_equal_a_walk_over_the_nodes(spark, fitted):
    df, forest = fitted
    nodes = {(n.model, n.tree, n.node): n for n in forest.nodes.collect()}
    bases = {r.model: r.base for r in forest.bases.collect()}
    asked = df.union(spark.createDataFrame([("x", None, 1.0, 1.0, 0.0), ("none", 1.0, 1.0, 1.0, 0.0), (None, 1.0, 1.0, 1.0, 0.0)], SCHEMA))
    scored = boosting.score(asked, forest, F.col("model"))
    for r in scored.collect():
        if r.model not in bases or r.a is None:
            assert r.prediction is None
        else:
            assert r.prediction == walk(nodes, bases, r.model, (r.a, r.b, r.c))


def test_partitioning_and_merging_change_nothing(spark, fitted, monkeypatch):
    """Models grown in a task each; level by level; with small blocks, predictions brought up
    every tree and sums merged in tasks: the same trees."""
    df, _ = fitted
    p = boosting.Params(n_estimators=5, max_depth=3, subsample=0.7, colsample_bytree=0.7, min_child_weight=2, max_bin=16)
    columns = ["model", "tree", "node", "feature", "threshold", "value", "gain", "cover"]
    one = boosting.fit(df, FEATURES, "y", p).nodes.orderBy("model", "tree", "node").select(*columns).collect()
    monkeypatch.setattr(boosting, "TASK_ROWS", 0)
    together = boosting.fit(df, FEATURES, "y", p).nodes.orderBy("model", "tree", "node").select(*columns).collect()
    assert one == together
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 90)
    monkeypatch.setattr(boosting, "KEEP", 1)
    monkeypatch.setattr(boosting, "DIRECT_BYTES", 1)
    other = boosting.fit(df.repartition(5), FEATURES, "y", p).nodes.orderBy("model", "tree", "node").select(*columns).collect()
    assert one == other and len(one) > 30


def test_features_added_up_together_give_the_same_trees(spark, monkeypatch):
    """Joint sums of several features, and siblings' sums by subtraction: the trees grown level by level."""
    df = spark.createDataFrame(data(9000), SCHEMA)
    p = boosting.Params(n_estimators=4, max_depth=4, subsample=0.8, colsample_bytree=0.7, min_child_weight=2, max_bin=16)
    columns = ["model", "tree", "node", "feature", "threshold", "value", "gain", "cover"]
    together = boosting.fit(df, FEATURES, "y", p).nodes.orderBy("model", "tree", "node").select(*columns).collect()
    assert len(boosting.Binned(np.array([[0, 11], [3, 15], [1, 0]], np.uint8), 3000 >> 3, 16).groups) == 2
    monkeypatch.setattr(boosting, "TASK_ROWS", 0)
    levels = boosting.fit(df, FEATURES, "y", p).nodes.orderBy("model", "tree", "node").select(*columns).collect()
    assert together == levels and len(levels) > 100


def test_a_tree_adds_up_each_row_a_few_times(monkeypatch):
    """Of two siblings the smaller is added up, and features are added up together: fewer than half
    of a sum and a count per row, feature and level."""
    rng = np.random.default_rng(5)
    n, n_features, p = 4000, 6, boosting.Params(n_estimators=3, max_depth=4, max_bin=16, min_child_weight=2)
    bins = rng.integers(0, 16, (n_features, n)).astype(np.uint8)
    y = bins[0] * 3.0 + (bins[1] > 7) * bins[2] + rng.normal(size=n)
    added, bincount = [0], np.bincount

    def counted(x, *args, **kwargs):
        added[0] += len(x)
        return bincount(x, *args, **kwargs)

    monkeypatch.setattr(np, "bincount", counted)
    trees = list(boosting._grown_in_task("m", bins, y, np.arange(n).astype(np.uint64), float(y.mean()), p))
    assert min(int(t.exists.sum()) for t in trees) > 15
    assert added[0] <= 0.45 * 2 * p.n_estimators * p.max_depth * n_features * n


def test_the_global_model_of_a_larger_table_needs_no_job_per_level(spark, monkeypatch):
    """As many rows as the global model has at sf0.1: 500 trees in a job per level took over ten minutes."""
    n = 318_499
    df = spark.range(n).selectExpr("'global' as model", "cast(id % 97 as double) as a", "cast(id % 31 as double) as b", "double(id % 7) as c")
    df = df.selectExpr("*", "a * 2 + b as y")
    monkeypatch.setattr(boosting, "_large_models", None)
    nodes = boosting.fit(df, FEATURES, "y", boosting.Params(n_estimators=2, max_depth=2)).nodes.collect()
    assert {r.cover for r in nodes if r.node == 0} == {n} and len(nodes) == 14


def test_the_driver_gets_splits_and_no_sums(spark, fitted, monkeypatch):
    """What a level sends to the driver is a record per open node, however many blocks there are."""
    df, _ = fitted
    p = boosting.Params(n_estimators=2, max_depth=3, min_child_weight=2, max_bin=16)
    sent = []
    collect = RDD.collect

    def counted(rdd):
        got = collect(rdd)
        sent.append(len(pickle.dumps(got)))
        return got

    monkeypatch.setattr(boosting, "TASK_ROWS", 0)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 30)
    monkeypatch.setattr(RDD, "collect", counted)
    boosting.fit(df, FEATURES, "y", p)
    levels = [s for s in sent if s > 100]
    # 3 models of at most 4 nodes; a node's sums would be 3 features of 16 bins of 16 bytes
    assert len(levels) >= 6 and max(levels) <= 12 * boosting.SPLIT.itemsize + 2000


def test_importances_are_shares_of_the_mean_gain(spark, fitted):
    _, forest = fitted
    got = {r.feature: r.importance for r in boosting.importances(forest, None).collect()}
    assert set(got) == set(FEATURES) and sum(got.values()) == pytest.approx(1, abs=1e-5)
    gains = {}
    for n in forest.nodes.where("feature is not null").collect():
        gains.setdefault(n.feature_name, []).append(n.gain)
    means = {k: np.mean(v) for k, v in gains.items()}
    for k, v in means.items():
        assert got[k] == pytest.approx(v / sum(means.values()), abs=1e-5)


def test_a_model_without_rows_or_splits(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert boosting.fit(none, FEATURES, "y", P).nodes.count() == 0
    flat = spark.createDataFrame([("x", 1.0, 2.0, 3.0, 7.5)] * 20, SCHEMA)
    forest = boosting.fit(flat, FEATURES, "y", P)
    assert {r.prediction for r in boosting.score(flat, forest, F.col("model")).collect()} == {7.5}


def test_saved_models_forecast_the_same(spark, fitted):
    df, forest = fitted
    results = spark.createDataFrame(
        [("x", 7, 1.0, 1.0, 5.0, 1.0, 10.0, 50.0, 10, 5), ("y", 7, 1.0, 1.0, 9.0, 1.0, 10.0, 10.0, 10, 5)],
        "commodity string, horizon int, model_mae double, model_rmse double, model_mape double, naive_mae double, "
        "naive_mape double, mape_improvement_pct double, train_size long, test_size long",
    )
    named = boosting.Forest(
        forest.nodes.withColumn("model", F.concat(F.lit("7d:"), "model")),
        forest.bases.withColumn("model", F.concat(F.lit("7d:"), "model")),
        forest.features,
        forest.max_depth,
    )
    path = f"{checkpoint_dir(spark)}/registry-{dt.datetime.now().timestamp()}"
    version = registry.save(named, results, path, dt.datetime(2024, 1, 1))
    rows = {r.model: r for r in registry.entries(spark, path).collect()}
    assert set(rows) == {"7d:x", "7d:y"} and rows["7d:x"].is_best and not rows["7d:y"].is_best
    assert all(version in r.path for r in rows.values())
    asked = df.withColumn("key", models.model_key("model", F.lit(7)))
    before = boosting.score(asked, named, F.col("key")).where("model in ('x', 'y')")
    after = boosting.score(asked, registry.load(spark, path), F.col("key")).where("prediction is not null")
    order = ["model", "a", "b", "c", "y", "prediction"]
    assert sorted(map(tuple, before.select(*order).collect())) == sorted(map(tuple, after.select(*order).collect()))
    best = registry.load(spark, path, where=F.col("is_best"))
    assert {r.model for r in best.nodes.select("model").distinct().collect()} == {"7d:x"}
    with pytest.raises(LookupError):
        registry.load(spark, path, where=F.col("horizon") == 30)
