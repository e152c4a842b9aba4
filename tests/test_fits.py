"""M2 trees as tasks, M8 seasonal fits of many series, F16 noise."""

import datetime as dt
import math
import struct
import tempfile

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from credtrail.operators import forest, isoforest, risk
from credtrail.operators.forecast import forecast, seasonal_coefficients
from credtrail.sources import io


def tree_by_hand(x, y, w, edges, depth):
    """Predictions of a regression tree grown by trying every cut."""
    def mean(rows):
        return float((w[rows] * y[rows]).sum() / w[rows].sum())

    def grow(rows, left):
        best = (1e-9 * max(1.0, float(((y - y.mean()) ** 2).sum())), None)
        all_s, all_w = (w[rows] * (y[rows] - y.mean())).sum(), w[rows].sum()
        for f in range(x.shape[1]):
            for cut in edges[f]:
                a = rows[x[rows, f] <= cut]
                b = rows[x[rows, f] > cut]
                if len(a) and len(b):
                    s = (w[a] * (y[a] - y.mean())).sum()
                    gain = s * s / w[a].sum() + (all_s - s) ** 2 / w[b].sum() - all_s ** 2 / all_w
                    if gain > best[0] + 1e-12:
                        best = (gain, (f, cut, a, b))
        if not left or best[1] is None:
            return mean(rows)
        f, cut, a, b = best[1]
        return (f, cut, grow(a, left - 1), grow(b, left - 1))

    def at(node, row):
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node

    root = grow(np.flatnonzero(w), depth)
    return np.array([at(root, row) for row in x])


@pytest.mark.parametrize("depth", [1, 3])
def test_a_tree_is_the_one_that_trying_every_cut_gives(depth):
    r = np.random.default_rng(depth)
    x = np.round(r.normal(size=(60, 3)), 1)
    y = 3 * x[:, 0] + np.where(x[:, 1] > 0, 5, 0) + r.normal(size=60)
    edges = forest.bin_edges(x, 256)
    tree = forest.grow_tree(forest.binned(x, edges), y, edges, [7, 0], depth)
    model = forest.ForestModel(["a", "b", "c"], np.array([0]), *[tree[c] for c in ("feature", "threshold", "left", "right", "value")])
    w = np.bincount(np.random.default_rng([7, 0]).integers(60, size=60), minlength=60).astype(float)
    hand = tree_by_hand(x, y, w, edges, depth)
    got = model.predict(x)
    own = np.flatnonzero(w)
    # equally good cuts may differ, so the errors are compared
    assert (w[own] * (got[own] - y[own]) ** 2).sum() == pytest.approx((w[own] * (hand[own] - y[own]) ** 2).sum(), rel=1e-6)


def synthetic(spark, n=1500):
    r = np.random.default_rng(1)
    x = r.random((n, len(risk.FEATURES)))
    rows = [(f"V{i:05d}", *map(float, v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "vendor_id string, " + ", ".join(f"{c} double" for c in risk.FEATURES))


def test_error_is_that_of_the_library(spark):
    feats = synthetic(spark)  # 100 trees: with 40 the error of either learner varies by 2 % with the seed
    errors = {m: risk.held_out_mse(risk.train_risk_model(feats, num_trees=100, max_depth=6, method=m)[1]).first()["mse"]
              for m in ("tasks", "distributed")}
    assert errors["tasks"] <= 1.02 * errors["distributed"], errors


def test_forest_is_the_same_however_rows_arrive_and_can_be_saved(spark):
    feats = synthetic(spark, 200)
    scores = []
    for parts in (1, 5):
        model, scored = risk.train_risk_model(feats.repartition(parts), num_trees=5, method="tasks")
        scores.append({r.vendor_id: r.prediction for r in scored.collect()})
    assert scores[0] == scores[1]
    path = tempfile.mkdtemp(prefix="credtrail-forest-") + "/model"
    io.save_model(model, path)
    again = io.load_model(path)
    assert {r.vendor_id: r.prediction for r in again.transform(feats).collect()} == scores[0]
    assert risk.score_vendors(feats, again).filter("risk_category is null").count() == 0


def test_a_tree_is_the_same_in_parts_of_a_level(monkeypatch):
    r = np.random.default_rng(5)
    x = np.round(r.normal(size=(3000, 4)), 2)
    y = 3 * x[:, 0] + r.normal(size=3000)
    edges = forest.bin_edges(x, 256)
    trees = []
    for chunk, small in ((4_000_000, forest.SMALL), (5000, forest.SMALL), (4_000_000, ()), (5000, ())):
        monkeypatch.setattr(forest, "CHUNK", chunk)
        monkeypatch.setattr(forest, "SMALL", small, raising=False)
        trees.append(forest.grow_tree(forest.binned(x, edges), y, edges, [7, 0], 30))
    assert len(trees[0]["feature"]) > 2000
    for tree in trees[1:]:
        assert all(np.array_equal(tree[c], trees[0][c]) for c in tree)


def test_a_forest_too_large_for_memory_is_written_and_scores_alike(spark, monkeypatch):
    feats = synthetic(spark, 300)
    held = {r.vendor_id: r.prediction for r in risk.train_risk_model(feats, num_trees=7)[1].collect()}
    monkeypatch.setattr(forest, "MAX_NODES", 1000)
    monkeypatch.setattr(forest, "BLOCK", 128, raising=False)
    model, scored = risk.train_risk_model(feats, num_trees=7)
    assert isinstance(model, forest.WrittenForest)
    assert {r.vendor_id: r.prediction for r in scored.collect()} == held
    path = tempfile.mkdtemp(prefix="credtrail-forest-") + "/model"
    io.save_model(model, path)
    again = io.load_model(path)
    assert {r.vendor_id: r.prediction for r in again.transform(feats).collect()} == held


def test_isolation_scores_are_those_of_a_walk_from_the_root(spark):
    r = np.random.default_rng(2)
    frame = spark.createDataFrame([(i, float(a), float(b) if i % 9 else None) for i, (a, b) in enumerate(r.lognormal(size=(700, 2)))],
                                  "id long, a double, b double")
    model = isoforest.IsolationForest(trees=11, sample_size=64, features=["a", "b"]).fit(frame)
    trees = {t: {n.node: n for n in own.itertuples()} for t, own in model.nodes.groupby("tree")}

    def length(tree, x):
        at, depth = tree[0], 0
        while at.feature >= 0:
            at, depth = tree[at.left if x[at.feature] < at.threshold else at.right], depth + 1
        return depth + isoforest.average_path_length([at.size])[0]

    c = isoforest.average_path_length([model.sample_size])[0]
    for row in model.score(frame).collect():
        x = [((v or 0.0) - m) / s for v, m, s in zip((row.a, row.b), model.means, model.stds, strict=True)]
        mean = np.mean([length(tree, x) for tree in trees.values()])
        assert row._score_samples == pytest.approx(-2.0 ** (-mean / c), rel=1e-12)
    assert [len(t) for t in isoforest._stepping(*model._arrays())] == [5] * 11


def test_forest_limits(spark):
    assert forest.fits(1000, 16, 100) and not forest.fits(10 ** 7, 16, 100) and not forest.fits(10 ** 5, 16, 100)
    one = synthetic(spark, 1)
    assert forest.train_forest(one.withColumn("y", F.lit(3.5)), risk.FEATURES, "y", num_trees=2).predict(np.zeros((2, 16))).tolist() == [3.5, 3.5]
    with pytest.raises(ValueError):
        forest.train_forest(one.limit(0).withColumn("y", F.lit(1.0)), risk.FEATURES, "y")


# --- isolation trees --------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(3))
def test_isolation_trees_split_their_sample_as_their_nodes_say(seed):
    from credtrail.operators.isoforest import _grow, average_path_length
    r = np.random.default_rng(seed)
    x = np.round(r.normal(size=(200, 3)), 1)
    x[50:90] = x[50]
    nodes = {n[0]: n for n in _grow(x, np.random.default_rng([seed, 1]), 8)}
    seen, depth_of = set(), np.zeros(len(x))

    def walk(node, rows, depth):
        _, feature, threshold, left, right, size = nodes[node]
        seen.add(node)
        assert size == len(rows)
        own = x[rows]
        if feature < 0:
            assert depth == 8 or len(rows) <= 1 or (own == own[0]).all()
            depth_of[rows] = depth + average_path_length([len(rows)])[0]
            return
        assert own[:, feature].min() <= threshold <= own[:, feature].max() and own[:, feature].min() < own[:, feature].max()
        goes = own[:, feature] < threshold
        walk(left, rows[goes], depth + 1)
        walk(right, rows[~goes], depth + 1)

    walk(0, np.arange(len(x)), 0)
    assert seen == set(nodes)
    # c(n), with H(n - 1) = ln(n - 1) + gamma, is about the mean depth of a random search tree's outer nodes
    for n in (10, 256):
        exact = 2 * sum(1 / k for k in range(1, n)) - 2 * (n - 1) / n
        assert average_path_length([n])[0] == pytest.approx(exact, rel=0.04)
    # rows that stand alone are isolated sooner than the copies
    assert depth_of[50:90].min() == depth_of[50:90].max()


# --- seasonal fits ----------------------------------------------------------------------------

def fit_by_hand(points, order=3, ridge=1e-3):
    ds, y = [p[0] for p in points], np.array([p[1] for p in points])
    first = min(ds)
    wave = np.array([2 * math.pi * d.timetuple().tm_yday / 365.25 for d in ds])
    cols = [np.ones(len(ds)), np.array([(d - first).days / 365.25 for d in ds])]
    for k in range(1, order + 1):
        cols += [np.sin(k * wave), np.cos(k * wave)]
    x = np.column_stack(cols)
    beta = np.linalg.solve(x.T @ x + ridge * np.eye(x.shape[1]), x.T @ y)
    rest = y - x @ beta
    return beta, x @ beta, math.sqrt((rest ** 2).sum() / max(len(y) - x.shape[1], 1))


def test_seasonal_fits_of_many_series(spark):
    r = np.random.default_rng(3)
    points = {f"s{k}": [(dt.date(2015 + m // 12, m % 12 + 1, 1), float(100 * k + m + 10 * math.sin(m) + r.normal())) for m in range(2 + 5 * k)]
              for k in range(12)}
    points[None] = [(dt.date(2020, 1, 1), 5.0)]
    rows = [(s, d, y) for s, own in points.items() for d, y in own]
    hist = spark.createDataFrame(rows, "s string, ds date, y double").repartition(4)
    fits = {r.s: r for r in seasonal_coefficients(hist, ["s"]).collect()}
    labels = hist.select("s", F.date_format("ds", "yyyy-MM").alias("p"), "y")
    out = forecast(labels, ["s"], "p", "y", horizon=3, method="seasonal").collect()
    for s, own in points.items():
        beta, fitted, se = fit_by_hand(sorted(own))
        scale = max(abs(y) for _, y in own)
        assert np.allclose(fits[s].beta, beta, atol=1e-8 * scale) and fits[s].periods == len(own)
        mine = sorted((x for x in out if x.s == s), key=lambda x: x.ds)
        assert len(mine) == len(own) + 3
        assert np.allclose([x.yhat for x in mine[:len(own)]], fitted, atol=1e-8 * scale)
        assert mine[0].yhat_upper - mine[0].yhat == pytest.approx(1.2815515655446004 * se, abs=1e-6 * scale)


def test_seasonal_periods_with_two_labels_get_one_future(spark):
    df = spark.createDataFrame([("2023-Q1", 1.0), ("2023Q1", 2.0), ("2023-Q2", 3.0), ("2023Q2", 4.0)], "p string, y double")
    out = forecast(df, [], "p", "y", horizon=2, method="seasonal")
    assert out.count() == 6 and forecast(df.limit(0), [], "p", "y", method="seasonal", freq="Q").count() == 0


# --- noise ------------------------------------------------------------------------------------

def test_noise_is_box_muller_of_two_hashes(spark):
    ids = [f"V{i:07d}" for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in ids], "vendor_id string")
    got = [r[0] for r in df.select(risk.gaussian_noise(F.col("vendor_id"), 42, 5.0)).collect()]

    def share(key, seed):
        h = xxhash.xxh64_intdigest(struct.pack("<i", seed), seed=xxhash.xxh64_intdigest(key.encode(), seed=42))
        return (h - (1 << 64) if h >> 63 else h) % (1 << 53)

    m = float(1 << 53)
    want = [math.sqrt(-2 * math.log((share(v, 42) + 1) / (m + 1))) * math.cos(2 * math.pi * share(v, 43) / m) * 5 for v in ids]
    assert np.allclose(got, want, atol=1e-9)
    assert abs(np.mean(got)) < 0.5 and 4.6 < np.std(got) < 5.4
