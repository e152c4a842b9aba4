"""Isolation forest (Liu, Ting & Zhou, 2008) as grouped Spark jobs.

* scaling: mean / population std from one aggregation;
* sampling: every tree draws min(``sample_size``, n) rows without replacement,
  whatever n is: a row has a rank for each tree, a hash of its key and the tree,
  and the lowest ranks of a tree are its sample, so it is the same however the
  data is partitioned or recomputed. (256 rows a tree are the algorithm's own
  default.) Above ``trees * sample_size`` rows the trees draw from a uniform pool
  of about that many, so the number of ranks doesn't grow with the data;
* fitting: ``groupBy(tree).applyInPandas`` grows one random tree per group
  and returns its nodes (at most 2 * sample_size - 1 per tree);
* scoring: the node table (trees x nodes, bounded) is broadcast to a pandas
  UDF that walks all trees for a whole Arrow batch at once;
* threshold: the ``contamination`` quantile of the training scores, computed
  with the distributed exact quantile.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credtrail.operators.quantiles import exact_quantiles
from credtrail.session import ship_package, write_snapshot

EULER_GAMMA = 0.5772156649015329
BLOCK = 4096
NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, "
               "size long")


def average_path_length(n) -> np.ndarray:
    """c(n): mean path length of an unsuccessful search in a BST of n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes (node, feature, threshold, left, right, size) of one isolation tree."""
    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, 0)]
    nodes.append(None)
    while stack:
        idx, depth, nid = stack.pop()
        sub = x[idx]
        if depth >= max_depth or len(idx) <= 1:
            nodes[nid] = [nid, -1, 0.0, -1, -1, len(idx)]
            continue
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            nodes[nid] = [nid, -1, 0.0, -1, -1, len(idx)]
            continue
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < thr
        left_id, right_id = len(nodes), len(nodes) + 1
        nodes.extend([None, None])
        nodes[nid] = [nid, f, thr, left_id, right_id, len(idx)]
        stack.append((idx[go_left], depth + 1, left_id))
        stack.append((idx[~go_left], depth + 1, right_id))
    return [tuple(n) for n in nodes]


def _stepping(feat, thr, left, right, size) -> list[tuple]:
    """Of each tree: feature, threshold, the two children (right, then left; a leaf's are itself), path length
    and the number of steps that bring every row to a leaf."""
    out = []
    for f, threshold, lefts, rights, sizes in zip(feat, thr, left, right, size, strict=True):
        own = np.arange(len(f))
        inner = f >= 0
        child = np.stack([np.where(inner, rights, own), np.where(inner, lefts, own)], axis=1)
        depth = np.zeros(len(f))
        at, steps = np.zeros(1, np.int64), 0
        while len(at := at[inner[at]]):
            below = child[at].ravel()
            depth[below] = np.repeat(depth[at], 2) + 1
            at, steps = below, steps + 1
        out.append((np.where(inner, f, 0), threshold, child.ravel(), depth + average_path_length(sizes), steps))
    return out


class IsolationForestModel:
    def __init__(self, nodes: pd.DataFrame, means, stds, features, sample_size, offset=None):
        self.nodes, self.means, self.stds = nodes, list(means), list(stds)
        self.features, self.sample_size, self.offset = list(features), sample_size, offset

    def _arrays(self):
        # only trees that exist count: their ids become 0, 1, ... without gaps
        ids, t = np.unique(self.nodes["tree"].to_numpy(), return_inverse=True)
        trees = len(ids)
        width = int(self.nodes["node"].max()) + 1
        feat = np.full((trees, width), -1, dtype=np.int64)
        thr = np.zeros((trees, width))
        left = np.full((trees, width), -1, dtype=np.int64)
        right = np.full((trees, width), -1, dtype=np.int64)
        size = np.zeros((trees, width))
        n = self.nodes["node"].to_numpy()
        feat[t, n] = self.nodes["feature"].to_numpy()
        thr[t, n] = self.nodes["threshold"].to_numpy()
        left[t, n] = self.nodes["left"].to_numpy()
        right[t, n] = self.nodes["right"].to_numpy()
        size[t, n] = self.nodes["size"].to_numpy()
        return feat, thr, left, right, size

    def score_column(self, spark):
        """pandas UDF: per row, sklearn-style score_samples = -2^(-E[h(x)] / c(psi))."""
        ship_package(spark)
        shared = spark.sparkContext.broadcast(_stepping(*self._arrays()))
        means, stds = np.array(self.means), np.array(self.stds)
        c_psi = float(average_path_length([self.sample_size])[0])

        @F.pandas_udf(T.DoubleType())
        def score(*cols: pd.Series) -> pd.Series:
            trees = shared.value
            x = (np.column_stack([c.to_numpy(dtype=float) for c in cols]) - means) / stds
            out = np.empty(len(x))
            for start in range(0, len(x), BLOCK):  # work arrays that stay in the processor's cache
                part = x[start:start + BLOCK]
                flat, first = part.ravel(), np.arange(len(part)) * part.shape[1]
                path = np.empty((len(part), len(trees)))
                for t, (feature, threshold, child, length, steps) in enumerate(trees):
                    node = np.zeros(len(part), np.int64)
                    for _ in range(steps):
                        node = child.take(2 * node + (flat.take(first + feature.take(node)) < threshold.take(node)))
                    path[:, t] = length.take(node)
                out[start:start + BLOCK] = path.mean(axis=1)
            return pd.Series(-np.power(2.0, -out / c_psi))

        return score(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.features])

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_score_samples``."""
        return df.withColumn("_score_samples", self.score_column(df.sparkSession))

    def flag(self, scored: DataFrame) -> DataFrame:
        """Decision score and flag from ``_score_samples`` and the fitted offset."""
        decision = F.col("_score_samples") - F.lit(self.offset)
        return (scored.withColumn("anomaly_score", decision)
                .withColumn("is_anomaly", decision < 0).drop("_score_samples"))

    def transform(self, df: DataFrame) -> DataFrame:
        return self.flag(self.score(df))


class IsolationForest:
    def __init__(self, trees=100, sample_size=256, contamination=0.1, seed=42, features=()):
        self.trees, self.sample_size = trees, sample_size
        self.contamination, self.seed, self.features = contamination, seed, list(features)

    def fit(self, df: DataFrame, key_cols: list[str] | None = None) -> IsolationForestModel:
        return self.fit_scored(df, key_cols)[0]

    def fit_scored(self, df: DataFrame, key_cols: list[str] | None = None):
        """(model, ``df`` with ``_score_samples`` as a written table): one scoring pass serves
        the threshold and later the flags. ``df`` is read several times: pass a table."""
        model = self._grow_trees(df, key_cols)
        scored = write_snapshot(model.score(df), "forest-scores")
        model.offset = exact_quantiles(scored, "_score_samples", [self.contamination])[0]
        return model, scored

    def sample(self, x: DataFrame, row_key, n: int) -> DataFrame:
        """(tree, _rank, row columns): min(sample_size, n) rows for each tree."""
        psi, pool = min(self.sample_size, n), self.trees * self.sample_size
        top = 1 << 30

        def draw(*salt):
            return F.pmod(F.xxhash64(row_key, *salt), F.lit(top))

        in_pool = x.filter(draw(F.lit(self.seed)) < min(1.0, 2.0 * pool / n) * top)
        ranked = in_pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(self.trees - 1)))) \
            .withColumn("_rank", draw(F.lit(self.seed + 1), F.col("tree")))
        # four times the rows a tree needs reach its window (fewer than needed: about never)
        ranked = ranked.filter(F.col("_rank") < min(1.0, 4.0 * psi / min(n, 2 * pool)) * top)
        w = Window.partitionBy("tree").orderBy("_rank", row_key)
        return ranked.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= psi)

    def _grow_trees(self, df: DataFrame, key_cols: list[str] | None) -> IsolationForestModel:
        feats = self.features
        x = df.select(*(key_cols or df.columns)).withColumns(
            {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in feats})
        stats = x.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(feats)],
                      *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(feats)],
                      F.count(F.lit(1)).alias("n")).first()
        means = [stats[f"m{i}"] or 0.0 for i in range(len(feats))]
        stds = [(stats[f"s{i}"] or 0.0) or 1.0 for i in range(len(feats))]
        n = max(stats["n"], 1)
        psi = int(min(self.sample_size, n))
        row_key = F.xxhash64(*[F.col(c) for c in (key_cols or df.columns)])
        sampled = self.sample(x, row_key, n)
        scaled = sampled.select("tree", "_rank", *[((F.col(c) - means[i]) / stds[i]).alias(c)
                                                   for i, c in enumerate(feats)])
        max_depth = int(math.ceil(math.log2(max(psi, 2))))
        seed = self.seed

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            tree = int(pdf["tree"].iloc[0])
            pdf = pdf.sort_values("_rank")
            rng = np.random.default_rng([seed, tree])
            nodes = _grow(pdf[feats].to_numpy(dtype=float), rng, max_depth)
            out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right",
                                               "size"])
            out.insert(0, "tree", tree)
            return out

        ship_package(df.sparkSession)
        nodes = scaled.groupBy("tree").applyInPandas(build, NODE_SCHEMA).toPandas()
        return IsolationForestModel(nodes, means, stds, feats, psi)
