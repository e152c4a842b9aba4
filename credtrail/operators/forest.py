"""Random-forest regression whose trees are independent tasks (M2), for features that fit one executor.

MLlib's learner runs several jobs for every level of the trees, which is what data needs that no single
machine can hold. A vendor table rarely is of that kind. Here the features are cut into up to 255
bins by their quantiles, the bin numbers (a byte for each value) and the targets are broadcast once,
behind a check of their size, and every tree is grown by one task from a seed of its own: level by
level, with the sums of weight and target of all (node, feature, bin) in one numpy pass. Where the nodes of
all trees may not fit in memory, they are written as a table and rows are scored tree by tree.

Trees grow as the library's: bootstrap weights, all features at every node, the cut that lowers the
squared error most, down to ``max_depth`` or to nodes that can't be improved. The same seed gives the same
forest on any cluster.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credtrail.session import scratch_path, ship_package

MAX_CELLS = 16_000_000  # rows x features that are broadcast, a byte each
MAX_NODES = 8_000_000   # 2 x rows x trees, what fully grown trees can have (36 bytes each), to be held in memory
CHUNK = 4_000_000       # cells of a level's histogram in memory at a time
SMALL = (2, 4, 8, 16, 32, 64)  # rows of a node up to which its histogram has places for the occurring bins only
BLOCK = 16_384          # rows that are scored together, where the trees are read one by one
NODES = "tree int, node int, feature int, threshold double, left int, right int, value double"


def fits_rows(rows: int, features: int) -> bool:
    """Whether a task can grow a tree over the rows."""
    return rows * features <= MAX_CELLS


def fits(rows: int, features: int, trees: int) -> bool:
    """Whether the whole forest fits in memory, too."""
    return fits_rows(rows, features) and 2 * rows * trees <= MAX_NODES


def bin_edges(x: np.ndarray, max_bins: int) -> list[np.ndarray]:
    """Of each column the thresholds between its bins: midpoints of distinct values, at quantiles if
    there are more values than bins."""
    edges = []
    for column in x.T:
        values = np.unique(column)
        middle = (values[1:] + values[:-1]) / 2
        if len(middle) > max_bins - 1:
            middle = np.unique(np.quantile(column, np.arange(1, max_bins) / max_bins, method="midpoint"))
            middle = middle[(middle >= values[0]) & (middle < values[-1])]
        edges.append(middle)
    return edges


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin numbers: how many thresholds lie below each value."""
    return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1).astype(np.uint8)


def _best_cuts(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, local: np.ndarray, nodes: int, width: int,
               min_rows: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each node of a level, whether a cut gains more than ``least``, and the feature and bin of the best.

    A node of few rows has few of the bins: its rows are sorted by feature and bin, and its histogram has a
    place for each bin that occurs, at most as many as the rows. So a level's work grows with its rows,
    not with nodes x bins, and the sums are those of the full histogram, to the bit."""
    k = bins.shape[1]
    better, feature, cut = np.zeros(nodes, bool), np.zeros(nodes, int), np.zeros(nodes, int)
    if width < 2:
        return better, feature, cut
    rows = np.bincount(local, minlength=nodes)
    widths = np.array([w for w in SMALL if w < width] + [width])
    kind = np.minimum(np.searchsorted(widths, rows), len(widths) - 1)  # places enough for a bin of each row, or all bins
    for c, places in enumerate(widths.tolist()):
        members, among = np.flatnonzero(kind == c), np.flatnonzero(kind[local] == c)
        count = max(1, CHUNK // (k * places))
        for start in range(0, len(members), count):
            some = members[start:start + count]
            m = len(some)
            own = among[(local[among] >= some[0]) & (local[among] <= some[-1])]
            at = np.searchsorted(some, local[own])
            group = at[:, None] * k + np.arange(k)
            of_row = np.arange(len(own))
            all_s = np.bincount(at * width + bins[own, 0], weight[own] * y[own], m * width).reshape(m, width).sum(axis=1)
            all_s, all_w = all_s[:, None, None], np.bincount(at, weight[own], m)[:, None, None]
            if places == width:
                cell, row = (group * width + bins[own]).ravel(), np.repeat(of_row, k)
            else:
                bits = max(1, int(len(own) - 1).bit_length())
                key = np.sort((((group * width + bins[own]) << bits) | of_row[:, None]).ravel())
                row, key = key & ((1 << bits) - 1), key >> bits
                new = np.append(True, key[1:] != key[:-1])
                occurring = key[new]
                group = occurring // width
                opens = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
                place = np.arange(len(group)) - np.repeat(opens, np.diff(np.append(opens, len(group))))
                cell = (group * places + place)[np.cumsum(new) - 1]
            own_weight, own_sum = weight[own], weight[own] * y[own]
            w = np.bincount(cell, own_weight[row], m * k * places).reshape(m, k, places)
            s = np.bincount(cell, own_sum[row], m * k * places).reshape(m, k, places)
            wl, sl = w.cumsum(axis=2), s.cumsum(axis=2)
            wr, sr = all_w - wl, all_s - sl
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((wl >= min_rows - 0.5) & (wr >= min_rows - 0.5) & (wl > 0.5) & (wr > 0.5),
                                sl * sl / wl + sr * sr / wr - all_s * all_s / all_w, -1.0).reshape(m, -1)
            best = gain.argmax(axis=1)
            better[some] = gain[np.arange(m), best] > least
            feature[some], cut[some] = best // places, best % places
            if places < width:  # from the place to the bin
                bin_at = np.zeros(m * k * places, np.int64)
                bin_at[group * places + place] = occurring % width
                cut[some] = bin_at[np.arange(m) * k * places + best]
    return better, feature, cut


def grow_tree(bins: np.ndarray, y: np.ndarray, edges: list[np.ndarray], seed: list[int], max_depth: int,
              min_rows: int = 1) -> dict[str, np.ndarray]:
    """Node arrays (feature, threshold, left, right, value); node 0 is the root, a leaf has feature -1 and
    the mean target of its rows as value."""
    n, k = bins.shape
    width = max((len(e) for e in edges), default=0) + 1
    weight = np.bincount(np.random.default_rng(seed).integers(n, size=n), minlength=n).astype(float)
    rows = np.flatnonzero(weight)
    middle = y.mean()  # sums of squares lose less around it
    bins, y, weight = bins[rows], y[rows] - middle, weight[rows]
    node = np.zeros(len(rows), np.int64)
    feature, threshold, left, right = [-1], [0.0], [-1], [-1]
    level = [0]
    position = np.arange(k) * width
    alive = np.ones(len(rows), bool)
    for _ in range(max_depth):
        live = np.flatnonzero(alive)
        if not len(live) or not level:
            break
        first, following = level[0], []
        local = node[live] - first
        better, f, b = _best_cuts(bins[live], y[live], weight[live], local, len(level), width, min_rows,
                                  1e-9 * max(1.0, float(y @ y)) / len(y))
        child = np.full((len(level), 2), -1)
        for j in np.flatnonzero(better).tolist():
            number = first + j
            feature[number], threshold[number] = int(f[j]), float(edges[f[j]][b[j]])
            left[number], right[number] = len(feature), len(feature) + 1
            child[j] = left[number], right[number]
            for column, value in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1)):
                column += [value, value]
            following += [left[number], right[number]]
        split = better[local]
        goes_right = bins[live, f[local]] > b[local]
        node[live[split]] = child[local[split], goes_right[split].astype(int)]
        alive[live[~split]] = False
        level = following
    total, mass = np.bincount(node, weight * y, len(feature)), np.bincount(node, weight, len(feature))
    mean = middle + np.divide(total, mass, out=np.zeros(len(feature)), where=mass > 0)
    return {"feature": np.array(feature, np.int32), "threshold": np.array(threshold), "left": np.array(left, np.int32),
            "right": np.array(right, np.int32), "value": mean}


class ForestModel:
    """The trees as arrays, one after the other; ``transform`` adds ``prediction``."""

    def __init__(self, features: list[str], roots: np.ndarray, feature: np.ndarray, threshold: np.ndarray,
                 left: np.ndarray, right: np.ndarray, value: np.ndarray):
        self.features, self.roots = list(features), roots
        self.feature, self.threshold, self.left, self.right, self.value = feature, threshold, left, right, value

    def predict(self, x: np.ndarray) -> np.ndarray:
        """All trees step down together; rows in blocks, so the work arrays stay small."""
        out = np.zeros(len(x))
        for start in range(0, len(x), 4096):
            part = x[start:start + 4096]
            at = np.repeat(self.roots[None, :], len(part), axis=0)
            while True:
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                value = np.take_along_axis(part, np.maximum(f, 0), axis=1)
                step = np.where(value <= self.threshold[at], self.left[at], self.right[at])
                at = np.where(inner, step, at)
            out[start:start + 4096] = self.value[at].mean(axis=1)
        return out

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        ship_package(df.sparkSession)
        shared = df.sparkSession.sparkContext.broadcast(self)  # at most trees x 2 x rows nodes, rows bounded by ``fits``
        keep = [f for f in df.schema.fields if f.name != output]
        names, features = [f.name for f in keep], self.features

        def run(batches):
            for batch in batches:
                x = np.stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in features], axis=1)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(shared.value.predict(x))],
                                                 [*names, output])

        return df.select(*names).mapInArrow(run, T.StructType([*keep, T.StructField(output, T.DoubleType())]))

    def save(self, spark: SparkSession, path: str) -> None:
        nodes = zip(*(a.tolist() for a in (self.feature, self.threshold, self.left, self.right, self.value)), strict=True)
        spark.createDataFrame([(i, *n) for i, n in enumerate(nodes)],
                              "i long, feature int, threshold double, left int, right int, value double") \
            .write.mode("overwrite").parquet(f"{path}/forest-nodes")
        about = json.dumps({"features": self.features, "roots": self.roots.tolist()})
        spark.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/forest")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestModel:
        about = json.loads(spark.read.text(f"{path}/forest").first()[0])
        if "trees" in about:
            return WrittenForest(about["features"], f"{path}/forest-trees", about["trees"])
        rows = spark.read.parquet(f"{path}/forest-nodes").orderBy("i").toArrow()
        arrays = [rows[c].to_numpy() for c in ("feature", "threshold", "left", "right", "value")]
        return cls(about["features"], np.array(about["roots"]), *arrays)


class WrittenForest(ForestModel):
    """A forest whose nodes stay a table in the shared folder, a folder for each tree: they grow with rows x
    trees. Tasks score blocks of ``BLOCK`` rows and hold one tree at a time; the driver holds none."""

    def __init__(self, features: list[str], path: str, trees: int):
        self.features, self.path, self.trees = list(features), path, trees

    def tree(self, number: int) -> list[np.ndarray]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        filesystem, inner = fs.FileSystem.from_uri(self.path if "://" in self.path else self.path.removeprefix("file:"))
        found = filesystem.get_file_info(fs.FileSelector(f"{inner}/tree={number}"))
        parts = [pq.ParquetFile(filesystem.open_input_file(i.path)).read() for i in found if i.path.endswith(".parquet")]
        nodes = pa.concat_tables(parts)
        order = np.argsort(nodes["node"].to_numpy())
        return [nodes[c].to_numpy()[order] for c in ("feature", "threshold", "left", "right", "value")]

    def predict(self, x: np.ndarray) -> np.ndarray:
        values = np.empty((len(x), self.trees))
        for number in range(self.trees):
            feature, threshold, left, right, value = self.tree(number)
            at = np.zeros(len(x), np.int64)
            moving = np.arange(len(x))
            while len(moving := moving[feature[at[moving]] >= 0]):
                here = at[moving]
                goes_left = x[moving, feature[here]] <= threshold[here]
                at[moving] = np.where(goes_left, left[here], right[here])
            values[:, number] = value[at]
        return values.mean(axis=1)

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        ship_package(df.sparkSession)
        keep = [f for f in df.schema.fields if f.name != output]
        names, features, predict = [f.name for f in keep], self.features, self.predict

        def scored(block):
            table = pa.Table.from_batches(block)
            x = np.stack([table.column(c).cast(pa.float64()).to_numpy() for c in features], axis=1)
            return table.append_column(output, pa.array(predict(x))).to_batches()

        def run(batches):
            block, size = [], 0
            for batch in batches:
                for start in range(0, batch.num_rows, BLOCK):
                    block.append(batch.slice(start, BLOCK))
                    size += block[-1].num_rows
                    if size >= BLOCK:
                        yield from scored(block)
                        block, size = [], 0
            if block:
                yield from scored(block)

        rows = df.select(*names)
        rows = rows.repartition(max(1, -(-rows.count() // BLOCK)))  # every task reads all trees: no more tasks than blocks
        return rows.mapInArrow(run, T.StructType([*keep, T.StructField(output, T.DoubleType())]))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.read.parquet(self.path).repartition("tree").write.mode("overwrite").partitionBy("tree").parquet(f"{path}/forest-trees")
        about = json.dumps({"features": self.features, "trees": self.trees})
        spark.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/forest")


def train_forest(rows: DataFrame, features: list[str], label: str, *, seed: int = 42, num_trees: int = 100,
                 max_depth: int = 30, max_bins: int = 256) -> ForestModel:
    """A forest over the ``rows``, which must fit (``fits_rows``); it is a ``WrittenForest`` if its nodes may
    not (``fits``)."""
    spark = rows.sparkSession
    n = rows.count()
    if not fits_rows(n, len(features)):
        raise ValueError(f"{num_trees} trees over {n} rows of {len(features)} features are too large for one executor")
    if not n:
        raise ValueError("no rows to learn from")
    held = rows.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias("_y")).toArrow()
    order = np.lexsort([held[c].to_numpy() for c in [*features, "_y"]])  # the same forest however the rows arrive
    x = np.stack([held[c].to_numpy() for c in features], axis=1)[order]
    y = held["_y"].to_numpy()[order]
    edges = bin_edges(x, min(max_bins, 256))
    ship_package(spark)
    shared = spark.sparkContext.broadcast((binned(x, edges), y, edges))  # at most MAX_CELLS bytes and 8 for each row

    def run(batches):
        bins, target, cuts = shared.value
        for batch in batches:
            for tree in batch.column("id").to_pylist():
                t = grow_tree(bins, target, cuts, [seed, tree], max_depth)
                size = len(t["feature"])
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array(np.full(size, tree, np.int32)), "node": pa.array(np.arange(size, dtype=np.int32)),
                    "feature": pa.array(t["feature"]), "threshold": pa.array(t["threshold"]), "left": pa.array(t["left"]),
                    "right": pa.array(t["right"]), "value": pa.array(t["value"])})

    grown = spark.range(0, num_trees, 1, min(num_trees, max(spark.sparkContext.defaultParallelism, 8))).mapInArrow(run, NODES)
    if not fits(n, len(features), num_trees):
        path = scratch_path(spark, "forest-trees")
        grown.write.partitionBy("tree").parquet(path)
        return WrittenForest(features, path, num_trees)
    nodes = grown.toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])
    tree = nodes["tree"].to_numpy()
    roots = np.flatnonzero(nodes["node"].to_numpy() == 0)
    base = roots[np.searchsorted(tree[roots], tree)]
    feature = nodes["feature"].to_numpy()
    move = lambda c: np.where(feature >= 0, nodes[c].to_numpy() + base, -1)
    return ForestModel(features, roots, feature, nodes["threshold"].to_numpy(), move("left"), move("right"), nodes["value"].to_numpy())
