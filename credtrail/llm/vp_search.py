"""Operator 11: approximate nearest neighbours with vantage-point trees per shard.

A vantage-point tree halves its rows by their distance to one of them. With d the distance of a
query to the vantage point, rows at distances [low, high] from it are at least
max(low - d, d - high) away from the query (triangle inequality), and a subtree is passed over if
``factor`` times that exceeds the query's k-th best distance so far. Factor 1 is exact search; a
larger one passes over subtrees that are unlikely, not impossible, to hold a neighbour.

1. A tree over a sample of up to ``SAMPLE`` rows (the only thing that is fitted on a sample) names
   the shards: every row goes down it to one leaf. Its halves are bounded by their radii, so the
   bounds hold for all rows, not for the sample only.
2. A shard's rows are cut into pieces of about ``TREE_ROWS`` by a hash of the row (a vector that many
   rows share is spread), and one vantage-point tree is built over each piece: all rows are in one.
3. Each query is answered in one tree of its own shard first. Its k-th best distance there decides
   which other trees it can reach; only there it is sent, in blocks of ``BLOCK`` queries.
4. Candidates within reach are measured by the definition, sqrt(sum((q - x)^2)) in double precision
   (products only rule candidates out, with a margin for rounding), and merged.

In 64 dimensions without clusters distances are alike and little can be passed over exactly; the
README has the recall and the share of distances computed that ``FACTOR`` gives there.

Defined cases: vectors null, empty, all zero, or with null or non-finite components take no part, nor do
rows without id. Shorter vectors count as padded with zeros. Rows with the query's id are not its
partners; other repeated rows each count; a query row that repeats is answered each time. Fewer than k
partners: all of them. Ties go to the smaller id. Very large components are scaled by a power of
two, so squares don't overflow. Only the id and the vector are read, under names of the operator's own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credtrail.llm.blocks import NO_ROW, answered, merge_best, merged, numbered
from credtrail.llm.common import read_table, ship_package, write_snapshot

K = 10
FACTOR = 6.0
SAMPLE = 32_768
TREE_ROWS = 8192
LEAF = 128
BLOCK = 4096
MARGIN = 1e-12


# --- one tree -------------------------------------------------------------------------------

def vectors_of(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as doubles, padded with zeros."""
    off = column.offsets.to_numpy().astype(np.int64)
    off = off - off[0]
    out = np.zeros((len(column), dim))
    n = np.diff(off)
    row = np.repeat(np.arange(len(column)), n)
    out[row, np.arange(off[-1]) - np.repeat(off[:-1], n)] = column.flatten().to_numpy()
    return out


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of the rows of x to y (one row, or as many)."""
    return np.sqrt(((x - y) ** 2).sum(axis=1))


def vantage(x: np.ndarray, rows: np.ndarray) -> int:
    """Of five rows, the one whose distances to 64 others spread most."""
    some = rows[np.linspace(0, len(rows) - 1, 64).astype(int)]
    tried = rows[np.linspace(0, len(rows) - 1, 5).astype(int)]
    return int(tried[int(np.argmax([apart(x[some], x[t]).std() for t in tried]))])


def build_tree(x: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, list[dict]]:
    """(order of the rows, nodes); node 0 is the root. An inner node has the row number of its
    vantage point, the largest distance of its near half and, of both halves, node and interval;
    a leaf has a range of the order."""
    nodes: list[dict] = []
    order: list[np.ndarray] = []
    done = 0

    def node(rows: np.ndarray) -> int:
        nonlocal done
        number = len(nodes)
        nodes.append({})
        if len(rows) <= leaf:
            nodes[number] = {"start": done, "end": done + len(rows)}
            order.append(rows)
            done += len(rows)
            return number
        point = vantage(x, rows)
        d = apart(x[rows], x[point])
        by = np.argsort(d, kind="stable")
        half = len(rows) // 2
        parts = by[:half], by[half:]
        nodes[number] = {"point": point, "radius": float(d[by[half - 1]]),
                         "halves": [(node(rows[p]), float(d[p].min()), float(d[p].max())) for p in parts]}
        return number

    node(np.arange(len(x)))
    return np.concatenate(order), nodes


class Search:
    """One block of queries in one tree. ``best`` and ``ids``: of each query the k best so far."""

    def __init__(self, x, ids, nodes, points, queries, own, reach, k, factor):
        self.x, self.row_ids, self.nodes, self.points = x, ids, nodes, points
        self.q, self.own, self.k, self.factor = queries, own, k, factor
        self.reach = np.array(reach, float)  # a neighbour is at most this far away
        self.norms, self.q_norms = (x ** 2).sum(axis=1), (queries ** 2).sum(axis=1)
        self.best, self.ids = np.full((len(queries), k), np.inf), np.full((len(queries), k), NO_ROW)
        self.first = np.full(len(queries), -1)
        self.measured = 0

    def halves(self, number: int, active: np.ndarray, least: np.ndarray):
        """(child, lower bounds of the active queries) of both halves."""
        d = apart(self.q[active], self.points[self.nodes[number]["point"]])
        self.measured += len(active)
        slack = MARGIN * (1 + d)
        return [(child, np.maximum(least, np.maximum(low - d, d - high) - slack * (1 + high)))
                for child, low, high in self.nodes[number]["halves"]]

    def leaf(self, number: int, active: np.ndarray) -> None:
        start, end = self.nodes[number]["start"], self.nodes[number]["end"]
        x, norm = self.x[start:end], self.q_norms[active][:, None] + self.norms[start:end]
        self.measured += len(active) * len(x)
        near = norm - 2 * (self.q[active] @ x.T)
        i, j = np.nonzero(~(near > (self.reach[active] ** 2)[:, None] + MARGIN * norm))
        other = self.row_ids[start + j] != self.own[active[i]]
        i, j = active[i[other]], j[other]
        if not len(i):
            return
        merge_best(self.best, self.ids, i, apart(x[j], self.q[i]), self.row_ids[start + j])
        mine = np.unique(i)
        self.reach[mine] = np.minimum(self.reach[mine], self.best[mine, -1])

    def descend(self) -> None:
        """Every query's nearest leaf."""
        stack = [(0, np.arange(len(self.q)), np.zeros(len(self.q)))]
        while stack:
            number, active, least = stack.pop()
            if "start" in self.nodes[number]:
                self.first[active] = number
                self.leaf(number, active)
                continue
            (near, a), (far, b) = self.halves(number, active, np.zeros(len(active)))
            for child, own in ((near, a <= b), (far, a > b)):
                if own.any():
                    stack.append((child, active[own], least[own]))

    def run(self) -> None:
        self.descend()
        stack = [(0, np.arange(len(self.q)), np.zeros(len(self.q)))]
        while stack:
            number, active, least = stack.pop()
            stay = self.factor * least <= self.reach[active]
            if "start" in self.nodes[number]:
                stay &= self.first[active] != number
            active, least = active[stay], least[stay]
            if not len(active):
                continue
            if "start" in self.nodes[number]:
                self.leaf(number, active)
                continue
            (near, a), (far, b) = self.halves(number, active, least)
            parts = [(near, active, a), (far, active, b)]
            stack += parts[::-1] if (a <= b).sum() * 2 >= len(active) else parts  # the nearer one comes first


# --- shards ---------------------------------------------------------------------------------

def route(top: dict, x: np.ndarray) -> np.ndarray:
    """The shard of every row: the leaf of the top tree that it goes down to."""
    out = np.zeros(len(x), np.int64)
    stack = [(0, np.arange(len(x)))]
    while stack:
        number, rows = stack.pop()
        n = top["nodes"][number]
        if "start" in n:
            out[rows] = number
            continue
        near = apart(x[rows], top["points"][n["point"]]) <= n["radius"]
        for (child, _, _), own in zip(n["halves"], (near, ~near), strict=True):
            if own.any():
                stack.append((child, rows[own]))
    return out


def reachable(top: dict, q: np.ndarray, reach: np.ndarray, factor: float):
    """(query position, shard) pairs that the bounds leave open."""
    found = []
    stack = [(0, np.arange(len(q)), np.zeros(len(q)))]
    while stack:
        number, rows, least = stack.pop()
        stay = factor * least <= reach[rows]
        rows, least = rows[stay], least[stay]
        if not len(rows):
            continue
        n = top["nodes"][number]
        if "start" in n:
            found.append(np.stack([rows, np.full(len(rows), number)], axis=1))
            continue
        d = apart(q[rows], top["points"][n["point"]])
        slack = MARGIN * (1 + d) * (1 + n["radius"])
        (near, _, _), (far, _, _) = n["halves"]
        stack.append((far, rows, np.maximum(least, n["radius"] - d - slack)))
        stack.append((near, rows, np.maximum(least, d - n["radius"] - slack)))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


# --- as Spark jobs --------------------------------------------------------------------------

TREE = "tree long, ids binary, x binary, nodes binary"


def usable(df: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """(vec_id, v: doubles) of the rows that take part."""
    return (df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
            .filter("vec_id is not null and v is not null")
            .filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
            .filter(F.exists("v", lambda x: x != 0)))


def neighbours(df: DataFrame, is_query: Column, k: int = K, factor: float = FACTOR, vector: str = "embedding",
               vec_id: str = "vec_id", tree_rows: int = TREE_ROWS, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """(query_id, rank, vec_id, score): k near rows of every row for which ``is_query`` (over
    ``vec_id``) holds, nearest first, with their Euclidean distances."""
    if factor < 1:
        raise ValueError("a factor below 1 passes over more than nothing but bounds less than exactly; use 1 or more")
    spark = df.sparkSession
    ship_package(spark)
    rows = numbered(usable(df, vector, vec_id), "vp-vectors")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"),
                    F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
    n, dim = size["n"], size["dim"] or 0
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    scale = 2.0 ** -max(0, int(np.frexp(size["most"])[1]) - 400)
    tree_rows = max(256, min(tree_rows, (1 << 22) // dim))

    sampled = rows.filter(F.pmod(F.xxhash64("number"), F.lit(1_000_000)) < min(1.0, SAMPLE / n) * 1_000_000) \
        .orderBy("number").select("v").limit(2 * SAMPLE).toArrow()["v"].combine_chunks()
    points = vectors_of(sampled if len(sampled) else rows.orderBy("number").select("v").limit(1).toArrow()["v"].combine_chunks(),
                        dim) * scale
    order, nodes = build_tree(points, max(8, int(len(points) * tree_rows / n)))
    used = sorted({x["point"] for x in nodes if "point" in x})
    for x in nodes:
        if "point" in x:
            x["point"] = used.index(x["point"])
    top = spark.sparkContext.broadcast({"nodes": nodes, "points": points[used]})  # at most SAMPLE / 4 points

    def place(batches):
        for batch in batches:
            shard = route(top.value, vectors_of(batch.column("v"), dim) * scale)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], [*batch.schema.names, "shard"])

    dealt = write_snapshot(rows.mapInArrow(place, "vec_id long, v array<double>, number long, shard long"), "vp-dealt")
    pieces = dealt.groupBy("shard").agg(F.ceil(F.count("*") / tree_rows).cast("long").alias("pieces"))
    counts = {r["shard"]: r["pieces"] for r in pieces.collect()}  # one row a leaf of the top tree
    first_tree = dict(zip(sorted(counts), np.cumsum([0, *(counts[s] for s in sorted(counts))]).tolist(), strict=False))
    placed = spark.createDataFrame([(s, first_tree[s], counts[s]) for s in counts], "shard long, first long, pieces long")
    dealt = dealt.join(F.broadcast(placed), "shard").select(
        "vec_id", "v", "number", (F.col("first") + F.pmod(F.xxhash64("number"), F.col("pieces"))).alias("tree"))

    def grown(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        part = part.sort_by("number")
        x = vectors_of(part["v"].combine_chunks(), dim) * scale
        order, nodes = build_tree(x, leaf)
        at = {int(o): i for i, o in enumerate(order)}
        flat = np.array([(-1, 0, n["start"], n["end"], 0, 0, 0, 0) if "start" in n else
                         (at[n["point"]], n["radius"], *n["halves"][0], *n["halves"][1]) for n in nodes], float)
        return pa.table({"tree": pa.array([key[0].as_py()], pa.int64()),
                         "ids": pa.array([part["vec_id"].to_numpy()[order].astype("<i8").tobytes()], pa.binary()),
                         "x": pa.array([x[order].tobytes()], pa.binary()),
                         "nodes": pa.array([flat.tobytes()], pa.binary())})

    trees = write_snapshot(dealt.groupBy("tree").applyInArrow(grown, TREE), "vp-trees")

    def answer(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        tree = own.iloc[0]
        ids = np.frombuffer(tree["ids"], "<i8")
        x = np.frombuffer(tree["x"]).reshape(len(ids), dim)
        nodes = [{"start": int(r[2]), "end": int(r[3])} if r[0] < 0 else
                 {"point": int(r[0]), "radius": r[1],
                  "halves": [(int(r[2]), r[3], r[4]), (int(r[5]), r[6], r[7])]}
                 for r in np.frombuffer(tree["nodes"]).reshape(-1, 8).tolist()]
        q = np.frombuffer(b"".join(asked["q"])).reshape(len(asked), dim)
        search = Search(x, ids, nodes, x, q, asked["query_id"].to_numpy(), asked["reach"].to_numpy(), k, factor)
        search.run()
        i, j = np.nonzero(np.isfinite(search.best))
        return pd.DataFrame({"number": asked["number"].to_numpy()[i], "query_id": asked["query_id"].to_numpy()[i],
                             "vec_id": search.ids[i, j], "score": search.best[i, j] / scale})

    found_type = "number long, query_id long, vec_id long, score double"

    def packed(batches):
        for batch in batches:
            q = vectors_of(batch.column("v"), dim) * scale
            yield pa.RecordBatch.from_pydict({
                "number": batch.column("number"), "query_id": batch.column("vec_id"), "tree": batch.column("tree"),
                "q": pa.array([row.tobytes() for row in q], pa.binary()),
                "reach": pa.array(np.full(len(q), np.inf))})

    queries = write_snapshot(
        dealt.filter(is_query).mapInArrow(packed, "number long, query_id long, tree long, q binary, reach double"),
        "vp-queries")
    asked = queries.count()
    by_distance = [F.col("score").asc(), F.col("vec_id").asc()]
    first = write_snapshot(answered(trees, queries, answer, found_type, asked, block), "vp-first")

    # the k-th best of a query's own tree bounds its search elsewhere
    kth = first.groupBy("number").agg(F.count("*").alias("m"), F.max("score").alias("last"))
    bounded = queries.join(kth, "number", "left").select(
        "number", "query_id", "q", F.col("tree").alias("own_tree"),
        F.when(F.col("m") >= k, F.col("last") * scale).otherwise(F.lit(float("inf"))).alias("reach"))

    def spread(batches):
        for batch in batches:
            q = np.frombuffer(b"".join(batch.column("q").to_pylist())).reshape(batch.num_rows, dim)
            own = batch.column("own_tree").to_numpy()
            pairs = reachable(top.value, q, batch.column("reach").to_numpy(), factor)
            for s in np.unique(pairs[:, 1]).tolist():
                who = pairs[pairs[:, 1] == s, 0]
                for tree in range(first_tree.get(s, 0), first_tree.get(s, 0) + counts.get(s, 0)):
                    to = who[own[who] != tree]
                    part = batch.take(pa.array(to))
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in ("number", "query_id", "q", "reach")),
                         pa.array(np.full(len(to), tree))], ["number", "query_id", "q", "reach", "tree"])

    sent = write_snapshot(bounded.mapInArrow(spread, "number long, query_id long, q binary, reach double, tree long"), "vp-sent")
    rest = answered(trees, sent, answer, found_type, asked, block)
    return merged(first.unionByName(rest), by_distance, k)


def op11_vp_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found of each 100th embedding among all others."""
    return neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
