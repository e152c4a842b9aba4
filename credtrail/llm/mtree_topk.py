"""Operator 2: exact top-k by inner product with M-trees searched best first.

Vectors become integers, floor(256 * component). An M-tree needs a metric, so every vector x gets
one more coordinate sqrt(M^2 - |x|^2), with M the largest norm, and a query gets 0 there. Then
distance^2 = |q|^2 + M^2 - 2 q.x: nearer in this metric means a larger inner product, and a
distance to a query is exact from the integer product.

Trees: vectors are dealt by their nearest of up to ``PIVOTS`` sampled pivots, each with the radius that
covers its rows; a pivot's rows are cut into pieces of about ``TREE_ROWS`` by a hash of the row (so a
vector or an id that many rows share is spread), and each piece is bulk-loaded into one M-tree. Its
nodes are pages, rows of a written table: an inner page holds routing vectors, covering radii and
distances to the page's own routing vector; a leaf holds vectors and those distances.

Each query is answered in one tree of its own pivot first. The k-th best there is its bound, and it
is sent only to the trees of pivots whose ball reaches into that bound, in blocks of ``BLOCK``.

Search of a block in a tree: pages wait in a queue by their lower bound, the least over the
queries that wait for them, and the best is opened next. The distance d of a query to a page's routing
vector is known, so |d - stored distance| bounds each entry's distance from below without computing it; only
entries that may still beat the k-th best are computed, for all waiting queries together.

Products are float64 while the norms stay below 2^26, where all their sums are exact. Vectors
with larger norms (``LIMIT``) lie in flat pages that every query meets, and as queries they meet every
page, with 64-bit integer products: slower and without pruning, but no row is left out.

Rounding can't lose results: bounds get a margin of 1e-9 of their size, and scores are integers.

Defined cases: vectors null or holding null or non-finite components take no part, nor do rows
without id. Components beyond 2^62 after scaling count as 2^62, and a score that does not fit a long
as the largest or smallest long. Shorter vectors count as padded with zeros. Rows with the
query's id are not its partners; other repeated rows each count, and a query row that repeats is answered each
time. Fewer than k partners: all of them. Ties go to the smaller id. Only the id and the vector are
read, under names of the operator's own.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credtrail.llm.blocks import NO_ROW, answered, merge_best, merged, numbered
from credtrail.llm.common import read_table, ship_package, write_snapshot

K = 5
PIVOTS = 4096
TREE_ROWS = 8192
LEAF = 128
FAN = 16
BLOCK = 4096
LIMIT = 2.0 ** 52
LARGEST = 2.0 ** 62
LONG = 2 ** 63 - 1


# --- one tree -------------------------------------------------------------------------------

def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an integer list column as an int64 matrix, padded with zeros."""
    off = column.offsets.to_numpy().astype(np.int64)
    values = column.flatten().to_numpy()
    off = off - off[0]
    out = np.zeros((len(column), dim), np.int64)
    n = np.diff(off)
    row = np.repeat(np.arange(len(column)), n)
    out[row, np.arange(off[-1]) - np.repeat(off[:-1], n)] = values
    return out


def lift(x: np.ndarray, top: int) -> np.ndarray:
    """Vectors with the coordinate that makes all norms sqrt(top)."""
    return np.concatenate([x, np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0))[:, None]], axis=1).astype(np.float64)


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of the rows of x to y (one row, or as many)."""
    return np.sqrt(((x - y) ** 2).sum(axis=1))


def build_pages(ids: np.ndarray, x: np.ndarray, top: int, leaf: int = LEAF, fan: int = FAN) -> list[dict]:
    """Pages of an M-tree over the rows of x; page 0 is the root."""
    full = lift(x, top)
    pages: list[dict] = []

    def page(rows: np.ndarray, routing: int | None) -> int:
        number = len(pages)
        pages.append({})
        center = full[rows].mean(axis=0) if routing is None else full[routing]
        if len(rows) <= leaf:
            pages[number] = {"leaf": True, "ids": ids[rows], "x": x[rows], "radius": np.zeros(len(rows)),
                             "parent": apart(full[rows], center)}
            return number
        # routing vectors: each the farthest from those before
        near = apart(full[rows], full[rows[0]])
        chosen, owner = [int(rows[0])], np.zeros(len(rows), np.int64)
        while len(chosen) < fan and near.max() > 0:
            chosen.append(int(rows[int(near.argmax())]))
            new = apart(full[rows], full[chosen[-1]])
            closer = new < near
            owner[closer] = len(chosen) - 1
            near = np.minimum(near, new)
        parts = [(c, rows[owner == j]) for j, c in enumerate(chosen)]
        if len(parts) == 1:  # all alike: cut evenly
            size = max(leaf, -(-len(rows) // fan))
            parts = [(int(rows[k]), rows[k:k + size]) for k in range(0, len(rows), size)]
        children = [page(part, c) for c, part in parts]
        heads = np.array([c for c, _ in parts])
        pages[number] = {"leaf": False, "ids": np.array(children), "x": x[heads],
                         "radius": np.array([apart(full[part], full[c]).max() for c, part in parts]),
                         "parent": apart(full[heads], center)}
        return number

    page(np.arange(len(ids)), None)
    return pages


def products_of(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors of any size; what does not fit a long is the largest or
    smallest one."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2.0 ** 62:
        return q @ x.T
    wide = q.astype(object) @ x.T.astype(object)
    return np.clip(wide, -LONG, LONG).astype(np.int64)


def search_block(pages: list[dict], query_ids: np.ndarray, q: np.ndarray, top: float, k: int, bounds: np.ndarray,
                 exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(negated scores, ids) of the k best entries of a tree for each query, best first; ``NO_ROW`` is the id
    where there are fewer. ``bounds``: nothing farther away matters. ``exact``: integers of any size, no pruning."""
    vectors = q if exact else q.astype(np.float64)
    base = (q.astype(np.float64) ** 2).sum(axis=1) + top
    margin = np.full(len(q), np.inf) if exact else 1e-9 * (1 + np.sqrt(base))
    bound = np.array(bounds, float)
    best, ids = np.full((len(q), k), LONG), np.full((len(q), k), NO_ROW)
    waiting = {0: (np.arange(len(q)), np.zeros(len(q)), None)}
    queue: list[tuple[float, int]] = [(0.0, 0)]
    while queue:
        _, number = heapq.heappop(queue)
        active, least, known = waiting.pop(number)
        reach = bound[active] + margin[active]
        stay = least <= reach
        active, reach, least = active[stay], reach[stay], least[stay]
        if not len(active):
            continue
        page = pages[number]
        radius, entries = page["radius"], page["ids"]
        if known is None or exact:
            may = np.ones((len(active), len(entries)), bool)
        else:
            may = np.abs(known[stay][:, None] - page["parent"]) - radius <= reach[:, None]
        rows, columns = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
        if not len(rows):
            continue
        active, least, reach, may = active[rows], least[rows], reach[rows], may[np.ix_(rows, columns)]
        entries, x = entries[columns], page["x"][columns]
        products = products_of(vectors[active], x) if exact else vectors[active] @ x.T
        if page["leaf"]:
            i, j = np.nonzero(may & (products >= -best[active, -1:]) & (entries != query_ids[active][:, None]))
            merge_best(best, ids, active[i], -products[i, j].astype(np.int64), entries[j])
            if not exact:
                full = active[ids[active, -1] != NO_ROW]
                bound[full] = np.minimum(bound[full], np.sqrt(np.maximum(base[full] + 2.0 * best[full, -1], 0)))
            continue
        distance = np.sqrt(np.maximum(base[active][:, None] - 2.0 * products, 0))
        lower = np.maximum(distance - radius[columns], least[:, None])
        may &= lower <= reach[:, None]
        for j, child in enumerate(entries.tolist()):
            own = np.flatnonzero(may[:, j])
            if len(own):
                waiting[child] = (active[own], lower[own, j], distance[own, j])
                heapq.heappush(queue, (float(lower[own, j].min()), child))
    return best, ids


def search(pages: list[dict], query_id: int, q: np.ndarray, top: int, k: int, bound: float) -> list[tuple[int, int]]:
    """(score, id) of the k best entries of a tree for one query."""
    best, ids = search_block(pages, np.array([query_id]), q[None, :], top, k, np.array([bound]))
    return [(-int(s), int(i)) for s, i in zip(best[0], ids[0], strict=True) if i != NO_ROW]


# --- as Spark jobs --------------------------------------------------------------------------

def quantised(df: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """(vec_id, v: integers, norm2) of the rows that take part."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
    ints = F.transform("c", lambda x: F.floor(F.greatest(F.least(x * 256, F.lit(LARGEST)), F.lit(-LARGEST))))
    return (rows.filter("vec_id is not null and c is not null")
            .filter(F.forall("c", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
            .select("vec_id", ints.alias("v"))
            .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))


PAGE = "tree long, page int, leaf boolean, ids binary, x binary, radius binary, parent binary"


def page_rows(tree: int, pages: list[dict]) -> pa.Table:
    return pa.table({
        "tree": pa.array([tree] * len(pages), pa.int64()), "page": pa.array(range(len(pages)), pa.int32()),
        "leaf": pa.array([p["leaf"] for p in pages], pa.bool_()),
        "ids": pa.array([p["ids"].astype("<i8").tobytes() for p in pages], pa.binary()),
        "x": pa.array([p["x"].astype("<i8").tobytes() for p in pages], pa.binary()),
        "radius": pa.array([p["radius"].astype("<f8").tobytes() for p in pages], pa.binary()),
        "parent": pa.array([p["parent"].astype("<f8").tobytes() for p in pages], pa.binary())})


def flat_page(ids: np.ndarray, x: np.ndarray) -> list[dict]:
    """The one page of vectors that are too large for the metric."""
    return [{"leaf": True, "ids": ids, "x": x, "radius": np.zeros(len(ids)), "parent": np.zeros(len(ids))}]


def top_k(df: DataFrame, is_query: Column, k: int = K, vector: str = "embedding", vec_id: str = "vec_id",
          tree_rows: int = TREE_ROWS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of every row for which
    ``is_query`` (over ``vec_id``) holds, among all other rows."""
    spark = df.sparkSession
    ship_package(spark)
    vectors = numbered(quantised(df, vector, vec_id), "mtree-vectors")
    fits = F.col("norm2") <= LIMIT
    size = vectors.agg(F.count_if(fits).alias("n"), F.count_if(~fits).alias("large"), F.max(F.size("v")).alias("dim"),
                       F.max(F.when(fits, F.col("norm2"))).alias("top")).first()
    n, dim, top = size["n"], size["dim"] or 0, size["top"] or 0.0
    if not n and not size["large"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    tree_rows = max(256, min(tree_rows, (1 << 22) // max(dim, 1)))
    sample = vectors.filter(fits).orderBy(F.xxhash64("number"), "number") \
        .select("v").limit(min(PIVOTS, -(-n // tree_rows))).toArrow()["v"].combine_chunks()
    pivots = matrix(sample, dim) if len(sample) else np.zeros((0, dim), np.int64)
    lifted = spark.sparkContext.broadcast(lift(pivots, int(top)))  # at most PIVOTS rows

    def place(batches):
        routes = lifted.value
        for batch in batches:
            full = lift(matrix(batch.column("v"), dim), int(top))
            cell = np.argmax(full @ routes.T, axis=1)  # all lifted norms are equal
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "v", "number")), pa.array(cell), pa.array(apart(full, routes[cell]))],
                ["vec_id", "v", "number", "cell", "off"])

    dealt = vectors.filter(fits).select("vec_id", "v", "number").mapInArrow(
        place, "vec_id long, v array<long>, number long, cell long, off double")
    flat = vectors.filter(~fits).select("vec_id", "v", "number", F.lit(-1).cast("long").alias("cell"), F.lit(0.0).alias("off"))
    dealt = write_snapshot(dealt.union(flat), "mtree-dealt")
    cells = {r["cell"]: r for r in dealt.groupBy("cell").agg(
        F.ceil(F.count("*") / tree_rows).cast("long").alias("pieces"), F.max("off").alias("radius")).collect()}
    first_tree, trees = {}, 0
    for cell in sorted(cells):  # at most PIVOTS + 1; the flat pages come first
        first_tree[cell], trees = trees, trees + cells[cell]["pieces"]
    n_flat = cells[-1]["pieces"] if -1 in cells else 0
    placed = spark.createDataFrame([(c, first_tree[c], cells[c]["pieces"]) for c in cells], "cell long, first long, pieces long")
    dealt = dealt.join(F.broadcast(placed), "cell").select(
        "vec_id", "v", "number", (F.col("first") + F.pmod(F.xxhash64("number"), F.col("pieces"))).alias("tree"))

    def grown(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        tree, part = key[0].as_py(), part.sort_by("number")
        ids, x = part["vec_id"].to_numpy(), matrix(part["v"].combine_chunks(), dim)
        return page_rows(tree, flat_page(ids, x) if tree < n_flat else build_pages(ids, x, int(top)))

    pages = write_snapshot(dealt.groupBy("tree").applyInArrow(grown, PAGE), "mtree-pages")

    def answer(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        loaded, is_flat = [], own["tree"].iloc[0] < n_flat
        for p in own.sort_values("page").itertuples():
            found = np.frombuffer(p.ids, "<i8")
            loaded.append({"leaf": p.leaf, "ids": found, "x": np.frombuffer(p.x, "<i8").reshape(len(found), dim),
                           "radius": np.frombuffer(p.radius, "<f8"), "parent": np.frombuffer(p.parent, "<f8")})
        plain = [p | {"x": p["x"].astype(np.float64)} for p in loaded] if not is_flat else loaded
        out = []
        for exact in (False, True):
            mine = asked[(asked["norm2"] > LIMIT) | is_flat] if exact else asked[(asked["norm2"] <= LIMIT) & (not is_flat)]
            if not len(mine):
                continue
            q = np.frombuffer(b"".join(mine["q"]), "<i8").reshape(len(mine), dim)
            best, ids = search_block(loaded if exact else plain, mine["query_id"].to_numpy(), q, top, k,
                                     mine["bound"].to_numpy(), exact)
            i, j = np.nonzero(ids != NO_ROW)
            out.append(pd.DataFrame({"number": mine["number"].to_numpy()[i], "query_id": mine["query_id"].to_numpy()[i],
                                     "vec_id": ids[i, j], "score": -best[i, j]}))
        return pd.concat(out)

    found_type = "number long, query_id long, vec_id long, score long"
    asked_type = "number long, query_id long, tree long, q binary, norm2 double, bound double"

    def packed(batches):
        for batch in batches:
            q = matrix(batch.column("v"), dim)
            yield pa.RecordBatch.from_pydict({
                "number": batch.column("number"), "query_id": batch.column("vec_id"), "tree": batch.column("tree"),
                "q": pa.array([row.astype("<i8").tobytes() for row in q], pa.binary()),
                "norm2": pa.array((q.astype(np.float64) ** 2).sum(axis=1)), "bound": pa.array(np.full(len(q), np.inf))})

    queries = write_snapshot(dealt.filter(is_query).mapInArrow(packed, asked_type), "mtree-queries")
    asked = queries.count()
    first = write_snapshot(answered(pages, queries, answer, found_type, asked, block), "mtree-first")

    # the k-th best of a query's own tree bounds its search elsewhere
    kth = first.groupBy("number").agg(F.count("*").alias("m"), F.min("score").alias("last"))
    bound = F.when((F.col("m") >= k) & (F.col("norm2") <= LIMIT), F.sqrt(F.greatest(
        F.col("norm2") + top - 2.0 * F.col("last"), F.lit(0.0)))).otherwise(F.lit(float("inf")))
    bounded = queries.drop("bound").join(kth, "number", "left").withColumn("bound", bound)
    names = ["number", "query_id", "q", "norm2", "bound"]
    shared = spark.sparkContext.broadcast((pivots, [cells[c]["radius"] if c in cells else -1.0 for c in range(len(pivots))]))

    def spread(batches):
        routes, radius = shared.value
        for batch in batches:
            q = np.frombuffer(b"".join(batch.column("q").to_pylist()), "<i8").reshape(batch.num_rows, dim).astype(np.float64)
            base = batch.column("norm2").to_numpy() + top
            reach = batch.column("bound").to_numpy() + 1e-9 * (1 + np.sqrt(base))
            distance = np.sqrt(np.maximum(base[:, None] - 2.0 * (q @ routes.T.astype(np.float64)), 0))
            may = distance - np.array(radius) <= reach[:, None]
            own = batch.column("tree").to_numpy()
            for cell in sorted(cells):
                who = np.flatnonzero(may[:, cell]) if cell >= 0 else np.arange(batch.num_rows)
                for tree in range(first_tree[cell], first_tree[cell] + cells[cell]["pieces"]):
                    part = batch.take(pa.array(who[own[who] != tree]))
                    if part.num_rows:
                        yield pa.RecordBatch.from_arrays(
                            [*(part.column(c) for c in names), pa.array(np.full(part.num_rows, tree))], [*names, "tree"])

    sent = write_snapshot(bounded.mapInArrow(
        spread, "number long, query_id long, q binary, norm2 double, bound double, tree long"), "mtree-sent")
    rest = answered(pages, sent, answer, found_type, asked, block)
    return merged(first.unionByName(rest), [F.col("score").desc(), F.col("vec_id").asc()], k)


def op2_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest integer inner products of each 50th embedding with all others."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP2_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM c q JOIN c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
