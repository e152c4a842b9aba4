"""Operator 8: benchmark decontamination by size-partitioned MinHash containment search.

A short test item inside a long document has a tiny Jaccard similarity with it, so whole-document
sketches would miss it. Items are therefore partitioned by size: class ``c`` holds the items with
up to u = 2^c distinct five-word shingles (and more than half of that), and for each class that
occurs, documents are read as overlapping windows of two neighbouring blocks of u shingles.
Any stretch of u shingles lies in one window whole, and an item of the class that has at least
0.8 of its shingles there has a Jaccard similarity of at least 0.8 q / (2u + 0.2 q), 0.19 for the
smallest q of a class, with that window. ``HASHES`` minima (one a band) then miss it with a
probability below 0.81^64 = 1.4e-6. Block minima of a class are the minima of pairs of blocks of
the class below, so one pass of ``HASHES`` hashes serves all sizes.

Candidates are confirmed exactly: the item's shingles that occur in the document's full set, as a
share of the item's. ``THRESHOLD`` 0.8 of them make a hit. Words are runs of anything but white
space, with A-Z lower-cased.

The items' sketches and sets are indexed by Spark tasks in parts of about ``INDEX_BYTES``, each a file in
the shared folder; the driver only has the paths. Every task searches its documents in pieces of up to
``PIECE_BYTES`` of text against one part after the other, and holds one part at a time, so no item is
left out and memory stays bounded. Documents are not shuffled.

Defined cases: null, empty and wordless documents have no hits, and such items are never found;
very long documents and items are read whole (a longer item makes a longer part);
an item with fewer than five words is one shingle of all its words, so only a document with
exactly those words contains it. Repeated items are all reported, repeated documents each. Columns
named ``hits`` are replaced; all others pass through.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credtrail.llm.common import open_shared, read_table, scratch_path, ship_package, slices, write_shared, write_snapshot
from credtrail.llm.words import mix, shingle_rows

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 64
INDEX_BYTES = 64 << 20
PIECE_BYTES = 16 << 20

_XOR = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_MUL = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def size_class(n: int) -> int:
    """The class of an item with n shingles: the smallest c with n <= 2^c."""
    return max(int(n) - 1, 0).bit_length()


def build_index(items: list[tuple[object, np.ndarray]]) -> dict:
    """Sketches of (item_id, distinct sorted shingles): for each class and hash the sorted
    minima, where the items of each begin in the list of members, the members, and which leading
    16 bits occur."""
    sizes = np.array([len(own) for _, own in items], np.int64)
    full = np.flatnonzero(sizes)
    bands: dict = {}
    if not len(full):
        return {"items": items, "classes": [], "bands": bands}
    flat = np.concatenate([items[i][1] for i in full])
    begin = np.cumsum(sizes[full]) - sizes[full]
    of_class = np.array([size_class(n) for n in sizes[full]])
    classes = sorted(set(of_class.tolist()))
    for k in range(HASHES):
        low = np.minimum.reduceat((flat ^ _XOR[k]) * _MUL[k], begin)
        for c in classes:
            members, minima = full[of_class == c], low[of_class == c]
            order = np.argsort(minima, kind="stable")
            keys, starts = np.unique(minima[order], return_index=True)
            near = np.zeros(1 << 16, bool)
            near[keys >> np.uint64(48)] = True
            bands[c, k] = (keys, np.append(starts, len(order)), members[order], near)
    return {"items": items, "classes": classes, "bands": bands}


def candidates(rows: list[np.ndarray], index: dict) -> set[tuple[int, int]]:
    """(row, item) pairs of which some window shares a minimum with the item."""
    sizes = np.array([len(x) for x in rows], np.int64)
    found: set[tuple[int, int]] = set()
    if not sizes.sum() or not index["classes"]:
        return found
    flat = np.concatenate(rows)
    levels = []  # for each class: where its blocks begin in the level below, and their row
    below = sizes
    step = 1 << index["classes"][0]
    for n, c in enumerate(index["classes"]):
        if n:
            step = 1 << (c - index["classes"][n - 1])
        blocks = -(-below // step)
        row = np.repeat(np.arange(len(rows)), blocks)
        ends = np.cumsum(blocks)
        inner = np.arange(ends[-1]) - np.repeat(ends - blocks, blocks)
        begin = np.repeat(np.cumsum(below) - below, blocks) + inner * step
        levels.append((c, begin, row, np.flatnonzero(row[1:] == row[:-1])))
        below = blocks
    for k in range(HASHES):
        low = (flat ^ _XOR[k]) * _MUL[k]
        for c, begin, row, paired in levels:
            low = np.minimum.reduceat(low, begin)
            window = low.copy()
            window[paired] = np.minimum(low[paired], low[paired + 1])
            keys, starts, members, near = index["bands"][c, k]
            likely = np.flatnonzero(near[window >> np.uint64(48)])
            at = np.searchsorted(keys, window[likely])
            same = keys[np.minimum(at, len(keys) - 1)] == window[likely]
            for r, g in np.unique(np.stack([row[likely[same]], at[same]], axis=1), axis=0).tolist():
                found.update((r, i) for i in members[starts[g]:starts[g + 1]].tolist())
    return found


def confirmed(rows: list[np.ndarray], index: dict, threshold: float = THRESHOLD):
    """Per row its hits (item position, shared shingles, shingles of the item)."""
    hits: list = [[] for _ in rows]
    full: dict = {}
    for r, i in sorted(candidates(rows, index)):
        if r not in full:
            full = {r: np.unique(rows[r])}
        own = index["items"][i][1]
        at = np.searchsorted(full[r], own)
        shared = int((full[r][np.minimum(at, len(full[r]) - 1)] == own).sum())
        if shared >= threshold * len(own) - 1e-9:
            hits[r].append((i, shared, len(own)))
    return hits


def item_sets(benchmark: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(item_id, n, shingles) of the items that have words."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [np.unique(x) for x in shingle_rows(part.column("text"), SHINGLE)]
                yield pa.RecordBatch.from_pydict({
                    "item_id": part.column("item_id"), "n": pa.array([len(x) for x in sets], pa.int64()),
                    "shingles": pa.array([x.tobytes() for x in sets], pa.binary())})

    ship_package(benchmark.sparkSession)
    return benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).mapInArrow(
        run, "item_id long, n long, shingles binary").filter("n > 0")


def index_parts(benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> list[str]:
    """Files that hold all items with words, each about ``index_bytes`` of sets and sketches; a part is made by one task."""
    spark = benchmark.sparkSession
    items = write_snapshot(item_sets(benchmark), "bench-items")
    total = items.agg(F.sum(8 * F.col("n") + 16 * HASHES)).first()[0] or 0
    parts = int(total // index_bytes) + 1
    folder = scratch_path(spark, "bench-index")

    def write(key: tuple[pa.Scalar, ...], own: pa.Table) -> pa.Table:
        rows = sorted(zip(own["item_id"].to_pylist(), own["shingles"].to_pylist(), strict=True),
                      key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        out = io.BytesIO()
        np.savez(out, ids=np.array([0 if i is None else i for i, _ in rows], np.int64),
                 null=np.array([i is None for i, _ in rows]), sizes=np.array([len(s) // 8 for _, s in rows], np.int64),
                 shingles=np.frombuffer(b"".join(s for _, s in rows), np.uint64))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()),
                         "path": pa.array([write_shared(folder, ".items.npz", [out.getvalue()])])})

    # an item goes to a part by its own content and, as it may repeat, by its row
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id", "shingles", F.monotonically_increasing_id()), F.lit(parts))
                             .cast("int"))
    made = write_snapshot(dealt.groupBy("part").applyInArrow(write, "part int, path string"), "bench-parts")
    return [r["path"] for r in made.orderBy("part").collect()]


def read_index(path: str) -> dict:
    with open_shared(path) as f:
        held = np.load(io.BytesIO(f.read_at(f.size(), 0)))
    flat, ends = held["shingles"], np.cumsum(held["sizes"])
    ids = [None if z else int(i) for i, z in zip(held["ids"], held["null"], strict=True)]
    return build_index([(i, flat[e - n:e]) for i, e, n in zip(ids, ends.tolist(), held["sizes"].tolist(), strict=True)])


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", threshold: float = THRESHOLD,
         index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``docs`` with ``hits``: the items each whole document contains
    (item_id, n_shared, n_item)."""
    ship_package(docs.sparkSession)
    paths = index_parts(benchmark, index_bytes)
    keep = [f for f in docs.schema.fields if f.name != "hits"]
    names = [f.name for f in keep]
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("n_shared", pa.int32()), ("n_item", pa.int32())]))

    def run(batches):
        held: dict = {}
        for batch in batches:
            for part in slices(batch, text, PIECE_BYTES if len(paths) > 1 else 4 << 20):
                rows = shingle_rows(part.column(text), SHINGLE)
                hits: list = [[] for _ in rows]
                for path in paths:
                    if path not in held:
                        held.clear()
                        held[path] = read_index(path)
                    for own, found in zip(hits, confirmed(rows, held[path], threshold), strict=True):
                        own += [{"item_id": held[path]["items"][i][0], "n_shared": n, "n_item": size} for i, n, size in found]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(hits, kind)], [*names, "hits"])

    spans = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("n_shared", T.IntegerType()),
                                      T.StructField("n_item", T.IntegerType())]))
    return docs.select(*names).mapInArrow(run, T.StructType([*keep, T.StructField("hits", spans)]))


def op8_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair of which the document contains 0.8 of the item's
    five-word shingles."""
    marked = mark(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", F.explode("hits").alias("hit")).select(
        "doc_id", "hit.item_id", F.col("hit.n_shared").cast("long").alias("n_shared"),
        F.col("hit.n_item").cast("long").alias("n_item"))


#: The same pairs by an exact join of all shingles.
OP8_SQL = r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark),
s AS (
  SELECT DISTINCT side, id, unnest(CASE WHEN len(ws) >= 5
    THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    ELSE [array_to_string(ws, ' ')] END) AS g
  FROM w WHERE len(ws) > 0),
n AS (SELECT id, count(*) AS n_item FROM s WHERE side = 'b' GROUP BY id),
x AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared
  FROM s d JOIN s b ON d.side = 'd' AND b.side = 'b' AND d.g = b.g GROUP BY ALL)
SELECT x.doc_id, x.item_id, x.n_shared, n.n_item FROM x JOIN n ON n.id = x.item_id
WHERE x.n_shared >= 0.8 * n.n_item
"""
