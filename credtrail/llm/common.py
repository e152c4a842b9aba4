"""Small helpers the training-data operators share: table access, folds, shared files,
bounded byte slices of Arrow batches, and connected components over link tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credtrail.session import scratch_path, ship_package, write_snapshot

__all__ = ["TwoGenerationCache", "connected_components", "fold_of", "open_shared", "read_table",
           "scratch_path", "ship_package", "slices", "text_bytes", "write_shared", "write_snapshot"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``folds``; a null id falls into fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


# --- files in the shared folder ------------------------------------------------------------

def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def write_shared(folder: str, suffix: str, chunks) -> str:
    """Write one new file of the shared folder from byte chunks; returns its path.

    Every attempt takes a name of its own, so a retried or speculative task never touches a
    committed file: readers only open the paths that the committed manifest names.
    """
    path = f"{folder}/{uuid.uuid4().hex}{suffix}"
    filesystem, inner = _filesystem(path)
    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(inner, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
    return path


def open_shared(path: str):
    """A seekable Arrow file: ``size()`` and ``read_at(n, offset)`` read byte ranges."""
    filesystem, inner = _filesystem(path)
    return filesystem.open_input_file(inner)


# --- Arrow batches -------------------------------------------------------------------------

def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column as one array, and the n + 1 row offsets into it.

    Null rows count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32,
                        len(column) + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` with at most ``limit`` bytes of ``column`` each (a longer
    single row makes a slice of its own), so that work arrays stay small."""
    _, off = text_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(off, off[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


class TwoGenerationCache(dict):
    """A bounded dictionary: when it is full, it becomes the old generation, whose entries
    move up as they are used again. ``make(missing keys)`` returns their values."""

    def __init__(self, limit: int, make):
        super().__init__()
        self.limit, self.make, self.old = limit, make, {}

    def values_of(self, keys: list) -> list:
        missing = []
        for key in [k for k in keys if k not in self]:
            if key in self.old:
                self[key] = self.old[key]
            else:
                missing.append(key)
        if missing:
            self.update(zip(missing, self.make(missing), strict=True))
        out = list(map(self.__getitem__, keys))
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
        return out


# --- connected components ------------------------------------------------------------------

def connected_components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node
    that can be reached.

    Each round every node takes the smallest label among itself and its neighbours, then the
    label's own label (pointer jumping), and the labels are written as a table, so lineage
    stays short and a lost executor costs one round. Labels never leave the executors; the
    driver reads one count a round.
    """
    both = write_snapshot(links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
                          .filter("a <> b"), "cc-links")
    labels = write_snapshot(both.groupBy(F.col("a").alias("node"))
                            .agg(F.least(F.col("node"), F.min("b")).alias("component")), "cc-labels")
    for _ in range(max_rounds):
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("component")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        near = write_snapshot(
            labels.join(near, "node")
            .select("node", F.col("component").alias("was"),
                    F.least("component", "near").alias("component")), "cc-near")
        jump = near.select(F.col("node").alias("component"), F.col("component").alias("further"))
        new = write_snapshot(
            near.join(jump, "component", "left")
            .select("node", "was", F.least(F.col("component"), F.col("further")).alias("component")),
            "cc-labels")
        if new.filter("component <> was").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
