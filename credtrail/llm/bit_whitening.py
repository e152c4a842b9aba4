"""Operator 12: whitening of embeddings from a bit-sliced scatter matrix.

Every component c becomes the integer x = floor(64 * c) + 1000000. The covariance of the x needs the
sums of all products of two dimensions. For a batch of rows each dimension is shifted to begin at 0
and cut into bit planes, and a plane of all rows is packed into 64-bit words. Then

    sum of u_i * u_j = sum over planes a of i, b of j: 2^(a+b) * popcount(plane a AND plane b),

which is exact in integers; the shifts are put back by the dimensions' sums. Planes without a one
are left out, so a batch costs what its own range of values needs.

Batches add up in their task, tasks in one aggregation by pair of dimensions (numbers are cut
into limbs of ``LIMB`` bits, so their sums are exact as well). The driver gets dim^2 sums whatever the
number of rows, centres them as integers, n * sum(x_i x_j) - S_i S_j, and only then divides by n^2
and calls eigh. A second pass projects the rows and measures the covariance of what came out.

Rows of ``embeddings`` are independent in all steps: no shuffle carries vectors, and no key is hot.

Defined cases: vectors that are null or hold null or non-finite components are dropped, rows without
id are not; shorter vectors count as padded with zeros (an empty one as all zeros); repeated rows each
count. A component without variance (its eigenvalue is below dim * 2^-52 of the largest; always so
with one row or equal rows) has ``whitened`` null and takes no part in ``identity_error``, which is null if
no component has variance, as ``explained`` is. An x of more than 2^62 either way, which may not fit a
long, counts as 2^62. ``deviation`` is null where it does not fit a long. An empty table gives no
rows. Only the id and the vector are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credtrail.llm.common import read_table, ship_package, write_snapshot

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
ROWS = 8192
LIMB = 40
LONG = 2 ** 63 - 1
LARGEST = 2 ** 62


# --- exact sums of products -----------------------------------------------------------------

def matrix_of(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column of longs as a matrix; missing entries are ``SHIFT``, the zero."""
    off = column.offsets.to_numpy().astype(np.int64)
    off = off - off[0]
    out = np.full((len(column), dim), SHIFT, np.int64)
    n = np.diff(off)
    row = np.repeat(np.arange(len(column)), n)
    out[row, np.arange(off[-1]) - np.repeat(off[:-1], n)] = column.flatten().to_numpy()
    return out


def planes_of(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(planes x words, dimension of each plane, bit of each plane) of a matrix of integers from 0;
    bit k of a word is a row."""
    rows, dim = u.shape
    words = -(-rows // 64)
    out, dims, bits = [], [], []
    columns = np.zeros((dim, words * 64), np.uint64)
    columns[:, :rows] = u.T.astype(np.uint64)
    occupied = np.bitwise_or.reduce(columns, axis=1)
    for bit in range(int(occupied.max()).bit_length() if dim else 0):
        has = np.flatnonzero((occupied >> np.uint64(bit)) & np.uint64(1))
        ones = ((columns[has] >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        out.append(np.packbits(ones, axis=1, bitorder="little").view(np.uint64))
        dims.append(has)
        bits.append(np.full(len(has), bit))
    if not out:
        return np.zeros((0, words), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(dims), np.concatenate(bits)


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, sums of products) of the columns of an integer matrix, as Python integers."""
    rows, dim = x.shape
    low = x.min(axis=0)
    high = x.max(axis=0)
    if int((high.astype(object) - low).max()) > LONG:  # the shifted values need a sign bit more
        wide = x.astype(object)
        return wide.sum(axis=0), wide.T.dot(wide)
    planes, dims, bits = planes_of(x - low)
    top = 2 * int(bits.max(initial=0)) + int(rows).bit_length() + 2
    kind = np.int64 if top + 2 * dim.bit_length() < 63 else object
    products = np.zeros((dim, dim), kind)
    sums = np.zeros(dim, kind)
    counts = np.bitwise_count(planes).sum(axis=1, dtype=np.int64)
    np.add.at(sums, dims, counts.astype(kind) * (np.array([1 << int(b) for b in bits], kind)))
    weights = np.array([1 << int(b) for b in bits], kind)
    for p in range(len(planes)):
        both = np.bitwise_count(planes[p:] & planes[p]).sum(axis=1, dtype=np.int64).astype(kind)
        both = both * weights[p:] * weights[p]
        np.add.at(products, (dims[p], dims[p:]), both)
        np.add.at(products, (dims[p + 1:], dims[p]), both[1:])
    low, sums, products = low.astype(object), sums.astype(object), products.astype(object)
    cross = np.outer(low, sums)
    return sums + rows * low, products + cross + cross.T + rows * np.outer(low, low)


def limbs_of(value: int) -> list[int]:
    """Limbs of LIMB bits; the last has the sign."""
    return [value & ((1 << LIMB) - 1), (value >> LIMB) & ((1 << LIMB) - 1), value >> (2 * LIMB)]


def from_limbs(limbs) -> int:
    return sum(int(v) << (LIMB * i) for i, v in enumerate(limbs))


# --- as Spark jobs --------------------------------------------------------------------------

def integers(df: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """(vec_id, x: longs) of the rows that take part."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return (rows.filter("v is not null")
            .filter(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
            .select("vec_id", F.transform("v", lambda c: F.floor(
                F.greatest(F.least(c * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))) + SHIFT).alias("x")))


def pieces(batches, dim: int):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, matrix_of(part.column("x"), dim)


def sums_of(rows: DataFrame, dim: int) -> tuple[list[int], list[list[int]]]:
    """Exact (sums, sums of products) over all rows."""
    def run(batches):
        total, products = np.zeros(dim, object), np.zeros((dim, dim), object)
        for _, x in pieces(batches, dim):
            s, p = scatter(x - SHIFT)
            total, products = total + s, products + p
        for i in range(dim):
            cells = [total[i], *products[i, i:]]
            limbs = np.array([limbs_of(int(v)) for v in cells], object)
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(np.full(len(cells), i, np.int32)),
                "j": pa.array(np.array([-1, *range(i, dim)], np.int32)),
                **{f"l{k}": pa.array([int(v) for v in limbs[:, k]], pa.int64()) for k in range(3)}})

    parts = rows.select("x").mapInArrow(run, "i int, j int, l0 long, l1 long, l2 long")
    got = parts.groupBy("i", "j").agg(*[F.sum(F.col(f"l{k}").cast("decimal(20,0)")).alias(f"l{k}") for k in range(3)])
    total, products = [0] * dim, [[0] * dim for _ in range(dim)]
    for r in got.collect():  # dim^2 rows
        value = from_limbs((r["l0"], r["l1"], r["l2"]))
        if r["j"] < 0:
            total[r["i"]] = value
        else:
            products[r["i"]][r["j"]] = products[r["j"]][r["i"]] = value
    return total, products


def decompose(n: int, total: list[int], products: list[list[int]], components: int):
    """(eigenvalues, unit eigenvectors in rows, shares of the trace), by falling eigenvalue. The
    numerators n * sum(x_i x_j) - S_i S_j are integers; one division rounds each of them."""
    dim = len(total)
    cov = np.array([[(n * products[i][j] - total[i] * total[j]) / (n * n) for j in range(dim)] for i in range(dim)],
                   float).reshape(dim, dim)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    trace = cov.trace()
    return np.maximum(values[order], 0), vectors[:, order].T, (values[order] / trace if trace > 0 else None)


def projection(total: list[int], n: int, values: np.ndarray, vectors: np.ndarray):
    """A function from integer rows to (whitened, deviation or None)."""
    dim = len(total)
    solid = values > values.max(initial=0) * dim * 2.0 ** -52
    scaled = np.where(solid[:, None], vectors, 0.0) / np.sqrt(np.where(solid, values, 1.0))[:, None]
    sums = np.array(total, object)

    def project(x: np.ndarray):
        y = x - SHIFT
        reach = n * max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0)))) + max(map(abs, total), default=0)
        if dim * reach * reach <= LONG:
            centred = n * y - np.array(total, np.int64)
            deviation = (centred * centred).sum(axis=1).tolist()
        else:
            centred = n * y.astype(object) - sums
            deviation = [v if v <= LONG else None for v in (int(sum(r * r)) for r in centred)]
        return (centred / n).astype(float) @ scaled.T, deviation

    return project, solid


def whitened(df: DataFrame, components: int = COMPONENTS, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row that takes
    part and each of the first ``components`` components."""
    spark = df.sparkSession
    ship_package(spark)
    rows = write_snapshot(integers(df, vector, vec_id), "white-rows")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dim")).first()
    n, dim = size["n"], size["dim"] or 0
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    if not n or not dim:
        return spark.createDataFrame([], schema)
    total, products = sums_of(rows, dim)
    values, vectors, explained = decompose(n, total, products, components)
    project, solid = projection(total, n, values, vectors)
    shared = spark.sparkContext.broadcast((total, values, vectors))  # components x dim numbers
    k = len(values)

    def measure(batches):
        project, _ = projection(shared.value[0], n, *shared.value[1:])
        first, second = np.zeros(k), np.zeros((k, k))
        for _, x in pieces(batches, dim):
            w, _ = project(x)
            first += w.sum(axis=0)
            second += w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(np.concatenate([np.arange(k), i]).astype(np.int32)),
            "j": pa.array(np.concatenate([np.full(k, -1), j]).astype(np.int32)),
            "s": pa.array(np.concatenate([first, second[i, j]]))})

    got = {(r["i"], r["j"]): r["s"] for r in rows.select("x").mapInArrow(measure, "i int, j int, s double")
           .groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}  # components^2 rows
    kept = np.flatnonzero(solid).tolist()
    error = max((abs(got[i, j] / n - got[i, -1] * got[j, -1] / n / n - (i == j)) for i in kept for j in kept if i <= j),
                default=None)

    def project_rows(batches):
        project, solid = projection(shared.value[0], n, *shared.value[1:])
        for part, x in pieces(batches, dim):
            for at in range(0, len(x), 1024):
                w, deviation = project(x[at:at + 1024])
                m = len(w)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": part.column("vec_id").slice(at, m).take(pa.array(np.repeat(np.arange(m), k))),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    "n": pa.array(np.full(m * k, n)),
                    "deviation": pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    "whitened": pa.array(w.ravel(), mask=np.tile(~solid, m)),
                    "explained": pa.array(np.tile(explained, m) if explained is not None else [None] * (m * k), pa.float64()),
                    "identity_error": pa.array([error] * (m * k), pa.float64())})

    return rows.mapInArrow(project_rows, schema)


def op12_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened ``embeddings`` in their first 32 components."""
    return whitened(read_table(spark, sf_dir, "embeddings"))
