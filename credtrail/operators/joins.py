"""Null-safe full outer equi-join that stays balanced when keys are hot.

A full outer sort-merge join cannot be split by AQE's skew handling, and the
pairs of a key with many rows on both sides can outgrow its input bytes by
orders of magnitude, which AQE does not look at. So hot keys are found first
(exact counts of key hashes over a Bernoulli sample of the key columns), and
their rows take a path of their own:

* pairs: a grid of ``a`` x ``b`` cells per hot key, sized from the estimated
  number of pairs. A left row goes to one of ``a`` slices and is copied to all
  ``b`` cells of it, a right row the reverse, so each pair meets in exactly one
  cell, and no cell has more than about ``pairs_per_cell`` pairs;
* rows without a partner: anti joins against the other side's distinct hot
  keys, one row a key.

All other keys go through one plain full outer sort-merge join. Which keys take
the hot path never changes the result: each key's rows go wholly to one path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credtrail.session import write_snapshot

IN_LEFT, IN_RIGHT = "_in_left", "_in_right"
_HASH, _HASH2, _A, _B = "_key_hash", "_key_hash2", "_cells_a", "_cells_b"
_SLICE_A, _SLICE_B = "_slice_a", "_slice_b"
MIN_HOT_ROWS = 200_000       # rows of a key on both sides
MIN_HOT_PAIRS = 20_000_000   # pairs of a key
PAIRS_PER_CELL = 2_000_000
SAMPLE = 0.01
BROADCAST_KEYS = 500_000     # hot keys (32 bytes each) that are broadcast; more are joined by shuffle
MAX_CELLS = 100_000


def _cond(left: DataFrame, right: DataFrame, keys, rkeys) -> Column:
    return reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(right[rk]) for k, rk in zip(keys, rkeys)])


def hot_keys_of(left: DataFrame, right: DataFrame, keys: list[str], *, min_rows: int = MIN_HOT_ROWS,
                min_pairs: int = MIN_HOT_PAIRS, fraction: float = SAMPLE, seed: int = 17,
                pairs_per_cell: int = PAIRS_PER_CELL) -> DataFrame:
    """(_key_hash, _cells_a, _cells_b) of the keys estimated to hold at least ``min_rows`` rows
    or to make ``min_pairs`` pairs.

    The thresholds are absolute, so a key is found whatever its share of the data is. The
    counts are an aggregation over the sampled key hashes; the list stays a table.
    """
    def counts(side: DataFrame, name: str) -> DataFrame:
        return (side.select(*keys).sample(fraction=fraction, seed=seed)
                .groupBy(F.xxhash64(*keys).alias(_HASH)).agg(F.count(F.lit(1)).alias(name)))

    both = counts(left, "nl").join(counts(right, "nr"), _HASH, "full").fillna(0, ["nl", "nr"])
    nl, nr = F.col("nl") / fraction, F.col("nr") / fraction
    hot = both.filter(((nl + nr) >= min_rows) | (nl * nr >= min_pairs))
    cells = F.greatest(F.ceil(nl * nr / pairs_per_cell), F.lit(1))
    a = F.greatest(F.lit(1), F.ceil(F.sqrt(cells * nl / F.greatest(nr, F.lit(1.0)))))
    a = F.least(a, cells)
    return hot.select(_HASH, a.cast("int").alias(_A), F.ceil(cells / a).cast("int").alias(_B))


_none_hot: set[tuple] = set()


def _known_cold(left: DataFrame, right: DataFrame, keys: list[str], options: tuple) -> tuple:
    """What names a pair of inputs: their plans down to the files. Only the finding that no key is hot is
    kept, and it only saves the sample: the result is the same on either path."""
    app = left.sparkSession.sparkContext.applicationId
    return (app, left.select(*keys).semanticHash(), right.select(*keys).semanticHash(), options)


def _split(left: DataFrame, right: DataFrame, keys, rkeys, hot_keys) -> dict | None:
    """Cold and hot rows of both sides and the hot pairs; None if no key is hot."""
    if hot_keys is None:
        return None
    hot = write_snapshot(hot_keys, "hot-keys")
    size = hot.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(_A) * F.col(_B)).alias("cells")).first()
    if not size["n"]:
        return None
    small = size["n"] <= BROADCAST_KEYS

    def bounded(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    def tagged(df: DataFrame, own) -> DataFrame:
        hashed = df.withColumn(_HASH, F.xxhash64(*own)).withColumn(_HASH2, F.xxhash64(F.lit(1), *own))
        return hashed.join(bounded(hot), _HASH, "left")

    def copies(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    l_all, r_all = tagged(left, keys), tagged(right, rkeys)
    extra = [_HASH, _HASH2, _A, _B]
    l_hot, r_hot = (x.filter(F.col(_A).isNotNull()) for x in (l_all, r_all))
    cell = [_HASH, _HASH2, _SLICE_A, _SLICE_B]
    n_cells = int(min(max(size["cells"], 1), MAX_CELLS))
    l_grid = l_hot.withColumn(_SLICE_A, F.pmod(F.xxhash64(*left.columns), F.col(_A)).cast("int")) \
        .withColumn(_SLICE_B, copies(_B)).drop(_A, _B).repartition(n_cells, *cell)
    r_grid = r_hot.withColumn(_SLICE_B, F.pmod(F.xxhash64(*right.columns), F.col(_B)).cast("int")) \
        .withColumn(_SLICE_A, copies(_A)).drop(_A, _B).repartition(n_cells, *cell)
    return {
        "l_cold": l_all.filter(F.col(_A).isNull()).drop(*extra),
        "r_cold": r_all.filter(F.col(_A).isNull()).drop(*extra),
        "l_hot": l_hot.drop(*extra), "r_hot": r_hot.drop(*extra),
        # 128 bits of hash stand for the key: the join keeps the partitioning of the grid
        "pairs": l_grid.join(r_grid, cell, "inner").drop(*cell),
        # one row a hot key
        "l_known": bounded(l_hot.select(*keys).distinct()), "r_known": bounded(r_hot.select(*rkeys).distinct())}


def inner_join(left: DataFrame, right: DataFrame, keys: list[str], rkeys: list[str], *,
               min_hot_rows: int = MIN_HOT_ROWS, min_hot_pairs: int = MIN_HOT_PAIRS,
               pairs_per_cell: int = PAIRS_PER_CELL, sample_fraction: float = SAMPLE) -> DataFrame:
    """Inner join of ``left.keys`` = ``right.rkeys`` (no NULLs in them) whose hot keys go through
    the grid. Column names of the two sides must be disjoint."""
    renamed = right.select(*[F.col(rk).alias(k) for k, rk in zip(keys, rkeys)])
    hot = hot_keys_of(left, renamed, keys, min_rows=min_hot_rows, min_pairs=min_hot_pairs,
                      fraction=sample_fraction, pairs_per_cell=pairs_per_cell)
    parts = _split(left, right, keys, rkeys, hot)
    l, r = (left, right) if parts is None else (parts["l_cold"], parts["r_cold"])
    cold = l.join(r, reduce(lambda a, b: a & b, [l[k] == r[rk] for k, rk in zip(keys, rkeys)]), "inner")
    return cold if parts is None else cold.unionByName(parts["pairs"])


def full_outer_join(left: DataFrame, right: DataFrame, keys: list[str], *,
                    hot_keys="auto", min_hot_rows: int = MIN_HOT_ROWS,
                    min_hot_pairs: int = MIN_HOT_PAIRS, pairs_per_cell: int = PAIRS_PER_CELL,
                    sample_fraction: float = SAMPLE) -> DataFrame:
    """Full outer join on ``keys`` with NULL matching NULL (``<=>``).

    Non-key column names of the two sides must be disjoint. The output has
    the coalesced keys, all other columns, and boolean ``_in_left`` /
    ``_in_right`` flags (the merge indicator).

    ``hot_keys``: ``"auto"`` to detect, ``None`` for a plain join, or a frame
    as ``hot_keys_of`` returns it.
    """
    rkeys = [f"_r_{k}" for k in keys]
    lt = left.withColumn(IN_LEFT, F.lit(True))
    rt = right.select(*[F.col(k).alias(rk) for k, rk in zip(keys, rkeys)],
                      *[c for c in right.columns if c not in keys]).withColumn(
        IN_RIGHT, F.lit(True))
    lcols = [c for c in lt.columns if c not in keys]
    rcols = [c for c in rt.columns if c not in rkeys]

    def finish(df: DataFrame) -> DataFrame:
        return df.select(
            *[F.coalesce(F.col(k), F.col(rk)).alias(k) for k, rk in zip(keys, rkeys)],
            *[c for c in lcols if c != IN_LEFT], *[c for c in rcols if c != IN_RIGHT],
            F.coalesce(F.col(IN_LEFT), F.lit(False)).alias(IN_LEFT),
            F.coalesce(F.col(IN_RIGHT), F.lit(False)).alias(IN_RIGHT))

    pair = None
    if isinstance(hot_keys, str) and hot_keys == "auto":
        pair = _known_cold(left, right, keys, (min_hot_rows, min_hot_pairs, pairs_per_cell, sample_fraction))
        hot_keys = None if pair in _none_hot else hot_keys_of(
            left, right, keys, min_rows=min_hot_rows, min_pairs=min_hot_pairs,
            fraction=sample_fraction, pairs_per_cell=pairs_per_cell)
    parts = _split(lt, rt, keys, rkeys, hot_keys)
    if parts is None:
        if pair is not None:
            _none_hot.add(pair)
        return finish(lt.join(rt, _cond(lt, rt, keys, rkeys), "full"))
    l_cold, r_cold, l_hot, r_hot = (parts[x] for x in ("l_cold", "r_cold", "l_hot", "r_hot"))
    cold = l_cold.join(r_cold, _cond(l_cold, r_cold, keys, rkeys), "full")
    l_only = l_hot.join(parts["r_known"], _cond(l_hot, parts["r_known"], keys, rkeys), "left_anti")
    r_only = r_hot.join(parts["l_known"], _cond(r_hot, parts["l_known"], rkeys, keys), "left_anti")
    hot_part = (parts["pairs"].unionByName(l_only, allowMissingColumns=True)
                .unionByName(r_only, allowMissingColumns=True))
    return finish(cold.unionByName(hot_part, allowMissingColumns=True))
