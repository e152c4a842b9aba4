"""Exact quantiles (linear interpolation) without gathering values in one task.

``percentile()`` keeps every distinct value of its input in one buffer on
the final task; at cluster scale that is unbounded. Here the distinct values
are counted (map-side combined), range-partitioned and sorted, and written as
a table in the checkpoint folder; the driver receives one row per partition (its size)
and then one row per requested rank.

Where a stated rank error is enough, ``quantile_sketches`` makes KLL sketches in one pass without a
sort: a few kilobytes for each group, built in the tasks that read the rows and merged. They can be
stored and merged again, so a quantile over many periods needs no second look at their rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credtrail.operators.ids import sorted_snapshot


def sketch_size(rank_error: float) -> int:
    """The sketch parameter k whose rank error stays within ``rank_error`` of the number of rows with
    99 % confidence (2.446 / k^0.9433, for a pair of ranks, as the KLL sketch states it)."""
    if not 0.0002 <= rank_error < 1:
        raise ValueError("a rank error from 0.0002 to 1 can be had; use the exact quantiles below that")
    return max(8, math.ceil((2.446 / rank_error) ** (1 / 0.9433)))


def _numbers(df: DataFrame, col: str | Column, by: list[str]) -> DataFrame:
    c = F.col(col) if isinstance(col, str) else col
    return df.select(*by, c.cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))


def quantile_sketches(df: DataFrame, col: str | Column, by: list[str] | None = None, rank_error: float = 0.005) -> DataFrame:
    """(by..., sketch): a mergeable sketch of the non-NULL values of each group."""
    by = list(by or [])
    return _numbers(df, col, by).groupBy(*by).agg(F.kll_sketch_agg_double("v", F.lit(sketch_size(rank_error))).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: list[str] | None = None, rank_error: float = 0.005) -> DataFrame:
    """(by..., sketch): sketches of parts merged into those of coarser groups."""
    return sketches.groupBy(*(by or [])).agg(F.kll_merge_agg_double("sketch", F.lit(sketch_size(rank_error))).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: list[float]) -> DataFrame:
    """``sketches`` with ``n`` (rows seen) and ``quantiles`` (one value for each of ``probs``; values that occur)."""
    n = F.kll_sketch_get_n_double("sketch")
    values = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probs])
    return sketches.withColumn("n", n).withColumn("quantiles", F.when(n > 0, values)).drop("sketch")


def exact_quantiles(df: DataFrame, col: str | Column, probs: list[float], *, approximate: bool = False,
                    rank_error: float = 0.005) -> list[float | None]:
    """Quantiles of the non-NULL values of ``col``: x[k] + (x[k+1] - x[k]) * frac,
    with rank position (n - 1) * p, the pandas/NumPy 'linear' rule.

    ``approximate``: values whose rank is off by at most ``rank_error`` of the rows, from one sketch."""
    c = F.col(col) if isinstance(col, str) else col
    if approximate:
        row = sketch_quantiles(quantile_sketches(df, c, [], rank_error), probs).first()
        return list(row["quantiles"]) if row and row["quantiles"] else [None for _ in probs]
    vals = df.select(c.cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    counts = vals.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    ordered = sorted_snapshot(counts, [F.col("v")]).withColumnRenamed("_pid", "pid")
    sizes = sorted((r["pid"], r["s"]) for r in
                   ordered.groupBy("pid").agg(F.sum("n").alias("s")).collect())
    total = sum(s for _, s in sizes)
    if total == 0:
        return [None for _ in probs]
    start_of, acc = {}, 0
    for pid, size in sizes:
        start_of[pid] = (acc, size)
        acc += size
    ranks = set()
    for p in probs:
        pos = (total - 1) * p
        ranks.update({math.floor(pos), math.ceil(pos)})
    wanted = {pid: st for pid, (st, size) in start_of.items()
              if any(st <= k < st + size for k in ranks)}
    # one job: running counts inside the (few) partitions that hold a wanted
    # rank; each window partition is one range partition, bounded in size
    starts = F.create_map(*[x for pid, st in wanted.items() for x in (F.lit(pid), F.lit(st))])
    part = ordered.filter(F.col("pid").isin(list(wanted)))
    w = Window.partitionBy("pid").orderBy("v").rowsBetween(Window.unboundedPreceding,
                                                           Window.currentRow)
    cum = part.withColumn("_end", F.sum("n").over(w) + starts[F.col("pid")])
    cum = cum.withColumn("_begin", F.col("_end") - F.col("n"))
    hit = F.lit(False)
    for k in ranks:
        hit = hit | ((F.col("_begin") <= k) & (F.lit(k) < F.col("_end")))
    found = [(r["_begin"], r["_end"], r["v"]) for r in cum.filter(hit).collect()]

    def value_at(k: int) -> float:
        return next(v for b, e, v in found if b <= k < e)

    out = []
    for p in probs:
        pos = (total - 1) * p
        lo, hi = math.floor(pos), math.ceil(pos)
        a, b = value_at(lo), value_at(hi)
        out.append(a + (b - a) * (pos - lo))
    return out
