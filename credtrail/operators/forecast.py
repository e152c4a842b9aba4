"""Period totals and forecasts for one or many series.

``trend``: least-squares line per series from ``regr_slope`` /
``regr_intercept`` (one aggregation, any number of series), residual
standard error from a second aggregation, 80 % interval.
``seasonal``: ridge fit of a linear trend plus yearly Fourier terms, for all
series at once: the sums of products that the normal equations need are one
aggregation by series, and the small systems are solved many to an Arrow
batch, so neither tasks nor groups grow with the number of series.
Future periods follow the frequency inferred from the raw labels
(quarter starts, month starts or days).
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credtrail.functions.periods import FREQ_MONTH, FREQ_QUARTER, infer_freq, parse_tax_period
from credtrail.session import ship_package, write_snapshot

Z80 = 1.2815515655446004  # two-sided 80 % normal interval
EPOCH = "1970-01-01"


def period_totals(df: DataFrame, period_col: str, value_col: str,
                  series_cols: list[str] | None = None) -> DataFrame:
    """SUM(value) per period label (and series), as ``y`` DOUBLE, in no order."""
    keys = list(series_cols or []) + [period_col]
    return df.groupBy(*keys).agg(F.sum(value_col).cast("double").alias("y"))


def _future(last_ds, freq, k):
    return (F.when(freq == FREQ_QUARTER, F.add_months(last_ds, 3 * k))
            .when(freq == FREQ_MONTH, F.add_months(last_ds, k))
            .otherwise(F.date_add(last_ds, k)))


def _history(df: DataFrame, series: list[str], period_col: str, value_col: str) -> DataFrame:
    return (df.select(*series, parse_tax_period(F.col(period_col)).alias("ds"),
                      F.col(value_col).cast("double").alias("y"))
            .filter(F.col("ds").isNotNull() & F.col("y").isNotNull()))


def forecast(df: DataFrame, series_cols: list[str], period_col: str, value_col: str = "y", *,
             horizon: int = 4, method: str = "trend", freq: str | None = None) -> DataFrame:
    """History + ``horizon`` future periods with yhat, yhat_lower, yhat_upper per series.

    The trend fit is one pass over the history partitioned by series: the
    least-squares line, the residual standard error and the last period are
    window aggregates over that partitioning, so the data is shuffled once.
    """
    one = not series_cols
    series = ["_series"] if one else list(series_cols)
    src = df.withColumn("_series", F.lit(0)) if one else df
    hist = _history(src, series, period_col, value_col)
    if method == "seasonal":
        out = _seasonal(hist, series, horizon, freq or infer_freq(df, period_col).first()["freq"])
        return out.drop("_series") if one else out
    w = Window.partitionBy(*series)
    x = F.datediff(F.col("ds"), F.lit(EPOCH)).cast("double")
    fitted = hist.select(
        *series, "ds", "y", x.alias("_x"),
        F.regr_slope(F.col("y"), x).over(w).alias("_b"),
        F.regr_intercept(F.col("y"), x).over(w).alias("_a"),
        F.avg("y").over(w).alias("_mean"), F.count(F.lit(1)).over(w).alias("_n"),
        F.max("ds").over(w).alias("_last"))
    # a single point (or constant x) has no slope: flat line at the mean
    fitted = fitted.withColumn("_a", F.coalesce("_a", "_mean")).withColumn(
        "_b", F.coalesce("_b", F.lit(0.0)))
    sq = F.pow(F.col("y") - (F.col("_a") + F.col("_b") * F.col("_x")), 2)
    fitted = fitted.withColumn(
        "_se", F.sqrt(F.sum(sq).over(w) / F.greatest(F.col("_n") - 2, F.lit(1)).cast("double")))
    # one row per series seeds the future periods
    seeds = fitted.filter(F.col("ds") == F.col("_last")).dropDuplicates(series)
    if freq is None:
        # the labels' frequency: one row from a global bool_or aggregation
        # (from the totals, not the facts), sent to every task
        seeds = seeds.crossJoin(F.broadcast(infer_freq(df, period_col).withColumnRenamed("freq", "_fq")))
    else:
        seeds = seeds.withColumn("_fq", F.lit(freq))
    steps = seeds.select(*series, "_a", "_b", "_se", "_last", "_fq",
                         F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_k"))
    future = steps.select(*series, _future(F.col("_last"), F.col("_fq"), F.col("_k")).alias("ds"),
                          "_a", "_b", "_se")
    allrows = fitted.select(*series, "ds", "_a", "_b", "_se").unionByName(future)
    yhat = F.col("_a") + F.col("_b") * F.datediff(F.col("ds"), F.lit(EPOCH)).cast("double")
    band = F.coalesce(F.col("_se"), F.lit(0.0)) * Z80
    out = allrows.select(*series, "ds", yhat.alias("yhat"), (yhat - band).alias("yhat_lower"),
                         (yhat + band).alias("yhat_upper")).orderBy(*series, "ds")
    return out.drop("_series") if one else out


FOURIER_ORDER = 3
RIDGE = 1e-3
YEAR = 365.25


def seasonal_design(ds: Column, start: Column, order: int = FOURIER_ORDER) -> list[Column]:
    """Columns of the seasonal fit: 1, years since ``start``, and sine and cosine of 1 to ``order``
    waves a year."""
    wave = F.dayofyear(ds) * F.lit(2 * math.pi / YEAR)
    waves = [f(wave * k) for k in range(1, order + 1) for f in (F.sin, F.cos)]
    return [F.lit(1.0), F.datediff(ds, start) / F.lit(YEAR), *waves]


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_s_{c}"]) for c in names])


def seasonal_coefficients(hist: DataFrame, series: list[str], ridge: float = RIDGE,
                          order: int = FOURIER_ORDER) -> DataFrame:
    """(series..., start, last, periods, beta): the ridge fit of every series of ``hist`` (series..., ds, y).

    The window for the first date and the sums share one shuffle by series. ``beta`` solves
    (X'X + ridge I) beta = X'y.
    """
    rows = hist.withColumn("start", F.min("ds").over(Window.partitionBy(*series)))
    x = seasonal_design(F.col("ds"), F.col("start"), order)
    k = len(x)
    rows = rows.select(*series, "ds", "y", "start", *[c.alias(f"x{i}") for i, c in enumerate(x)])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = rows.groupBy(*series).agg(
        F.first("start").alias("start"), F.max("ds").alias("last"), F.count(F.lit(1)).alias("periods"),
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"g{i}_{j}") for i, j in pairs],
        *[F.sum(F.col(f"x{i}") * F.col("y")).alias(f"b{i}") for i in range(k)])
    keep = [*series, "start", "last", "periods"]
    types = dict(sums.dtypes)

    def solve(batches):
        for batch in batches:
            gram = np.zeros((batch.num_rows, k, k))
            for i, j in pairs:
                gram[:, i, j] = gram[:, j, i] = batch.column(f"g{i}_{j}").to_numpy()
            right = np.stack([batch.column(f"b{i}").to_numpy() for i in range(k)], axis=1)
            beta = np.linalg.solve(gram + ridge * np.eye(k), right[:, :, None])[:, :, 0]
            offsets = pa.array(np.arange(0, k * (batch.num_rows + 1), k, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.ListArray.from_arrays(offsets, pa.array(beta.ravel()))], [*keep, "beta"])

    ship_package(hist.sparkSession)
    return sums.mapInArrow(solve, ", ".join(f"`{c}` {types[c]}" for c in keep) + ", beta array<double>")


def _seasonal(hist: DataFrame, series: list[str], horizon: int, freq: str) -> DataFrame:
    """History and future of every series with the fitted values and their band."""
    # read twice, by the fit and by the fitted values: totals have one row a series and period
    hist = write_snapshot(hist.select(*series, "ds", "y"), "seasonal-history")
    fits = write_snapshot(seasonal_coefficients(hist, series), "seasonal-fits")
    fits = fits.select(*[F.col(c).alias(f"_s_{c}") for c in series], F.col("start").alias("_start"), F.col("last").alias("_last"),
                       F.col("periods").alias("_n"), F.col("beta").alias("_beta"))
    design = seasonal_design(F.col("ds"), F.col("_start"))
    yhat = reduce(lambda a, b: a + b, [F.col("_beta")[i] * c for i, c in enumerate(design)])
    known = hist.join(fits, _same(hist, fits, series)).select(*series, "ds", "y", "_start", "_last", "_n", "_beta", yhat.alias("yhat"))
    spread = F.sum(F.pow(F.col("y") - F.col("yhat"), 2)).over(Window.partitionBy(*series))
    known = known.withColumn("_se", F.sqrt(spread / F.greatest(F.col("_n") - len(design), F.lit(1)).cast("double")))
    # one row of a series seeds its future periods
    seed = F.row_number().over(Window.partitionBy(*series).orderBy(F.col("ds").desc())) == 1
    known = known.withColumn("_seed", seed)
    k = F.explode(F.sequence(F.lit(0), F.when(F.col("_seed"), F.lit(horizon)).otherwise(F.lit(0))))
    out = known.withColumn("_k", k).withColumn("ds", F.when(F.col("_k") == 0, F.col("ds")).otherwise(
        _future(F.col("_last"), F.lit(freq), F.col("_k")))).withColumn("yhat", yhat)
    band = F.col("_se") * Z80
    return out.select(*series, "ds", "yhat", (F.col("yhat") - band).alias("yhat_lower"),
                      (F.col("yhat") + band).alias("yhat_upper")).orderBy(*series, "ds")
