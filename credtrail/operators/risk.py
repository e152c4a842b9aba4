"""Vendor features, rule-based and random-forest risk scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credtrail.functions import scalars as S
from credtrail.operators import forest
from credtrail.operators.joins import IN_LEFT
from credtrail.session import write_snapshot

FEATURES = ["gst_status_score", "total_invoices", "unmatched_count", "avg_tax_diff",
            "total_tax_diff", "std_tax_diff", "mismatch_rate", "total_filings", "late_count",
            "avg_delay", "max_delay", "filing_delay_rate", "total_volume", "avg_transaction",
            "transaction_count", "std_transaction"]

# Weights of the rule score and of the synthetic training target.
W_MISMATCH, W_DELAY, W_STATUS = 40.0, 30.0, 0.3
NOISE_SD = 5.0


def _mismatch(rec_vendor: DataFrame) -> DataFrame:
    d = F.col("tax_difference")
    return (rec_vendor.filter(F.col("vendor_id").isNotNull()).groupBy("vendor_id")
            .agg(F.count("purchase_invoice_id").alias("total_invoices"),
                 F.count_if(F.col("match_status") == S.UNMATCHED).alias("unmatched_count"),
                 S.exact_avg(d).alias("avg_tax_diff"),
                 F.sum(d).cast("double").alias("total_tax_diff"),
                 F.stddev_samp(d.cast("double")).alias("std_tax_diff")))


def _filing(comp: DataFrame) -> DataFrame:
    return (comp.filter(F.col("vendor_id").isNotNull()).groupBy("vendor_id")
            .agg(F.count("record_id").alias("total_filings"),
                 F.count_if(F.col("filing_status") == S.LATE_FILING).alias("late_count"),
                 F.avg("delay_days").alias("avg_delay"),
                 F.max("delay_days").alias("max_delay")))


def _volume(pr: DataFrame) -> DataFrame:
    t = F.col("total_tax")
    return (pr.filter(F.col("vendor_id").isNotNull()).groupBy("vendor_id")
            .agg(F.sum(t).cast("double").alias("total_volume"),
                 S.exact_avg(t).alias("avg_transaction"),
                 F.count(t).alias("transaction_count"),
                 F.stddev_samp(t.cast("double")).alias("std_transaction")))


def _combine(vm: DataFrame, mismatch: DataFrame, filing: DataFrame, volume: DataFrame) -> DataFrame:
    """vendor_master LEFT JOIN the three per-vendor aggregates, NULL -> 0.

    Each aggregate has one row per vendor, so these joins are dimension-sized;
    AQE turns them into broadcast joins when the measured size allows.
    """
    base = vm.select("vendor_id", S.gst_status_score("gst_status").alias("gst_status_score"))
    out = (base.join(mismatch, "vendor_id", "left").join(filing, "vendor_id", "left")
           .join(volume, "vendor_id", "left"))
    out = out.select(
        "vendor_id", "gst_status_score",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
          for c in ["avg_tax_diff", "total_tax_diff", "std_tax_diff", "avg_delay",
                    "total_volume", "avg_transaction", "std_transaction"]],
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
          for c in ["total_invoices", "unmatched_count", "total_filings", "late_count",
                    "max_delay", "transaction_count"]])
    out = out.withColumn("mismatch_rate", F.col("unmatched_count").cast("double")
                         / S.one_if_zero(F.col("total_invoices")).cast("double"))
    out = out.withColumn("filing_delay_rate", F.col("late_count").cast("double")
                         / S.one_if_zero(F.col("total_filings")).cast("double"))
    return out.select("vendor_id", *FEATURES)


def vendor_features(vm: DataFrame, rec: DataFrame, comp: DataFrame, pr: DataFrame) -> DataFrame:
    """The 16 per-vendor features from the stored tables (results LEFT JOIN register)."""
    prv = pr.select("vendor_id", "purchase_invoice_id", "total_tax")
    rec_vendor = rec.join(prv.select("purchase_invoice_id", "vendor_id"),
                          "purchase_invoice_id", "left")
    return _combine(vm, _mismatch(rec_vendor), _filing(comp), _volume(prv))


def vendor_features_from_detail(vm: DataFrame, detail: DataFrame, comp: DataFrame,
                                pr: DataFrame) -> DataFrame:
    """Same features with the mismatch part read off the reconciliation detail."""
    rec_vendor = detail.filter(F.col(IN_LEFT)).select(
        "vendor_id", "purchase_invoice_id", "match_status",
        F.col("tax_difference").cast("decimal(15,2)").alias("tax_difference"))
    return _combine(vm, _mismatch(rec_vendor), _filing(comp),
                    _volume(pr.select("vendor_id", "total_tax")))


def rule_score(features: DataFrame) -> Column:
    return (F.col("mismatch_rate") * 100 * (W_MISMATCH / 100)
            + F.col("filing_delay_rate") * 100 * (W_DELAY / 100)
            + F.col("gst_status_score") * W_STATUS)


def gaussian_noise(key: Column, seed: int, sd: float = NOISE_SD) -> Column:
    """N(0, sd) noise from two hashes of ``key`` (Box-Muller).

    Depends only on the row's key and the seed, so it is identical however
    the data is partitioned or recomputed.
    """
    m = float(1 << 53)
    u1 = (F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 53)).cast("double") + 1.0) / (m + 1.0)
    u2 = F.pmod(F.xxhash64(key, F.lit(seed + 1)), F.lit(1 << 53)).cast("double") / m
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2) * sd


def with_synthetic_target(features: DataFrame, seed: int = 42, noise_sd: float = NOISE_SD) -> DataFrame:
    """Training target: clip(rule score + N(0, noise_sd) noise, 0, 100)."""
    raw = (F.col("mismatch_rate") * W_MISMATCH + F.col("filing_delay_rate") * W_DELAY
           + F.col("gst_status_score") * W_STATUS + gaussian_noise(F.col("vendor_id"), seed, noise_sd))
    return features.withColumn("synthetic_risk", S.clip(raw, 0.0, 100.0))


# The learner's limits, as parameters: 30 is the greatest depth the library grows (its default
# of 5 would cut the trees); 256 bins put a split between any two values of up to 256 distinct
# ones, and at 256 quantiles of more.
MAX_DEPTH, MAX_BINS = 30, 256


def in_test(seed: int = 42, test_fraction: float = 0.2) -> Column:
    """The held-out fifth of the vendors, by a hash of the id (stable under repartitioning)."""
    return F.pmod(F.xxhash64(F.col("vendor_id"), F.lit(seed)), F.lit(1000)) < int(test_fraction * 1000)


def train_risk_model(features: DataFrame, *, seed: int = 42, num_trees: int = 100,
                     max_depth: int = MAX_DEPTH, max_bins: int = MAX_BINS, test_fraction: float = 0.2,
                     method: str = "auto"):
    """Random forest on the 16 features; returns (model, scored).

    ``method``: "tasks" grows every tree in one task over features that fit an executor
    (``operators.forest``), "distributed" is MLlib's learner; "auto" takes tasks where they fit.
    ``scored`` has every vendor's features, ``synthetic_risk``, ``prediction`` and ``in_test``;
    ``held_out_mse(scored)`` is the held-out error. The features are written as a table first: the
    learner reads them many times.
    """
    if method not in ("auto", "tasks", "distributed"):
        raise ValueError(f"unknown method {method!r}")
    data = write_snapshot(with_synthetic_target(features, seed)
                          .withColumn("in_test", in_test(seed, test_fraction)), "risk-features")
    known = data.filter("not in_test")
    if method == "tasks" or (method == "auto" and 0 < (n := known.count()) and forest.fits_rows(n, len(FEATURES))):
        model = forest.train_forest(known, FEATURES, "synthetic_risk", seed=seed, num_trees=num_trees,
                                    max_depth=max_depth, max_bins=max_bins)
        return model, model.transform(data)

    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="features_vec"),
        RandomForestRegressor(featuresCol="features_vec", labelCol="synthetic_risk",
                              numTrees=num_trees, maxDepth=max_depth, maxBins=max_bins, seed=seed,
                              featureSubsetStrategy="all", subsamplingRate=1.0)])
    model = pipe.fit(known)
    return model, model.transform(data)


def held_out_mse(scored: DataFrame) -> DataFrame:
    """One row: mean squared error over the held-out vendors (NULL without any)."""
    error = F.col("synthetic_risk") - F.col("prediction")
    return scored.filter("in_test").agg(F.avg(error * error).alias("mse"))


def score_vendors(features: DataFrame, model=None) -> DataFrame:
    """vendor_risk_score from the model if given, else the weighted rule; plus category."""
    if model is not None or "prediction" in features.columns:  # scored already, or score now
        scored = features if "prediction" in features.columns else model.transform(features)
        scored = scored.withColumn("vendor_risk_score", F.col("prediction"))
        scored = scored.drop("prediction", "features_vec", "synthetic_risk", "in_test")
    else:
        scored = features.withColumn("vendor_risk_score", rule_score(features))
    return scored.withColumn("risk_category", S.risk_category("vendor_risk_score")) \
                 .withColumn("filing_delay_frequency", F.col("filing_delay_rate"))


def risk_table(scored: DataFrame) -> DataFrame:
    """The six stored columns of the vendor risk table."""
    return scored.select("vendor_id", "mismatch_rate", "filing_delay_frequency",
                         "gst_status_score", "vendor_risk_score", "risk_category")
