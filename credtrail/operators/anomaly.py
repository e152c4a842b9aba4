"""Transaction anomalies: the un-normalised merge, quantile rule, isolation forest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credtrail.operators.joins import IN_LEFT, IN_RIGHT
from credtrail.operators.quantiles import exact_quantiles
from credtrail.operators.reconcile import merge_invoices
from credtrail.session import write_snapshot

FEATURES = ["total_tax", "igst_g2b", "cgst_g2b", "sgst_g2b", "invoice_value_g2b"]
# The fallback rule's quantiles and the forest's parameters.
LOW_Q, HIGH_Q = 0.05, 0.95
TREES, SAMPLE_SIZE, CONTAMINATION, SEED = 100, 256, 0.1, 42


def anomaly_frame(pr: DataFrame, g2b: DataFrame, *, hot_keys="auto") -> DataFrame:
    """Full outer merge on the raw keys (invoice numbers NOT normalised) plus
    ``invoice_value_g2b`` = sum of the filed amounts, NULLs counted as 0."""
    m = merge_invoices(pr, g2b, normalize=False, hot_keys=hot_keys)
    parts = ["taxable_value_g2b", "igst_g2b", "cgst_g2b", "sgst_g2b"]
    total = None
    for p in parts:
        t = F.coalesce(F.col(p), F.lit(0))
        total = t if total is None else total + t
    return m.withColumn("invoice_value_g2b", total.cast("double"))


# the columns that the registered queries and their oracle compare
OUTPUT = ["supplier_gstin", "invoice_number", "purchase_invoice_id", "gstr2b_id", "total_tax",
          "igst_g2b", "cgst_g2b", "sgst_g2b", "invoice_value_g2b"]


def merged_table(pr: DataFrame, g2b: DataFrame, *, columns=None, hot_keys="auto") -> DataFrame:
    """The anomaly merge as a written table: it is read more than once, the join runs once."""
    frame = anomaly_frame(pr, g2b, hot_keys=hot_keys).drop(IN_LEFT, IN_RIGHT)
    return write_snapshot(frame.select(*columns) if columns else frame, "anomaly-merge")


def flag_by_quantiles(frame: DataFrame) -> DataFrame:
    """Score 0; flags total_tax above its 95th or below its 5th percentile (exact, NULLs
    skipped; a NULL total_tax is not flagged)."""
    lo, hi = exact_quantiles(frame, "total_tax", [LOW_Q, HIGH_Q])
    t = F.col("total_tax").cast("double")
    flag = F.coalesce((t > F.lit(hi)) | (t < F.lit(lo)), F.lit(False)) if lo is not None \
        else F.lit(False)
    return frame.withColumn("anomaly_score", F.lit(0.0)).withColumn("is_anomaly", flag)


def detect_anomalies(pr: DataFrame, g2b: DataFrame, model=None, *, columns=None,
                     hot_keys="auto") -> DataFrame:
    """The merged rows (all columns, or ``columns``) with anomaly_score and is_anomaly: from an
    isolation-forest model if given, else by the quantile rule."""
    frame = merged_table(pr, g2b, columns=columns, hot_keys=hot_keys)
    return model.transform(frame) if model is not None else flag_by_quantiles(frame)


def anomaly_summary(flagged: DataFrame) -> DataFrame:
    return flagged.agg(F.count_if(F.col("is_anomaly")).alias("anomalies"),
                       F.count(F.lit(1)).alias("rows"))


def _forest(trees, sample_size, contamination, seed):
    from credtrail.operators.isoforest import IsolationForest
    return IsolationForest(trees=trees, sample_size=sample_size, contamination=contamination,
                           seed=seed, features=FEATURES)


def train_isolation_forest(pr: DataFrame, g2b: DataFrame, *, trees: int = TREES,
                           sample_size: int = SAMPLE_SIZE, contamination: float = CONTAMINATION,
                           seed: int = SEED, hot_keys="auto"):
    frame = merged_table(pr, g2b, columns=OUTPUT, hot_keys=hot_keys)
    return _forest(trees, sample_size, contamination, seed).fit(frame)


def train_and_detect(pr: DataFrame, g2b: DataFrame, *, trees: int = TREES,
                     sample_size: int = SAMPLE_SIZE, contamination: float = CONTAMINATION,
                     seed: int = SEED, columns=None, hot_keys="auto"):
    """(model, flagged rows): one merge join and one scoring pass for both."""
    frame = merged_table(pr, g2b, columns=columns, hot_keys=hot_keys)
    forest = _forest(trees, sample_size, contamination, seed)
    model, scored = forest.fit_scored(frame, [*OUTPUT])
    return model, model.flag(scored)
