"""Dashboard queries: KPI row, status breakdown, aging, histogram, top vendors, detail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credtrail.functions import scalars as S

HIST_BINS, HIST_LO, HIST_HI = 20, 0.0, 100.0


def filter_summary(ils: DataFrame, vrs: DataFrame, periods=(), risks=()) -> DataFrame:
    """Tax-period filter and risk-category filter (semi join); empty lists mean no filter."""
    out = ils
    if periods:
        out = out.filter(F.col("tax_period").isin(*periods))
    if risks:
        chosen = vrs.filter(F.col("risk_category").isin(*risks)).select("vendor_id")
        out = out.join(chosen, "vendor_id", "left_semi")
    return out


def d1_kpis(ils: DataFrame, vrs: DataFrame, periods=(), risks=()) -> DataFrame:
    s = filter_summary(ils, vrs, periods, risks)
    g = s.agg(F.coalesce(F.sum("total_itc_claimed"), F.lit(0)).cast("decimal(25,2)").alias("total_itc"),
              F.coalesce(F.sum("itc_matched"), F.lit(0)).cast("decimal(25,2)").alias("matched_itc"),
              F.coalesce(F.sum("itc_at_risk"), F.lit(0)).cast("decimal(25,2)").alias("at_risk_itc"))
    total = F.col("total_itc").cast("double")
    pct = F.when(total > 0, F.round(F.col("at_risk_itc").cast("double") / total * 100, 2)) \
           .otherwise(F.lit(0.0))
    return g.withColumn("leakage_pct", pct)


def d1_kpi_display(kpis: DataFrame) -> DataFrame:
    """The KPI row as display strings: thousands separators, two decimals, percent sign."""
    return kpis.select(*[S.money_text(c).alias(f"{c}_text")
                         for c in ("total_itc", "matched_itc", "at_risk_itc")],
                       F.concat(F.format_number("leakage_pct", 2), F.lit("%")).alias("leakage_pct_text"))


def d2_status_breakdown(irr: DataFrame) -> DataFrame:
    return (irr.filter(F.col("match_status").isNotNull()).groupBy("match_status")
            .agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc()))


def d3_at_risk_by_aging(ils: DataFrame) -> DataFrame:
    return (ils.filter(F.col("aging_bucket").isNotNull()).groupBy("aging_bucket")
            .agg(F.sum("itc_at_risk").cast("decimal(25,2)").alias("itc_at_risk"))
            .orderBy("aging_bucket"))


def d4_risk_histogram(vrs: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """Fixed-width bins over [0, 100]; a score of exactly 100 falls in the last bin."""
    width = (HIST_HI - HIST_LO) / bins
    score = F.col("vendor_risk_score").cast("double")
    b = F.least(F.lit(bins), F.greatest(F.lit(1), (F.floor((score - HIST_LO) / width) + 1)
                                       .cast("int")))
    return (vrs.filter(score.isNotNull()).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
        .select("bin", (HIST_LO + (F.col("bin") - 1) * width).alias("bin_start"),
                (HIST_LO + F.col("bin") * width).alias("bin_end"), "count")
        .orderBy("bin"))


def d5_top_vendors(ils: DataFrame, k: int = 10) -> DataFrame:
    g = ils.groupBy("vendor_id").agg(
        F.sum("total_itc_claimed").cast("decimal(25,2)").alias("total_itc_claimed"),
        F.sum("itc_at_risk").cast("decimal(25,2)").alias("itc_at_risk"),
        S.exact_avg(F.col("leakage_percentage")).alias("leakage_percentage"))
    return g.orderBy(F.col("itc_at_risk").desc(), "vendor_id").limit(k)


def d6_reconciliation_detail(irr: DataFrame) -> DataFrame:
    return irr
