"""The ten analytic insight queries, as DataFrame plans.

Where a query joins a fact table to a dimension and then groups by a
dimension attribute, the fact side is aggregated per key first (map-side
combined), so the join and the final grouping see one row per vendor or per
invoice instead of one row per fact. Distinct counts are exact whether or not the
declared primary keys hold (``sources.quality`` checks them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from credtrail.functions import scalars as S
from credtrail.functions.distinct import NUMBER, bitmaps, counted, with_numbers

MONEY_SUM = "decimal(25,2)"


def _msum(c) -> F.Column:
    return F.sum(c).cast(MONEY_SUM)


def i1_claimed_vs_matched(vm: DataFrame, ils: DataFrame, k: int = 20) -> DataFrame:
    """Top-k vendor-period rows by credit at risk, with names and the leakage ratio."""
    j = vm.select("vendor_id", "vendor_name", "state").join(ils, "vendor_id")
    return (j.orderBy(F.col("itc_at_risk").desc(), "vendor_id", "tax_period").limit(k)
            .select("vendor_name", "state", "total_itc_claimed", "itc_matched", "itc_at_risk",
                    S.pct("itc_at_risk", "total_itc_claimed").alias("leakage_percentage")))


def i2_top_leakage_vendors(vm: DataFrame, ils: DataFrame, k: int = 10) -> DataFrame:
    """Top-k vendors by summed credit at risk, with the mean leakage percentage."""
    per_vendor = ils.groupBy("vendor_id").agg(
        _msum("itc_at_risk").alias("total_leakage"),
        S.exact_avg(F.col("leakage_percentage")).alias("avg_leakage_percentage"))
    j = vm.select("vendor_id", "vendor_name", "gstin", "state").join(per_vendor, "vendor_id")
    return (j.orderBy(F.col("total_leakage").desc(), "vendor_id").limit(k)
            .select("vendor_name", "gstin", "state", "total_leakage", "avg_leakage_percentage"))


def i3_mismatch_rate_by_state(vm: DataFrame, pr: DataFrame, irr: DataFrame,
                              status: str = S.UNMATCHED, collation: str | None = None) -> DataFrame:
    """Per state: vendors, reconciliation ids with ``status``, and their share of all its ids.

    ``status='Mismatch'`` reproduces the literal the reference's SQL tests
    (a value the reconciliation never emits, so the count is 0). All counts are of distinct ids, also where
    ids repeat: both id counts come from bitmaps in one pass. ``collation``: how the status is compared.
    """
    rec = with_numbers(irr.select("purchase_invoice_id", "reconciliation_id", "match_status"), "reconciliation_id")
    rec = rec.select("purchase_invoice_id", NUMBER, F.coalesce(S.compared("match_status", collation) == status, F.lit(False)).alias("_is"))
    found = pr.select("purchase_invoice_id", "vendor_id").join(rec, "purchase_invoice_id")
    found = vm.select("vendor_id", "state").distinct().join(found, "vendor_id")
    names = {"mismatch_count": F.col("_is"), "_all": F.lit(True)}
    ids = counted(bitmaps(found, ["state"], names), ["state"], list(names))
    vendors = vm.groupBy(F.col("state").alias("_state")).agg(F.count_distinct("vendor_id").alias("total_vendors"))
    g = vendors.join(ids, vendors["_state"].eqNullSafe(ids["state"]), "left").select(
        F.col("_state").alias("state"), "total_vendors", F.coalesce("mismatch_count", F.lit(0)).cast("bigint").alias("mismatch_count"),
        F.coalesce("_all", F.lit(0)).alias("_all"))
    return (g.select("state", "total_vendors", "mismatch_count",
                     S.pct("mismatch_count", "_all").alias("mismatch_rate_percentage"))
            .orderBy(F.col("mismatch_rate_percentage").desc_nulls_last(), "state"))


def i4_filing_compliance_by_period(vfc: DataFrame, collation: str | None = None) -> DataFrame:
    status = S.compared("filing_status", collation)
    on_time = F.sum(F.when(status == "On Time", 1).otherwise(0))
    delayed = F.sum(F.when(status == "Delayed", 1).otherwise(0))
    g = vfc.groupBy("tax_period").agg(
        F.count(F.lit(1)).alias("total_filings"), on_time.cast("bigint").alias("on_time_filings"),
        delayed.cast("bigint").alias("delayed_filings"), F.avg("delay_days").alias("avg_delay_days"))
    return (g.withColumn("compliance_rate_percentage", S.pct("on_time_filings", "total_filings"))
            .orderBy(F.col("tax_period").desc()))


def i5_high_risk_vendors(vm: DataFrame, vrs: DataFrame, ils: DataFrame,
                         categories=("High", "Critical"), collation: str | None = None) -> DataFrame:
    """High-risk vendors, one row per vendor and leakage period (left join)."""
    risky = vrs.filter(S.compared("risk_category", collation).isin(*categories))
    j = (vm.select("vendor_id", "vendor_name", "gstin", "state").join(risky, "vendor_id")
         .join(ils.select("vendor_id", "itc_at_risk"), "vendor_id", "left"))
    return (j.select("vendor_name", "gstin", "state", "vendor_risk_score", "risk_category",
                     "mismatch_rate", "filing_delay_frequency", "itc_at_risk")
            .orderBy(F.col("vendor_risk_score").desc(), F.col("itc_at_risk").desc()))


def i6_leakage_by_period(ils: DataFrame) -> DataFrame:
    g = ils.groupBy("tax_period").agg(
        _msum("total_itc_claimed").alias("total_itc_claimed"),
        _msum("itc_matched").alias("total_itc_matched"),
        _msum("itc_at_risk").alias("total_leakage"))
    return (g.withColumn("overall_leakage_percentage",
                         S.pct("total_leakage", "total_itc_claimed"))
            .orderBy(F.col("tax_period").desc()))


def i7_delay_by_business_type(vm: DataFrame, vfc: DataFrame) -> DataFrame:
    per_vendor = vfc.groupBy("vendor_id").agg(
        F.sum("delay_days").alias("_s"), F.count("delay_days").alias("_c"),
        F.max("delay_days").alias("_max"), F.min("delay_days").alias("_min"))
    j = vm.select("vendor_id", "business_type").join(per_vendor, "vendor_id")
    g = j.groupBy("business_type").agg(
        F.count_distinct("vendor_id").alias("vendor_count"),
        F.try_divide(F.sum("_s").cast("double"), F.nullif(F.sum("_c"), F.lit(0)))
        .alias("avg_delay_days"),
        F.max("_max").alias("max_delay_days"), F.min("_min").alias("min_delay_days"))
    return g.orderBy(F.col("avg_delay_days").desc_nulls_last(), "business_type")


def i8_status_distribution(irr: DataFrame) -> DataFrame:
    """Rows, share of all rows, and summed / mean |tax difference| per status."""
    d = F.abs(F.col("tax_difference"))
    g = irr.groupBy("match_status").agg(
        F.count(F.lit(1)).alias("count"), _msum(d).alias("total_tax_difference"),
        S.exact_avg(d).alias("avg_tax_difference"))
    total = F.sum("count").over(Window.partitionBy())  # one row per status: tiny
    return (g.withColumn("percentage", S.pct(F.col("count"), total))
            .select("match_status", "count", "percentage", "total_tax_difference",
                    "avg_tax_difference")
            .orderBy(F.col("count").desc()))


def i9_risk_by_business_type(vm: DataFrame, vrs: DataFrame, ils: DataFrame) -> DataFrame:
    """Per business type; a vendor's score weighs once per leakage period (join fan-out)."""
    per_vendor = ils.groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("_k"), F.sum("itc_at_risk").alias("_risk"),
        F.sum("total_itc_claimed").alias("_claimed"))
    j = (vm.select("vendor_id", "business_type")
         .join(vrs.select("vendor_id", "vendor_risk_score"), "vendor_id", "left")
         .join(per_vendor, "vendor_id", "left"))
    w = F.greatest(F.coalesce(F.col("_k"), F.lit(0)), F.lit(1))
    score = F.col("vendor_risk_score")
    g = j.groupBy("business_type").agg(
        F.count_distinct("vendor_id").alias("vendor_count"),
        F.try_divide(F.sum(score * w).cast("double"),
                     F.nullif(F.sum(F.when(score.isNotNull(), w)), F.lit(0)))
        .alias("avg_risk_score"),
        _msum("_risk").alias("total_leakage"), F.sum("_claimed").alias("_claimed"))
    return (g.select("business_type", "vendor_count", "avg_risk_score", "total_leakage",
                     S.pct("total_leakage", "_claimed").alias("avg_leakage_percentage"))
            .orderBy(F.col("avg_risk_score").desc_nulls_last(), "business_type"))


def i10_monthly_trend(pr: DataFrame, irr: DataFrame, k: int = 12) -> DataFrame:
    """Latest k months: distinct invoices, claimed / matched / unmatched tax (fan-out kept).

    The join leaves the rows dealt by invoice id, so one row for each (id, month) is made without another
    shuffle, and counting those rows counts distinct ids.
    """
    per_invoice = (irr.filter(F.col("purchase_invoice_id").isNotNull())
                   .groupBy("purchase_invoice_id")
                   .agg(F.count(F.lit(1)).alias("_n"),
                        F.count_if(F.col("match_status") == S.MATCHED).alias("_nm"),
                        F.count_if(F.col("match_status") != S.MATCHED).alias("_nu")))
    j = pr.select("purchase_invoice_id", "invoice_date", "total_tax").join(
        per_invoice, "purchase_invoice_id", "left")
    t = F.col("total_tax")
    once = j.groupBy("purchase_invoice_id", F.date_format("invoice_date", "yyyy-MM").alias("month_year")).agg(
        F.sum(t * F.coalesce(F.col("_n"), F.lit(1))).alias("_claimed"),
        F.sum(t * F.coalesce(F.col("_nm"), F.lit(0))).alias("_matched"),
        F.sum(t * F.coalesce(F.col("_nu"), F.lit(0))).alias("_unmatched"))
    g = once.groupBy("month_year").agg(
        F.count("purchase_invoice_id").alias("total_invoices"),
        _msum("_claimed").alias("total_tax_claimed"), _msum("_matched").alias("matched_tax"),
        _msum("_unmatched").alias("unmatched_tax"))
    return (g.withColumn("monthly_leakage_percentage",
                         S.pct("unmatched_tax", "total_tax_claimed"))
            .orderBy(F.col("month_year").desc_nulls_last()).limit(k))
