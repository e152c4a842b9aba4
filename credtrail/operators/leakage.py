"""Input-tax-credit leakage by vendor and tax period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credtrail.functions import scalars as S
from credtrail.operators.joins import IN_LEFT
from credtrail.operators.reconcile import _as_of


def _summarise(rows: DataFrame, as_of, vendor: str, period: str, inv_date: str) -> DataFrame:
    """Group (vendor, period) rows: sums, conditional sums, modal aging bucket.

    The mode of three buckets is taken from three conditional counts in the
    same aggregation (ties go to the smallest label), so one partial+final
    aggregation does everything and hot vendors are combined map-side.
    """
    age = F.datediff(_as_of(as_of), F.col(inv_date))
    bucket = S.aging_bucket(age)
    tax = F.col("total_tax")
    grouped = (rows.filter(F.col(vendor).isNotNull() & F.col(period).isNotNull())
               .groupBy(F.col(vendor).alias("vendor_id"), F.col(period).alias("tax_period"))
               .agg(F.coalesce(F.sum(tax), F.lit(0)).alias("total_itc_claimed"),
                    F.coalesce(F.sum(F.when(F.col("match_status") == S.MATCHED, tax)), F.lit(0))
                    .alias("itc_matched"),
                    F.coalesce(F.sum(F.when(F.col("match_status") == S.UNMATCHED, tax)), F.lit(0))
                    .alias("itc_at_risk"),
                    F.count_if(bucket == S.AGING_0_30).alias("_a"),
                    F.count_if(bucket == S.AGING_31_60).alias("_b"),
                    F.count_if(bucket == S.AGING_60_PLUS).alias("_c")))
    a, b, c = F.col("_a"), F.col("_b"), F.col("_c")
    mode = (F.when((a >= b) & (a >= c), F.lit(S.AGING_0_30))
            .when(b >= c, F.lit(S.AGING_31_60)).otherwise(F.lit(S.AGING_60_PLUS)))
    claimed = F.col("total_itc_claimed").cast("double")
    pct = F.col("itc_at_risk").cast("double") / S.one_if_zero(claimed) * 100
    return grouped.select("vendor_id", "tax_period", "total_itc_claimed", "itc_matched",
                          "itc_at_risk", pct.alias("leakage_percentage"),
                          mode.alias("aging_bucket"))


def itc_leakage(pr: DataFrame, rec: DataFrame, as_of=None) -> DataFrame:
    """Leakage from the purchase register and the stored reconciliation results.

    pr LEFT JOIN results on purchase_invoice_id (an invoice matched by two
    filings counts twice, as in the reference).
    """
    r = rec.select("purchase_invoice_id", "match_status")
    rows = pr.select("purchase_invoice_id", "vendor_id", "tax_period", "invoice_date",
                     "total_tax").join(r, "purchase_invoice_id", "left")
    return _summarise(rows, as_of, "vendor_id", "tax_period", "invoice_date")


def itc_leakage_from_detail(detail: DataFrame, as_of=None) -> DataFrame:
    """Same result from the reconciliation detail, without a second join.

    Every purchase row appears in the detail once per matching filing (or
    once, unmatched), exactly the rows of pr LEFT JOIN results.
    """
    rows = detail.filter(F.col(IN_LEFT))
    return _summarise(rows, as_of, "vendor_id", "tax_period_pr", "invoice_date_pr")
