"""Invoice reconciliation: purchase register vs. supplier filings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credtrail.functions import scalars as S
from credtrail.operators.bloom import anti_join
from credtrail.operators.ids import with_dense_ids
from credtrail.operators.joins import IN_LEFT, IN_RIGHT, full_outer_join
from credtrail.session import write_snapshot

JOIN_KEYS = ["supplier_gstin", "invoice_number"]
LEFT_SUFFIX, RIGHT_SUFFIX = "_pr", "_g2b"


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (dt.date, str)):
        return F.lit(as_of).cast("date")
    return as_of


def suffixed(df: DataFrame, suffix: str, shared: set[str]) -> DataFrame:
    """``df`` with the ``suffix`` on the column names that both sides have."""
    return df.select(*[F.col(c).alias(c + suffix if c in shared else c) for c in df.columns])


def merge_invoices(pr: DataFrame, g2b: DataFrame, *, normalize: bool = True,
                   hot_keys="auto", **join_opts) -> DataFrame:
    """Full outer merge on (supplier_gstin, invoice_number), NULL keys matching.

    Non-key columns present on both sides get ``_pr`` / ``_g2b`` suffixes.
    With ``normalize`` the invoice number is stripped and upper-cased on both
    sides first. Adds the indicator flags ``_in_left`` / ``_in_right``.
    """
    shared = (set(pr.columns) & set(g2b.columns)) - set(JOIN_KEYS)

    def side(df: DataFrame, suffix: str) -> DataFrame:
        out = suffixed(df, suffix, shared)
        if normalize:
            out = out.withColumn("invoice_number", S.normalize_invoice_number("invoice_number"))
        return out

    return full_outer_join(side(pr, LEFT_SUFFIX), side(g2b, RIGHT_SUFFIX), JOIN_KEYS,
                           hot_keys=hot_keys, **join_opts)


def classify(merged: DataFrame, *, tolerance: float = S.DEFAULT_TOLERANCE,
             time_bar_days: int = S.DEFAULT_TIME_BAR_DAYS) -> DataFrame:
    """Add match_status, mismatch_type and tax_difference to a merged frame.

    both sides:  |total_tax - (igst+cgst+sgst)| < tolerance -> Matched, else
                 Unmatched / Amount Mismatch (a NULL difference is a mismatch);
                 filed more than ``time_bar_days`` after the filed invoice
                 date -> type Time-Barred, status unchanged.
    one side:    Unmatched / Missing in GSTR2B (difference = total_tax) or
                 Missing in Purchase Register (difference = filed tax).
    """
    both = F.col(IN_LEFT) & F.col(IN_RIGHT)
    left_only = F.col(IN_LEFT) & ~F.col(IN_RIGHT)
    filed_tax = F.col("igst_g2b") + F.col("cgst_g2b") + F.col("sgst_g2b")
    diff = F.abs(F.col("total_tax") - filed_tax)
    within = diff < F.lit(tolerance)
    late = (F.col("filing_date").isNotNull() & F.col("invoice_date_g2b").isNotNull()
            & (F.datediff(F.col("filing_date"), F.col("invoice_date_g2b")) > time_bar_days))
    status = F.when(both & within, F.lit(S.MATCHED)).otherwise(F.lit(S.UNMATCHED))
    mtype = (F.when(both & late, F.lit(S.TIME_BARRED))
             .when(both, F.when(within, F.lit(S.NO_MISMATCH)).otherwise(F.lit(S.AMOUNT_MISMATCH)))
             .when(left_only, F.lit(S.MISSING_IN_GSTR2B))
             .otherwise(F.lit(S.MISSING_IN_PURCHASE_REGISTER)))
    tax_diff = F.when(both, diff).when(left_only, F.col("total_tax")).otherwise(filed_tax)
    return merged.select("*", status.alias("match_status"), mtype.alias("mismatch_type"),
                         tax_diff.alias("tax_difference"))


def reconcile_detail(pr: DataFrame, g2b: DataFrame, *, tolerance: float = S.DEFAULT_TOLERANCE,
                     time_bar_days: int = S.DEFAULT_TIME_BAR_DAYS, hot_keys="auto",
                     **join_opts) -> DataFrame:
    """Merged invoices + classification: one row per pair or unmatched row.

    This wide frame carries both sides' columns, so leakage and vendor
    features can aggregate it directly instead of re-joining the results
    table to the purchase register.
    """
    merged = merge_invoices(pr, g2b, normalize=True, hot_keys=hot_keys, **join_opts)
    return classify(merged, tolerance=tolerance, time_bar_days=time_bar_days)


def result_order() -> list[Column]:
    """Key order of a sorted outer merge, then the two row ids (a total order)."""
    return [F.col(c).asc_nulls_last()
            for c in ("supplier_gstin", "invoice_number", "purchase_invoice_id", "gstr2b_id")]


def results_from_detail(detail: DataFrame, *, as_of=None, with_ids: bool = True, written: bool = False) -> DataFrame:
    """Project the detail onto the reconciliation-results table.

    With ``with_ids`` the rows get ``REC0000000``-style ids numbered in
    key order (supplier_gstin, invoice number, then the two row ids), the
    order of a sorted outer merge. ``written``: the detail is a table already,
    or a join of arranged tables that needs no exchange.
    """
    out = detail.select(
        *JOIN_KEYS, "purchase_invoice_id", "gstr2b_id", "match_status", "mismatch_type",
        F.col("tax_difference").cast("decimal(15,2)").alias("tax_difference"),
        F.lit(None).cast("tinyint").alias("tolerance_applied"),
        _as_of(as_of).alias("reconciliation_date"))
    if with_ids:
        # the sort reads its input twice (sampling the ranges, then sorting): a narrow table is
        # written first, so that the join behind it runs once
        out = with_dense_ids(out if written else write_snapshot(out, "results-narrow"), result_order(), "reconciliation_id",
                             drop=JOIN_KEYS)
    else:
        out = out.withColumn("reconciliation_id", F.lit(None).cast("string"))
    return out.select("reconciliation_id", "purchase_invoice_id", "gstr2b_id", "match_status",
                      "mismatch_type", "tax_difference", "tolerance_applied",
                      "reconciliation_date")


def reconcile(pr: DataFrame, g2b: DataFrame, *, tolerance: float = S.DEFAULT_TOLERANCE,
              time_bar_days: int = S.DEFAULT_TIME_BAR_DAYS, as_of=None,
              with_ids: bool = True, hot_keys="auto", **join_opts) -> DataFrame:
    """Reconciliation results table (the reference's ``perform_reconciliation``)."""
    detail = reconcile_detail(pr, g2b, tolerance=tolerance, time_bar_days=time_bar_days,
                              hot_keys=hot_keys, **join_opts)
    return results_from_detail(detail, as_of=as_of, with_ids=with_ids)


def missing_in_filings(pr: DataFrame, g2b: DataFrame, *, bloom=None) -> DataFrame:
    """Purchase rows with no filing on the normalised key (anti join).

    Only existence matters, so the other side is reduced to its distinct keys
    first (combined map-side): a key repeated a million times is one row. With ``bloom="auto"`` a
    filter of those keys finds rows without a partner before the shuffle (``operators.bloom``).
    """
    l = pr.withColumn("_k", S.normalize_invoice_number("invoice_number"))
    r = g2b.select("supplier_gstin", S.normalize_invoice_number("invoice_number").alias("_rk"))
    return anti_join(l, ["supplier_gstin", "_k"], r, ["supplier_gstin", "_rk"], bloom=bloom).drop("_k")


def missing_in_register(pr: DataFrame, g2b: DataFrame, *, bloom=None) -> DataFrame:
    """Filed rows with no purchase row on the normalised key (anti join)."""
    return missing_in_filings(g2b, pr, bloom=bloom)


def fuzzy_matches(pr: DataFrame, g2b: DataFrame, **options) -> DataFrame:
    """The second pass of ``operators.matching``, which builds on this module."""
    from credtrail.operators.matching import fuzzy_matches as run

    return run(pr, g2b, **options)
