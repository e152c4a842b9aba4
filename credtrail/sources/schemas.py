"""Declared table schemas (the store's DDL re-expressed as StructTypes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, I = T.StringType(), T.DateType(), T.IntegerType()
MONEY = T.DecimalType(15, 2)


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


VENDOR_MASTER = _struct(
    ("vendor_id", S), ("vendor_name", S), ("gstin", S), ("state", S),
    ("business_type", S), ("gst_status", S), ("registration_date", D),
    ("compliance_rating", T.DecimalType(5, 2)))

GSTR2B_DATA = _struct(
    ("gstr2b_id", S), ("supplier_gstin", S), ("invoice_number", S),
    ("invoice_date", D), ("tax_period", S), ("taxable_value", MONEY),
    ("igst", MONEY), ("cgst", MONEY), ("sgst", MONEY), ("filing_date", D),
    ("amendment_flag", T.ByteType()))

PURCHASE_REGISTER = _struct(
    ("purchase_invoice_id", S), ("vendor_id", S), ("supplier_gstin", S),
    ("invoice_number", S), ("invoice_date", D), ("tax_period", S),
    ("taxable_value", MONEY), ("igst", MONEY), ("cgst", MONEY), ("sgst", MONEY),
    ("total_tax", MONEY), ("payment_date", D), ("business_unit", S))

INVOICE_RECONCILIATION_RESULTS = _struct(
    ("reconciliation_id", S), ("purchase_invoice_id", S), ("gstr2b_id", S),
    ("match_status", S), ("mismatch_type", S), ("tax_difference", MONEY),
    ("tolerance_applied", T.ByteType()), ("reconciliation_date", D))

VENDOR_FILING_COMPLIANCE = _struct(
    ("record_id", S), ("vendor_id", S), ("gstin", S), ("tax_period", S),
    ("return_type", S), ("filing_date", D), ("delay_days", I),
    ("filing_status", S))

ITC_LEAKAGE_SUMMARY = _struct(
    ("vendor_id", S), ("tax_period", S), ("total_itc_claimed", MONEY),
    ("itc_matched", MONEY), ("itc_at_risk", MONEY),
    ("leakage_percentage", T.DecimalType(10, 2)), ("aging_bucket", S))

VENDOR_RISK_SCORES = _struct(
    ("vendor_id", S), ("mismatch_rate", T.DecimalType(5, 3)),
    ("filing_delay_frequency", T.DecimalType(5, 3)), ("gst_status_score", I),
    ("vendor_risk_score", T.DecimalType(5, 2)), ("risk_category", S))

# Parent tables first, the order in which a full load writes them.
TABLES: dict[str, T.StructType] = {
    "vendor_master": VENDOR_MASTER,
    "gstr2b_data": GSTR2B_DATA,
    "purchase_register": PURCHASE_REGISTER,
    "invoice_reconciliation_results": INVOICE_RECONCILIATION_RESULTS,
    "vendor_filing_compliance": VENDOR_FILING_COMPLIANCE,
    "itc_leakage_summary": ITC_LEAKAGE_SUMMARY,
    "vendor_risk_scores": VENDOR_RISK_SCORES,
}

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "vendor_master": ("vendor_id",),
    "gstr2b_data": ("gstr2b_id",),
    "purchase_register": ("purchase_invoice_id",),
    "invoice_reconciliation_results": ("reconciliation_id",),
    "vendor_filing_compliance": ("record_id",),
    "itc_leakage_summary": ("vendor_id", "tax_period"),
    "vendor_risk_scores": ("vendor_id",),
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("purchase_register", "vendor_id", "vendor_master", "vendor_id"),
    ("invoice_reconciliation_results", "purchase_invoice_id",
     "purchase_register", "purchase_invoice_id"),
    ("vendor_filing_compliance", "vendor_id", "vendor_master", "vendor_id"),
    ("itc_leakage_summary", "vendor_id", "vendor_master", "vendor_id"),
    ("vendor_risk_scores", "vendor_id", "vendor_master", "vendor_id"),
)


def cast_to_schema(df: DataFrame, table: str | T.StructType) -> DataFrame:
    """Project ``df`` onto a declared schema: same column order and types.

    Columns the frame lacks become typed NULLs (as a row store fills
    undeclared values). The casts are where DECIMAL rounding happens.
    """
    schema = TABLES[table] if isinstance(table, str) else table
    have = set(df.columns)
    cols: list[Column] = []
    for f in schema.fields:
        src = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(src.cast(f.dataType).alias(f.name))
    return df.select(*cols)
