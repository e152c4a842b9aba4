"""Adapter: derive the reconciliation input tables from the TPC-H-like test tables.

The derivation (FIXTURES.md section 2) turns every (order, supplier, line)
of ``lineitem`` into one purchase invoice and, depending on a deterministic
code ``h`` in 0..99, a matching, altered, amended or missing supplier filing,
so that every reconciliation branch occurs at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMEND_CODE = 19  # h value whose filing is amended (second filing row)


def _s(c) -> Column:
    return F.col(c).cast("string")


def _cents_to_money(c) -> Column:
    return (F.col(c).cast("double") / 100).cast("decimal(15,2)")


def _vendor_id(suppkey: str) -> Column:
    return F.concat(F.lit("V"), F.lpad(_s(suppkey), 7, "0"))


def _gstin(nationkey: str, suppkey: str) -> Column:
    return F.concat(F.lpad(_s(nationkey), 2, "0"), F.lit("GST"), F.lpad(_s(suppkey), 10, "0"))


def vendor_dim(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Supplier joined to its nation, with the vendor-master columns.

    ``nation`` is the fixed 25-row TPC-H nation list, so broadcasting it is
    bounded at every scale factor.
    """
    s = supplier.select("s_suppkey", "s_name", "s_nationkey")
    n = F.broadcast(nation.select("n_nationkey", "n_name"))
    j = s.join(n, s["s_nationkey"] == n["n_nationkey"])
    k = F.col("s_suppkey")
    return j.select(
        "s_suppkey", "s_nationkey",
        _vendor_id("s_suppkey").alias("vendor_id"),
        F.col("s_name").alias("vendor_name"),
        _gstin("s_nationkey", "s_suppkey").alias("gstin"),
        F.col("n_name").alias("state"),
        F.when(k % 4 == 0, "Manufacturer").when(k % 4 == 1, "Trader")
         .when(k % 4 == 2, "Service Provider").otherwise("Wholesaler").alias("business_type"),
        F.when(k % 10 == 7, "Cancelled").when(k % 10 == 8, "Suspended")
         .when(k % 10 == 9, "Inactive").when(k % 10 == 6, "Unknown")
         .otherwise("Active").alias("gst_status"),
        F.lit("1990-01-01").cast("date").alias("registration_date"),
        ((k % 500).cast("double") / 100).cast("decimal(5,2)").alias("compliance_rating"))


VENDOR_COLUMNS = ["vendor_id", "vendor_name", "gstin", "state", "business_type",
                  "gst_status", "registration_date", "compliance_rating"]


def vendor_master(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return vendor_dim(supplier, nation).select(*VENDOR_COLUMNS)


def invoice_sums(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per (order, supplier, line) of a known supplier, in the few numbers that all else follows from.

    ``parts``: lines are dealt to so many parts before they are summed. Few lines share a key, so sums by the
    tasks that read the lines save nothing, and they spill where such a task's lines don't fit in memory."""
    keys = ["l_orderkey", "l_suppkey", "l_linenumber"]
    li = lineitem.select(*keys, "l_shipdate",
                         F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("taxable"),
                         F.round(F.col("l_tax") * 100).cast("bigint").alias("tax_rate"))
    g = (li.repartition(parts, *keys) if parts else li).groupBy(*keys).agg(
        F.min("l_shipdate").cast("date").alias("invoice_date"),
        F.sum("taxable").alias("taxable_p"),
        F.max("tax_rate").alias("rate"))
    v = vendor_dim(supplier, nation).select("s_suppkey", "s_nationkey")
    return g.join(v, g["l_suppkey"] == v["s_suppkey"]).drop("s_suppkey")


def invoice_columns(sums: DataFrame) -> DataFrame:
    """The invoice base from ``invoice_sums``: amounts in integer hundredths."""
    prod = F.col("taxable_p") * F.col("rate")
    j = sums.select(
        "*",
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_suppkey") * 3) % 100)
        .alias("h"),
        ((prod - prod % 100) / 100).cast("bigint").alias("tax_p"),
        _vendor_id("l_suppkey").alias("vendor_id"),
        _gstin("s_nationkey", "l_suppkey").alias("supplier_gstin"))
    even = F.col("s_nationkey") % 2 == 0
    tax = F.col("tax_p")
    half = ((tax - tax % 2) / 2).cast("bigint")
    return j.select(
        "l_orderkey", "l_suppkey", "l_linenumber", "h", "invoice_date", "taxable_p", "rate",
        "tax_p", "vendor_id", "supplier_gstin",
        F.concat(F.lit("INV-"), _s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("inv"),
        F.concat(F.year("invoice_date").cast("string"), F.lit("-Q"),
                 F.quarter("invoice_date").cast("string")).alias("tax_period"),
        F.when(even, tax).otherwise(F.lit(0).cast("bigint")).alias("igst_p"),
        F.when(even, F.lit(0).cast("bigint")).otherwise(half).alias("cgst_p"),
        F.when(even, F.lit(0).cast("bigint")).otherwise(tax - half).alias("sgst_p"))


def invoice_base(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """One row per (order, supplier, line) with all columns that the input tables take."""
    return invoice_columns(invoice_sums(lineitem, supplier, nation))


def _ids(prefix: str) -> Column:
    return F.concat(F.lit(prefix), _s("l_orderkey"), F.lit("-"), _s("l_suppkey"), F.lit("-"),
                    _s("l_linenumber"))


def purchase_register(base: DataFrame) -> DataFrame:
    b = base.filter(~F.col("h").between(20, 24))
    return b.select(
        _ids("PUR-").alias("purchase_invoice_id"), "vendor_id", "supplier_gstin",
        F.col("inv").alias("invoice_number"), "invoice_date", "tax_period",
        _cents_to_money("taxable_p").alias("taxable_value"),
        _cents_to_money("igst_p").alias("igst"), _cents_to_money("cgst_p").alias("cgst"),
        _cents_to_money("sgst_p").alias("sgst"), _cents_to_money("tax_p").alias("total_tax"),
        F.date_add("invoice_date", 30).alias("payment_date"),
        F.concat(F.lit("BU"), _s("l_linenumber")).alias("business_unit"))


def gstr2b_data(base: DataFrame) -> DataFrame:
    b = base.filter(~F.col("h").between(0, 4))
    # every filed invoice once, plus an amended second filing for code 19
    rows = b.withColumn("amend", F.lit(0)).unionByName(
        b.filter(F.col("h") == AMEND_CODE).withColumn("amend", F.lit(1)))
    h = F.col("h")
    bump = F.when(h.between(5, 9), 5000).when(h.between(10, 12), 50).otherwise(0)
    return rows.select(
        F.concat(_ids("G2B-"), F.when(F.col("amend") == 1, "-A").otherwise("")).alias("gstr2b_id"),
        "supplier_gstin",
        F.when(h.between(16, 18), F.concat(F.lit("  "), F.lower("inv"), F.lit(" ")))
         .otherwise(F.col("inv")).alias("invoice_number"),
        "invoice_date", "tax_period",
        _cents_to_money("taxable_p").alias("taxable_value"),
        ((F.col("igst_p") + bump).cast("double") / 100).cast("decimal(15,2)").alias("igst"),
        _cents_to_money("cgst_p").alias("cgst"), _cents_to_money("sgst_p").alias("sgst"),
        F.when(h == 25, F.lit(None).cast("date"))
         .when(h.between(13, 15) | (h == 9), F.date_add("invoice_date", 400))
         .otherwise(F.date_add("invoice_date", 20)).alias("filing_date"),
        F.col("amend").alias("amendment_flag"))


def vendor_filing_compliance(base: DataFrame) -> DataFrame:
    # numbers that fix the other columns go through the shuffle; a GSTIN begins with its state's two characters
    p = base.select("l_suppkey", F.left("supplier_gstin", F.lit(2)).alias("state"), F.year("invoice_date").alias("year"),
                    F.quarter("invoice_date").alias("quarter")).distinct()
    p = p.select("l_suppkey", _vendor_id("l_suppkey").alias("vendor_id"), _gstin("state", "l_suppkey").alias("supplier_gstin"),
                 F.concat(_s("year"), F.lit("-Q"), _s("quarter")).alias("tax_period"),
                 (F.col("year") * 4 + F.col("quarter")).alias("pi"))
    m = (F.col("l_suppkey") * 5 + F.col("pi") * 3) % 60
    p = p.withColumn("delay", F.when(m < 25, F.lit(0)).otherwise(m - 24))
    return p.select(
        F.concat(F.lit("FIL-"), "vendor_id", F.lit("-"), "tax_period").alias("record_id"),
        "vendor_id", F.col("supplier_gstin").alias("gstin"), "tax_period",
        F.when(F.col("pi") % 2 == 0, "GSTR-1").otherwise("GSTR-3B").alias("return_type"),
        F.lit(None).cast("date").alias("filing_date"),
        F.col("delay").cast("int").alias("delay_days"),
        F.when(F.col("delay") == 0, "On Time").when(F.col("delay") <= 20, "Late")
         .otherwise("Delayed").alias("filing_status"))


def derive_tables(read) -> dict[str, DataFrame]:
    """``read(name)`` returns a driver table; returns the four input tables."""
    supplier, nation, lineitem = read("supplier"), read("nation"), read("lineitem")
    base = invoice_base(lineitem, supplier, nation)
    return {
        "vendor_master": vendor_master(supplier, nation),
        "purchase_register": purchase_register(base),
        "gstr2b_data": gstr2b_data(base),
        "vendor_filing_compliance": vendor_filing_compliance(base),
    }
