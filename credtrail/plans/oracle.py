"""Independent ANSI-SQL formulations (DuckDB dialect) of the registered queries.

Each string is self-contained: it derives the input tables from the driver's
tables with the same adapter as ``sources.testdata`` (written here as SQL),
then computes the query the way the reference states it (full outer join,
left joins, COUNT DISTINCT, ...), not the pre-aggregated plans the Spark side
uses, so agreement checks the rewrites too.
"""

from __future__ import annotations

from credtrail.functions.scalars import WHITESPACE_CODEPOINTS

AS_OF = "DATE '2001-11-15'"

ADAPTER = r"""
vendor_master AS (
  SELECT concat('V', lpad(CAST(s_suppkey AS VARCHAR), 7, '0')) AS vendor_id,
         s_name AS vendor_name,
         concat(lpad(CAST(s_nationkey AS VARCHAR), 2, '0'), 'GST', lpad(CAST(s_suppkey AS VARCHAR), 10, '0')) AS gstin,
         n_name AS state,
         CASE s_suppkey % 4 WHEN 0 THEN 'Manufacturer' WHEN 1 THEN 'Trader' WHEN 2 THEN 'Service Provider' ELSE 'Wholesaler' END AS business_type,
         CASE s_suppkey % 10 WHEN 7 THEN 'Cancelled' WHEN 8 THEN 'Suspended' WHEN 9 THEN 'Inactive' WHEN 6 THEN 'Unknown' ELSE 'Active' END AS gst_status,
         CAST(DATE '1990-01-01' AS DATE) AS registration_date,
         CAST(CAST(s_suppkey % 500 AS DOUBLE) / 100 AS DECIMAL(5,2)) AS compliance_rating
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
g_base AS (
  SELECT l_orderkey, l_suppkey, l_linenumber,
         (l_orderkey * 7 + l_linenumber * 13 + l_suppkey * 3) % 100 AS h,
         CAST(MIN(l_shipdate) AS DATE) AS invoice_date,
         SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS taxable_p,
         MAX(CAST(ROUND(l_tax * 100) AS BIGINT)) AS rate
  FROM lineitem GROUP BY l_orderkey, l_suppkey, l_linenumber),
t_base AS (SELECT *, CAST((taxable_p * rate - (taxable_p * rate) % 100) / 100 AS BIGINT) AS tax_p FROM g_base),
invoice_base AS (
  SELECT t.*, v.vendor_id, v.gstin AS supplier_gstin,
         concat('INV-', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS inv,
         concat(CAST(year(invoice_date) AS VARCHAR), '-Q', CAST(quarter(invoice_date) AS VARCHAR)) AS tax_period,
         CASE WHEN s_nationkey % 2 = 0 THEN tax_p ELSE 0 END AS igst_p,
         CASE WHEN s_nationkey % 2 = 0 THEN 0 ELSE CAST((tax_p - tax_p % 2) / 2 AS BIGINT) END AS cgst_p,
         CASE WHEN s_nationkey % 2 = 0 THEN 0 ELSE tax_p - CAST((tax_p - tax_p % 2) / 2 AS BIGINT) END AS sgst_p
  FROM t_base t JOIN supplier ON l_suppkey = s_suppkey
       JOIN vendor_master v ON v.vendor_id = concat('V', lpad(CAST(l_suppkey AS VARCHAR), 7, '0'))),
purchase_register AS (
  SELECT concat('PUR-', CAST(l_orderkey AS VARCHAR), '-', CAST(l_suppkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS purchase_invoice_id,
         vendor_id, supplier_gstin, inv AS invoice_number, invoice_date, tax_period,
         CAST(CAST(taxable_p AS DOUBLE) / 100 AS DECIMAL(15,2)) AS taxable_value,
         CAST(CAST(igst_p AS DOUBLE) / 100 AS DECIMAL(15,2)) AS igst,
         CAST(CAST(cgst_p AS DOUBLE) / 100 AS DECIMAL(15,2)) AS cgst,
         CAST(CAST(sgst_p AS DOUBLE) / 100 AS DECIMAL(15,2)) AS sgst,
         CAST(CAST(tax_p AS DOUBLE) / 100 AS DECIMAL(15,2)) AS total_tax,
         CAST(invoice_date + INTERVAL 30 DAY AS DATE) AS payment_date,
         concat('BU', CAST(l_linenumber AS VARCHAR)) AS business_unit
  FROM invoice_base WHERE h NOT BETWEEN 20 AND 24),
gstr2b_data AS (
  SELECT concat('G2B-', CAST(l_orderkey AS VARCHAR), '-', CAST(l_suppkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR), CASE WHEN a.amend = 1 THEN '-A' ELSE '' END) AS gstr2b_id,
         supplier_gstin,
         CASE WHEN h BETWEEN 16 AND 18 THEN concat('  ', lower(inv), ' ') ELSE inv END AS invoice_number,
         invoice_date, tax_period,
         CAST(CAST(taxable_p AS DOUBLE) / 100 AS DECIMAL(15,2)) AS taxable_value,
         CAST(CAST(igst_p + CASE WHEN h BETWEEN 5 AND 9 THEN 5000 WHEN h BETWEEN 10 AND 12 THEN 50 ELSE 0 END AS DOUBLE) / 100 AS DECIMAL(15,2)) AS igst,
         CAST(CAST(cgst_p AS DOUBLE) / 100 AS DECIMAL(15,2)) AS cgst,
         CAST(CAST(sgst_p AS DOUBLE) / 100 AS DECIMAL(15,2)) AS sgst,
         CASE WHEN h = 25 THEN CAST(NULL AS DATE) WHEN h BETWEEN 13 AND 15 OR h = 9 THEN CAST(invoice_date + INTERVAL 400 DAY AS DATE) ELSE CAST(invoice_date + INTERVAL 20 DAY AS DATE) END AS filing_date,
         a.amend AS amendment_flag
  FROM invoice_base JOIN (SELECT 0 AS amend UNION ALL SELECT 1 AS amend) a ON a.amend = 0 OR h = 19
  WHERE h NOT BETWEEN 0 AND 4),
vfc_p AS (SELECT DISTINCT l_suppkey, vendor_id, supplier_gstin, tax_period, year(invoice_date) * 4 + quarter(invoice_date) AS pi FROM invoice_base),
vfc_d AS (SELECT *, CASE WHEN (l_suppkey * 5 + pi * 3) % 60 < 25 THEN 0 ELSE (l_suppkey * 5 + pi * 3) % 60 - 24 END AS delay FROM vfc_p),
vendor_filing_compliance AS (
  SELECT concat('FIL-', vendor_id, '-', tax_period) AS record_id, vendor_id, supplier_gstin AS gstin, tax_period,
         CASE WHEN pi % 2 = 0 THEN 'GSTR-1' ELSE 'GSTR-3B' END AS return_type,
         CAST(NULL AS DATE) AS filing_date, CAST(delay AS INT) AS delay_days,
         CASE WHEN delay = 0 THEN 'On Time' WHEN delay <= 20 THEN 'Late' ELSE 'Delayed' END AS filing_status
  FROM vfc_d)"""

def norm(c: str) -> str:
    """SQL for the invoice-number normalisation (strip all whitespace, upper-case)."""
    chars = " || ".join(f"chr({cp})" for cp in WHITESPACE_CODEPOINTS)
    return f"upper(trim({c}, {chars}))"

RECON = r"""
pr_n AS (SELECT *, %(pn)s AS inv_n, 1 AS _l FROM purchase_register),
g_n AS (SELECT *, %(gn)s AS inv_n, 1 AS _r FROM gstr2b_data),
merged AS (
  SELECT coalesce(p.supplier_gstin, g.supplier_gstin) AS supplier_gstin,
         coalesce(p.inv_n, g.inv_n) AS invoice_number,
         p.purchase_invoice_id, g.gstr2b_id, p.vendor_id, p.total_tax,
         g.igst AS igst_g2b, g.cgst AS cgst_g2b, g.sgst AS sgst_g2b,
         g.filing_date, g.invoice_date AS invoice_date_g2b,
         p._l IS NOT NULL AS in_l, g._r IS NOT NULL AS in_r
  FROM pr_n p FULL OUTER JOIN g_n g
    ON p.supplier_gstin IS NOT DISTINCT FROM g.supplier_gstin AND p.inv_n IS NOT DISTINCT FROM g.inv_n),
detail AS (
  SELECT *,
    CASE WHEN in_l AND in_r AND abs(total_tax - (igst_g2b + cgst_g2b + sgst_g2b)) < 1.0 THEN 'Matched' ELSE 'Unmatched' END AS match_status,
    CASE WHEN in_l AND in_r AND filing_date IS NOT NULL AND invoice_date_g2b IS NOT NULL
              AND datediff('day', invoice_date_g2b, filing_date) > 365 THEN 'Time-Barred'
         WHEN in_l AND in_r THEN CASE WHEN abs(total_tax - (igst_g2b + cgst_g2b + sgst_g2b)) < 1.0 THEN '' ELSE 'Amount Mismatch' END
         WHEN in_l THEN 'Missing in GSTR2B' ELSE 'Missing in Purchase Register' END AS mismatch_type,
    CASE WHEN in_l AND in_r THEN abs(total_tax - (igst_g2b + cgst_g2b + sgst_g2b))
         WHEN in_l THEN total_tax ELSE igst_g2b + cgst_g2b + sgst_g2b END AS tax_difference
  FROM merged),
irr AS (
  SELECT 'REC' || CASE WHEN length(CAST(rn AS VARCHAR)) < 7 THEN lpad(CAST(rn AS VARCHAR), 7, '0') ELSE CAST(rn AS VARCHAR) END AS reconciliation_id,
         purchase_invoice_id, gstr2b_id, match_status, mismatch_type,
         CAST(tax_difference AS DECIMAL(15,2)) AS tax_difference,
         CAST(NULL AS TINYINT) AS tolerance_applied, %(as_of)s AS reconciliation_date
  FROM (SELECT *, row_number() OVER (ORDER BY supplier_gstin NULLS LAST, invoice_number NULLS LAST,
                                     purchase_invoice_id NULLS LAST, gstr2b_id NULLS LAST) - 1 AS rn
        FROM detail) x)""" % {"pn": norm("invoice_number"), "gn": norm("invoice_number"),
                               "as_of": AS_OF}

LEAKAGE = r"""
leak_rows AS (
  SELECT p.vendor_id, p.tax_period, p.total_tax, r.match_status,
         datediff('day', p.invoice_date, %(as_of)s) AS age
  FROM purchase_register p LEFT JOIN irr r ON p.purchase_invoice_id = r.purchase_invoice_id),
leak_g AS (
  SELECT vendor_id, tax_period,
         coalesce(SUM(total_tax), 0) AS claimed,
         coalesce(SUM(CASE WHEN match_status = 'Matched' THEN total_tax END), 0) AS matched,
         coalesce(SUM(CASE WHEN match_status = 'Unmatched' THEN total_tax END), 0) AS at_risk,
         SUM(CASE WHEN age <= 30 THEN 1 ELSE 0 END) AS a,
         SUM(CASE WHEN age > 30 AND age <= 60 THEN 1 ELSE 0 END) AS b,
         SUM(CASE WHEN age IS NULL OR age > 60 THEN 1 ELSE 0 END) AS c
  FROM leak_rows WHERE vendor_id IS NOT NULL AND tax_period IS NOT NULL
  GROUP BY vendor_id, tax_period),
ils AS (
  SELECT vendor_id, tax_period,
         CAST(claimed AS DECIMAL(15,2)) AS total_itc_claimed,
         CAST(matched AS DECIMAL(15,2)) AS itc_matched,
         CAST(at_risk AS DECIMAL(15,2)) AS itc_at_risk,
         CAST(CAST(at_risk AS DOUBLE) / (CASE WHEN CAST(claimed AS DOUBLE) = 0 THEN 1 ELSE CAST(claimed AS DOUBLE) END) * 100 AS DECIMAL(10,2)) AS leakage_percentage,
         CASE WHEN a >= b AND a >= c THEN '0-30' WHEN b >= c THEN '31-60' ELSE '60+' END AS aging_bucket
  FROM leak_g)""" % {"as_of": AS_OF}

FEATURES = r"""
rec_vendor AS (SELECT r.*, p.vendor_id FROM irr r LEFT JOIN purchase_register p ON r.purchase_invoice_id = p.purchase_invoice_id),
f_mm AS (
  SELECT vendor_id, COUNT(purchase_invoice_id) AS total_invoices,
         SUM(CASE WHEN match_status = 'Unmatched' THEN 1 ELSE 0 END) AS unmatched_count,
         CAST(SUM(tax_difference) AS DOUBLE) / NULLIF(COUNT(tax_difference), 0) AS avg_tax_diff,
         CAST(SUM(tax_difference) AS DOUBLE) AS total_tax_diff,
         stddev_samp(CAST(tax_difference AS DOUBLE)) AS std_tax_diff
  FROM rec_vendor WHERE vendor_id IS NOT NULL GROUP BY vendor_id),
f_fl AS (
  SELECT vendor_id, COUNT(record_id) AS total_filings,
         SUM(CASE WHEN filing_status = 'Late' THEN 1 ELSE 0 END) AS late_count,
         AVG(delay_days) AS avg_delay, MAX(delay_days) AS max_delay
  FROM vendor_filing_compliance WHERE vendor_id IS NOT NULL GROUP BY vendor_id),
f_vol AS (
  SELECT vendor_id, CAST(SUM(total_tax) AS DOUBLE) AS total_volume,
         CAST(SUM(total_tax) AS DOUBLE) / NULLIF(COUNT(total_tax), 0) AS avg_transaction,
         COUNT(total_tax) AS transaction_count, stddev_samp(CAST(total_tax AS DOUBLE)) AS std_transaction
  FROM purchase_register WHERE vendor_id IS NOT NULL GROUP BY vendor_id),
feat0 AS (
  SELECT v.vendor_id,
         CASE v.gst_status WHEN 'Active' THEN 0 WHEN 'Cancelled' THEN 100 WHEN 'Suspended' THEN 80 WHEN 'Inactive' THEN 50 ELSE 0 END AS gst_status_score,
         CAST(coalesce(m.total_invoices, 0) AS BIGINT) AS total_invoices,
         CAST(coalesce(m.unmatched_count, 0) AS BIGINT) AS unmatched_count,
         coalesce(m.avg_tax_diff, 0.0) AS avg_tax_diff, coalesce(m.total_tax_diff, 0.0) AS total_tax_diff,
         coalesce(m.std_tax_diff, 0.0) AS std_tax_diff,
         CAST(coalesce(f.total_filings, 0) AS BIGINT) AS total_filings,
         CAST(coalesce(f.late_count, 0) AS BIGINT) AS late_count,
         coalesce(CAST(f.avg_delay AS DOUBLE), 0.0) AS avg_delay,
         CAST(coalesce(f.max_delay, 0) AS BIGINT) AS max_delay,
         coalesce(o.total_volume, 0.0) AS total_volume, coalesce(o.avg_transaction, 0.0) AS avg_transaction,
         CAST(coalesce(o.transaction_count, 0) AS BIGINT) AS transaction_count,
         coalesce(o.std_transaction, 0.0) AS std_transaction
  FROM vendor_master v LEFT JOIN f_mm m ON v.vendor_id = m.vendor_id
       LEFT JOIN f_fl f ON v.vendor_id = f.vendor_id LEFT JOIN f_vol o ON v.vendor_id = o.vendor_id),
feat AS (
  SELECT *, CAST(unmatched_count AS DOUBLE) / CAST(CASE WHEN total_invoices = 0 THEN 1 ELSE total_invoices END AS DOUBLE) AS mismatch_rate,
            CAST(late_count AS DOUBLE) / CAST(CASE WHEN total_filings = 0 THEN 1 ELSE total_filings END AS DOUBLE) AS filing_delay_rate
  FROM feat0),
vrs_raw AS (
  SELECT vendor_id, mismatch_rate, filing_delay_rate, gst_status_score,
         mismatch_rate * 100 * CAST(0.4 AS DOUBLE) + filing_delay_rate * 100 * CAST(0.3 AS DOUBLE)
           + gst_status_score * CAST(0.3 AS DOUBLE) AS score
  FROM feat),
vrs AS (
  SELECT vendor_id, CAST(mismatch_rate AS DECIMAL(5,3)) AS mismatch_rate,
         CAST(filing_delay_rate AS DECIMAL(5,3)) AS filing_delay_frequency,
         CAST(gst_status_score AS INTEGER) AS gst_status_score,
         CAST(score AS DECIMAL(5,2)) AS vendor_risk_score,
         CASE WHEN score < 20 THEN 'Low' WHEN score < 40 THEN 'Medium' ELSE 'High' END AS risk_category
  FROM vrs_raw)"""


def with_ctes(*blocks: str, body: str) -> str:
    return "WITH " + ",".join(b.strip("\n") for b in blocks) + "\n" + body


def _after(head: str, body: str) -> str:
    """``body`` may start with further CTEs ("name AS (...), ...")."""
    if body.lstrip().upper().startswith("SELECT"):
        return head + body
    return head.rstrip("\n") + ",\n" + body


def base(body: str) -> str:
    return _after(with_ctes(ADAPTER, body=""), body)


def recon(body: str) -> str:
    return with_ctes(ADAPTER, RECON, body=body)


def leak(body: str) -> str:
    return with_ctes(ADAPTER, RECON, LEAKAGE, body=body)


def full(body: str) -> str:
    """All stage CTEs; ``body`` may start with further CTEs ("name AS (...), ...")."""
    return _after(with_ctes(ADAPTER, RECON, LEAKAGE, FEATURES, body=""), body)


def trim_ws(c: str) -> str:
    chars = " || ".join(f"chr({cp})" for cp in WHITESPACE_CODEPOINTS)
    return f"trim({c}, {chars})"


def parse_period(c: str) -> str:
    """SQL twin of functions.periods.parse_tax_period."""
    v = trim_ws(f"CAST({c} AS VARCHAR)")
    return (
        f"CASE WHEN regexp_full_match({v}, '[0-9]{{4}}-Q[1-4]') OR regexp_full_match({v}, '[0-9]{{4}}Q[1-4]') "
        f"THEN make_date(CAST(substr({v}, 1, 4) AS INTEGER), (CAST(right({v}, 1) AS INTEGER) - 1) * 3 + 1, 1) "
        f"WHEN regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{2}}') THEN CAST(try_strptime({v}, '%Y-%m') AS DATE) "
        f"WHEN regexp_full_match({v}, '[0-9]{{6}}') THEN CAST(try_strptime({v}, '%Y%m') AS DATE) "
        f"WHEN regexp_full_match({v}, '[0-9]{{4}}') THEN CAST(try_strptime({v}, '%Y') AS DATE) "
        f"WHEN regexp_full_match({v}, '[0-9]{{8}}') THEN CAST(try_strptime({v}, '%Y%m%d') AS DATE) "
        f"WHEN regexp_matches({v}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}([ T].*)?$') "
        f"THEN CAST(try_strptime(regexp_extract({v}, '^([0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}})', 1), '%Y-%m-%d') AS DATE) "
        + "".join(f"WHEN regexp_full_match({v}, '{shape}') THEN CAST(try_strptime({v}, '{layout}') AS DATE) "
                  for shape, layout in (
                      ("[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}", "%Y/%m/%d"), ("[0-9]{4}/[0-9]{1,2}", "%Y/%m"),
                      ("[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", "%m/%d/%Y"), ("[0-9]{1,2}/[0-9]{4}", "%m/%Y"),
                      ("[A-Za-z]{3} [0-9]{4}", "%b %Y"), ("[A-Za-z]{3}-[0-9]{4}", "%b-%Y"),
                      ("[A-Za-z]{4,9} [0-9]{4}", "%B %Y"), ("[0-9]{1,2} [A-Za-z]{3} [0-9]{4}", "%d %b %Y")))
        + "ELSE NULL END")


J2 = r"""
j2 AS (
  SELECT coalesce(p.supplier_gstin, g.supplier_gstin) AS supplier_gstin,
         coalesce(p.invoice_number, g.invoice_number) AS invoice_number,
         p.purchase_invoice_id, g.gstr2b_id, p.total_tax,
         g.igst AS igst_g2b, g.cgst AS cgst_g2b, g.sgst AS sgst_g2b,
         CAST(coalesce(g.taxable_value, 0) + coalesce(g.igst, 0) + coalesce(g.cgst, 0) + coalesce(g.sgst, 0) AS DOUBLE) AS invoice_value_g2b
  FROM purchase_register p FULL OUTER JOIN gstr2b_data g
    ON p.supplier_gstin IS NOT DISTINCT FROM g.supplier_gstin AND p.invoice_number IS NOT DISTINCT FROM g.invoice_number),
j2q AS (SELECT quantile_cont(CAST(total_tax AS DOUBLE), 0.05) AS lo, quantile_cont(CAST(total_tax AS DOUBLE), 0.95) AS hi FROM j2),
flagged AS (
  SELECT j2.*, CAST(0.0 AS DOUBLE) AS anomaly_score,
         coalesce(CAST(total_tax AS DOUBLE) > hi OR CAST(total_tax AS DOUBLE) < lo, false) AS is_anomaly
  FROM j2 CROSS JOIN j2q)"""


def anomalies(body: str) -> str:
    return with_ctes(ADAPTER, J2, body=body)


def trend_forecast(series: list[str], value: str, horizon: int = 4) -> str:
    """Trend forecast of SUM(value) per tax period (quarter labels) per series."""
    s = ", ".join(series)
    sp = (s + ", ") if series else ""
    on = " AND ".join(f"h.{c} IS NOT DISTINCT FROM f.{c}" for c in series) or "TRUE"
    on2 = " AND ".join(f"h.{c} IS NOT DISTINCT FROM se.{c}" for c in series) or "TRUE"
    on3 = " AND ".join(f"f.{c} IS NOT DISTINCT FROM se.{c}" for c in series) or "TRUE"
    fs = ", ".join(f"f.{c}" for c in series)
    hs = ", ".join(f"h.{c}" for c in series)
    return full(
        f"tot AS (SELECT {sp}tax_period, CAST(SUM({value}) AS DOUBLE) AS y FROM ils GROUP BY {sp}tax_period),\n"
        f"h AS (SELECT {sp}{parse_period('tax_period')} AS ds, y FROM tot),\n"
        f"hx AS (SELECT *, CAST(datediff('day', DATE '1970-01-01', ds) AS DOUBLE) AS x FROM h WHERE ds IS NOT NULL AND y IS NOT NULL),\n"
        f"f0 AS (SELECT {sp}regr_slope(y, x) AS b, regr_intercept(y, x) AS a, AVG(y) AS m, COUNT(*) AS n, MAX(ds) AS last FROM hx {'GROUP BY ' + s if series else ''}),\n"
        f"f AS (SELECT {sp}coalesce(b, 0.0) AS b, coalesce(a, m) AS a, n, last FROM f0),\n"
        f"se AS (SELECT {(fs + ', ') if series else ''}sqrt(SUM(power(h.y - (f.a + f.b * h.x), 2)) / CAST(greatest(MAX(f.n) - 2, 1) AS DOUBLE)) AS se "
        f"FROM hx h JOIN f ON {on} {'GROUP BY ' + fs if series else ''}),\n"
        f"pts AS (SELECT {(hs + ', ') if series else ''}h.ds FROM hx h UNION ALL "
        f"SELECT {(fs + ', ') if series else ''}CAST(f.last + to_months(CAST(3 * k AS INTEGER)) AS DATE) FROM f CROSS JOIN range(1, {horizon + 1}) t(k))\n"
        f"SELECT {(', '.join('p.' + c for c in series) + ', ') if series else ''}p.ds, "
        "ROUND(f.a + f.b * CAST(datediff('day', DATE '1970-01-01', p.ds) AS DOUBLE), 2) AS yhat, "
        "ROUND(f.a + f.b * CAST(datediff('day', DATE '1970-01-01', p.ds) AS DOUBLE) - coalesce(se.se, 0.0) * 1.2815515655446004, 2) AS yhat_lower, "
        "ROUND(f.a + f.b * CAST(datediff('day', DATE '1970-01-01', p.ds) AS DOUBLE) + coalesce(se.se, 0.0) * 1.2815515655446004, 2) AS yhat_upper "
        f"FROM pts p JOIN f ON {on.replace('h.', 'p.')} JOIN se ON {on3}")


def seasonal_normal_equations(order: int = 3, ridge: str = "1e-3") -> str:
    """Per vendor the seasonal ridge fit of the claimed tax by quarter: the sums of products, then
    Gauss-Jordan elimination a pivot at a time. Coefficients are in units of the largest |y|."""
    waves = [f"{f}({k} * 2 * pi() * dayofyear(ds) / 365.25)" for k in range(1, order + 1) for f in ("sin", "cos")]
    x = ["1.0", "datediff('day', first, ds) / 365.25", *waves]
    n = len(x)
    rows = ", ".join("[" + ", ".join(f"SUM(x[{i}] * x[{j}])" + (f" + {ridge}" if i == j else "")
                                     for j in range(1, n + 1)) + f", SUM(x[{i}] * y)]" for i in range(1, n + 1))
    return full(
        "tot AS (SELECT vendor_id, tax_period, CAST(SUM(total_itc_claimed) AS DOUBLE) AS y FROM ils GROUP BY vendor_id, tax_period),\n"
        f"h AS (SELECT vendor_id, {parse_period('tax_period')} AS ds, y FROM tot),\n"
        "hx AS (SELECT vendor_id, ds, y, MIN(ds) OVER (PARTITION BY vendor_id) AS first FROM h WHERE ds IS NOT NULL AND y IS NOT NULL),\n"
        f"d AS (SELECT vendor_id, y, [{', '.join(x)}]::DOUBLE[] AS x FROM hx),\n"
        f"sums AS (SELECT vendor_id, COUNT(*) AS periods, MAX(ABS(y)) AS scale, [{rows}] AS m FROM d GROUP BY vendor_id),\n"
        "solved AS (SELECT * FROM (WITH RECURSIVE e AS (SELECT vendor_id, periods, scale, 1 AS k, m FROM sums UNION ALL "
        "SELECT vendor_id, periods, scale, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN r ELSE "
        f"list_transform(r, lambda v, j: v - r[k] / m[k][k] * m[k][j]) END) FROM e WHERE k <= {n}) SELECT * FROM e WHERE k = {n + 1}))\n"
        "SELECT vendor_id, periods, " + ", ".join(f"ROUND(m[{i}][{n + 1}] / m[{i}][{i}] / scale, 5) AS b{i - 1}" for i in range(1, n + 1)) +
        " FROM solved")


FUZZY = (
    "pn AS (SELECT purchase_invoice_id, supplier_gstin AS gstin, " + norm("invoice_number") + " AS num, total_tax AS tax FROM purchase_register),\n"
    "gn AS (SELECT gstr2b_id, supplier_gstin AS gstin, " + norm("invoice_number") + " AS num, igst + cgst + sgst AS tax FROM gstr2b_data),\n"
    "pl AS (SELECT * FROM pn p WHERE NOT EXISTS (SELECT 1 FROM gn g WHERE g.gstin IS NOT DISTINCT FROM p.gstin AND g.num IS NOT DISTINCT FROM p.num)),\n"
    "gl AS (SELECT * FROM gn g WHERE NOT EXISTS (SELECT 1 FROM pn p WHERE g.gstin IS NOT DISTINCT FROM p.gstin AND g.num IS NOT DISTINCT FROM p.num)),\n")


def fuzzy_matching(distance: int, tolerance: int, prepare: str = FUZZY) -> str:
    """One-to-one matching in rounds: each round takes the pairs of classes that are each other's best."""
    def classes(rows: str) -> str:
        return (f"SELECT gstin, num, tax, COUNT(*) AS size, md5(concat_ws(chr(31), gstin, num, CAST(tax AS VARCHAR))) AS digest "
                f"FROM {rows} WHERE gstin IS NOT NULL AND num IS NOT NULL AND tax IS NOT NULL GROUP BY gstin, num, tax")

    best = "row_number() OVER (PARTITION BY {} ORDER BY edits, diff, tie) = 1"
    return base(
        prepare + f"pc AS ({classes('pl')}),\ngc AS ({classes('gl')}),\n"
        "edges AS (SELECT p.digest AS p, g.digest AS g, levenshtein(p.num, g.num) AS edits, abs(p.tax - g.tax) AS diff, "
        "md5(p.digest || g.digest) AS tie, p.size AS size_p, g.size AS size_g FROM pc p JOIN gc g ON p.gstin = g.gstin "
        f"WHERE levenshtein(p.num, g.num) <= {distance} AND abs(p.tax - g.tax) < {tolerance}),\n"
        "found AS (SELECT * FROM (WITH RECURSIVE m AS (\n"
        "SELECT p, g, edits, diff, tie, size_p, size_g, 0::BIGINT AS from_p, 0::BIGINT AS from_g, 0::BIGINT AS n FROM edges UNION ALL\n"
        "SELECT p, g, edits, diff, tie, size_p, size_g, CASE WHEN hit > 0 THEN from_p ELSE from_p + now_p END, "
        "CASE WHEN hit > 0 THEN from_g ELSE from_g + now_g END, hit FROM (\n"
        "SELECT *, CAST(SUM(hit) OVER (PARTITION BY p) AS BIGINT) AS now_p, CAST(SUM(hit) OVER (PARTITION BY g) AS BIGINT) AS now_g FROM (\n"
        f"SELECT *, CASE WHEN {best.format('p')} AND {best.format('g')} THEN least(size_p - from_p, size_g - from_g) ELSE 0 END AS hit "
        "FROM m WHERE n = 0) a) b WHERE hit > 0 OR (from_p + now_p < size_p AND from_g + now_g < size_g))\n"
        "SELECT * FROM m WHERE n > 0)),\n"
        "slots AS (SELECT *, unnest(range(n)) AS k FROM found),\n"
        + "".join(f"{x}r AS (SELECT {i} AS id, md5(concat_ws(chr(31), gstin, num, CAST(tax AS VARCHAR))) AS digest, "
                  f"row_number() OVER (PARTITION BY gstin, num, tax ORDER BY {i}) - 1 AS at FROM {x}l){',' if x == 'p' else ''}\n"
                  for x, i in (("p", "purchase_invoice_id"), ("g", "gstr2b_id"))) +
        "SELECT pr.id AS purchase_invoice_id, gr.id AS gstr2b_id, CAST(edits AS INTEGER) AS edits, CAST(diff AS DECIMAL(18,2)) AS tax_difference "
        "FROM slots JOIN pr ON pr.digest = p AND pr.at = from_p + k JOIN gr ON gr.digest = g AND gr.at = from_g + k")


def repeated_keys(body: str) -> str:
    """``body`` over tables in which ids repeat: some vendors have a second state, some invoices and
    results a second row."""
    def also(name: str, rows: str, more: str) -> str:
        return f"{name}_twice AS (SELECT * FROM {rows} UNION ALL SELECT {more})"

    return full(",\n".join([
        also("vendor_master", "vendor_master", "* REPLACE ('Elsewhere' AS state) FROM vendor_master WHERE right(vendor_id, 1) = '3'"),
        also("purchase_register", "purchase_register", "* FROM purchase_register WHERE right(purchase_invoice_id, 1) = '7'"),
        also("irr", "irr", "* FROM irr WHERE right(reconciliation_id, 1) IN ('1', '5')"),
        also("vrs", "vrs", "* FROM vrs WHERE right(vendor_id, 1) = '4'")]) + "\n" + body)
