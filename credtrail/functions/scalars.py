"""Scalar column expressions: key normalisation, classifications, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These literals must equal the reference's outputs exactly.
MATCHED = "Matched"
UNMATCHED = "Unmatched"
AMOUNT_MISMATCH = "Amount Mismatch"
TIME_BARRED = "Time-Barred"
MISSING_IN_GSTR2B = "Missing in GSTR2B"
MISSING_IN_PURCHASE_REGISTER = "Missing in Purchase Register"
NO_MISMATCH = ""
AGING_0_30, AGING_31_60, AGING_60_PLUS = "0-30", "31-60", "60+"
GST_STATUS_SCORES = {"Active": 0, "Cancelled": 100, "Suspended": 80, "Inactive": 50}
RISK_LOW, RISK_MEDIUM, RISK_HIGH = "Low", "Medium", "High"
LATE_FILING = "Late"
DEFAULT_TOLERANCE = 1.0
DEFAULT_TIME_BAR_DAYS = 365
ID_PREFIX, ID_WIDTH = "REC", 7
# Whitespace code points as Python's str.strip() sees them, in code-point order.
WHITESPACE_CODEPOINTS = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009,
    0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# ---------------------------------------------------------------------------

WHITESPACE_CHARS = "".join(chr(c) for c in WHITESPACE_CODEPOINTS)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_all(c) -> Column:
    """Remove leading/trailing whitespace of every kind (plain ``trim`` only removes spaces).

    Uses ``trim(BOTH chars FROM c)`` with the whole whitespace set: a
    codegen'd character scan, no regex.
    """
    return F.trim(_c(c), F.lit(WHITESPACE_CHARS))


def normalize_invoice_number(c) -> Column:
    """Strip surrounding whitespace and upper-case; NULL stays NULL."""
    return F.upper(strip_all(c))


def aging_bucket(days) -> Column:
    """<=30 -> 0-30, <=60 -> 31-60, otherwise (including NULL age) 60+."""
    d = _c(days)
    return (F.when(d <= 30, F.lit(AGING_0_30))
            .when(d <= 60, F.lit(AGING_31_60))
            .otherwise(F.lit(AGING_60_PLUS)))


def risk_category(score) -> Column:
    """<20 Low, <40 Medium, otherwise (including NULL/NaN) High."""
    s = _c(score)
    return (F.when(s < 20, F.lit(RISK_LOW))
            .when(s < 40, F.lit(RISK_MEDIUM))
            .otherwise(F.lit(RISK_HIGH)))


def gst_status_score(status) -> Column:
    """Map a registration status to its score; unknown or NULL -> 0."""
    st = _c(status)
    expr = None
    for k, v in GST_STATUS_SCORES.items():
        expr = (F.when(st == k, F.lit(v)) if expr is None
                else expr.when(st == k, F.lit(v)))
    return F.coalesce(expr, F.lit(0))


def compared(c, collation: str | None = None) -> Column:
    """A text column as it is to be compared: byte by byte, or under a collation such as ``UTF8_LCASE``
    (upper and lower case alike) or ``UTF8_LCASE_RTRIM`` (trailing blanks don't count either), as
    stores do whose text columns ignore case."""
    x = _c(c)
    return F.collate(x, collation) if collation else x


def one_if_zero(c) -> Column:
    """Denominator guard: 0 becomes 1 so that n/0 reads as n/1."""
    x = _c(c)
    return F.when(x == 0, F.lit(1)).otherwise(x)


def clip(c, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), _c(c)))


def pct(num, den, digits: int = 2) -> Column:
    """ROUND(num / NULLIF(den, 0) * 100, digits) computed in DOUBLE."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.round(F.try_divide(n, F.nullif(d, F.lit(0.0))) * 100, digits)


def exact_avg(c) -> Column:
    """AVG as CAST(SUM AS DOUBLE) / COUNT: exact decimal sum, one rounding."""
    x = _c(c)
    return F.try_divide(F.sum(x).cast("double"), F.nullif(F.count(x), F.lit(0)))


def padded_id(ordinal, prefix: str = ID_PREFIX, width: int = ID_WIDTH) -> Column:
    """prefix + zero-padded ordinal; longer numbers are kept whole (lpad would cut)."""
    s = _c(ordinal).cast("string")
    return F.concat(F.lit(prefix),
                    F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s))


def money_text(c) -> Column:
    """Display string with thousands separators and two decimals."""
    return F.format_number(_c(c).cast("double"), 2)
