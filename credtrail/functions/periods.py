"""Tax-period labels: parsing to a period-start date and frequency inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credtrail.functions.scalars import strip_all

# The label shapes the reference recognises, tried in this order.
QUARTER_DASH = r"^[0-9]{4}-Q[1-4]$"
QUARTER_PLAIN = r"^[0-9]{4}Q[1-4]$"
MONTH_DASH = r"^[0-9]{4}-[0-9]{2}$"
MONTH_PLAIN = r"^[0-9]{6}$"
# Further shapes of the generic parse, and their layouts.
GENERIC = (
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"),
    (r"^[0-9]{4}/[0-9]{1,2}$", "yyyy/M"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"),
    (r"^[0-9]{1,2}/[0-9]{4}$", "M/yyyy"),
    (r"^[A-Za-z]{3} [0-9]{4}$", "MMM yyyy"),
    (r"^[A-Za-z]{3}-[0-9]{4}$", "MMM-yyyy"),
    (r"^[A-Za-z]{4,9} [0-9]{4}$", "MMMM yyyy"),
    (r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4}$", "d MMM yyyy"),
)
FREQ_QUARTER, FREQ_MONTH, FREQ_DAY = "Q", "MS", "D"


def parse_tax_period(c) -> Column:
    """Label -> DATE of the period start, or NULL when nothing parses.

    Quarters (``2023-Q2``, ``2023Q2``) map to the first day of the quarter,
    months (``2023-04``, ``202304``) to the first of the month, anything else
    goes through a generic date parse: a year, ISO dates, ``20230405``, dates
    with slashes (year first, else month first), and month names.
    """
    v = strip_all(F.col(c) if isinstance(c, str) else c)
    year = F.substring(v, 1, 4).cast("int")
    q = F.substring(F.regexp_extract(v, "Q([1-4])$", 1), 1, 1).cast("int")
    quarter_start = F.make_date(year, (q - 1) * 3 + 1, F.lit(1))
    generic = F.coalesce(
        F.when(v.rlike(r"^[0-9]{4}$"), F.try_to_date(v, "yyyy")),
        F.when(v.rlike(r"^[0-9]{8}$"), F.try_to_date(v, "yyyyMMdd")),
        F.when(v.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?$"),
               F.try_to_date(F.regexp_extract(v, r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})", 1),
                             "yyyy-M-d")),
        *[F.when(v.rlike(shape), F.try_to_date(F.initcap(v), layout)) for shape, layout in GENERIC])
    return (F.when(v.rlike(QUARTER_DASH) | v.rlike(QUARTER_PLAIN), quarter_start)
            .when(v.rlike(MONTH_DASH), F.try_to_date(v, "yyyy-MM"))
            .when(v.rlike(MONTH_PLAIN), F.try_to_date(v, "yyyyMM"))
            .otherwise(generic))


def infer_freq(df: DataFrame, c: str) -> DataFrame:
    """One-row frame ``freq``: Q if any quarter label, else MS if any month label, else D.

    Runs as a single partial aggregation (``bool_or``), so the labels never
    leave the executors.
    """
    v = strip_all(F.col(c).cast("string"))
    any_q = F.coalesce(F.bool_or(v.rlike(QUARTER_DASH) | v.rlike(QUARTER_PLAIN)), F.lit(False))
    any_m = F.coalesce(F.bool_or(v.rlike(MONTH_DASH) | v.rlike(MONTH_PLAIN)), F.lit(False))
    return df.agg(F.when(any_q, F.lit(FREQ_QUARTER))
                  .when(any_m, F.lit(FREQ_MONTH))
                  .otherwise(F.lit(FREQ_DAY)).alias("freq"))
