"""t3: hand-made edge frames (FIXTURES.md section 3)."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from credtrail.functions import scalars as S
from credtrail.functions.periods import infer_freq, parse_tax_period
from credtrail.operators import leakage, reconcile, risk
from credtrail.operators.ids import dense_ordinals
from credtrail.operators.joins import full_outer_join, hot_keys_of
from credtrail.operators.quantiles import exact_quantiles
from credtrail.plans import dashboards
from credtrail.sources.schemas import GSTR2B_DATA, PURCHASE_REGISTER

D = Decimal
DAY = dt.date(2023, 1, 1)


def pr_rows(spark, rows):
    """rows: (id, vendor, gstin, invoice_number, total_tax[, invoice_date])"""
    full = []
    for r in rows:
        pid, vendor, gstin, inv, tax = r[:5]
        date = r[5] if len(r) > 5 else DAY
        full.append((pid, vendor, gstin, inv, date, "2023-Q1", D("100.00"), tax, D("0.00"),
                     D("0.00"), tax, date, "BU1"))
    return spark.createDataFrame(full, PURCHASE_REGISTER)


def g2b_rows(spark, rows):
    """rows: (id, gstin, invoice_number, igst, filing_date[, invoice_date])"""
    full = []
    for r in rows:
        gid, gstin, inv, igst, filing = r[:5]
        date = r[5] if len(r) > 5 else DAY
        full.append((gid, gstin, inv, date, "2023-Q1", D("100.00"), igst, D("0.00"), D("0.00"),
                     filing, 0))
    return spark.createDataFrame(full, GSTR2B_DATA)


def rec_by_pair(spark, pr, g2b, **kw):
    out = reconcile.reconcile(pr, g2b, as_of=DAY, **kw).collect()
    return {(r.purchase_invoice_id, r.gstr2b_id): r for r in out}


def test_null_keys_match(spark):
    pr = pr_rows(spark, [("P1", "V1", None, "INV-1", D("10.00"))])
    g = g2b_rows(spark, [("G1", None, "INV-1", D("10.00"), DAY)])
    res = rec_by_pair(spark, pr, g)
    assert list(res) == [("P1", "G1")] and res[("P1", "G1")].match_status == S.MATCHED


def test_whitespace_normalised_in_reconcile_not_in_anomaly_join(spark):
    from credtrail.operators.anomaly import anomaly_frame
    pr = pr_rows(spark, [("P1", "V1", "G", "INV-1", D("10.00"))])
    g = g2b_rows(spark, [("G1", "G", "\t inv-1 \n", D("10.00"), DAY)])
    assert list(rec_by_pair(spark, pr, g)) == [("P1", "G1")]
    assert anomaly_frame(pr, g).count() == 2


@pytest.mark.parametrize("filed,status,mtype", [
    (D("9.01"), S.MATCHED, ""), (D("9.00"), S.UNMATCHED, S.AMOUNT_MISMATCH),
    (None, S.UNMATCHED, S.AMOUNT_MISMATCH)])
def test_tolerance_and_null_tax(spark, filed, status, mtype):
    pr = pr_rows(spark, [("P1", "V1", "G", "I", D("10.00"))])
    g = g2b_rows(spark, [("G1", "G", "I", filed, DAY)])
    r = rec_by_pair(spark, pr, g)[("P1", "G1")]
    assert (r.match_status, r.mismatch_type) == (status, mtype)
    if filed is None:
        assert r.tax_difference is None


@pytest.mark.parametrize("days,barred", [(365, False), (366, True), (None, False)])
def test_time_bar(spark, days, barred):
    filing = None if days is None else DAY + dt.timedelta(days=days)
    pr = pr_rows(spark, [("P1", "V1", "G", "I", D("10.00"))])
    g = g2b_rows(spark, [("G1", "G", "I", D("10.00"), filing)])
    r = rec_by_pair(spark, pr, g)[("P1", "G1")]
    assert r.match_status == S.MATCHED
    assert (r.mismatch_type == S.TIME_BARRED) == barred


def test_many_to_many_and_one_sided(spark):
    pr = pr_rows(spark, [("P1", "V1", "G", "I", D("1.00")), ("P2", "V1", "G", "I", D("1.00")),
                         ("P3", "V1", "G", "ONLY-PR", D("5.00"))])
    g = g2b_rows(spark, [("G1", "G", "I", D("1.00"), DAY), ("G2", "G", "I", D("1.00"), DAY),
                         ("G3", "G", "ONLY-G", D("7.00"), DAY)])
    res = rec_by_pair(spark, pr, g)
    assert len(res) == 6
    assert res[("P3", None)].mismatch_type == S.MISSING_IN_GSTR2B
    assert res[("P3", None)].tax_difference == D("5.00")
    assert res[(None, "G3")].mismatch_type == S.MISSING_IN_PURCHASE_REGISTER
    ids = sorted(r.reconciliation_id for r in res.values())
    assert ids == [f"REC{i:07d}" for i in range(6)]
    # key order: (G, I) pairs first, then ONLY-G, ONLY-PR
    assert res[("P1", "G1")].reconciliation_id == "REC0000000"
    assert res[("P3", None)].reconciliation_id == "REC0000005"


def test_hot_key_path_equals_plain_join(spark):
    rows_l = [(("K" if i % 3 else f"k{i}"), None if i % 7 == 0 else "A", i) for i in range(300)]
    rows_r = [(("K" if i % 2 else f"k{i}"), None if i % 5 == 0 else "A", i) for i in range(200)]
    left = spark.createDataFrame(rows_l, "k string, a string, lv int")
    right = spark.createDataFrame(rows_r, "k string, a string, rv int")
    keys = ["k", "a"]
    hot = hot_keys_of(left, right, keys, min_rows=20, fraction=1.0)
    assert hot.count() >= 1  # "K"/"A" is hot
    plain = full_outer_join(left, right, keys, hot_keys=None)
    split = full_outer_join(left, right, keys, hot_keys=hot)
    def key(r):
        return tuple("~" if v is None else str(v) for v in r)
    a, b = sorted(plain.collect(), key=key), sorted(split.collect(), key=key)
    assert [tuple(r) for r in a] == [tuple(r) for r in b] and len(a) > 300


def test_aging_buckets_and_tie(spark):
    as_of = dt.date(2023, 3, 1)
    ages = [None, -5, 30, 31, 60, 61]
    expect = ["60+", "0-30", "0-30", "31-60", "31-60", "60+"]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = [r[0] for r in df.select(S.aging_bucket("age")).collect()]
    assert got == expect
    # tie (one 0-30 row, one 60+ row) -> smallest label
    pr = pr_rows(spark, [("P1", "V1", "G", "A", D("1.00"), as_of - dt.timedelta(days=10)),
                         ("P2", "V1", "G", "B", D("1.00"), as_of - dt.timedelta(days=100))])
    g = g2b_rows(spark, [("G1", "G", "A", D("1.00"), as_of)])
    rec = reconcile.reconcile(pr, g, as_of=as_of)
    out = leakage.itc_leakage(pr, rec, as_of=as_of).collect()
    assert len(out) == 1 and out[0].aging_bucket == "0-30"


def test_zero_claimed_and_null_vendor(spark):
    pr = pr_rows(spark, [("P1", "V1", "G", "A", D("0.00")), ("P2", None, "G", "B", D("3.00"))])
    g = g2b_rows(spark, [])
    rec = reconcile.reconcile(pr, g, as_of=DAY)
    out = leakage.itc_leakage(pr, rec, as_of=DAY).collect()
    assert [(r.vendor_id, r.leakage_percentage) for r in out] == [("V1", 0.0)]
    detail = reconcile.reconcile_detail(pr, g)
    assert leakage.itc_leakage_from_detail(detail, as_of=DAY).count() == 1


def test_features_single_invoice_and_idle_vendor(spark):
    vm = spark.createDataFrame([("V1", "Active"), ("V2", "Cancelled")],
                               "vendor_id string, gst_status string")
    pr = pr_rows(spark, [("P1", "V1", "G", "A", D("5.00"))])
    g = g2b_rows(spark, [("G1", "G", "A", D("5.00"), DAY)])
    rec = reconcile.reconcile(pr, g, as_of=DAY)
    comp = spark.createDataFrame([], "record_id string, vendor_id string, filing_status string, "
                                     "delay_days int")
    f = {r.vendor_id: r for r in risk.vendor_features(vm, rec, comp, pr).collect()}
    assert f["V1"].std_transaction == 0.0 and f["V1"].transaction_count == 1
    assert all(getattr(f["V2"], c) == 0 for c in risk.FEATURES if c != "gst_status_score")
    scored = {r.vendor_id: r for r in risk.score_vendors(
        risk.vendor_features(vm, rec, comp, pr)).collect()}
    assert scored["V2"].vendor_risk_score == pytest.approx(30.0)


def test_risk_category_edges(spark):
    df = spark.createDataFrame([(v,) for v in [19.99, 20.0, 39.99, 40.0, None]], "s double")
    got = [r[0] for r in df.select(S.risk_category("s")).collect()]
    assert got == ["Low", "Medium", "Medium", "High", "High"]


def test_period_parser_and_freq(spark):
    labels = ["2023-Q2", "2023Q2", " 2023-04 ", "202304", "2023-04-05", "202313", "x", "2023",
              "20230115", None]
    df = spark.createDataFrame([(v,) for v in labels], "p string")
    got = [r[0] for r in df.select(parse_tax_period("p")).collect()]
    d = dt.date
    assert got == [d(2023, 4, 1)] * 4 + [d(2023, 4, 5), None, None, d(2023, 1, 1),
                                        d(2023, 1, 15), None]
    assert infer_freq(df, "p").first()[0] == "Q"
    assert infer_freq(spark.createDataFrame([("2023-04",)], "p string"), "p").first()[0] == "MS"
    assert infer_freq(spark.createDataFrame([("2023-04-01",)], "p string"), "p").first()[0] == "D"


def test_empty_filters_mean_unfiltered(spark):
    ils = spark.createDataFrame([("V1", "2023-Q1", D("10.00"), D("5.00"), D("5.00"))],
                                "vendor_id string, tax_period string, total_itc_claimed decimal(15,2),"
                                " itc_matched decimal(15,2), itc_at_risk decimal(15,2)")
    vrs = spark.createDataFrame([("V1", "Low")], "vendor_id string, risk_category string")
    assert dashboards.d1_kpis(ils, vrs).first().leakage_pct == 50.0
    assert dashboards.d1_kpis(ils, vrs, risks=["High"]).first().total_itc == 0


def test_id_width(spark):
    df = spark.createDataFrame([(0,), (42,), (10_000_000,)], "n long")
    got = [r[0] for r in df.select(S.padded_id("n")).collect()]
    assert got == ["REC0000000", "REC0000042", "REC10000000"]


def test_dense_ordinals_are_a_permutation_in_order(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        (F.col("id") * 7919 % 5000).alias("v"))
    out = dense_ordinals(df, [F.col("v")], "o").collect()
    assert sorted((r.v, r.o) for r in out) == [(i, i) for i in range(5000)]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.gamma(2.0, 50.0, 3001), 2)
    vals[::17] = 0.0
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double")
    got = exact_quantiles(df.repartition(5), "x", [0.05, 0.5, 0.95, 0.0, 1.0])
    want = np.percentile(vals, [5, 50, 95, 0, 100])
    assert got == pytest.approx(list(want), rel=1e-12)


def test_forecast_empty_input_and_flat_single_point(spark):
    from credtrail.operators.forecast import forecast
    empty = spark.createDataFrame([], "tax_period string, y double")
    assert forecast(empty, [], "tax_period", "y").count() == 0
    one = spark.createDataFrame([("2023-Q1", 10.0)], "tax_period string, y double")
    rows = forecast(one, [], "tax_period", "y", horizon=2).collect()
    assert [str(r.ds) for r in rows] == ["2023-01-01", "2023-04-01", "2023-07-01"]
    assert all(r.yhat == 10.0 for r in rows)


def test_forecast_many_series_and_monthly_steps(spark):
    from credtrail.operators.forecast import forecast
    rows = [(s, f"2023-{m:02d}", float(m * (2 if s == "a" else 1))) for s in ("a", "b")
            for m in range(1, 7)]
    df = spark.createDataFrame(rows, "s string, tax_period string, y double")
    out = forecast(df, ["s"], "tax_period", "y", horizon=3).collect()
    fut = [r for r in out if r.ds > dt.date(2023, 6, 1)]
    assert sorted({str(r.ds) for r in fut}) == ["2023-07-01", "2023-08-01", "2023-09-01"]
    assert len(fut) == 6
    seas = forecast(df, ["s"], "tax_period", "y", horizon=3, method="seasonal").collect()
    assert len(seas) == 18
