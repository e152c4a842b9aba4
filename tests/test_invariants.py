"""t4: invariants on the sf0.001 data."""

from pyspark.sql import functions as F

from credtrail.functions import scalars as S
from credtrail.operators import anomaly, reconcile
from credtrail.operators.joins import IN_LEFT, IN_RIGHT


def test_reconcile_rows_are_pairs_plus_one_sided(catalog):
    pr, g = catalog.table("purchase_register"), catalog.table("gstr2b_data")
    d = reconcile.reconcile_detail(pr, g)
    c = d.agg(F.count_if(F.col(IN_LEFT) & F.col(IN_RIGHT)).alias("both"),
              F.count_if(F.col(IN_LEFT) & ~F.col(IN_RIGHT)).alias("l"),
              F.count_if(~F.col(IN_LEFT) & F.col(IN_RIGHT)).alias("r"),
              F.count(F.lit(1)).alias("n")).first()
    assert c.n == c.both + c.l + c.r
    assert c.l == reconcile.missing_in_filings(pr, g).count()
    assert c.r == reconcile.missing_in_register(pr, g).count()
    ids = catalog.table("invoice_reconciliation_results").select("reconciliation_id")
    assert ids.distinct().count() == ids.count() == c.n


def test_claimed_covers_matched_and_at_risk(catalog):
    ils = catalog.table("itc_leakage_summary")
    bad = ils.filter(F.col("total_itc_claimed") < F.col("itc_matched") + F.col("itc_at_risk"))
    assert bad.count() == 0


def test_status_shares_sum_to_100(catalog):
    from credtrail.plans.insights import i8_status_distribution
    rows = i8_status_distribution(catalog.table("invoice_reconciliation_results")).collect()
    assert abs(sum(r.percentage for r in rows) - 100.0) < 0.02
    assert {r.match_status for r in rows} <= {S.MATCHED, S.UNMATCHED}


def test_quantile_rule_flags_about_ten_percent(catalog):
    flagged = anomaly.detect_anomalies(catalog.table("purchase_register"),
                                       catalog.table("gstr2b_data"))
    s = anomaly.anomaly_summary(flagged).first()
    assert 0 < s.anomalies <= 0.11 * s.rows


def test_isolation_forest_flags_about_contamination(catalog):
    pr, g = catalog.table("purchase_register"), catalog.table("gstr2b_data")
    model = anomaly.train_isolation_forest(pr, g, trees=20)
    s = anomaly.anomaly_summary(anomaly.detect_anomalies(pr, g, model=model)).first()
    assert 0.05 * s.rows <= s.anomalies <= 0.15 * s.rows


def test_risk_model_trains(catalog):
    from credtrail.operators import risk
    feats = risk.vendor_features(catalog.table("vendor_master"),
                                 catalog.table("invoice_reconciliation_results"),
                                 catalog.table("vendor_filing_compliance"),
                                 catalog.table("purchase_register"))
    model, scored = risk.train_risk_model(feats, num_trees=10, max_depth=4)
    assert scored.filter("in_test").isEmpty() or risk.held_out_mse(scored).first()["mse"] >= 0
    out = risk.score_vendors(feats, model)
    assert out.count() == feats.count()
    assert out.filter(F.col("vendor_risk_score").isNull()).count() == 0
