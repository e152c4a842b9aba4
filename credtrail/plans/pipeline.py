"""The end-to-end run: load, reconcile, risk, leakage, anomalies, forecasts.

Each stage is a DataFrame function; the runner writes every stage output as
a table (Parquet, cast to the declared schema) and later stages read the
written table, which cuts lineage at every boundary. Only one big shuffle
join happens (the reconciliation); leakage and vendor features aggregate its
written detail instead of joining the results back to the register. A missing
or unreadable input counts as an empty table and is reported.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from credtrail.operators import leakage, reconcile, risk
from credtrail.session import temporary_snapshots, write_snapshot


def stage_detail(pr: DataFrame, g2b: DataFrame, *, hot_keys="auto") -> DataFrame:
    """The reconciliation detail in the columns that the three stage outputs read: ids, keys, the
    purchase side's vendor / period / date / tax, and the classification."""
    needed = ["supplier_gstin", "invoice_number", "purchase_invoice_id", "gstr2b_id",
              "vendor_id", "tax_period_pr", "invoice_date_pr", "total_tax", "match_status",
              "mismatch_type", "tax_difference", "_in_left", "_in_right"]
    return reconcile.reconcile_detail(pr, g2b, hot_keys=hot_keys).select(*needed)


def stage_output(name: str, detail: DataFrame, pr: DataFrame, vm: DataFrame, comp: DataFrame, *,
                 as_of=None, risk_model=None) -> DataFrame:
    """One of the outputs of ``compute_stages`` from the written detail."""
    if name == "invoice_reconciliation_results":
        return reconcile.results_from_detail(detail, as_of=as_of, with_ids=True, written=True)
    if name == "itc_leakage_summary":
        return leakage.itc_leakage_from_detail(detail, as_of=as_of)
    feats = risk.vendor_features_from_detail(vm, detail, comp, pr)
    return feats if name == "_features" else risk.risk_table(risk.score_vendors(feats, risk_model))


def compute_stages(pr: DataFrame, g2b: DataFrame, vm: DataFrame, comp: DataFrame, *,
                   as_of=None, risk_model=None, hot_keys="auto") -> dict[str, DataFrame]:
    """Reconciliation results, leakage summary and risk scores.

    The reconciliation detail is written as a table first (so the join runs
    once and a lost executor costs no more than reading it again), the ids of
    the results as well; the other frames are lazy over the detail.
    """
    detail = write_snapshot(stage_detail(pr, g2b, hot_keys=hot_keys), "reconciliation-detail")
    return {name: stage_output(name, detail, pr, vm, comp, as_of=as_of, risk_model=risk_model)
            for name in ("invoice_reconciliation_results", "itc_leakage_summary", "vendor_risk_scores", "_features")}


RISK_MODEL, ANOMALY_MODEL = "vendor_risk_model", "anomaly_model"
PARTITIONING = {"itc_leakage_summary": ("tax_period",)}


def read_table(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Read a written stage table with its declared schema (and column order).

    Declaring the schema keeps partition values such as ``202304`` as text
    instead of letting partition-type inference turn them into numbers. A versioned table is read
    as its newest manifest names it.
    """
    from credtrail.sources import versions
    from credtrail.sources.schemas import TABLES
    if versions.is_versioned(spark, path):
        return versions.read_version(spark, path).select(*TABLES[table].fieldNames())
    return spark.read.schema(TABLES[table]).parquet(path).select(*TABLES[table].fieldNames())


def train_models(spark: SparkSession, output_dir: str, model_dir: str, *, seed: int = 42) -> dict:
    """Train both models from a finished run's tables and save them under ``model_dir``.

    The random forest learns the vendor features (synthetic target: rule
    score + seeded noise); the isolation forest learns the merged invoices.
    """
    from credtrail.operators import anomaly
    from credtrail.sources import io

    t = {n: read_table(spark, n, f"{output_dir}/{n}") for n in
         ("vendor_master", "purchase_register", "gstr2b_data", "vendor_filing_compliance",
          "invoice_reconciliation_results")}
    feats = risk.vendor_features(t["vendor_master"], t["invoice_reconciliation_results"],
                                 t["vendor_filing_compliance"], t["purchase_register"])
    model, scored = risk.train_risk_model(feats, seed=seed)
    mse = risk.held_out_mse(scored).first()["mse"]
    io.save_model(model, f"{model_dir}/{RISK_MODEL}")
    iforest = anomaly.train_isolation_forest(t["purchase_register"], t["gstr2b_data"], seed=seed)
    io.save_model(iforest, f"{model_dir}/{ANOMALY_MODEL}")
    return {"risk_model_mse": mse, "anomaly_threshold": iforest.offset}


def stage_inputs(spark: SparkSession, input_dir: str, output_dir: str, *, fmt: str = "parquet",
                 day_first: bool = False) -> tuple[dict[str, DataFrame], dict]:
    """Write the four input tables to ``output_dir`` and read them back.

    A table that is missing, or of which any file can't be read, becomes an empty table with the
    declared schema; the others go on. The report names the status and the dates that were lost.
    """
    from credtrail.sources import io

    raw: dict[str, DataFrame] = {}
    _, report = io.load_tables(spark, input_dir, fmt=fmt, names=io.INPUT_ORDER, day_first=day_first, raw=raw)
    staged = {}
    for name in io.INPUT_ORDER:
        path = f"{output_dir}/{name}"
        if report[name]["status"] == "loaded":
            try:
                report[name] |= io.write_staged(raw[name], name, path, day_first=day_first)
            except Exception as e:  # one bad file does not stop the others
                report[name] |= {"status": "error", "error": str(e)[:500]}
        if report[name]["status"] != "loaded":
            io.write_table(io.empty_table(spark, name), name, path)
        staged[name] = read_table(spark, name, path)
    return staged, report


def run_pipeline(spark: SparkSession, input_dir: str, output_dir: str, *,
                 as_of=None, input_format: str = "parquet", forecast_horizon: int = 4,
                 forecast_method: str = "seasonal", day_first: bool = False,
                 model_dir: str | None = None, versioned: bool = False) -> dict:
    """Run every stage over the input tables in ``input_dir``; write to ``output_dir``.

    ``input_dir`` holds the four input tables (vendor_master, purchase_register,
    gstr2b_data, vendor_filing_compliance) as Parquet folders or CSV files.
    Saved models under ``model_dir`` are used when present; otherwise the
    risk score is the weighted rule and anomalies use the quantile rule.
    Forecasts fit a trend with yearly seasonality unless ``forecast_method`` is
    "trend". With ``versioned`` the three result tables keep versions (``sources.versions``); else their
    folders are swapped. Returns a per-stage report (row counts, written paths).
    """
    with temporary_snapshots(spark):
        return _run(spark, input_dir, output_dir, as_of or dt.date.today(), input_format,
                    forecast_horizon, forecast_method, day_first, model_dir, versioned)


def _run(spark, input_dir, output_dir, as_of, input_format, horizon, method, day_first, model_dir, versioned) -> dict:
    from credtrail.operators import anomaly, forecast
    from credtrail.sources import io

    risk_model = io.load_model(f"{model_dir}/{RISK_MODEL}") if model_dir else None
    anomaly_model = (io.load_model(f"{model_dir}/{ANOMALY_MODEL}", kind="iforest")
                     if model_dir else None)
    report: dict = {"as_of": str(as_of), "stages": {}}
    staged, report["stages"]["load"] = stage_inputs(spark, input_dir, output_dir, fmt=input_format,
                                                    day_first=day_first)

    out = compute_stages(staged["purchase_register"], staged["gstr2b_data"],
                         staged["vendor_master"], staged["vendor_filing_compliance"],
                         as_of=as_of, risk_model=risk_model)
    for name in ("invoice_reconciliation_results", "vendor_risk_scores", "itc_leakage_summary"):
        # the leakage summary is read by period (dashboard filters, forecasts):
        # one folder per tax period lets those reads skip the other periods
        path = io.write_table(out[name], name, f"{output_dir}/{name}", partition_by=PARTITIONING.get(name),
                              versioned=versioned)
        report["stages"][name] = {"path": path, "rows": read_table(spark, name, path).count()}

    anomalies = anomaly.detect_anomalies(staged["purchase_register"], staged["gstr2b_data"],
                                         model=anomaly_model)
    anomalies.write.mode("overwrite").parquet(f"{output_dir}/anomalies")
    report["stages"]["anomalies"] = {"path": f"{output_dir}/anomalies",
                                     "model": "isolation forest" if anomaly_model else "quantile rule"}
    report["stages"]["vendor_risk_scores"]["model"] = (
        "random forest" if risk_model else "weighted rule")

    ils = read_table(spark, "itc_leakage_summary", f"{output_dir}/itc_leakage_summary")
    for name, value in (("itc_forecast", "total_itc_claimed"), ("leakage_forecast", "itc_at_risk")):
        totals = forecast.period_totals(ils, "tax_period", value)
        fc = forecast.forecast(totals, [], "tax_period", "y", horizon=horizon, method=method)
        io.write_forecast_csv(fc, f"{output_dir}/{name}")
        report["stages"][name] = {"path": f"{output_dir}/{name}", "method": method}
    return report


if __name__ == "__main__":  # pragma: no cover
    import sys

    from credtrail.session import get_session

    s = get_session()
    print(json.dumps(run_pipeline(s, sys.argv[1], sys.argv[2]), default=str, indent=1))
