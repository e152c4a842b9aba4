"""Sources and sinks, streaming ingest, and the end-to-end pipeline."""

import contextlib
import datetime as dt
import io as io_text
import os
import tempfile

import pytest

from credtrail.operators import anomaly
from credtrail.sources import io, quality, testdata
from credtrail.sources.schemas import TABLES, cast_to_schema
from tests.conftest import SF_SMALL


def _tmp():
    return tempfile.mkdtemp(prefix="credtrail-test-")


def test_csv_load_order_and_missing(spark, catalog):
    d = _tmp()
    for name in ("vendor_master", "purchase_register"):
        catalog.table(name).write.option("header", True).csv(f"{d}/{name}.csv")
    tables, report = io.load_tables(spark, d, fmt="csv")
    assert report["gstr2b_data"]["status"] == "missing"
    assert set(tables) == {"vendor_master", "purchase_register"}
    assert tables["purchase_register"].schema == TABLES["purchase_register"]
    assert tables["purchase_register"].count() == catalog.table("purchase_register").count()
    assert quality.fk_orphans(tables["purchase_register"], "vendor_id",
                              tables["vendor_master"], "vendor_id").count() == 0


def test_unreadable_table_is_reported_and_others_load(spark, catalog):
    d = _tmp()
    catalog.table("vendor_master").write.parquet(f"{d}/vendor_master")
    os.makedirs(f"{d}/gstr2b_data")
    with open(f"{d}/gstr2b_data/part-0.parquet", "w") as fh:
        fh.write("not a parquet file")
    tables, report = io.load_tables(spark, d)
    assert list(report) == io.LOAD_ORDER and len(report) == 7
    assert report["gstr2b_data"]["status"] == "error"
    assert report["vendor_master"]["status"] == "loaded" and "vendor_master" in tables
    assert report["purchase_register"]["status"] == "missing"


def test_run_goes_on_without_a_table_and_with_a_corrupt_later_file(spark, catalog):
    from credtrail.plans.pipeline import run_pipeline
    src, out = _tmp(), _tmp()
    for name in ("vendor_master", "purchase_register", "gstr2b_data"):
        catalog.table(name).write.parquet(f"{src}/{name}")
    with open(f"{src}/gstr2b_data/zz-part.parquet", "w") as fh:
        fh.write("not a parquet file")
    report = run_pipeline(spark, src, out, as_of=catalog.as_of)
    load = report["stages"]["load"]
    assert load["vendor_filing_compliance"]["status"] == "missing" and load["gstr2b_data"]["status"] == "error"
    assert load["purchase_register"]["status"] == "loaded"
    got = spark.read.parquet(f"{out}/invoice_reconciliation_results")
    assert got.count() == catalog.table("purchase_register").count()
    assert got.filter("mismatch_type <> 'Missing in GSTR2B'").count() == 0
    assert spark.read.parquet(f"{out}/vendor_filing_compliance").schema.fieldNames() == \
        TABLES["vendor_filing_compliance"].fieldNames()


def test_csv_columns_are_bound_by_name(spark):
    d = _tmp()
    with open(f"{d}/vendor_master.csv", "w") as fh:
        fh.write("vendor_name,vendor_id,state,registration_date,surplus\nAcme,V1,KA,04/05/2023,x\nBeta,V2,TN,2023-02-30,\n")
    got = io.read_csv(spark, f"{d}/vendor_master.csv", "vendor_master").orderBy("vendor_id").collect()
    assert [(r.vendor_id, r.vendor_name, r.gstin, str(r.registration_date)) for r in got] == [
        ("V1", "Acme", None, "2023-04-05"), ("V2", "Beta", None, "None")]
    raw = io.read_csv_text(spark, f"{d}/vendor_master.csv")
    report = io.write_staged(raw, "vendor_master", f"{d}/out")
    assert report == {"lost_dates": {"registration_date": 1}}
    day_first = io.read_csv(spark, f"{d}/vendor_master.csv", "vendor_master", day_first=True)
    assert str(day_first.orderBy("vendor_id").first().registration_date) == "2023-05-04"


def test_files_of_one_folder_must_share_the_header(spark):
    d = _tmp()
    for name, head in (("a", "vendor_id,vendor_name"), ("b", "vendor_name,vendor_id")):
        with open(f"{d}/{name}.csv", "w") as fh:
            fh.write(f"{head}\n1,2\n")
    with pytest.raises(Exception, match="header|schema"):
        io.read_csv(spark, d, "vendor_master").collect()


def test_date_coercion_bad_values_null(spark):
    df = spark.createDataFrame([("2023-01-05", "x"), ("bad", "y"), (None, "z")],
                               "filing_date string, note string")
    out = io.coerce_date_columns(df).collect()
    assert str(out[0].filing_date) == "2023-01-05" and out[1].filing_date is None
    assert out[0].note == "x"


@pytest.mark.parametrize("text,date,day_first", [
    ("2023-04-05T10:00:00", "2023-04-05", "2023-04-05"), ("2023-4-5", "2023-04-05", "2023-04-05"),
    ("2023-04-05 10:00:00.5", "2023-04-05", "2023-04-05"), ("01/02/2023", "2023-01-02", "2023-02-01"),
    ("25/12/2023", "2023-12-25", "2023-12-25"), ("12/25/2023 08:30", "2023-12-25", "2023-12-25"), ("20230405", "2023-04-05", "2023-04-05"),
    ("5 Apr 2023", "2023-04-05", "2023-04-05"), ("April 5, 2023", "2023-04-05", "2023-04-05"), ("2023-04-05T10:00:00Z", "2023-04-05", "2023-04-05"),
    ("", "None", "None"), ("13/13/2023", "None", "None"), ("no date", "None", "None")])
def test_date_layouts(spark, text, date, day_first):
    df = spark.createDataFrame([(text,)], "a_date string")
    assert str(io.coerce_date_columns(df).first().a_date) == date
    assert str(io.coerce_date_columns(df, day_first=True).first().a_date) == day_first


def test_timestamps_become_dates(spark):
    df = spark.sql("SELECT TIMESTAMP '2023-04-05 23:59:59.123' AS a_date, TIMESTAMP_NTZ '2023-04-05 23:59:59.9' AS b_date")
    row = io.coerce_date_columns(df).first()
    assert str(row.a_date) == str(row.b_date) == "2023-04-05"


@pytest.mark.parametrize("n", [40, 2000, 30_000])
def test_every_tree_has_the_same_sample_size(spark, n):
    from pyspark.sql import functions as F

    from credtrail.operators.isoforest import IsolationForest
    df = spark.range(n).select("id", (F.col("id") * 7 % 101).cast("double").alias("a"), F.sin("id").alias("b"))
    model = IsolationForest(trees=20, sample_size=256, features=["a", "b"])._grow_trees(df, ["id", "a", "b"])
    roots = model.nodes[model.nodes["node"] == 0]
    assert len(roots) == 20 and set(roots["size"]) == {min(256, n)}
    scores = [r[0] for r in model.score(df).select("_score_samples").collect()]
    assert -1 <= min(scores) < max(scores) < 0


def test_model_save_load(spark, catalog):
    pr, g = catalog.table("purchase_register"), catalog.table("gstr2b_data")
    model = anomaly.train_isolation_forest(pr, g, trees=5)
    path = _tmp() + "/iforest"
    io.save_model(model, path)
    again = io.load_model(path, kind="iforest")
    a = anomaly.detect_anomalies(pr, g, model=model).select("anomaly_score").collect()
    b = anomaly.detect_anomalies(pr, g, model=again).select("anomaly_score").collect()
    assert sorted(a) == sorted(b)
    assert io.load_model(_tmp() + "/nothing") is None


def test_streaming_ingest_exactly_once(spark, catalog):
    src, out, ck = _tmp(), _tmp() + "/out", _tmp() + "/ck"
    vm = catalog.table("vendor_master")
    vm.limit(4).write.mode("overwrite").option("header", True).csv(f"{src}/a")
    from credtrail.streaming import ingest_stream
    q = ingest_stream(spark, f"{src}/a", "vendor_master", out, ck)
    q.awaitTermination()
    n1 = spark.read.parquet(out).count()
    q = ingest_stream(spark, f"{src}/a", "vendor_master", out, ck)  # nothing new
    q.awaitTermination()
    assert n1 == 4 and spark.read.parquet(out).count() == 4
    assert spark.read.parquet(out).schema == TABLES["vendor_master"]


def test_stream_fails_on_a_file_with_other_columns(spark):
    from credtrail.streaming import ingest_stream
    src, out, ck = _tmp(), _tmp() + "/out", _tmp() + "/ck"
    with open(f"{src}/a.csv", "w") as fh:
        fh.write("vendor_name,vendor_id,gstin,state,business_type,gst_status,registration_date,compliance_rating\nA,V1,,,,,,\n")
    q = ingest_stream(spark, src, "vendor_master", out, ck)
    with pytest.raises(Exception, match="(?i)header|schema|stream"):
        q.awaitTermination()


def test_fuzzy_matches(spark):
    from credtrail.operators.reconcile import fuzzy_matches
    pr = spark.createDataFrame(
        [("p1", "g", "INV-100", 10.0), ("p2", "g", "INV-200", 10.0), ("p3", "h", "INV-100", 10.0), ("p4", "g", "EXACT", 5.0),
         ("p5", "g", None, 1.0), ("p6", "g", "INV-1000", 10.2), ("p7", "g", "A", 1.0)],
        "purchase_invoice_id string, supplier_gstin string, invoice_number string, total_tax double")
    g = spark.createDataFrame(
        [("g1", "g", "inv-10O ", 10.0), ("g2", "g", "INV-2", 10.0), ("g4", "g", "exact", 5.0), ("g5", "g", None, 1.0), ("g7", "g", "B", 1.0),
         ("g8", "g", "INV-201", 99.0)],
        "gstr2b_id string, supplier_gstin string, invoice_number string, igst double") \
        .selectExpr("*", "0D AS cgst", "0D AS sgst")
    got = sorted((r.purchase_invoice_id, r.gstr2b_id, r.edits) for r in fuzzy_matches(pr, g).collect())
    assert got == [("p1", "g1", 1), ("p7", "g7", 1)]  # p6 is two edits away, g8's tax too far
    split = fuzzy_matches(pr, g, sample_fraction=1.0, min_hot_rows=2, pairs_per_cell=2)
    assert sorted((r.purchase_invoice_id, r.gstr2b_id, r.edits) for r in split.collect()) == got


def test_pipeline_end_to_end(spark, catalog):
    from credtrail.plans.pipeline import run_pipeline
    src, out = _tmp(), _tmp()
    for name in ("vendor_master", "purchase_register", "gstr2b_data",
                 "vendor_filing_compliance"):
        catalog.table(name).write.parquet(f"{src}/{name}")
    from credtrail.session import checkpoint_root
    want = catalog.table("invoice_reconciliation_results").count()  # writes tables of its own
    before = os.listdir(checkpoint_root(spark).removeprefix("file:"))
    report = run_pipeline(spark, src, out, as_of=catalog.as_of)
    assert report["stages"]["invoice_reconciliation_results"]["rows"] == want
    fc = spark.read.option("header", True).csv(f"{out}/itc_forecast")
    assert fc.columns == ["ds", "yhat", "yhat_lower", "yhat_upper"] and fc.count() > 4
    assert os.path.exists(f"{out}/anomalies") and report["stages"]["itc_forecast"]["method"] == "seasonal"
    # at most files_per_value files for a period; what was left over in between is deleted
    assert max(len([f for f in files if f.endswith(".parquet")])
               for d, _, files in os.walk(f"{out}/itc_leakage_summary")) <= 8
    assert not [x for x in os.listdir(checkpoint_root(spark).removeprefix("file:")) if x.startswith("reconciliation-detail")
                and x not in before]
    assert report["stages"]["anomalies"]["model"] == "quantile rule"
    # the leakage table is partitioned by tax period: a period filter prunes folders
    from credtrail.plans.pipeline import read_table
    ils = read_table(spark, "itc_leakage_summary", f"{out}/itc_leakage_summary")
    assert ils.columns == list(TABLES["itc_leakage_summary"].fieldNames())
    assert ils.count() == catalog.table("itc_leakage_summary").count()
    one = ils.filter(ils.tax_period == "1995-Q1")
    buf = io_text.StringIO()
    with contextlib.redirect_stdout(buf):
        one.explain()
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(tax_period" in plan and "1995-Q1" in plan
    assert os.path.isdir(f"{out}/itc_leakage_summary/tax_period=1995-Q1")
    # train, save, and rerun: the saved models are picked up
    from credtrail.plans.pipeline import train_models
    models = _tmp()
    info = train_models(spark, out, models)
    assert info["anomaly_threshold"] is not None
    out2 = _tmp()
    report2 = run_pipeline(spark, src, out2, as_of=catalog.as_of, model_dir=models)
    assert report2["stages"]["vendor_risk_scores"]["model"] == "random forest"
    assert report2["stages"]["anomalies"]["model"] == "isolation forest"
    flagged = spark.read.parquet(f"{out2}/anomalies")
    assert 0 < flagged.filter("is_anomaly").count() < 0.2 * flagged.count()


def test_pipeline_from_csv_inputs(spark, catalog):
    """The reference's inputs are CSV files: same reconciliation from a CSV drop folder."""
    from credtrail.plans.pipeline import run_pipeline
    src, out = _tmp(), _tmp()
    for name in ("vendor_master", "purchase_register", "gstr2b_data",
                 "vendor_filing_compliance"):
        catalog.table(name).write.option("header", True).csv(f"{src}/{name}.csv")
    report = run_pipeline(spark, src, out, as_of=catalog.as_of, input_format="csv")
    assert all(report["stages"]["load"][n]["status"] == "loaded"
               for n in ("vendor_master", "purchase_register", "gstr2b_data",
                         "vendor_filing_compliance"))
    got = spark.read.parquet(f"{out}/invoice_reconciliation_results")
    want = catalog.table("invoice_reconciliation_results")
    cols = ["reconciliation_id", "purchase_invoice_id", "gstr2b_id", "match_status",
            "mismatch_type", "tax_difference"]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert got.count() == want.count()


def test_written_inputs_are_narrow_and_compressed(spark, monkeypatch, tmp_path):
    import glob

    from credtrail.plans import catalog
    kept = {}
    write = catalog.write_snapshot
    monkeypatch.setattr(catalog, "write_snapshot", lambda df, name: kept.setdefault(name, write(df, name)))
    c = catalog.Catalog(spark, SF_SMALL, dt.date(1999, 1, 1))
    monkeypatch.setattr(catalog, "_written", {})
    c.table("purchase_register")
    assert len(kept["invoice-base"].columns) == 7
    base = testdata.invoice_base(c.raw("lineitem"), c.raw("supplier"), c.raw("nation"))
    for name in ("purchase_register", "gstr2b_data", "vendor_filing_compliance"):
        want, got = cast_to_schema(getattr(testdata, name)(base), name), c.table(name)
        assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()
        path = catalog._written[c._key(name)]
        assert glob.glob(f"{path.removeprefix('file:')}/*.zstd.parquet")
