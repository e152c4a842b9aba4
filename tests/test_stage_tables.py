"""Stage tables are made when they are asked for, from one written detail."""

import pytest

from credtrail.plans import catalog as C
from credtrail.plans import pipeline
from credtrail.sources import testdata

LINES = [(o, o % 3 + 1, n, f"199{o % 5 + 3}-0{o % 9 + 1}-11", 100.0 * o + n, 0.01 * (o % 9)) for o in range(1, 90) for n in (1, 2)]


@pytest.fixture
def made(spark, tmp_path):
    """A catalog over rows of its own."""
    tables = {"lineitem": (LINES, "l_orderkey long, l_suppkey long, l_linenumber long, l_shipdate string, l_extendedprice double, l_tax double"),
              "supplier": ([(k, f"S{k}", k) for k in (1, 2, 3)], "s_suppkey long, s_name string, s_nationkey long"),
              "nation": ([(k, f"N{k}") for k in (1, 2, 3)], "n_nationkey long, n_name string")}
    for name, (rows, shape) in tables.items():
        spark.createDataFrame(rows, shape).write.parquet(f"{tmp_path}/{name}.parquet")
    return C.Catalog(spark, str(tmp_path))


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_stage_table_does_not_make_the_others(made, monkeypatch):
    from credtrail.operators import reconcile
    from credtrail.plans.registry import QUERIES
    names = []
    monkeypatch.setattr(reconcile, "write_snapshot", lambda df, name="x": (names.append(name), df)[1])
    features = QUERIES["m1_vendor_features"](made.spark, made.sf_dir)
    assert features.count() == 3 and features.filter("total_invoices > 0").count() == 3
    written = {key[2] for key in C._written if key[1] == made.sf_dir}
    assert {"reconciliation-detail", "invoice_reconciliation_results"} <= written
    assert not {"itc_leakage_summary", "vendor_risk_scores"} & written and names == []


def test_stage_tables_equal_those_made_together(made):
    t = {n: made.table(n) for n in C.INPUT_TABLES}
    want = pipeline.compute_stages(t["purchase_register"], t["gstr2b_data"], t["vendor_master"],
                                   t["vendor_filing_compliance"], as_of=made.as_of)
    for name in reversed(C.STAGE_TABLES):
        got = made.table(name)
        assert got.count() > 2 and rows(got) == rows(C.cast_to_schema(want[name], name))


def test_order_lines_are_summed_behind_the_shuffle(made, monkeypatch):
    raw = [made.raw(n) for n in ("lineitem", "supplier", "nation")]
    raw[0] = raw[0].unionByName(raw[0].filter("l_orderkey < 20")).unionByName(raw[0].selectExpr("* except(l_orderkey)", "cast(null as long) l_orderkey"))
    want = testdata.invoice_sums(*raw)
    got = testdata.invoice_sums(*raw, parts=5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == rows(want) and got.schema == want.schema
    assert "Aggregate" in plan and "Aggregate" not in plan[plan.index("REPARTITION_BY_NUM"):]
    # the catalog deals them to parts that fit in memory
    parts = []
    sums = testdata.invoice_sums
    monkeypatch.setattr(C, "LINES_PER_PART", 10)
    monkeypatch.setattr(C.testdata, "invoice_sums", lambda *a: (parts.append(a[3]), sums(*a))[1])
    again = C.Catalog(made.spark, made.sf_dir + "/")
    assert again.table("purchase_register").count() > 100 and parts == [-(-len(LINES) // 10)]
