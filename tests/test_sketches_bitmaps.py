"""Distinct counts by bitmaps, quantile sketches, Bloom filters, aggregates from the store."""

import datetime as dt
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from credtrail.functions import distinct as D
from credtrail.operators import bloom
from credtrail.operators.quantiles import exact_quantiles, merged_sketches, quantile_sketches, sketch_quantiles, sketch_size
from credtrail.sources import quality, store


# --- distinct counts --------------------------------------------------------------------------

@pytest.mark.parametrize("ids", ["REC%07d", "free"])
def test_distinct_counts_with_repeated_keys(spark, ids):
    rows = [(f"g{i % 3}" if i % 5 else None, (ids % (i * 7 % 90_000) if ids != "free" else f"k-{i % 700}é") if i % 11 else None, i % 4)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "grp string, id string, kind int").repartition(6)
    got = {r.grp: (r.all_ids, r.ones) for r in D.distinct_counts(
        df, ["grp"], "id", {"all_ids": F.lit(True), "ones": F.col("kind") == 1}).collect()}
    want = {}
    for g, i, k in rows:
        both = want.setdefault(g, (set(), set()))
        if i is not None:
            both[0].add(i)
            if k == 1:
                both[1].add(i)
    assert got == {g: (len(a), len(b)) for g, (a, b) in want.items()}


def test_numbers_are_one_to_one_with_keys(spark):
    for keys in (["A1", "A01", "A001"], ["A1", "B1"], ["A10", "A9"], ["REC0000001", "REC10000000", "REC0000002"], ["x", "A1"],
                 ["", "1", "01"], ["A" + "9" * 30, "A1"], ["A09", "A10", "A100"]):
        df = spark.createDataFrame([(k,) for k in [*keys, *keys, None]], "id string")
        got = {(r.id, r._number) for r in D.with_numbers(df, "id").collect()}
        assert len({n for k, n in got if k is not None}) == len(keys) == len({k for k, n in got if k is not None and n is not None}), keys
        assert (None, None) in got


def test_bitmaps_of_parts_merge_and_need_no_expand(spark):
    df = spark.range(0, 200_000).select((F.col("id") % 100_000).alias(D.NUMBER), (F.col("id") % 2).alias("grp"))
    conditions = {"a": F.lit(True), "b": F.col("grp") == 0}
    parts = [D.bitmaps(df.filter(f"pmod(hash(_number), 3) = {k}").withColumn("part", F.lit(k)), ["grp", "part"], conditions) for k in range(3)]
    whole = D.merged_bitmaps(parts[0].union(parts[1]).union(parts[2]), ["grp"], ["a", "b"])
    got = {r.grp: (r.a, r.b) for r in D.counted(whole, ["grp"], ["a", "b"]).collect()}
    assert got == {0: (50_000, 50_000), 1: (50_000, 0)}
    plan = D.counted(D.bitmaps(df, ["grp"], conditions), ["grp"], ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


# --- quantile sketches ------------------------------------------------------------------------

def rank_error(values, got, p):
    """How far p lies outside the ranks that the value takes, as a share of the rows."""
    low, high = np.searchsorted(values, got, "left") / len(values), np.searchsorted(values, got, "right") / len(values)
    return max(low - p, p - high, 0)


@pytest.mark.parametrize("kind", ["skewed", "tied", "sorted"])
def test_sketches_keep_their_rank_error(spark, kind):
    r = np.random.default_rng(5)
    values = {"skewed": np.exp(r.normal(size=60_000) * 3), "tied": r.integers(0, 7, 60_000).astype(float) ** 3,
              "sorted": np.arange(60_000.0)}[kind]
    df = spark.createDataFrame([(float(v), int(i % 9)) for i, v in enumerate(values)] + [(None, 1), (float("nan"), 2)], "x double, part int")
    probs = [0.0, 0.01, 0.05, 0.25, 0.5, 0.9, 0.95, 0.999, 1.0]
    ordered = np.sort(values)
    got = exact_quantiles(df, "x", probs, approximate=True, rank_error=0.01)
    assert max(rank_error(ordered, g, p) for g, p in zip(got, probs, strict=True)) <= 0.01
    # sketches of parts, stored and merged
    path = tempfile.mkdtemp(prefix="credtrail-sketch-") + "/parts"
    quantile_sketches(df, "x", ["part"], rank_error=0.01).write.parquet(path)
    row = sketch_quantiles(merged_sketches(spark.read.parquet(path), [], rank_error=0.01), probs).first()
    assert row.n == len(values) and max(rank_error(ordered, g, p) for g, p in zip(row.quantiles, probs, strict=True)) <= 0.01
    plan = quantile_sketches(df, "x")._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan


def test_sketches_of_nothing_and_their_size(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(empty, "x", [0.5], approximate=True) == [None]
    assert sketch_size(0.01) < sketch_size(0.001) and pytest.raises(ValueError, sketch_size, 0.0)


# --- Bloom filter -----------------------------------------------------------------------------

def test_filtered_anti_join_finds_the_same_and_joins_fewer_rows(spark):
    child = spark.range(0, 30_000).select(F.when(F.col("id") % 10 == 0, F.concat(F.lit("lost"), "id")).otherwise(
        F.concat(F.lit("k"), F.col("id") % 900)).alias("fk"), "id").union(spark.createDataFrame([(None, -1)], "fk string, id long"))
    parent = spark.range(0, 900).select(F.concat(F.lit("k"), "id").alias("pk"))
    plain = quality.fk_orphans(child, "fk", parent, "pk")
    filtered = quality.fk_orphans(child, "fk", parent, "pk", bloom="auto")
    assert sorted(r.id for r in plain.collect()) == sorted(r.id for r in filtered.collect()) == list(range(0, 30_000, 10))
    made = bloom.build(parent.withColumnRenamed("pk", "_k0"), ["_k0"])
    probed = bloom.maybe_in(child.filter("fk is not null"), ["fk"], made)
    present = probed.filter("fk like 'k%'")
    assert present.count() == present.filter("_maybe").count() == 27_000  # never false for a key that is there
    assert probed.filter("fk like 'lost%' and _maybe").count() <= 0.02 * 3_000
    # with NULL keys, which match each other
    with_null = bloom.anti_join(child, ["fk"], parent.union(spark.createDataFrame([(None,)], "pk string")), ["pk"])
    assert with_null.count() == 3_000
    assert bloom.anti_join(child, ["fk"], parent.limit(0), ["pk"]).count() == child.count()


def test_a_filter_that_would_be_too_large_is_left_out(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MAX_BYTES", 1000)
    parent = spark.range(0, 900).select(F.col("id").alias("pk"))
    assert bloom.build(parent.withColumnRenamed("pk", "_k0"), ["_k0"]) is None
    assert bloom.anti_join(spark.range(0, 1000), ["id"], parent, ["pk"]).count() == 100


# --- aggregates from the store ----------------------------------------------------------------

def test_aggregates_are_pushed_to_the_store(spark, catalog):
    path = catalog.by_period("purchase_register")
    table = store.open_table(spark, path)
    found = store.profile(table, ["tax_period"], ["invoice_date"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(invoice_date), MIN(invoice_date), MAX(invoice_date)]" in plan and "PushedGroupBy: [tax_period]" in plan
    want = catalog.table("purchase_register").groupBy("tax_period").agg(F.count("*").alias("n"), F.min("invoice_date").alias("low"))
    assert {(r.tax_period, r.rows, r.min_invoice_date) for r in found.collect()} == {(r.tax_period, r.n, r.low) for r in want.collect()}
    assert isinstance(found.first().max_invoice_date, dt.date)
    with pytest.raises(ValueError):
        store.profile(table, ["tax_period"], ["total_tax"])
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


# --- comparison of texts ----------------------------------------------------------------------

def test_insights_compare_texts_under_a_collation(spark):
    from credtrail.plans import insights
    vfc = spark.createDataFrame([("2023-Q1", "On Time", 0), ("2023-Q1", "on time", 1), ("2023-Q1", "DELAYED", 4)],
                                "tax_period string, filing_status string, delay_days int")
    plain, loose = (insights.i4_filing_compliance_by_period(vfc, c).first() for c in (None, "UTF8_LCASE"))
    assert (plain.on_time_filings, plain.delayed_filings) == (1, 0) and (loose.on_time_filings, loose.delayed_filings) == (2, 1)
    vm = spark.createDataFrame([("V1", "KA")], "vendor_id string, state string")
    pr = spark.createDataFrame([("P1", "V1"), ("P2", "V1")], "purchase_invoice_id string, vendor_id string")
    irr = spark.createDataFrame([("P1", "R1", "unmatched "), ("P2", "R2", "Matched")],
                                "purchase_invoice_id string, reconciliation_id string, match_status string")
    counts = [insights.i3_mismatch_rate_by_state(vm, pr, irr, collation=c).first().mismatch_count for c in (None, "UTF8_LCASE", "UTF8_LCASE_RTRIM")]
    assert counts == [0, 0, 1]
    vrs = spark.createDataFrame([("V1", "HIGH", 50.0)], "vendor_id string, risk_category string, vendor_risk_score double") \
        .selectExpr("*", "0D as mismatch_rate", "0D as filing_delay_frequency")
    names = vm.selectExpr("*", "'n' as vendor_name", "'g' as gstin")
    ils = spark.createDataFrame([("V1", 1.0)], "vendor_id string, itc_at_risk double")
    assert [insights.i5_high_risk_vendors(names, vrs, ils, collation=c).count() for c in (None, "UTF8_LCASE")] == [0, 1]
