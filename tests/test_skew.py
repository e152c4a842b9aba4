"""Skew: one key holding a third of the rows on both sides of the reconciliation."""

import tempfile

from pyspark.sql import functions as F

from credtrail.operators import reconcile
from credtrail.operators.joins import full_outer_join, hot_keys_of


def _skewed(catalog):
    """The sf0.001 inputs plus copies that all share one (gstin, NULL invoice number) key."""
    pr, g2b = catalog.table("purchase_register"), catalog.table("gstr2b_data")
    n_pr = pr.count()
    hot_pr = pr.limit(n_pr // 2).select(
        *[F.concat(F.col(c), F.lit("-H")).alias(c) if c == "purchase_invoice_id"
          else (F.lit("99GSTHOT").alias(c) if c == "supplier_gstin"
                else (F.lit(None).cast("string").alias(c) if c == "invoice_number" else F.col(c)))
          for c in pr.columns])
    hot_g = g2b.limit(40).select(
        *[F.concat(F.col(c), F.lit("-H")).alias(c) if c == "gstr2b_id"
          else (F.lit("99GSTHOT").alias(c) if c == "supplier_gstin"
                else (F.lit(None).cast("string").alias(c) if c == "invoice_number" else F.col(c)))
          for c in g2b.columns])
    # written once, so both join paths read the same rows
    d = tempfile.mkdtemp(prefix="credtrail-skew-")
    pr.unionByName(hot_pr).write.parquet(f"{d}/pr")
    g2b.unionByName(hot_g).write.parquet(f"{d}/g2b")
    spark = pr.sparkSession
    return spark.read.parquet(f"{d}/pr"), spark.read.parquet(f"{d}/g2b"), n_pr // 2


def _rows(df):
    return sorted(tuple("~" if v is None else str(v) for v in r) for r in df.collect())


def test_detection_finds_a_third_of_the_rows(spark, catalog):
    pr, g2b, n_hot = _skewed(catalog)
    keys = ["supplier_gstin", "invoice_number"]
    hot = hot_keys_of(pr, g2b, keys, min_rows=n_hot // 2, fraction=0.05).collect()
    want = spark.createDataFrame([("99GSTHOT", None)], "a string, b string").select(
        F.xxhash64("a", "b")).first()[0]
    assert [r["_key_hash"] for r in hot] == [want]


def test_hot_path_reconciles_exactly_like_the_plain_join(spark, catalog):
    pr, g2b, n_hot = _skewed(catalog)
    plain = reconcile.reconcile_detail(pr, g2b, hot_keys=None)
    split = reconcile.reconcile_detail(pr, g2b, hot_keys="auto", min_hot_rows=n_hot // 2,
                                       sample_fraction=0.05)
    cols = ["purchase_invoice_id", "gstr2b_id", "match_status", "mismatch_type", "tax_difference"]
    a, b = _rows(plain.select(*cols)), _rows(split.select(*cols))
    assert a == b
    pairs = split.filter((F.col("supplier_gstin") == "99GSTHOT") & F.col("_in_left")
                         & F.col("_in_right")).count()
    assert pairs == n_hot * 40  # every hot purchase row meets every hot filing


def test_no_hot_keys_on_ordinary_data(catalog):
    pr, g2b = catalog.table("purchase_register"), catalog.table("gstr2b_data")
    keys = ["supplier_gstin", "invoice_number"]
    assert hot_keys_of(pr, g2b, keys).count() == 0
    auto = reconcile.reconcile_detail(pr, g2b, hot_keys="auto")
    plain = reconcile.reconcile_detail(pr, g2b, hot_keys=None)
    cols = ["purchase_invoice_id", "gstr2b_id", "match_status"]
    assert _rows(auto.select(*cols)) == _rows(plain.select(*cols))


def test_pairs_of_a_hot_key_are_spread_over_tasks(spark):
    """One key with 20,000 x 150 rows makes 3 million pairs: no task may hold a tenth of them."""
    left = spark.range(20_000).select(F.lit("hot").alias("k"), F.lit(None).cast("string").alias("m"), F.col("id").alias("l"))
    right = spark.range(150).select(F.lit("hot").alias("k"), F.lit(None).cast("string").alias("m"), F.col("id").alias("r"))
    left = left.unionByName(left.limit(3).withColumn("k", F.lit("left only")))
    right = right.unionByName(right.limit(2).withColumn("k", F.lit("right only")))
    joined = full_outer_join(left, right, ["k", "m"], sample_fraction=0.2, min_hot_rows=10_000, pairs_per_cell=50_000)
    share = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    total = sum(r["count"] for r in share)
    assert total == 20_000 * 150 + 5
    assert max(r["count"] for r in share) < 0.1 * total
    assert joined.select("l", "r").distinct().count() == total
