"""S7: a table is replaced as a whole or not at all."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from credtrail.sources import io, versions
from credtrail.sources.schemas import TABLES


def fresh():
    return tempfile.mkdtemp(prefix="credtrail-versions-") + "/table"


def failing(df):
    """Rows of which some are written before the job fails."""
    return df.repartition(4).withColumn("n", F.when(F.col("n") == 7, F.raise_error(F.lit("lost executor")).cast("long")).otherwise(F.col("n")))


def numbers(df):
    return sorted(r.n for r in df.collect())


def test_a_failed_write_leaves_the_old_version(spark):
    path = fresh()
    assert versions.replace_version(spark.range(3).toDF("n"), path) == 1
    with pytest.raises(Exception, match="lost executor"):
        versions.replace_version(failing(spark.range(20).toDF("n")), path)
    assert numbers(versions.read_version(spark, path)) == [0, 1, 2] and versions.current(spark, path)["number"] == 1
    assert len([x for x in os.listdir(path) if x.startswith("data-")]) == 2  # what the failed write left
    assert len(versions.remove_unfinished(spark, path)) == 1
    assert numbers(versions.read_version(spark, path)) == [0, 1, 2]


def test_replaced_from_itself_and_old_versions_stay_for_readers(spark):
    path = fresh()
    versions.replace_version(spark.range(3).toDF("n"), path)
    held = versions.read_version(spark, path)  # a reader that began before the replacement
    for k in range(1, 4):
        versions.replace_version(versions.read_version(spark, path).select((F.col("n") * 2).alias("n")), path)
        assert numbers(versions.read_version(spark, path)) == [0, 2 ** k, 2 * 2 ** k]
        if k == 1:
            assert numbers(held) == [0, 1, 2] and numbers(versions.read_version(spark, path, 1)) == [0, 1, 2]
    assert len([x for x in os.listdir(path) if x.startswith("data-")]) == versions.KEEP


def test_two_writers_both_finish_and_the_later_holds(spark, monkeypatch):
    path = fresh()
    versions.replace_version(spark.range(1).toDF("n"), path)
    before = versions._versions
    stale = before(versions.Folder(spark, path))
    monkeypatch.setattr(versions, "_versions", lambda folder: stale)  # both saw version 1 only
    assert versions.replace_version(spark.range(2).toDF("n"), path) == 2
    assert versions.replace_version(spark.range(4).toDF("n"), path) == 3
    monkeypatch.setattr(versions, "_versions", before)
    assert numbers(versions.read_version(spark, path)) == [0, 1, 2, 3]
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, fresh())


def test_plain_folders_are_swapped(spark):
    path = fresh()
    versions.swap_folder(spark.range(3).toDF("n"), path)
    with pytest.raises(Exception, match="lost executor"):
        versions.swap_folder(failing(spark.range(20).toDF("n")), path)
    assert numbers(spark.read.parquet(path)) == [0, 1, 2] and os.listdir(os.path.dirname(path)) == ["table"]
    versions.swap_folder(spark.read.parquet(path).filter("n > 0"), path)
    assert numbers(spark.read.parquet(path)) == [1, 2]
    os.rename(path, path + "._old")  # a run that ended between the two renames
    versions.settle(spark, path)
    assert numbers(spark.read.parquet(path)) == [1, 2]


def test_sink_and_pipeline_reader_follow_versions(spark, catalog):
    from credtrail.plans.pipeline import read_table
    path = fresh()
    ils = catalog.table("itc_leakage_summary")
    io.write_table(ils, "itc_leakage_summary", path, partition_by=("tax_period",), versioned=True)
    got = read_table(spark, "itc_leakage_summary", path)
    assert got.columns == TABLES["itc_leakage_summary"].fieldNames() and got.count() == ils.count()
    io.write_table(got.filter("tax_period = '1995-Q1'"), "itc_leakage_summary", path, versioned=True)
    assert read_table(spark, "itc_leakage_summary", path).exceptAll(ils.filter("tax_period = '1995-Q1'")).isEmpty()


def test_forecast_csv_keeps_series_columns(spark):
    fc = spark.createDataFrame([("a", "2023-01-01", 1.0, 0.5, 1.5), ("b", "2023-01-01", 2.0, 1.0, 3.0)],
                               "vendor_id string, ds string, yhat double, yhat_lower double, yhat_upper double")
    path = fresh()
    io.write_forecast_csv(fc, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["vendor_id", "ds", "yhat", "yhat_lower", "yhat_upper"] and back.count() == 2
