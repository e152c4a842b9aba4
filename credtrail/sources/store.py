"""Aggregates that the store answers (S6): MIN, MAX and COUNT from Parquet footers.

Spark's V2 Parquet source can answer these from the files' statistics without reading a row, also for each value
of the columns that the table is partitioned by. That takes two settings, which would change every other
read; so the table is opened in a session of its own that shares the application.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
            "spark.sql.parquet.aggregatePushdown": "true"}
#: types whose statistics answer MIN and MAX (texts and decimals have none that may be used)
COUNTED = ("date", "int", "bigint", "smallint", "tinyint", "float", "double", "boolean")


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table at ``path`` in a session that pushes aggregates down."""
    own = spark.newSession()
    for key, value in SETTINGS.items():
        own.conf.set(key, value)
    return own.read.parquet(path)


def profile(table: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(by..., rows, for each column count, min and max), from the footers if ``by`` are the partition columns."""
    kinds = dict(table.dtypes)
    unfit = [c for c in columns if kinds[c] not in COUNTED]
    if unfit:
        raise ValueError(f"no MIN or MAX from statistics for {unfit}")
    parts = [x for c in columns for x in (F.count(c).alias(f"count_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]
    return table.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *parts)
