"""File-stream ingest: CSV drops -> typed Parquet table, exactly once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from credtrail.sources.io import coerce_date_columns
from credtrail.sources.schemas import TABLES, cast_to_schema


def ingest_stream(spark: SparkSession, source_dir: str, table: str, target_dir: str,
                  checkpoint_dir: str, *, available_now: bool = True,
                  max_files_per_trigger: int | None = None):
    """Start a stream that appends every new CSV file in ``source_dir`` to ``target_dir``.

    Columns are read as text with the declared names, date columns coerced,
    then cast to the declared schema. Each file's header is checked against the
    declared names in their order; a different one fails the query instead of
    filling the wrong columns. The checkpoint records which files were
    committed, so a restarted or failed run neither skips nor repeats a file.
    Returns the ``StreamingQuery`` (call ``awaitTermination()`` for a
    one-shot ``availableNow`` run).
    """
    schema = TABLES[table]
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    reader = spark.readStream.schema(text).option("header", True) \
        .option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    typed = cast_to_schema(coerce_date_columns(reader.csv(source_dir)), table)
    writer = (typed.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_dir).option("path", target_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
