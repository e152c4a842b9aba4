"""Dense, ordered surrogate ids without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credtrail.functions.scalars import ID_PREFIX, ID_WIDTH, padded_id
from credtrail.session import COMPRESSION, scratch_path, shuffles_freed

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | row-in-partition


def sorted_snapshot(df: DataFrame, order: list[Column], drop: list[str] = ()) -> DataFrame:
    """``df`` sorted by ``order`` and written as a table in the shared checkpoint folder, without the columns
    to ``drop``, with ``_pid`` (index of its range partition) and ``_local`` (position inside it).

    Both columns are stamped by the tasks that sort the data, in the same
    stage, so they describe exactly the rows that were written; every later
    read sees the same snapshot however often it is scanned.
    """
    ordered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    path = scratch_path(df.sparkSession, "sorted")
    with shuffles_freed(df.sparkSession):
        (ordered.withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS).cast("int"))
         .withColumn("_local", F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1))
         .drop("_mid", *drop).write.option("compression", COMPRESSION).parquet(path))
    return df.sparkSession.read.parquet(path)


def dense_ordinals(df: DataFrame, order: list[Column], name: str = "ordinal", drop: list[str] = ()) -> DataFrame:
    """Add ``name`` = 0-based position of each row in the total order ``order``. Columns to ``drop`` only
    take part in the order.

    The frame is range-partitioned and sorted by ``order`` and written to the
    shared checkpoint folder (so that partition contents are fixed even if
    executors are lost), then each row's position is the number of rows in
    earlier partitions plus its position inside its partition. Only one row
    per partition is aggregated; the big side is never reshuffled.
    ``order`` must be a total order (end it with a unique key) for the ids to
    be reproducible.
    """
    tagged = sorted_snapshot(df, order, drop)
    # one row per partition: the window below sees #partitions rows, no more
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, F.col("_off") + F.col("_local")).drop("_pid", "_local", "_off")


def with_dense_ids(df: DataFrame, order: list[Column], id_col: str,
                   prefix: str = ID_PREFIX, width: int = ID_WIDTH, drop: list[str] = ()) -> DataFrame:
    """``id_col`` = prefix + zero-padded dense ordinal (``REC0000000`` ...)."""
    out = dense_ordinals(df, order, "_ordinal", drop)
    return out.withColumn(id_col, padded_id(F.col("_ordinal"), prefix, width)).drop("_ordinal")
