"""Exact distinct counts by bitmaps: several conditions in one pass, without expanding the rows.

Keys become numbers, a number one bit of a bitmap of 32,768; the bitmaps of a group are counted, and
those of several parts of the data can be merged. A plan with several COUNT(DISTINCT CASE ...) would
copy every row once for each of them; here each row is dealt once, by the bitmap its number falls into, and
all conditions set bits of their own bitmaps there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credtrail.operators.ids import dense_ordinals
from credtrail.session import write_snapshot

NUMBER = "_number"
SPARSE = 64  # numbers in use up to so many times the rows fill bitmaps well enough


def with_numbers(rows: DataFrame, key: str, name: str = NUMBER) -> DataFrame:
    """``rows`` with a number from 0 for each value of the text column ``key`` (NULL stays NULL).

    Ids of one prefix and digits, as W1 makes them (``REC0000012``), have their own number. That is checked
    over all rows first; other keys, and numbers too far apart, are numbered in a table of the distinct ones."""
    prefix = F.regexp_extract(key, r"^(.*?)\d+$", 1)
    number = F.regexp_extract(key, r"(\d{1,18})$", 1).try_cast("long")
    known = F.col(key).isNotNull()
    again = F.concat(prefix, F.lpad(number.cast("string"), F.greatest(F.length(key) - F.length(prefix), F.length(number.cast("string"))), F.lit("0")))
    # one text for each number: the same prefix, and as many digits as the smallest width or no leading zero
    width = F.length(key) - F.length(prefix)
    seen = rows.filter(known).agg(
        F.count_if(~F.coalesce(again == F.col(key), F.lit(False))).alias("other"), F.min(prefix).alias("low"),
        F.max(prefix).alias("high"), F.min(width).alias("width"), F.max(number).alias("largest"), F.count(F.lit(1)).alias("n"),
        F.max(F.when(number.cast("string") != F.right(key, width), width)).alias("padded")).first()
    dense = (seen["largest"] or 0) <= SPARSE * max(seen["n"], 1_000)
    plain = not seen["other"] and seen["low"] == seen["high"] and (seen["padded"] or 0) <= (seen["width"] or 0) and dense
    if plain:
        return rows.withColumn(name, number)
    book = write_snapshot(dense_ordinals(write_snapshot(rows.filter(known).select(key).distinct(), "distinct-keys"),
                                         [F.col(key)], name), "key-numbers")
    return rows.join(book.withColumnRenamed(key, "_key"), F.col(key) == F.col("_key"), "left").drop("_key")


def bitmaps(rows: DataFrame, by: list[str], conditions: dict[str, Column], number: str = NUMBER) -> DataFrame:
    """(by..., bucket, a bitmap for each condition): the numbers of the rows that meet it.

    The rows are dealt by bucket, so that a bucket's bits meet in one task and its bitmaps are made
    once, however many groups there are."""
    dealt = rows.select(*by, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("position"),
                        *[c.alias(f"_is_{n}") for n, c in conditions.items()]).filter("bucket is not null").repartition("bucket")
    return dealt.groupBy("bucket", *by).agg(*[
        F.bitmap_construct_agg(F.when(F.col(f"_is_{n}"), F.col("position"))).alias(n) for n in conditions])


def merged_bitmaps(parts: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """Bitmaps of several parts of the data as those of the whole."""
    return parts.groupBy("bucket", *by).agg(*[F.bitmap_or_agg(n).alias(n) for n in names])


def counted(maps: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """(by..., a count for each name)."""
    return maps.groupBy(*by).agg(*[F.sum(F.bitmap_count(n)).alias(n) for n in names])


def distinct_counts(rows: DataFrame, by: list[str], key: str, conditions: dict[str, Column]) -> DataFrame:
    """(by..., for each condition the number of distinct ``key`` among the group's rows that meet it).
    Groups without a key are absent."""
    return counted(bitmaps(with_numbers(rows, key), by, conditions), by, list(conditions))
