"""Data-quality rules from the declared keys: primary-key and foreign-key checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credtrail.operators.bloom import anti_join
from credtrail.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS


def pk_profile(df: DataFrame, table: str) -> DataFrame:
    """One row: rows, distinct keys, keys occurring more than once, rows with a NULL key part.

    Two-level aggregation (per key, then global), both map-side combined.
    """
    keys = list(PRIMARY_KEYS[table])
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                    F.max(null_key.cast("int")).alias("_null"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("_null") == 1, F.col("_n"))), F.lit(0)).cast("bigint")
        .alias("null_key_rows"))


def fk_orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str, *, bloom=None) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row (anti join). With ``bloom="auto"`` rows
    whose key is not in a Bloom filter of the parent's keys are found without being shuffled."""
    return anti_join(child.filter(F.col(column).isNotNull()), [column], parent, [parent_column], bloom=bloom)


def fk_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphan counts for every declared foreign key whose two tables are given.

    Child rows are counted by key first (combined map-side), so what is shuffled are keys, not rows."""
    parts = []
    for child, col, parent, pcol in FOREIGN_KEYS:
        if child in tables and parent in tables:
            keys = tables[child].filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("_fk")).agg(F.count(F.lit(1)).alias("_n"))
            known = tables[parent].select(F.col(pcol).alias("_pk")).distinct()
            n = keys.join(known, F.col("_fk") == F.col("_pk"), "left_anti").agg(
                F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphan_rows"))
            parts.append(n.select(F.lit(child).alias("child_table"), F.lit(col).alias("fk_column"),
                                  F.lit(parent).alias("parent_table"), "orphan_rows"))
    return reduce(lambda a, b: a.unionByName(b), parts)
