"""Operator 10: sharding by k-d tree partitioning, in DataFrame operations only.

Documents are points in the space of their metadata (position of the id, language, source,
length), weighted by their bytes. A node that stands for ``n`` shards is cut across its widest
dimension at the weighted median (for odd ``n``: at the share of the smaller half), until every
leaf is one shard of the target bytes. All nodes of a level are cut together.

The median is exact and distributed: points have a 40-bit coordinate (20 bits of the dimension,
20 bits of a hash that tells ties apart); three histograms, of 14 and twice 13 bits, each over the
cell that the one before found, give the point at which half of the weight is reached. What goes
back to the executors is one row for each node.

Equal texts are one point, so that copies stay together; a group of copies heavier than
``GROUP_SHARE`` of a shard is split into pieces of about ``PIECE_SHARE`` of one (a group of a third of
all rows can't stay whole in near-equal shards). Law: ``bytes``.

Rows that are equal in id and text are told apart by ``twin``, their number among each other, which is
counted within the parts of the written rows and moved on by the counts of the parts before. Pieces and slot
buckets are dealt by it as well, so that a row which makes up a third of the table spreads like any others.
Slots are numbered in two steps, over (shard, bucket) counts and within each bucket, so no shard
goes through one task.

Defined cases: null texts weigh 1 byte and count as empty; null metadata counts as the empty
string or 0; repeated rows are rows of their own; a text that is longer than a shard's share stays whole, and its
shard is that much heavier; fewer points than shards leave shards empty; an empty table gives no
rows. Only doc_id, text, lang and source are read; other columns may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from credtrail.llm.common import read_table, write_snapshot

GROUP_SHARE = 0.05
PIECE_SHARE = 1 / 64
BROADCAST_NODES = 20_000
BITS = 20
STEPS = ((26, 14), (13, 13), (0, 13))  # (shift, bits) of each histogram over a 40-bit coordinate
DIMENSIONS = ("x_id", "x_lang", "x_source", "x_length")


def _text_code(column: str) -> F.Column:
    """The first six bytes of a text column as a number that sorts like them."""
    return F.expr(f"cast(conv(hex(rpad(substring(encode(coalesce(`{column}`, ''), 'UTF-8'), 1, 6), 6, X'00')), 16, 10)"
                  " as bigint)")


def prepare(docs: DataFrame) -> DataFrame:
    """Sizes, digests and metadata of every row, without the texts."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("same"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("x_id"),
        _text_code("lang").alias("x_lang"), _text_code("source").alias("x_source"),
        F.log2(F.octet_length(text) + 1).alias("x_length"))


def bounded(rows: DataFrame, shards: int) -> DataFrame:
    """A table with some rows for each shard: broadcast while the shards are few."""
    return F.broadcast(rows) if shards <= BROADCAST_NODES else rows


def with_twins(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, same, part, number, ...) with ``twin``: 0, 1, ... among the rows equal in
    doc_id and text, whatever the order of the parts they are read from."""
    rows = rows.withColumn("key", F.xxhash64("doc_id", "same"))
    counts = rows.groupBy("key", "part").agg(F.count("*").alias("m"))
    several = counts.groupBy("key").agg(F.sum("m").alias("all")).filter("all > 1").select("key")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = write_snapshot(counts.join(several, "key").select(
        "key", "part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before")), "kd-twins")
    own = Window.partitionBy("key", "part").orderBy("number")  # at most one part of the written rows
    repeated = rows.join(offsets, ["key", "part"]).withColumn("twin", F.col("before") + F.row_number().over(own) - 1)
    single = rows.join(offsets, ["key", "part"], "left_anti").withColumn("twin", F.lit(0).cast("long"))
    return write_snapshot(repeated.drop("before").unionByName(single).drop("key", "part", "number"), "kd-told-apart")


def kd_points(rows: DataFrame, bounds, shards: int) -> tuple[DataFrame, DataFrame]:
    """(``rows`` with ``piece``, the points: same, piece, w, scaled coordinates, tie)."""
    share = (bounds["total"] or 0) / shards
    heavy = rows.groupBy("same").agg(F.sum("size").alias("w")).filter(F.col("w") > max(1.0, GROUP_SHARE * share)) \
        .select("same", F.ceil(F.col("w") / max(1.0, PIECE_SHARE * share)).alias("pieces"))  # at most shards / GROUP_SHARE
    rows = rows.join(bounded(heavy, shards), "same", "left").withColumn(
        "piece", F.coalesce(F.pmod(F.xxhash64("doc_id", "twin"), F.col("pieces")), F.lit(0)).cast("int")).drop("pieces")
    scaled = [F.floor((F.min(d).cast("double") - F.lit(float(bounds[f"low_{d}"] or 0)))
                      * F.lit((2 ** BITS - 1) / max(float((bounds[f"high_{d}"] or 0) - (bounds[f"low_{d}"] or 0)), 1e-9)))
              .alias(d) for d in DIMENSIONS]
    points = rows.groupBy("same", "piece").agg(F.sum("size").alias("w"), *scaled) \
        .withColumn("tie", F.pmod(F.xxhash64("same", "piece", F.lit("kd")), F.lit(2 ** BITS)))
    return rows, points


def kd_shards(docs: DataFrame, n_shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs`` (doc_id, text, lang,
    source), in ``n_shards`` shards or as many as ``target_bytes`` asks for."""
    rows = write_snapshot(prepare(docs).withColumn("part", F.spark_partition_id())
                          .withColumn("number", F.monotonically_increasing_id()), "kd-rows")
    bounds = rows.agg(F.sum("size").alias("total"), F.count("*").alias("n"),
                      *[f(d).alias(f"{k}_{d}") for d in DIMENSIONS for k, f in (("low", F.min), ("high", F.max))]).first()
    shards = n_shards or max(1, math.ceil((bounds["total"] or 0) / target_bytes))

    rows, points = kd_points(with_twins(rows), bounds, shards)
    points = write_snapshot(points.withColumn("node", F.lit(0)).withColumn("leaves", F.lit(shards)), "kd-points")
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        points = write_snapshot(_cut(points, shards), "kd-points")

    placed = rows.select("doc_id", "size", "text_crc32", "same", "twin", "piece").join(
        points.select("same", "piece", F.col("node").alias("shard")), ["same", "piece"])
    buckets = max(64, math.ceil(bounds["n"] / (shards * 1_000_000)))
    placed = write_snapshot(placed.select(
        "doc_id", "size", "text_crc32", "same", "twin", "shard",
        F.pmod(F.xxhash64("doc_id", "text_crc32", "twin"), F.lit(buckets)).cast("int").alias("bucket")), "kd-placed")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "bucket").agg(F.count("*").alias("m")).select(
        "shard", "bucket", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "same", "twin")
    return placed.join(offsets, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("offset") + F.row_number().over(within) - 1).alias("slot"))


def _cut(points: DataFrame, shards: int) -> DataFrame:
    """Every node with more than one leaf cut in two. The joined tables have one row a node."""
    spread = [F.max(d) - F.min(d) for d in DIMENSIONS]
    widest = F.array_position(F.array(*spread), F.greatest(*spread))
    stats = write_snapshot(
        points.filter("leaves > 1").groupBy("node", "leaves").agg(widest.alias("axis"), F.sum("w").alias("all"))
        .withColumn("left", F.floor(F.col("leaves") / 2).cast("int"))
        .withColumn("goal", F.col("all") * F.col("left") / F.col("leaves")), "kd-nodes")
    along = F.element_at(F.array(*DIMENSIONS), F.col("axis").cast("int"))
    inner = points.join(bounded(stats.select("node", "axis", "left", "goal"), shards), "node", "left").withColumn(
        "c", along * (2 ** BITS) + F.col("tie"))
    found = stats.select("node", "goal", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))
    for shift, bits in STEPS:
        cell = F.shiftright("c", shift)
        open_part = inner.drop("goal").join(bounded(found, shards), "node").filter(
            F.shiftright("c", shift + bits) == F.col("prefix"))
        sums = open_part.groupBy("node", "goal", "before", cell.alias("cell")).agg(F.sum("w").alias("w"))
        so_far = F.sum("w").over(Window.partitionBy("node").orderBy("cell"))
        found = write_snapshot(
            sums.withColumn("upto", F.col("before") + so_far).filter("upto >= goal")
            .groupBy("node", "goal").agg(F.min(F.struct("cell", "upto", "w")).alias("at"))
            .select("node", "goal", F.col("at.cell").alias("prefix"),
                    (F.col("at.upto") - F.col("at.w")).alias("before"), F.col("at.w").alias("own")), "kd-median")
        last, found = found, found.drop("own")
    # the point at the median goes where it leaves the halves more equal
    cuts = last.select("node", F.when(
        F.col("before") + F.col("own") - F.col("goal") <= F.col("goal") - F.col("before"),
        F.col("prefix")).otherwise(F.col("prefix") - 1).alias("cut"))
    right = F.col("c") > F.col("cut")
    return inner.join(bounded(cuts, shards), "node", "left").select(
        "same", "piece", "w", *DIMENSIONS, "tie",
        F.when(right, F.col("node") + F.col("left")).otherwise(F.col("node")).cast("int").alias("node"),
        F.when(F.col("axis").isNull(), F.col("leaves")).when(right, F.col("leaves") - F.col("left"))
        .otherwise(F.col("left")).cast("int").alias("leaves"))


def op10_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in 16 shards of near-equal bytes."""
    docs = read_table(spark, sf_dir, "documents")
    return kd_shards(docs, n_shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
