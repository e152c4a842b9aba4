"""Operator 13: prefix trie of conversations by depth-band rollup.

A node is a distinct sequence of first turns; its subtree totals (leaves, tokens that storing the
shared prefix once would save) need sums over all descendants. Depths are cut into bands of
``HEIGHT``:

1. inside its band a node is exploded to its ancestors there, at most ``HEIGHT`` rows, and one
   aggregation gives every node the total of its descendants in its own band;
2. band roots, the nodes at multiples of ``HEIGHT``, pass their totals on to the band root above, one
   round a band from the deepest up, on the small table of band roots only;
3. a band root's complete total is exploded to its ancestors in the band above, and a second
   aggregation completes all nodes.

So there are depth / HEIGHT rounds and no node is exploded to more than HEIGHT ancestors.

Nodes get their names without gathering a conversation in one task. Turns are range-sorted by
conversation and turn, and counted in their tasks; what a conversation had in earlier partitions comes from
one row for each partition. The name of a prefix is the XOR of 128-bit hashes of (position, role,
text) of its turns, which is again a running total over sorted partitions. The ancestors of a turn in its
band lie in the same partition, because the sort is dealt by (conversation, band).

The SHA-256 over the conversations that end in a node is sequential by definition. Nodes where one
ends take it from SQL; for others the sorted ids are first joined to pieces of ``PIECE`` ids by
range partitions, and the pieces of a node then go through one task in order, a piece at a time.

Defined cases: rows without conv_id are no conversation and are left out; null roles and texts are
empty; turns are ordered by turn, null first, and equal turns by the MD5 of role and text; repeated rows are
turns of their own. A conversation without rebuilt turns ends in the root. An empty table has no
members and gives no rows. Two sequences share a name with probability 2^-128. Only the four columns
are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credtrail.llm.common import read_table, scratch_path, ship_package, write_snapshot
from credtrail.llm.words import mix

HEIGHT = 32
PIECE = 8192
BASES = 20
WORDS = r"[^\x20\x09-\x0D]+"
NOBODY = hashlib.sha256(b"").hexdigest()


# --- positions of turns ---------------------------------------------------------------------

def segments(keys: np.ndarray) -> np.ndarray:
    """Where the runs of equal keys begin."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)


def carried(parts: list, add) -> dict:
    """{partition: (conversation, what it has in earlier partitions)}, from (partition, first
    conversation, last conversation, total of the last one) in order."""
    out, conv, total = {}, None, None
    for part, first, last, own in sorted(parts, key=lambda r: r[0]):
        if conv == first:
            out[part] = (conv, total)
        total = add(total, own) if conv == last else own
        conv = last
    return out


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words) of every turn; pos counts a conversation's turns from 0."""
    spark = conversations.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turns = write_snapshot(conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.md5(role), F.md5(text))).alias("digest"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row")).filter("conv_id is not null"), "trie-turns")
    by = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")]
    dealt = turns.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id())

    def count(batches):
        conv, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_numpy()
            begin = segments(ids)
            at = np.arange(len(ids)) - np.repeat(begin, np.diff(np.r_[begin, len(ids)]))
            if ids[0] == conv:
                at[:begin[1] if len(begin) > 1 else None] += seen
            conv, seen = ids[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "digest", "words", "part")), pa.array(at)],
                ["conv_id", "digest", "words", "part", "at"])

    local = write_snapshot(dealt.select("conv_id", "digest", "words", "part").mapInArrow(
        count, "conv_id long, digest string, words long, part int, at long"), "trie-ordered")
    ends = local.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "at")).alias("last"))
    before = carried([(r["part"], r["first"], r["last"]["conv_id"], r["last"]["at"] + 1) for r in ends.collect()],
                     lambda a, b: a + b)  # one row a partition
    moved = spark.createDataFrame([(p, c, t) for p, (c, t) in before.items()], "part int, conv_id long, earlier long")
    return local.join(F.broadcast(moved), ["part", "conv_id"], "left").select(
        "conv_id", (F.col("at") + F.coalesce("earlier", F.lit(0))).alias("pos"), "digest", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, depth, digest, words, ends) of every rebuilt turn, (conv_id, total) of every
    conversation); depth counts from 1."""
    turns = write_snapshot(turns, "trie-positions")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4)).cast("int")
    convs = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("own")).select(
        "conv_id", "own", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % BASES).alias("base"))
    # the first three turns of each conversation that others may begin with
    bases = turns.filter(f"pos < 3 and conv_id % {BASES} = 0").groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("firsts"))
    taken = F.when(F.col("firsts").isNotNull() & (F.col("h") > 0), F.slice("firsts", 1, F.greatest("h", F.lit(1))))
    convs = convs.join(bases, "base", "left").withColumn("taken", taken).withColumn(
        "k", F.when(F.col("taken").isNull(), 0).otherwise(F.size("taken")))
    convs = write_snapshot(convs.select(
        "conv_id", "h", "k", "taken", (F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("total")),
        "trie-convs")
    heads = convs.filter("k > 0").select("conv_id", "total", F.explode("taken").alias("t")).select(
        "conv_id", (F.col("t.pos") + 1).alias("depth"), "t.digest", "t.words", "total")
    own = turns.join(convs.select("conv_id", "h", "k", "total"), "conv_id").filter("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("k") + 1).alias("depth"), "digest", "words", "total")
    rows = heads.unionByName(own).select("conv_id", "depth", "digest", "words", (F.col("depth") == F.col("total")).alias("ends"))
    return write_snapshot(rows, "trie-rebuilt"), convs.select("conv_id", "total")


# --- names of prefixes ----------------------------------------------------------------------

PATH = "conv_id long, depth long, words long, ends boolean, part int, hi long, lo long, above array<struct<hi:long,lo:long>>"


def paths(rows: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(conv_id, depth, words, ends, hi, lo, above) of every rebuilt turn: the name of the prefix that ends with
    it and the names of its ancestors from the last band root above it on, the shallowest first."""
    spark = rows.sparkSession
    ship_package(spark)
    band = F.floor((F.col("depth") - 1) / height)
    dealt = rows.withColumn("band", band).repartitionByRange("conv_id", "band").sortWithinPartitions("conv_id", "depth") \
        .withColumn("part", F.spark_partition_id())
    multiply = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)

    def name(batches):
        conv, names = None, np.zeros((1, 2), np.uint64)  # of its last prefixes, the one before the band's first included
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, depth = batch.column("conv_id").to_numpy(), batch.column("depth").to_numpy()
            digest = np.frombuffer(bytes.fromhex("".join(batch.column("digest").to_pylist())), "<u8").reshape(-1, 2)
            own = mix(mix(digest + depth.astype(np.uint64)[:, None] * multiply) ^ digest[:, ::-1])
            begin = segments(ids)
            lens = np.diff(np.r_[begin, len(ids)])
            run = np.bitwise_xor.accumulate(own, axis=0)
            start = np.repeat(np.where(begin[:, None] > 0, run[begin - 1], 0).astype(np.uint64), lens, axis=0)
            run ^= start
            same = int(lens[0]) if ids[0] == conv else 0
            run[:same] ^= names[-1]
            # names before each row: those kept from the batch before, then this batch's
            old = names if same else np.zeros((1, 2), np.uint64)
            zero = np.zeros((1, 2), np.uint64)
            values, lists = [], np.zeros(len(ids) + 1, np.int32)
            for s, (a, m) in enumerate(zip(begin.tolist(), lens.tolist(), strict=True)):
                line = np.concatenate([old if s == 0 else zero, run[a:a + m]])
                shift = len(line) - m  # prefix of row a + i is line[shift + i]
                count = (depth[a:a + m] - 1) % height + 1
                at = np.arange(m) + shift
                first = np.maximum(at - count, 0)
                size = at - first
                lists[a + 1:a + m + 1] = size
                values.append(line[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())])
                kept = line[-(height + 1):]
            conv, names = ids[-1], kept
            flat = np.concatenate(values).view(np.int64)
            above = pa.ListArray.from_arrays(np.cumsum(lists, dtype=np.int32), pa.StructArray.from_arrays(
                [pa.array(np.ascontiguousarray(flat[:, 0])), pa.array(np.ascontiguousarray(flat[:, 1]))], ["hi", "lo"]))
            got = run.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "depth", "words", "ends", "part")),
                 pa.array(np.ascontiguousarray(got[:, 0])), pa.array(np.ascontiguousarray(got[:, 1])), above],
                ["conv_id", "depth", "words", "ends", "part", "hi", "lo", "above"])

    local = write_snapshot(dealt.select("conv_id", "depth", "digest", "words", "ends", "part").mapInArrow(name, PATH), "trie-named")
    ends = local.groupBy("part").agg(F.min("conv_id").alias("first"),
                                     F.max(F.struct("conv_id", "depth", "hi", "lo")).alias("last"))
    before = carried([(r["part"], r["first"], r["last"]["conv_id"], (r["last"]["hi"], r["last"]["lo"]))
                      for r in ends.collect()], lambda a, b: (a[0] ^ b[0], a[1] ^ b[1]))  # one row a partition
    moved = spark.createDataFrame([(p, c, *t) for p, (c, t) in before.items()],
                                  "part int, conv_id long, more_hi long, more_lo long")

    def whole(x: Column, more: str) -> Column:
        return x.bitwiseXOR(F.coalesce(F.col(more), F.lit(0).cast("long")))

    return local.join(F.broadcast(moved), ["part", "conv_id"], "left").select(
        "conv_id", "depth", "words", "ends", whole(F.col("hi"), "more_hi").alias("hi"), whole(F.col("lo"), "more_lo").alias("lo"),
        F.transform("above", lambda a: F.struct(whole(a["hi"], "more_hi").alias("hi"), whole(a["lo"], "more_lo").alias("lo")))
        .alias("above"))


# --- totals ---------------------------------------------------------------------------------

def trie_nodes(path_rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each node, with its members and what ends in it."""
    none = F.array().cast("array<struct<hi:long,lo:long>>")
    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", zero.alias("depth"), zero.alias("words"), (F.col("total") == 0).alias("ends"),
                        zero.alias("hi"), zero.alias("lo"), none.alias("above"))
    here = F.when(F.col("ends"), F.col("conv_id"))
    return path_rows.unionByName(root).groupBy("hi", "lo").agg(
        F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.first("words").alias("words"), F.first("above").alias("above"),
        F.count(here).alias("n_ends"), F.min(here).alias("first_end"))


def rolled_up(own: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(hi, lo, n_leaves, saved_tokens): totals over the subtrees of all nodes of ``own`` (hi, lo,
    depth, above, leaf, saved)."""
    spark = own.sparkSession
    self_ = F.array(F.struct("hi", "lo"))
    is_root = (F.col("depth") % height == 0) & (F.col("depth") > 0)
    reach = F.when(is_root, self_).otherwise(F.concat(self_, F.col("above")))
    sums = [F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")]
    inside = write_snapshot(own.select(F.explode(reach).alias("to"), "leaf", "saved").groupBy("to.hi", "to.lo").agg(*sums),
                            "trie-inside")
    roots = own.filter(is_root).select("hi", "lo", (F.col("depth") / height).cast("long").alias("band"), "above") \
        .join(inside, ["hi", "lo"])
    folder = scratch_path(spark, "trie-bands")
    roots = write_snapshot(roots, "trie-roots")
    deepest = roots.agg(F.max("band")).first()[0] or 0
    below = None
    for band in range(deepest, 0, -1):
        mine = roots.filter(F.col("band") == band)
        if below is not None:
            passed = below.select(F.col("above")[0].alias("up"), "leaf", "saved").groupBy("up.hi", "up.lo") \
                .agg(F.sum("leaf").alias("more_leaf"), F.sum("saved").alias("more_saved"))
            mine = mine.join(passed, ["hi", "lo"], "left").select(
                "hi", "lo", "band", "above", (F.col("leaf") + F.coalesce("more_leaf", F.lit(0))).alias("leaf"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))
        path = f"{folder}/band_{band}"
        mine.drop("band").write.parquet(path)
        below = spark.read.parquet(path)
    if not deepest:
        return inside.select("hi", "lo", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    done = spark.read.schema(below.schema).parquet(f"{folder}/band_*")
    across = done.select(F.explode("above").alias("to"), "leaf", "saved").groupBy("to.hi", "to.lo") \
        .agg(F.sum("leaf").alias("more_leaf"), F.sum("saved").alias("more_saved"))
    return inside.join(across, ["hi", "lo"], "left").select(
        "hi", "lo", (F.col("leaf") + F.coalesce("more_leaf", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"))


def ends_of(path_rows: DataFrame, convs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(hi, lo, ends_sha256) of the nodes where several conversations end."""
    several = nodes.filter("n_ends > 1").select("hi", "lo")
    zero = F.lit(0).cast("long")
    ending = path_rows.filter("ends").select("hi", "lo", "conv_id").union(
        convs.filter("total = 0").select(zero.alias("hi"), zero.alias("lo"), "conv_id"))
    rows = ending.join(several, ["hi", "lo"])
    sorted_rows = rows.repartitionByRange("hi", "lo", "conv_id").sortWithinPartitions("hi", "lo", "conv_id")

    def join_ids(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            hi, lo, ids = (batch.column(c).to_numpy() for c in ("hi", "lo", "conv_id"))
            change = np.r_[True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])]
            cuts = []
            starts = np.flatnonzero(change).tolist()
            for a, b in zip(starts, [*starts[1:], len(ids)], strict=True):
                cuts += [(c, min(c + PIECE, b)) for c in range(a, b, PIECE)]
            yield pa.RecordBatch.from_pydict({
                "hi": pa.array([hi[a] for a, _ in cuts], pa.int64()), "lo": pa.array([lo[a] for a, _ in cuts], pa.int64()),
                "conv_id": pa.array([ids[a] for a, _ in cuts], pa.int64()),
                "ids": pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in cuts])})

    joined = sorted_rows.mapInArrow(join_ids, "hi long, lo long, conv_id long, ids string")

    def digest(batches):
        node, state = None, None

        def out():
            return pa.RecordBatch.from_pydict({"hi": pa.array([node[0]], pa.int64()), "lo": pa.array([node[1]], pa.int64()),
                                               "ends_sha256": pa.array([state.hexdigest()])})

        for batch in batches:
            for hi, lo, ids in zip(*(batch.column(c).to_pylist() for c in ("hi", "lo", "ids")), strict=True):
                if (hi, lo) != node:
                    if node:
                        yield out()
                    node, state = (hi, lo), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if node:
            yield out()

    return joined.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "conv_id") \
        .mapInArrow(digest, "hi long, lo long, ends_sha256 string")


def conversation_trie(conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations."""
    rows, convs = rebuilt(ordered_turns(conversations))
    path_rows = write_snapshot(paths(rows, height), "trie-paths")
    nodes = write_snapshot(trie_nodes(path_rows, convs), "trie-nodes")
    up = F.when(F.col("depth") > 0, F.element_at("above", -1))
    nodes = nodes.withColumn("up_hi", up["hi"]).withColumn("up_lo", up["lo"])
    children = nodes.filter("depth > 0").groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")) \
        .agg(F.count("*").alias("n_children"))
    own = write_snapshot(
        nodes.join(children, ["hi", "lo"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
        .withColumn("leaf", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "trie-own")
    totals = write_snapshot(rolled_up(own, height), "trie-totals")
    ends = write_snapshot(ends_of(path_rows, convs, nodes), "trie-ends")
    parents = own.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv_id").alias("parent_conv_id"))
    digest = F.when(F.col("n_ends") == 0, NOBODY).when(F.col("n_ends") == 1, F.sha2(F.col("first_end").cast("string"), 256)) \
        .otherwise(F.col("ends_sha256")).alias("ends_sha256")
    return own.join(totals, ["hi", "lo"]).join(ends, ["hi", "lo"], "left").join(parents, ["up_hi", "up_lo"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt ``conversations``."""
    return conversation_trie(read_table(spark, sf_dir, "conversations"))


OP13_SQL = r"""
WITH t AS (
  SELECT conv_id, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(md5(coalesce(role, '')) || md5(coalesce(text, '')))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base FROM t),
hexed AS (SELECT conv_id, base, conv_id::VARCHAR AS s FROM c),
bits AS (  -- CRC-32 by its definition, a byte at a time
  SELECT * FROM (
    WITH RECURSIVE step AS (
      SELECT conv_id, base, s, 0 AS i, 4294967295::BIGINT AS crc FROM hexed
      UNION ALL
      SELECT conv_id, base, s, i + 1, list_reduce([xor(crc, ascii(substr(s, i + 1, 1))::BIGINT)] || range(8),
        lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)
      FROM step WHERE i < length(s))
    SELECT conv_id, base, (xor(crc, 4294967295) % 4)::BIGINT AS h FROM step WHERE i = length(s))),
line AS (
  SELECT b.conv_id, 0 AS side, t.pos, digest, words FROM bits b JOIN t ON t.conv_id = b.base AND t.pos < b.h
  UNION ALL
  SELECT b.conv_id, 1, t.pos, digest, words FROM bits b JOIN t ON t.conv_id = b.conv_id AND t.pos >= b.h),
p AS (
  SELECT conv_id, row_number() OVER o AS depth, string_agg(digest, '') OVER o AS name, words FROM line
  WINDOW o AS (PARTITION BY conv_id ORDER BY side, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
last AS (SELECT conv_id, max(depth) AS total FROM p GROUP BY conv_id),
n AS (
  SELECT name, min(depth) AS depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words,
    sha256(coalesce(string_agg(CASE WHEN depth = total THEN p.conv_id::VARCHAR END, ',' ORDER BY p.conv_id), '')) AS ends_sha256
  FROM p JOIN last USING (conv_id) GROUP BY name),
kids AS (SELECT name[:-33] AS name, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (name)),
totals AS (
  SELECT p.name, sum((n_children = 0)::INTEGER) AS n_leaves, sum((n_convs - 1) * m.words) AS saved_tokens
  FROM m JOIN p ON p.conv_id = m.conv_id AND p.depth <= m.depth GROUP BY p.name)
SELECT m.conv_id, m.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, m.ends_sha256
FROM m JOIN totals USING (name) LEFT JOIN n up ON m.depth > 0 AND up.name = m.name[:-33]
"""
