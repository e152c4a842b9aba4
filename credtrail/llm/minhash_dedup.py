"""Operator 6: MinHash near-duplicates by tensored banding.

Instead of hashing afresh for every table, ``TERMS`` sub-keys of ``WIDTH`` minima each are made for
two small collections; table (i, j) is keyed by the pair of sub-key i of the first and sub-key j
of the second. So ``TERMS``^2 = 144 tables of 6 minima come from 2 * 12 * 3 = 72 minima instead of
864. Two documents of Jaccard similarity s meet in no table with probability
1 - (1 - (1 - s^3)^12)^2, which is 2.2e-5 at 0.85 and falls quickly above. At 0.80 it is 3.7e-4
with 12 terms and 2.1e-5 with 16 (256 tables from 96 minima); ``terms`` is an argument.

The job, each step a written table:

1. whole texts -> distinct five-word shingles, their number, a digest of the set, 24 sub-keys;
2. documents with equal sets become one class, represented by the smallest doc_id and, of its
   texts, the smallest digest; classes are numbered in that order, and the steps below work on the
   numbers, because one doc_id can stand for several texts and so for several classes;
3. sub-keys that only one class has can't meet anyone: only the others are paired to table keys;
4. each class is compared with the smallest class of each of its buckets (a star, not all pairs),
   exactly, on the full sets, and the links give components;
5. buckets that still hold several components are settled: their pairs across components are
   compared as well, but only those that can be links. For that, every document left in such a
   bucket gets the number of its shingles that occur in another component there, which bounds
   what it can share with any of them; who can't reach the threshold with it leaves, as long as a tenth
   does. That bound and its own size also limit the sizes a partner can have: each document asks only
   for partners that are no larger than itself, in size classes of ``STEP`` within that limit, so pages of one
   template that differ too much never meet, however many they are. The bounds are exact, so no link is
   lost; pairs inside a component can't change the result; no bucket is capped or written out as all
   pairs.

Joins read written tables on both sides, so that adaptive execution can split a hot key.

Defined cases: texts without words are linked with nothing; with fewer than five words the whole
sequence is the one shingle; a very long text is cut like any other. Rows with a null doc_id get no component (null) and are kept.
Rows of one doc_id are compared by their own texts: equal texts share a component, different ones
only if they are linked. A component is named by its smallest doc_id, so components of different
texts of that doc_id have one name; ``kept`` tells them apart: it holds for the rows whose doc_id
and text represent the component. Only doc_id and text are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from credtrail.llm.common import connected_components, read_table, ship_package, slices, write_snapshot
from credtrail.llm.words import mix, shingle_sets

SHINGLE = 5
TERMS = 12
WIDTH = 3
PERCENT = 85
STEP = 1.04


def sub_keys(sets: list[np.ndarray], terms: int = TERMS) -> np.ndarray:
    """2 * terms sub-keys of each non-empty set: WIDTH minima and the sub-key's number, mixed."""
    number = np.arange(1, 2 * terms * WIDTH + 1, dtype=np.uint64)
    xor = mix(number * np.uint64(0x8CB92BA72F3D8DD7))
    mul = mix(number * np.uint64(0xAAAAAAAAAAAAAAAB)) | np.uint64(1)
    flat = np.concatenate(sets)
    begin = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.zeros((len(sets), 2 * terms), np.uint64)
    for t in range(2 * terms):
        key = np.full(len(sets), t + 1, np.uint64)
        for k in range(t * WIDTH, (t + 1) * WIDTH):
            key = mix(key + np.minimum.reduceat((flat ^ xor[k]) * mul[k], begin))
        out[:, t] = key
    return out


def text_digest(text: str = "text") -> Column:
    """MD5 of a text column; empty for null, which no text has."""
    return F.coalesce(F.unhex(F.md5(text)), F.lit(b""))


def sketches(docs: DataFrame, terms: int = TERMS) -> DataFrame:
    """(doc_id, digest, n_shingles, set_id, keys) of every row; set_id and keys are null without words."""
    ship_package(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                sets = shingle_sets(part.column("text"), SHINGLE)
                full = [i for i, x in enumerate(sets) if len(x)]
                keys: list = [None] * len(sets)
                if full:
                    for i, row in zip(full, sub_keys([sets[i] for i in full], terms).view(np.int64), strict=True):
                        keys[i] = row
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"),
                    "digest": part.column("digest"),
                    "n_shingles": pa.array([len(x) for x in sets], pa.int64()),
                    "set_id": pa.array([xxhash.xxh128_digest(x) if len(x) else None for x in sets], pa.binary()),
                    "keys": pa.array(keys, pa.list_(pa.int64()))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_digest().alias("digest")).mapInArrow(
        run, "doc_id long, digest binary, n_shingles long, set_id binary, keys array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, shingles: array of 64-bit hashes) of the texts in ``wanted`` (id, doc_id, digest)."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                sets = shingle_sets(part.column("text"), SHINGLE)
                yield pa.RecordBatch.from_pydict({
                    "id": part.column("id"),
                    "shingles": pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))})

    # repeated rows are combined before the shuffle, and the digest spreads the texts of one doc_id
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_digest().alias("digest")) \
        .filter("doc_id is not null and text is not null").dropDuplicates(["doc_id", "digest"])
    rows = texts.join(wanted, ["doc_id", "digest"]).select("id", "text")
    return rows.mapInArrow(run, "id long, shingles array<long>")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold on their full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(left, "a").join(right, "b")
            .withColumn("both", both)
            .filter(100 * F.col("both") >= percent * (F.size("sa") + F.size("sb") - F.col("both")))
            .select("a", "b"))


def _unsettled(rows: DataFrame) -> DataFrame:
    """The rows (key, id, n, component, ...) of the keys with several components."""
    keys = write_snapshot(
        rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high").select("key"), "near-open")
    return write_snapshot(rows.join(keys, "key"), "near-unsettled")


def _able(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(id, most) of the documents of ``rows`` (id, n, component, ...) that may reach the threshold
    with one of another component; ``most``: their shingles that occur in another component."""
    ids = write_snapshot(rows.select("id", "n", "component").distinct(), "near-left")
    each = write_snapshot(ids.join(sets, "id").select("id", "component", F.explode("shingles").alias("shingle")),
                          "near-left-shingles")
    common = write_snapshot(
        each.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high").select("shingle"), "near-common")
    most = write_snapshot(each.join(common, "shingle").groupBy("id").agg(F.count("*").alias("most")), "near-most")
    return ids.join(most, "id").filter(f"100 * most >= {percent} * n").select("id", "most")


def size_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / math.log(STEP)).cast("int")


def pairs_across(by_sub: DataFrame, percent: int, terms: int) -> DataFrame:
    """(a, b) of the pairs of different components that share a sub-key of both collections and
    may reach the threshold, from (id, n, component, most, keys, i, u: sub-key i of the first collection).

    A partner of size m shares at most ``most`` shingles, so 100 * most >= percent * (n + m - most): that is
    the largest m a document asks for, and percent * n / 100 the smallest. The larger one of a pair asks."""
    own = [F.col(c).alias(c + "_a") for c in ("id", "n", "component", "most", "keys")]
    largest = F.least(F.col("n"), F.floor((100 + percent) * F.col("most") / percent) - F.col("n"))
    smallest = F.greatest(F.ceil(percent * F.col("n") / 100), F.lit(1))
    asks = by_sub.withColumn("largest", largest.cast("long")).withColumn("smallest", smallest.cast("long")) \
        .filter("largest >= smallest") \
        .select("u", "i", "largest", "smallest", *own,
                F.explode(F.sequence(size_class(F.col("smallest")), size_class(F.col("largest")))).alias("class"))
    gives = by_sub.select("u", size_class(F.col("n")).alias("class"),
                          *[F.col(c).alias(c + "_b") for c in ("id", "n", "component", "most", "keys")])
    most = F.least("most_a", "most_b")
    reach = 100 * most >= percent * (F.col("n_a") + F.col("n_b") - most)
    once = (F.col("n_b") < F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("id_b") < F.col("id_a")))
    first = F.expr(" AND ".join(f"(i <= {t} OR keys_a[{t}] <> keys_b[{t}])" for t in range(terms)))
    meets = F.expr(" OR ".join(f"keys_a[{t}] = keys_b[{t}]" for t in range(terms, 2 * terms)))
    return asks.join(gives, ["u", "class"]).filter("n_b between smallest and largest and component_a <> component_b") \
        .filter(once).filter(reach).filter(first).filter(meets) \
        .select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, terms: int = TERMS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text);
    documents are linked if 100 * shared shingles >= percent * all shingles of the two. A lower
    ``percent`` needs more ``terms``: the module docstring has the chance to miss a pair."""
    return labelled(docs, percent, terms).drop("digest")


def labelled(docs: DataFrame, percent: int = PERCENT, terms: int = TERMS) -> DataFrame:
    """(doc_id, digest of the text, n_shingles, component_id, kept) of every row of ``docs``."""
    fits = F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")

    sketch = write_snapshot(sketches(docs, terms), "near-sketch")
    known = sketch.filter("doc_id is not null and set_id is not null")
    classes = write_snapshot(
        known.groupBy("set_id").agg(F.min(F.struct("doc_id", "digest")).alias("one"), F.first("n_shingles").alias("n"),
                                    F.first("keys").alias("keys"))
        .select("set_id", "one.doc_id", "one.digest", "n", "keys"), "near-classes")
    # ids in the order of doc_id and digest, so that the smallest id of a component has its smallest doc_id
    firsts = write_snapshot(
        classes.orderBy("doc_id", "digest").withColumn("id", F.monotonically_increasing_id()), "near-firsts")
    subs = firsts.select("id", "n", F.posexplode("keys").alias("term", "sub"))

    shared = write_snapshot(subs.groupBy("sub").agg(F.count("*").alias("m")).filter("m > 1").select("sub"),
                            "near-shared")
    per_class = subs.join(shared, "sub").groupBy("id").agg(
        F.first("n").alias("n"), F.collect_list(F.struct("term", "sub")).alias("subs"))
    firsts_of = F.expr(f"transform(filter(subs, x -> x.term < {terms}), x -> x.sub)")
    seconds_of = F.expr(f"transform(filter(subs, x -> x.term >= {terms}), x -> x.sub)")
    entries = write_snapshot(
        per_class.select("id", "n", F.explode(firsts_of).alias("u"), seconds_of.alias("vs"))
        .select("id", "n", "u", F.explode("vs").alias("v"))
        .select("id", "n", F.xxhash64("u", "v").alias("key")), "near-entries")

    stars = write_snapshot(
        entries.groupBy("key").agg(F.min(F.struct("id", "n")).alias("lead"), F.count("*").alias("m"))
        .filter("m > 1").select("key", F.col("lead.id").alias("a"), F.col("lead.n").alias("na")), "near-stars")
    members = entries.join(stars, "key").select("key", "a", "na", F.col("id").alias("b"), F.col("n").alias("nb"))
    pairs = write_snapshot(members.filter("a <> b").filter(fits).select("a", "b").distinct(), "near-pairs")
    wanted = entries.join(stars.select("key"), "key").select("id").distinct()
    wanted = firsts.select("id", "doc_id", "digest").join(wanted, "id")
    sets = write_snapshot(full_sets(docs, write_snapshot(wanted, "near-wanted")), "near-sets")
    links = write_snapshot(_linked(pairs, sets, percent), "near-links")
    found = connected_components(links)

    placed = write_snapshot(
        entries.join(stars.select("key"), "key").join(found.withColumnRenamed("node", "id"), "id", "left")
        .select("key", "id", "n", F.coalesce("component", "id").alias("component"), F.lit(0).alias("most")),
        "near-placed")
    unsettled = _unsettled(placed)
    while True:
        # what each document shares with other components of the unsettled buckets
        able = write_snapshot(_able(unsettled, sets, percent), "near-able")
        kept = _unsettled(write_snapshot(unsettled.drop("most").join(able, "id"), "near-kept"))
        done = kept.count() >= 0.9 * unsettled.count()
        unsettled = kept
        if done:
            break
    # the pairs that meet in a table share a sub-key of each collection: joined on the first
    # collection's, and counted at the first of those they share
    left = unsettled.select("id", "n", "component", "most").distinct().join(firsts.select("id", "keys"), "id")
    by_sub = write_snapshot(left.select("*", F.posexplode(F.slice("keys", 1, terms)).alias("i", "u")), "near-by-sub")
    across = write_snapshot(pairs_across(by_sub, percent, terms), "near-across")
    rest = across.join(pairs, ["a", "b"], "left_anti")
    more = write_snapshot(_linked(rest, sets, percent), "near-more-links")
    if not more.isEmpty():
        found = connected_components(links.union(more))

    member = firsts.select("set_id", "id").join(found.withColumnRenamed("node", "id"), "id", "left") \
        .select("set_id", F.coalesce("component", "id").alias("id"))
    whole = write_snapshot(
        member.join(firsts.select("id", F.col("doc_id").alias("component_id"), F.col("digest").alias("first_digest")), "id")
        .select("set_id", "component_id", "first_digest"), "near-components")
    out = sketch.select("doc_id", "digest", "n_shingles", "set_id").join(whole, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    first = (F.col("doc_id") == F.col("component_id")) & (F.col("digest") == F.col("first_digest"))
    return out.select("doc_id", "digest", "n_shingles", component.alias("component_id"),
                      (F.col("doc_id").isNull() | F.coalesce(first, F.lit(True))).alias("kept"))


def op6_minhash_tensored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents``."""
    return near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


#: The same components from an exact join of all shingles.
OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5
    THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    ELSE [array_to_string(ws, ' ')] END) AS g
  FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS m
  FROM s p JOIN s q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM x JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * m >= 85 * (p.n + q.n - m)),
reach AS (
  SELECT doc_id, doc_id AS c FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.c = l.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id, r.doc_id = min(c) AS kept
FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
