"""Fuzzy second pass (J11): one-to-one matching of what the exact reconciliation left over.

What is left over is found by 128-bit hashes of the keys of both sides, aggregated together; the rows
themselves pass a Bloom filter of the lone keys before they are shuffled.

Rows that are equal in supplier, normalised number and tax are one *class* with a number of rows, so
tied copies are matched in bulk. Classes meet by the hash of (supplier, band of the tax). Where such a group has more than
``PAIRS_PER_ROW`` pairs a class, its classes meet by a 64-bit hash of (supplier, deletion variant of the
number, band) instead, and texts are joined to the pairs afterwards. Which groups do so never changes the result.

Matching rule: the pair of classes with the smallest (edits, tax difference, MD5 of the two classes) is
matched first, with as many rows as the smaller one has free; then the next, until no pair is left. Rows of
a class are taken in the order of their ids. That is done for all pairs at once: in each round every
class that is its best partner's best partner is matched (such a pair would come before all others
of the two in the order), and what is still free goes on. Rounds are written tables; the MD5 breaks ties at random, so
that many equally good pairs take few rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credtrail.functions import scalars as S
from credtrail.operators import bloom
from credtrail.operators.ids import dense_ordinals
from credtrail.operators.joins import BROADCAST_KEYS, inner_join
from credtrail.session import write_snapshot

SLOTS = 65_536  # matched rows that one task expands at a time
PAIRS_PER_ROW = 1024  # pairs a class of a group, above which deletion variants cost less than comparing all pairs
_HASHES = ["_key_hash", "_key_hash2"]


def deletion_variants(c: Column, distance: int) -> Column:
    """The text and every text that up to ``distance`` deletions make of it. Two texts within
    that edit distance of each other have a variant in common."""
    out = F.array(c)
    for _ in range(distance):
        shorter = F.flatten(F.transform(out, lambda t: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))),
            lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))))
        out = F.array_distinct(F.concat(out, shorter))
    return out


def _hashed(rows: DataFrame) -> DataFrame:
    """``rows`` with 128 bits of hash that stand for (gstin, number)."""
    return rows.withColumns({_HASHES[0]: F.xxhash64("gstin", "number"), _HASHES[1]: F.xxhash64(F.lit(1), "gstin", "number")})


def left_over(purchases: DataFrame, filings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of either side whose (gstin, number) the other one does not have; no NULLs in these."""
    sides = [_hashed(purchases), _hashed(filings)]
    seen = sides[0].select(*_HASHES, F.lit(1).alias("side")).unionByName(sides[1].select(*_HASHES, F.lit(2).alias("side")))
    alone = write_snapshot(seen.groupBy(*_HASHES).agg(F.bit_or("side").alias("side")).filter("side < 3"), "fuzzy-alone")
    number = {r["side"]: r["count"] for r in alone.groupBy("side").count().collect()}  # two rows at most

    def rows(side: int, name: str) -> DataFrame:
        keys = alone.filter(F.col("side") == side).select(*_HASHES)
        found = sides[side - 1]
        if (made := bloom.build(keys, _HASHES, number.get(side, 0))) is not None:
            found = bloom.maybe_in(found, _HASHES, made).filter("_maybe").drop("_maybe")
        return write_snapshot(found.join(keys, _HASHES, "left_semi").drop(*_HASHES), name)

    return rows(1, "fuzzy-purchases"), rows(2, "fuzzy-filings")


def _classes(rows: DataFrame, name: str) -> DataFrame:
    """(n, gstin, number, tax, size) of the distinct (gstin, number, tax) of ``rows``."""
    return write_snapshot(rows.groupBy("gstin", "number", "tax").agg(F.count("*").alias("size"))
                          .withColumn("n", F.monotonically_increasing_id()), name)


def _crowded(left: DataFrame, right: DataFrame) -> DataFrame:
    """(group) of the groups with more than ``PAIRS_PER_ROW`` pairs a row. Both their sides have more than that
    many rows, so there are few of them."""
    counts = [df.groupBy("group").agg(F.count("*").alias(n)) for df, n in ((left, "nl"), (right, "nr"))]
    nl, nr = F.col("nl").cast("double"), F.col("nr").cast("double")
    return write_snapshot(counts[0].join(counts[1], "group").filter(nl * nr > PAIRS_PER_ROW * (nl + nr)).select("group"), "fuzzy-crowded")


def candidate_pairs(left: DataFrame, right: DataFrame, distance: int, tolerance: float, **join_opts) -> DataFrame:
    """(p, g, edits, tax_difference, tie, size_p, size_g) of the class pairs within reach."""
    band = F.floor(F.col("tax").cast("double") / tolerance)

    def grouped(df: DataFrame, bands: list[Column]) -> DataFrame:
        return df.filter("tax is not null").withColumn("group", F.explode(F.array(*[F.xxhash64("gstin", b) for b in bands])))

    def named(df: DataFrame, mark: str) -> DataFrame:
        return df.select(F.col("n").alias(mark), *[F.col(c).alias(f"{c}_{mark}") for c in df.columns if c != "n"])

    def near(pairs: DataFrame) -> DataFrame:
        def digest(mark: str) -> Column:
            return F.md5(F.concat_ws("\x1f", f"gstin_{mark}", f"number_{mark}", F.col(f"tax_{mark}").cast("string")))

        return (pairs.withColumn("tax_difference", F.abs(F.col("tax_p") - F.col("tax_g")))
                .filter((F.col("tax_difference") < F.lit(tolerance)) & (F.col("gstin_p") == F.col("gstin_g"))
                        & (F.abs(F.length("number_p") - F.length("number_g")) <= distance)
                        & (F.levenshtein("number_p", "number_g", distance) >= 0))
                .select("p", "g", F.levenshtein("number_p", "number_g").alias("edits"), "tax_difference",
                        F.md5(F.concat(digest("p"), digest("g"))).alias("tie"), "size_p", "size_g"))

    # the tax of a partner lies in the own band or one beside it, so a pair meets in one group
    l, r = grouped(left, [band]), grouped(right, [band - 1, band, band + 1])
    crowded = _crowded(l, r)
    if not (n_crowded := crowded.count()):
        return near(inner_join(named(l, "p"), named(r, "g"), ["group_p"], ["group_g"], **join_opts))
    if n_crowded <= BROADCAST_KEYS:
        crowded = F.broadcast(crowded)

    def keys(df: DataFrame, name: str) -> DataFrame:
        # the variants of a class are made once, then hashed with each of its crowded groups
        hashed = (df.join(crowded, "group", "left_semi").groupBy("n", "number").agg(F.collect_set("group").alias("groups"))
                  .select("n", "groups", F.explode(deletion_variants(F.col("number"), distance)).alias("variant")))
        keyed = hashed.select("n", F.xxhash64("variant").alias("key"), F.explode("groups").alias("group"))
        return write_snapshot(keyed.select(F.col("n").alias(name), F.xxhash64("key", "group").alias(f"{name}_key")), f"fuzzy-variants-{name}")

    met = inner_join(keys(l, "p"), keys(r, "g"), ["p_key"], ["g_key"], **join_opts).select("p", "g").distinct()
    by_variant = near(met.join(named(left, "p"), "p").join(named(right, "g"), "g"))
    l, r = (df.join(crowded, "group", "left_anti") for df in (l, r))
    return near(inner_join(named(l, "p"), named(r, "g"), ["group_p"], ["group_g"], **join_opts)).unionByName(by_variant)


def greedy_matching(pairs: DataFrame) -> DataFrame:
    """(p, g, edits, tax_difference, from_p, from_g, rows): the classes matched with each other, the number of
    rows, and how many rows of each class were matched before."""
    order = [F.col(c) for c in ("edits", "tax_difference", "tie")]
    left_p, left_g = F.col("size_p") - F.col("from_p"), F.col("size_g") - F.col("from_g")
    zero = F.lit(0).cast("long")
    open_pairs = write_snapshot(pairs.withColumns({"from_p": zero, "from_g": zero}), "match-open")
    done = None
    while True:
        best_p = open_pairs.groupBy("p").agg(F.min(F.struct(*order, "g")).alias("best")).select("p", F.col("best.g").alias("g"))
        best_g = open_pairs.groupBy("g").agg(F.min(F.struct(*order, "p")).alias("best")).select("g", F.col("best.p").alias("p"))
        chosen = best_p.join(best_g, ["p", "g"])
        hits = write_snapshot(open_pairs.join(chosen, ["p", "g"]).select(
            "p", "g", "edits", "tax_difference", "from_p", "from_g", F.least(left_p, left_g).alias("rows")), "match-hits")
        if hits.isEmpty():
            return hits if done is None else done
        done = hits if done is None else done.unionByName(hits)
        taken_p, taken_g = hits.select("p", F.col("rows").alias("now_p")), hits.select("g", F.col("rows").alias("now_g"))
        open_pairs = write_snapshot(
            open_pairs.join(taken_p, "p", "left").join(taken_g, "g", "left")
            .withColumn("from_p", F.col("from_p") + F.coalesce("now_p", F.lit(0)))
            .withColumn("from_g", F.col("from_g") + F.coalesce("now_g", F.lit(0)))
            .drop("now_p", "now_g").filter((left_p > 0) & (left_g > 0)), "match-open")


def _ranked(rows: DataFrame, classes: DataFrame, row_id: str, n: str, rank: str) -> DataFrame:
    """(n, rank, row_id): the rows of every class counted from 0 in the order of their ids."""
    named = rows.join(classes.select("gstin", "number", "tax", F.col("n").alias(n)),
                      rows["gstin"].eqNullSafe(classes["gstin"]) & rows["number"].eqNullSafe(classes["number"])
                      & rows["tax"].eqNullSafe(classes["tax"])).select(n, row_id)
    numbered = dense_ordinals(named, [F.col(n), F.col(row_id)], "at")
    begin = numbered.groupBy(n).agg(F.min("at").alias("begin"))
    return numbered.join(begin, n).select(n, (F.col("at") - F.col("begin")).alias(rank), row_id)


def fuzzy_matches(pr: DataFrame, g2b: DataFrame, *, distance: int = 1,
                  tolerance: float = S.DEFAULT_TOLERANCE, **join_opts) -> DataFrame:
    """Second pass over what the exact reconciliation left over on both sides: rows of one
    supplier whose normalised invoice numbers are within ``distance`` edits and whose tax differs
    by less than ``tolerance`` (above 0), one to one, until no further pair can be made.

    Rows without a supplier, a number or a tax have no fuzzy match.
    """
    def side(df: DataFrame, row_id: str, tax: Column) -> DataFrame:
        return (df.filter(F.col("supplier_gstin").isNotNull() & F.col("invoice_number").isNotNull())
                .select(F.col("supplier_gstin").alias("gstin"), S.normalize_invoice_number("invoice_number").alias("number"),
                        tax.alias("tax"), F.col(row_id)))

    left, right = left_over(side(pr, "purchase_invoice_id", F.col("total_tax")),
                            side(g2b, "gstr2b_id", F.col("igst") + F.col("cgst") + F.col("sgst")))
    classes_p, classes_g = _classes(left, "fuzzy-classes-p"), _classes(right, "fuzzy-classes-g")
    found = greedy_matching(candidate_pairs(classes_p, classes_g, distance, tolerance, **join_opts))

    # each matched pair of classes becomes as many slots as it has rows, in pieces
    piece = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / SLOTS)))
    pieces = found.withColumn("piece", piece).repartition("p", "g", "piece")
    slots = pieces.withColumn("slot", F.explode(F.sequence(
        F.col("piece") * SLOTS, F.least((F.col("piece") + 1) * SLOTS, F.col("rows")) - 1)))
    slots = slots.select("p", "g", "edits", "tax_difference", (F.col("from_p") + F.col("slot")).alias("rank_p"),
                         (F.col("from_g") + F.col("slot")).alias("rank_g"))
    used_p, used_g = (classes.join(found.select(F.col(x).alias("n")).distinct(), "n", "left_semi")
                      for classes, x in ((classes_p, "p"), (classes_g, "g")))
    return (slots.join(_ranked(left, used_p, "purchase_invoice_id", "p", "rank_p"), ["p", "rank_p"])
            .join(_ranked(right, used_g, "gstr2b_id", "g", "rank_g"), ["g", "rank_g"])
            .select("purchase_invoice_id", "gstr2b_id", "edits", "tax_difference"))
