"""A partitioned Bloom filter ahead of an anti join.

The filter is a table: a key's hash picks one block of 32,768 bits, and ``BITS`` bits in it. A row whose
key is not in the filter has no partner for certain and never reaches the join; the rest is joined
exactly. Blocks are made by one aggregation and go to every task as a broadcast, whose size is the number of keys
times ``BITS_PER_KEY`` and is checked against ``MAX_BYTES``; beyond that there is no filter, only the
exact join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credtrail.session import write_snapshot

BLOCK_BITS = 32_768
BITS = 4
BITS_PER_KEY = 12
MAX_BYTES = 64 << 20
_BLOCK = "_bloom_block"
_WORDS = "_bloom_words"


def _positions(keys: list[Column]) -> list[Column]:
    """``BITS`` positions in a block, 15 bits of a second hash each."""
    h = F.xxhash64(F.lit(7), *keys)
    return [F.shiftrightunsigned(h, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for i in range(BITS)]


def _block(keys: list[Column], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int")


def build(keys: DataFrame, names: list[str], n_keys: int | None = None) -> tuple[DataFrame, int] | None:
    """(the filter: block and 512 words of 64 bits, number of blocks) of the distinct ``keys``; None if it
    would be larger than ``MAX_BYTES``."""
    n = keys.count() if n_keys is None else n_keys
    blocks = max(1, math.ceil(n * BITS_PER_KEY / BLOCK_BITS))
    if blocks * BLOCK_BITS // 8 > MAX_BYTES:
        return None
    columns = [F.col(c) for c in names]
    bits = keys.select(_block(columns, blocks).alias(_BLOCK), F.explode(F.array(*_positions(columns))).alias("bit"))
    words = bits.groupBy(_BLOCK, F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)))).alias("bits"))
    held = words.groupBy(_BLOCK).agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("held"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1)), lambda i: F.coalesce(F.col("held")[i], F.lit(0).cast("long")))
    return write_snapshot(held.select(_BLOCK, dense.alias(_WORDS)), "bloom"), blocks


def maybe_in(rows: DataFrame, names: list[str], bloom: tuple[DataFrame, int], flag: str = "_maybe") -> DataFrame:
    """``rows`` with ``flag``: whether the key may be in the filter (never false for one that is)."""
    table, blocks = bloom
    columns = [F.col(c) for c in names]
    probed = rows.withColumn(_BLOCK, _block(columns, blocks)).join(F.broadcast(table), _BLOCK, "left")
    set_ = None
    for p in _positions(columns):
        word = F.element_at(F.col(_WORDS), F.shiftright(p, 6) + 1)
        bit = F.call_function("shiftrightunsigned", word, p.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1).cast("long")) == 1
        set_ = bit if set_ is None else set_ & bit
    return probed.withColumn(flag, F.coalesce(set_, F.lit(False))).drop(_BLOCK, _WORDS)


def anti_join(rows: DataFrame, names: list[str], keys: DataFrame, key_names: list[str], *, bloom="auto") -> DataFrame:
    """The ``rows`` whose key (NULL equal to NULL) is not among ``keys``; both sides' key columns in order.

    ``bloom``: "auto" to build a filter of the distinct keys, or None for the exact join alone."""
    own = [f"_k{i}" for i in range(len(names))]
    held = keys.select(*[F.col(k).alias(o) for k, o in zip(key_names, own, strict=True)]).distinct()
    made = None
    if bloom == "auto":
        held = write_snapshot(held, "anti-keys")
        made = build(held, own)

    def exact(part: DataFrame) -> DataFrame:
        cond = None
        for n, k in zip(names, own, strict=True):
            one = part[n].eqNullSafe(held[k])
            cond = one if cond is None else cond & one
        return part.join(held, cond, "left_anti")

    if made is None:
        return exact(rows)
    probed = maybe_in(rows, names, made)
    absent = probed.filter("not _maybe").drop("_maybe")
    return absent.unionByName(exact(probed.filter("_maybe").drop("_maybe")))
