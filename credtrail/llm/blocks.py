"""What the tree searches (operators 2 and 11) share: numbered rows, blocks of queries that meet
the trees they are sent to, and the merge of their answers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credtrail.llm.common import write_snapshot


#: stands for the id where a query has fewer answers
NO_ROW = np.iinfo(np.int64).max


def merge_best(keys: np.ndarray, ids: np.ndarray, at: np.ndarray, new_keys: np.ndarray, new_ids: np.ndarray) -> None:
    """Merge new entries (key, id), each of query ``at``, into the k smallest of every query, in place.

    ``keys`` and ``ids`` (queries x k) are sorted by key, then id."""
    if not len(at):
        return
    k = keys.shape[1]
    mine = np.unique(at)
    query = np.concatenate([np.repeat(mine, k), at])
    key, row = np.concatenate([keys[mine].ravel(), new_keys]), np.concatenate([ids[mine].ravel(), new_ids])
    by = np.lexsort((row, key, query))
    query = query[by]
    head = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
    keep = by[(head[:, None] + np.arange(k)).ravel()]
    keys[mine], ids[mine] = key[keep].reshape(-1, k), row[keep].reshape(-1, k)


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with a ``number`` of its own for each row, also for equal ones, as a written table."""
    return write_snapshot(rows.withColumn("number", F.monotonically_increasing_id()), name)


def answered(trees: DataFrame, sent: DataFrame, answer: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
             schema: str, n_queries: int, block: int) -> DataFrame:
    """``answer(rows of a tree, a block of queries)`` for every tree that queries were sent to.

    ``trees`` (tree, ...), ``sent`` (number, tree, ...): a tree's queries are cut into blocks by their
    number, and a tree is copied only to the blocks that hold queries for it, so the
    largest group is one tree and about ``block`` queries."""
    blocks = max(1, -(-n_queries // block))
    sent = sent.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int"))
    met = write_snapshot(sent.select("tree", "block").distinct(), "search-met")
    return trees.join(met, "tree").groupBy("tree", "block").cogroup(sent.groupBy("tree", "block")).applyInPandas(
        lambda key, own, asked: answer(own, asked), schema)


def merged(found: DataFrame, order: list[Column], k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): of every query row the first ``k`` answers."""
    rank = F.row_number().over(Window.partitionBy("number").orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
