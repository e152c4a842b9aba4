"""Operators 11, 12 and 13 against brute force, with odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from credtrail.llm import bit_whitening, prefix_trie, vp_search
from tests.conftest import SF_SMALL

VECTORS = "vec_id long, embedding array<double>, score string"


# --- neighbours -----------------------------------------------------------------------------

def nearest(rows, is_query, k):
    """{position of a query: its k nearest} by the definition."""
    good = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    dim = max((len(v) for _, v in good), default=0)
    x = np.array([[*v, *[0.0] * (dim - len(v))] for _, v in good]).reshape(-1, dim)
    ids = np.array([i for i, _ in good], np.int64)
    out = []
    for i, q in zip(ids, x, strict=True):
        if is_query(i):
            d = np.sqrt(((x - q) ** 2).sum(axis=1))
            found = sorted((s, j) for s, j in zip(d.tolist(), ids.tolist(), strict=True) if j != i)[:k]
            out += [(int(i), r + 1, j, s) for r, (s, j) in enumerate(found)]
    return sorted(out)


def answers(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def clustered(n=1500, dim=8, seed=2):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(12, dim)) * 6
    return [(int(i), (centers[i % 12] + r.normal(size=dim)).tolist()) for i in range(n)]


def test_factor_one_is_exact(spark):
    rows = clustered()
    rows += [(9000 + i, rows[40][1]) for i in range(700)]  # a third of all rows are one vector
    rows += [(40, rows[40][1]), (50, None), (60, []), (70, [0.0] * 8), (80, [1.0, None] * 4), (90, [float("nan")] * 8),
             (110, [float("inf")] * 8), (None, [1.0] * 8), (120, [3.0, 1.0])]
    df = spark.createDataFrame([(i, v, "s") for i, v in rows], VECTORS).repartition(5)
    got = answers(vp_search.neighbours(df, F.col("vec_id") % 10 == 0, k=6, factor=1.0, tree_rows=300, block=40, leaf=20))
    want = nearest(rows, lambda i: i % 10 == 0, 6)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-14, atol=0)


def test_larger_factors_give_true_distances_and_good_recall(spark):
    df = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.1')}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = nearest(rows, lambda i: i % 100 == 0, 10)
    got = answers(vp_search.neighbours(df, F.col("vec_id") % 100 == 0, tree_rows=400))
    assert len(got) == len(want) and {g[0] for g in got} == {w[0] for w in want}
    true = {(w[0], w[2]) for w in want}
    assert sum((g[0], g[2]) in true for g in got) >= 0.93 * len(want)
    x = dict(rows)
    assert all(abs(g[3] - np.sqrt(((np.array(x[g[0]]) - np.array(x[g[2]])) ** 2).sum())) < 1e-14 for g in got)


def test_pruning_measures_less_on_clusters():
    rows = clustered(4000)
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    order, nodes = vp_search.build_tree(x, 64)
    counts = {}
    for factor in (1.0, 3.0):
        s = vp_search.Search(x[order], ids[order], nodes, x, x[:100], ids[:100], np.full(100, np.inf), 5, factor)
        s.run()
        counts[factor] = s.measured
        if factor == 1.0:
            d = np.sort(np.sqrt(((x[:100, None] - x[None]) ** 2).sum(axis=2)), axis=1)[:, 1:6]
            assert np.allclose(s.best, d)
    assert counts[3.0] < counts[1.0] < 0.6 * 100 * len(x)


def test_neighbours_of_few_rows_and_large_components(spark):
    df = spark.createDataFrame([(100, [3e200, 0.0], "s"), (200, [0.0, 4e200], "s"), (5, [1.0, 1.0], "s")], VECTORS)
    got = answers(vp_search.neighbours(df, F.col("vec_id") % 100 == 0))
    assert [g[:3] for g in got] == [(100, 1, 5), (100, 2, 200), (200, 1, 5), (200, 2, 100)]
    assert got[1][3] == pytest.approx(5e200)
    assert vp_search.neighbours(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert vp_search.neighbours(df, F.col("vec_id") == 7).count() == 0
    with pytest.raises(ValueError):
        vp_search.neighbours(df, F.col("vec_id") == 5, factor=0.5)


# --- whitening ------------------------------------------------------------------------------

@pytest.mark.parametrize("span", [1, 2, 100, 2 ** 31, 2 ** 62])
def test_scatter_is_exact(span):
    r = random.Random(span)
    for rows, dim in ((1, 1), (3, 2), (64, 3), (65, 4), (300, 5)):
        x = np.array([[r.randrange(-span, span + 1) for _ in range(dim)] for _ in range(rows)], np.int64)
        sums, products = bit_whitening.scatter(x)
        wide = x.astype(object)
        assert sums.tolist() == wide.sum(axis=0).tolist() and products.tolist() == wide.T.dot(wide).tolist()
    for value in (0, 5, -5, 2 ** 100 + 7, -(2 ** 110) - 3):
        assert bit_whitening.from_limbs(bit_whitening.limbs_of(value)) == value


def whitening_by_hand(rows, components):
    dim = max(len(v) for _, v in rows)
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in [*v, *[0.0] * (dim - len(v))]] for _, v in rows], object)
    n, total = len(rows), x.sum(axis=0)
    centred = n * x - total
    cov = (centred.T.dot(centred) / n ** 3).astype(float)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return ([int(v) for v in (centred ** 2).sum(axis=1)], (centred / n).astype(float) @ vectors / np.sqrt(values),
            values / np.trace(cov))


def test_whitening_against_numpy(spark):
    r = np.random.default_rng(4)
    mixing = r.normal(size=(6, 6))
    rows = [(i, (mixing @ r.normal(size=6)).tolist()) for i in range(500)] + [(7, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 3.0]), (None, [0.5] * 6)]
    odd = [(900, None), (901, [1.0, None, 1.0]), (902, [float("nan")] * 6), (903, [float("-inf")] * 6)]
    df = spark.createDataFrame([(i, v, "s") for i, v in rows + odd], VECTORS).repartition(3)
    got = bit_whitening.whitened(df, components=4).collect()
    assert len(got) == 4 * len(rows)
    deviation, want, explained = whitening_by_hand(rows, 4)
    by_row = defaultdict(list)
    for g in got:
        by_row[str(g["vec_id"]), g["deviation"]].append(g)
    flips = None
    for (i, _), d, w in zip(rows, deviation, want, strict=True):
        own = sorted(by_row[str(i), d], key=lambda g: g["component"])[::1 if i != 7 else 2 if d == deviation[500] else 1]
        own = {g["component"]: g["whitened"] for g in own}
        line = np.array([own[c] for c in (1, 2, 3, 4)])
        flips = np.sign(line * w) if flips is None else flips
        assert np.allclose(line, w * flips, atol=1e-9)
    assert {g["n"] for g in got} == {len(rows)} and all(g["identity_error"] < 1e-9 for g in got)
    for c in range(4):
        assert {round(g["explained"], 9) for g in got if g["component"] == c + 1} == {round(float(explained[c]), 9)}


def test_whitening_without_variance_large_components_and_empty_tables(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0], "s"), (2, [1.0, 2.0], "s")], VECTORS)
    got = bit_whitening.whitened(same).collect()
    assert len(got) == 4 and {(g["whitened"], g["explained"], g["identity_error"], g["deviation"]) for g in got} == {(None, None, None, 0)}
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], "s") for i in range(9)], VECTORS)
    got = bit_whitening.whitened(line).collect()
    assert len(got) == 27 and all((g["whitened"] is None) == (g["component"] > 1) for g in got)
    assert max(g["identity_error"] for g in got) < 1e-9
    huge = spark.createDataFrame([(1, [1e300, 1.0], "s"), (2, [-1e300, 2.0], "s"), (3, [0.0, 3.0], "s")], VECTORS)
    got = bit_whitening.whitened(huge).collect()
    assert len(got) == 6 and any(g["deviation"] is None for g in got)
    assert bit_whitening.whitened(same.limit(0)).count() == 0


def test_whitening_query(spark):
    got = bit_whitening.op12_bit_sliced_whitening(spark, SF_SMALL)
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    deviation, _, explained = whitening_by_hand(rows, 32)
    rows_of = got.filter("component = 3").collect()
    assert got.count() == 32 * len(rows) and {r["vec_id"]: r["deviation"] for r in rows_of} == dict(zip((i for i, _ in rows), deviation, strict=True))
    assert abs(rows_of[0]["explained"] / explained[2] - 1) < 1e-9 and rows_of[0]["identity_error"] < 1e-9


# --- trie -----------------------------------------------------------------------------------

def trie_by_hand(rows):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0), md5(md5(role) + md5(text)), role, text))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        words = len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(who) - 1) * words
    return sorted((min(who), len(node), min(members[node[:-1]]) if node else -1, len(who), children.get(node, 0), leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest())
                  for node, who in members.items())


def trie_rows(df):
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"],
                   r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in df.collect())


TURNS = "conv_id long, turn long, role string, text string, hi string, depth string"


def turns_of(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS).repartition(parts)


def branching(seed=1, convs=160, longest=12):
    r = random.Random(seed)
    rows = []
    for c in range(-30, convs - 30):
        for t in range(r.randint(1, longest)):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(["a b", "c", "d  e f", ""])))
    return rows


@pytest.mark.parametrize("height", [1, 2, 3, 32])
def test_trie_against_brute_force(spark, height):
    rows = branching() + [(47, None, "user", "first"), (47, 0, None, None), (47, 0, None, None), (None, 1, "user", "nobody")]
    rows += [(9, 50, "user", "again")] * 5 + [(300, 1, "user", "w " * 50_000)]
    assert trie_rows(prefix_trie.conversation_trie(turns_of(spark, rows), height)) == trie_by_hand(rows)


def test_trie_with_a_hot_conversation_and_copies(spark):
    rows = [(8, t, "user", f"turn {t % 7}") for t in range(700)]  # a third of all rows in one conversation
    rows += [(8, 5, "user", "same")] * 300  # of which many are equal
    rows += [(100 + c, t, "user", f"copy {t}") for c in range(300) for t in range(5)]  # many equal conversations
    got = trie_rows(prefix_trie.conversation_trie(turns_of(spark, rows, 16), 8))
    assert got == trie_by_hand(rows)


def test_pieces_of_long_lists_of_ends(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(20 * c, 0, "user", "hello") for c in range(400)]
    assert trie_rows(prefix_trie.conversation_trie(turns_of(spark, rows, 8))) == trie_by_hand(rows)


def test_trie_of_empty_and_turnless_conversations(spark):
    rows = [(c, 0, "user", "x") for c in range(1, 20)]  # base 0 is absent: those with h > 0 have no turn
    assert trie_rows(prefix_trie.conversation_trie(turns_of(spark, rows))) == trie_by_hand(rows)
    assert prefix_trie.conversation_trie(turns_of(spark, rows).limit(0)).count() == 0


def test_words_and_ranges_of_batches():
    assert prefix_trie.segments(np.array([3, 3, 4, 4, 4, 9])).tolist() == [0, 2, 5]
    parts = [(0, 1, 5, 2), (1, 5, 5, 3), (2, 5, 6, 4), (4, 7, 7, 1)]
    assert prefix_trie.carried(parts, lambda a, b: a + b) == {1: (5, 2), 2: (5, 5)}
    assert pa.__version__
