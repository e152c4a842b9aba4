"""Operators 2, 6, 8 and 10 against brute force on small frames with odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from credtrail.llm import containment, kd_sharding, minhash_dedup, mtree_topk
from credtrail.llm.words import shingle_sets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def test_shingle_sets():
    texts = [None, "", " \t\n", "one", "a b c d e", "A b  c\td\ne f", "é É   x", "a b a b a b a b a b a b", "x " * 40_000]
    assert [len(s) for s in shingle_sets(pa.array(texts))] == [len(shingles(t)) for t in texts]
    same = shingle_sets(pa.array(["The QUICK brown fox jumps", "the quick\nbrown  fox jumps", "the quick brown fox jumpsx"]))
    assert same[0].tolist() == same[1].tolist() != same[2].tolist()


# --- near-duplicates ------------------------------------------------------------------------

def components(docs, percent=85):
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x = sets[a] & sets[b]
            if x and 100 * len(x) >= percent * len(sets[a] | sets[b]):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {d: (len(sets[d]), root(d)) for d in ids}


def varied(seed=5):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefgh", k=4))
    docs, base = [], [[word() for _ in range(r.choice([6, 40, 120, 300]))] for _ in range(25)]
    for words in base:
        for copy in range(r.randint(1, 9)):
            own = list(words)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                own[r.randrange(len(own))] = word()
            docs.append(" ".join(own) if copy % 2 else "  ".join(w.upper() for w in own))
    docs += [None, "", " ", "one two", "One  two", "one two three", "x " * 30_000]
    r.shuffle(docs)
    return [(1000 - i, t) for i, t in enumerate(docs)]


def test_near_duplicates_against_brute_force(spark):
    docs = varied()
    df = spark.createDataFrame([(d, t, "c") for d, t in docs], "doc_id long, text string, component_id string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash_dedup.near_duplicates(df).collect()}
    assert got == components(docs)


def test_chain_and_large_group_of_near_copies(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(150):  # a chain: each differs by one more word from the one before
        words = list(words)
        words[(7 * i) % 200] = f"v{i}"
        docs.append((i * 3 + 1, " ".join(words)))
    docs += [(10_000 + i, docs[0][1] + " " + "".join(r.choices("xyz", k=6))) for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = minhash_dedup.near_duplicates(df).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == components(docs)
    assert sum(r["kept"] for r in rows) == len({c for _, c in components(docs).values()})


def test_near_duplicates_of_null_ids_repeated_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (2, None)], "doc_id long, text string")
    rows = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_dedup.near_duplicates(df).collect())
    assert rows == [("2", 0, 2, True), ("4", 2, 4, True), ("4", 2, 4, True), ("None", 2, None, True)]
    assert minhash_dedup.near_duplicates(df.limit(0)).count() == 0


def test_texts_that_share_an_id_are_compared_by_their_own_sets(spark):
    r = random.Random(12)
    words = lambda n: ["".join(r.choices("abcdefgh", k=4)) for _ in range(n)]
    hot = [" ".join(words(60)) for _ in range(120)]
    near = [t + " more" for t in hot[:40]]  # 56 of 57 shingles shared
    rows = [(5, t) for t in hot] + [(5, t) for t in near[:20]] + [(100 + i, t) for i, t in enumerate(near[20:])]
    rows += [(7, hot[50]), (3, hot[60].upper()), (5, None), (5, ""), (5, hot[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = minhash_dedup.labelled(df).join(df.withColumn("digest", minhash_dedup.text_digest()).distinct(), ["doc_id", "digest"]).collect()
    assert len(got) == len(rows)
    nodes = sorted({(d, hashlib.md5(t.encode()).digest() if t is not None else b"", t) for d, t in rows}, key=lambda x: x[:2])
    want = components([(i, t) for i, (_, _, t) in enumerate(nodes)])
    at = {(d, t): i for i, (d, _, t) in enumerate(nodes)}
    for x in got:
        i = at[x["doc_id"], x["text"]]
        assert (x["n_shingles"], x["component_id"], x["kept"]) == (want[i][0], nodes[want[i][1]][0], want[i][1] == i)


# --- containment ----------------------------------------------------------------------------

def test_containment_against_brute_force(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choices("abcdefghij", k=5))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 3, 5, 6, 7, 12, 13, 20, 21, 30, 57, 58, 90, 400])]
    items += [(90, items[9][1]), (91, None), (92, " ")]
    docs = [(0, None), (1, ""), (2, items[1][1]), (3, "x " * 20_000)]
    for i, text in items[2:14]:
        own = text.split()
        for k in range(6):
            part = list(own)
            if k in (1, 2):
                part[0] = word()
            if k == 3:
                part = part[:max(5, int(len(part) * 0.84))]
            if k == 4:
                part[len(part) // 2] = word()
            filler = [word() for _ in range(r.choice([0, 10, 3000]))]
            docs.append((100 * i + k, " ".join(filler[:7] + [w.upper() for w in part] + filler[7:])))
    sets = {i: shingles(t) for i, t in items}
    want = {(d, i): len(s & shingles(t)) for d, t in docs for i, s in sets.items()
            if s and len(s & shingles(t)) >= 0.8 * len(s) - 1e-9}
    df = spark.createDataFrame([(d, t, "h") for d, t in docs], "doc_id long, text string, hits string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (1 << 26, 9000):  # one pass, several passes
        marked = containment.mark(df, bench, index_bytes=limit)
        assert marked.columns == ["doc_id", "text", "hits"]
        got = {(r["doc_id"], h["item_id"]): h["n_shared"] for r in marked.collect() for h in r["hits"]}
        assert got == want
    assert len(want) > 50
    assert containment.mark(df, bench.limit(0)).filter("size(hits) > 0").count() == 0
    assert containment.mark(df.limit(0), bench).count() == 0


# --- top k ----------------------------------------------------------------------------------

def brute_top(vectors, query_ids, k=5):
    dim = max(map(len, vectors.values()))
    x = {i: np.array([int(np.floor(256.0 * float(np.float32(c)))) for c in v] + [0] * (dim - len(v))) for i, v in vectors.items()}
    out = {}
    for q in query_ids:
        scores = sorted((-int(x[q] @ x[i]), i) for i in x if i != q)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


@pytest.mark.parametrize("tree_rows,block", [(8192, 2048), (64, 7)])
def test_top_k_against_brute_force(spark, tree_rows, block):
    r = np.random.default_rng(4)
    centers = r.normal(size=(6, 12))
    data = {i: (centers[i % 6] + 0.2 * r.normal(size=12)).round(3).tolist() for i in range(400)}
    for i in range(0, 130):
        data[1000 + i] = data[3]  # a vector that many rows share
    data[2000], data[2001] = [0.0] * 12, [1.5]
    rows = [(i, v) for i, v in data.items()] + [
        (5000, None), (5010, [None, 1.0]), (5020, [float("nan")]), (5030, [float("inf")]), (None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    found = mtree_topk.top_k(df, F.col("vec_id") % 10 == 0, tree_rows=tree_rows, block=block)
    for x in found.orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["vec_id"], x["score"]))
    assert got == brute_top(data, [i for i in data if i % 10 == 0])


def test_top_k_with_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    rows = mtree_topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert [tuple(r) for r in rows] == [(0, 1, 1, 256 * 512)]
    assert mtree_topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert mtree_topk.top_k(df, F.lit(False)).count() == 0


def test_search_skips_distance_computations():
    r = np.random.default_rng(1)
    x = (np.repeat(r.normal(size=(30, 8)) * 1000, 60, axis=0) + r.normal(size=(1800, 8)) * 10).astype(np.int64)
    top = int((x * x).sum(axis=1).max())
    pages = mtree_topk.build_pages(np.arange(len(x)), x, top)
    seen = []

    class Page(dict):
        def __getitem__(self, key):
            if key == "radius":
                seen.append(1)
            return super().__getitem__(key)

    got = mtree_topk.search([Page(p) for p in pages], 5, x[5], top, 5, float("inf"))
    scores = sorted((-int(x[5] @ x[i]), i) for i in range(len(x)) if i != 5)[:5]
    assert sorted(got, key=lambda t: (-t[0], t[1])) == [(-s, i) for s, i in scores]
    assert len(seen) < len(pages)


# --- sharding -------------------------------------------------------------------------------

def checked(rows, n):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    assert set(by) <= set(range(n))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return [sum(r["size"] for r in by[s]) for s in range(n)]


@pytest.mark.parametrize("n", [16, 1, 7])
def test_shards_are_near_equal_in_bytes(spark, n):
    r = random.Random(2)
    texts = ["".join(r.choices("abc é", k=r.choice([0, 5, 60, 300]))) for _ in range(3000)] + ["the same text"] * 40 + [None] * 3
    data = [(i, t, r.choice(["en", "de", None]), "src0" if i % 3 else f"src{i % 17}", 7) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, shard int")
    rows = kd_sharding.kd_shards(df, n_shards=n).collect()
    sizes = checked(rows, n)
    assert len(rows) == len(data) and max(sizes) <= 1.05 * sum(sizes) / n
    at = {x["doc_id"]: x for x in rows}
    for i, t, *_ in data:
        assert at[i]["size"] == len((t or "").encode()) + 1 and at[i]["text_crc32"] == zlib.crc32((t or "").encode())
    assert len({at[i]["shard"] for i, t, *_ in data if t == "the same text"}) == 1


def test_shards_of_a_hot_group_ties_and_empty_tables(spark):
    data = [(i, "hot " * 20, "en", "s") for i in range(300)] + [(1000 + i, f"{i}", None, None) for i in range(400)] + [(7, "hot " * 20, "en", "s")] * 3
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    sizes = checked(kd_sharding.kd_shards(df, n_shards=4).collect(), 4)
    assert sum(sizes) == sum(len(t) + 1 for _, t, *_ in data) and max(sizes) < 1.3 * sum(sizes) / 4
    assert checked(kd_sharding.kd_shards(df.limit(2), n_shards=16).collect(), 16)
    assert kd_sharding.kd_shards(df.limit(0), n_shards=16).count() == 0
    assert len({r["shard"] for r in kd_sharding.kd_shards(df, target_bytes=2000).collect()}) > 8
