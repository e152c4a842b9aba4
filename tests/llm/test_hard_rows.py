"""Rows that broke the operators once: large components, repeated rows, hot ids, template pages, few long documents."""

import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from credtrail.llm import containment, kd_sharding, minhash_dedup, mtree_topk, ppm_language, token_files, toxicity_mil
from credtrail.llm.common import write_snapshot
from tests.llm.test_similar import checked, components, shingles

VECTORS = "vec_id long, embedding array<double>, norm2 string"


# --- exact top-k ------------------------------------------------------------------------------

def top_by_hand(rows, is_query, k):
    """Sorted (query_id, rank, vec_id, score) in Python integers."""
    good = [(i, [max(-2 ** 62, min(2 ** 62, math.floor(256 * c))) for c in v]) for i, v in rows
            if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for i, q in good:
        if is_query(i):
            found = sorted((-max(-2 ** 63 + 1, min(2 ** 63 - 1, sum(a * b for a, b in zip(q, x)))), j) for j, x in good if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(out)


def found_by(df, **options):
    rows = mtree_topk.top_k(df, F.col("vec_id") % 10 == 0, **options).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows)


def test_large_components_are_partners_and_queries(spark):
    r = random.Random(3)
    rows = [(i, [r.uniform(-1, 1) for _ in range(5)]) for i in range(300)]
    rows += [(400, [300000.0, 0.0, 0.0, 0.0, 0.0]), (401, [-4e6, 1e6, 0.0, 0.0, 1.0]), (410, [1e10, -1e10, 3.0, 0.0, 0.0]),
             (411, [1e300, 1.0, 1.0, 1.0, 1.0]), (420, [0.5, 2.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS).repartition(4)
    assert found_by(df, tree_rows=300, block=16) == top_by_hand(rows, lambda i: i % 10 == 0, 5)
    few = spark.createDataFrame([(0, [1.0, 0.0], "x"), (1, [2.0, 0.0], "x"), (2, [300000.0, 0.0], "x"), (3, [-1.0, 2.0], "x")], VECTORS)
    assert found_by(few)[0] == (0, 1, 2, 256 * 256 * 300000)
    only = spark.createDataFrame([(0, [1e9], "x"), (1, [2e9], "x")], VECTORS)
    assert found_by(only) == [(0, 1, 1, 2 ** 63 - 1)]


def test_repeated_queries_and_hot_rows(spark):
    r = random.Random(5)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    rows += [(0, rows[0][1]), (20, [1.0] * 6)] + [(7, rows[7][1])] * 300  # queries given twice, a third equal rows
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VECTORS).repartition(6)
    assert found_by(df, tree_rows=256, block=10) == top_by_hand(rows, lambda i: i % 10 == 0, 5)


def test_block_search_equals_brute_force_with_ties():
    r = np.random.default_rng(9)
    x = r.integers(-3, 4, size=(900, 4)).astype(np.int64)
    ids = r.permutation(900)
    pages = mtree_topk.build_pages(ids, x, int((x * x).sum(axis=1).max()), leaf=32, fan=4)
    q = r.integers(-3, 4, size=(50, 4)).astype(np.int64)
    best, found = mtree_topk.search_block(pages, np.arange(50), q, float((x * x).sum(axis=1).max()), 5, np.full(50, np.inf))
    for row in range(50):
        want = sorted((-int(q[row] @ v), int(i)) for v, i in zip(x, ids, strict=True) if i != row)[:5]
        assert list(zip(best[row].tolist(), found[row].tolist(), strict=True)) == want


# --- near-duplicates of template pages --------------------------------------------------------

def template_pages(n, seed=1):
    r = random.Random(seed)
    shared = [f"word{i}" for i in range(200)]
    return [(i, " ".join(shared + [f"own{i}x{r.randrange(10 ** 9)}" for _ in range(24)])) for i in range(n)]


@pytest.mark.parametrize("n", [300, 600])
def test_template_pages_that_differ_too_much_never_meet(spark, n, monkeypatch):
    made = []

    def counting(by_sub, percent, terms):
        asks = pairs(by_sub, percent, terms)
        plan = asks._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" in plan
        u, size = F.col("u"), minhash_dedup.size_class(F.col("n"))
        own = by_sub.withColumn("largest", F.least("n", F.floor((100 + percent) * F.col("most") / percent) - F.col("n")).cast("long")) \
            .withColumn("smallest", F.ceil(percent * F.col("n") / 100).cast("long")).filter("largest >= smallest")
        left = own.select(u, F.explode(F.sequence(minhash_dedup.size_class(F.col("smallest")), minhash_dedup.size_class(F.col("largest")))).alias("c"))
        made.append(left.join(by_sub.select(u, size.alias("c")), ["u", "c"]).count())
        return asks

    pairs = minhash_dedup.pairs_across
    monkeypatch.setattr(minhash_dedup, "pairs_across", counting)
    rows = template_pages(n) + [(5000, template_pages(1)[0][1])] + [(6000, " ".join(f"word{i}" for i in range(200)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(df).collect()}
    # the bare template is within 0.85 of every page, so all are one component through it
    assert got == {d: c for d, (_, c) in components(rows).items()}
    alone = spark.createDataFrame(template_pages(n), "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in minhash_dedup.near_duplicates(alone).collect()} == {(i, i) for i in range(n)}
    assert made and made[-1] <= 20 * n


# --- sharding ---------------------------------------------------------------------------------

def test_a_third_of_equal_rows_keeps_the_law(spark):
    rows = [(7, "x" * 200, "en", "s", 1)] * 1000 + [(i, "y" * (i % 400), "de", f"s{i % 9}", 2) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, twin int").repartition(9)
    out = kd_sharding.kd_shards(df, n_shards=16).collect()
    sizes = checked(out, 16)
    want = sum(len(t) + 1 for _, t, *_ in rows) / 16
    assert len(out) == len(rows) and max(sizes) <= 1.05 * want and min(sizes) >= 0.95 * want


def test_twins_do_not_depend_on_the_layout(spark):
    rows = [(i % 5, f"text {i % 3}", "en", "s") for i in range(400)] + [(None, None, None, None)] * 7
    seen = []
    for parts in (2, 7):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(parts)
        numbered = write_snapshot(kd_sharding.prepare(df).withColumn("part", F.spark_partition_id())
                                  .withColumn("number", F.monotonically_increasing_id()), "test-kd")
        seen.append(sorted((str(r["doc_id"]), r["text_crc32"], r["twin"]) for r in kd_sharding.with_twins(numbered).collect()))
    assert seen[0] == seen[1] and len(set(seen[0])) == len(rows)


def cut_by_hand(points, shards):
    """{point: leaf}: nodes cut one after the other at the weighted median of their widest dimension."""
    where, todo = {}, [(0, shards, list(points))]
    while todo:
        node, leaves, own = todo.pop()
        if leaves <= 1 or not own:
            where.update({p[0]: node for p in own})
            continue
        spread = [max(p[2][d] for p in own) - min(p[2][d] for p in own) for d in range(4)]
        axis, left = spread.index(max(spread)), leaves // 2
        total = sum(p[1] for p in own)
        place = lambda p: (p[2][axis] << 20) + p[3]
        cells = defaultdict(int)
        for p in own:
            cells[place(p)] += p[1]
        upto = 0
        for c in sorted(cells):
            if (upto + cells[c]) * leaves >= total * left:
                break
            upto += cells[c]
        goal = total * left / leaves
        cut = c if upto + cells[c] - goal <= goal - upto else c - 1
        todo += [(node, left, [p for p in own if place(p) <= cut]), (node + left, leaves - left, [p for p in own if place(p) > cut])]
    return where


@pytest.mark.parametrize("shards", [2, 5, 16])
def test_cuts_are_those_of_a_kd_tree_by_hand(spark, shards):
    r = random.Random(shards)
    points = [(i, r.choice([1, 5, 40]), [r.randrange(2 ** 20) if d % 2 else r.choice([3, 900_000]) for d in range(4)], r.randrange(2 ** 20))
              for i in range(500)]
    df = spark.createDataFrame([(i, 0, w, *x, tie, 0, shards) for i, w, x, tie in points],
                               "same long, piece int, w long, x_id long, x_lang long, x_source long, x_length long, tie long, node int, leaves int")
    for _ in range(math.ceil(math.log2(shards))):
        df = write_snapshot(kd_sharding._cut(df, shards), "test-kd-cut")
    assert {p["same"]: p["node"] for p in df.collect()} == cut_by_hand(points, shards)


# --- language ---------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(3))
def test_a_language_of_few_long_documents_is_learned(spark, seed):
    r = random.Random(seed)
    words = {"aa": ["taka", "miru", "sono"], "bb": ["gruf", "blat", "krem"]}
    text = lambda lang, n: " ".join(r.choices(words[lang], k=n))
    rows = [(i, text("aa", 30), "aa") for i in range(200)] + [(1000 * seed + 5000 + i, text("bb", 20_000), "bb") for i in range(5)]
    rows += [(9, rows[0][1], "aa")] * 100
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = ppm_language.learn(df, max_bytes=4000)
    assert model["languages"] == ["aa", "bb"]
    got = ppm_language.predict(df.select("doc_id", "text"), model).join(df.select("doc_id", "lang").distinct(), "doc_id")
    assert got.filter("lang <> lang_pred").count() == 0


# --- toxicity ---------------------------------------------------------------------------------

def test_length_alone_is_not_toxic(spark):
    model = {"weights": np.zeros(toxicity_mil.BUCKETS, np.float32), "bias": -9.0, "base": float(np.logaddexp(0, -9.0))}
    clean = ["the cat sat on the mat. " * n for n in (1, 100, 1000, 10_000, 100_000)]
    df = spark.createDataFrame(list(enumerate(clean)), "doc_id long, text string")
    got = [r["score"] for r in toxicity_mil.score(df, model).orderBy("doc_id").collect()]
    assert got == sorted(got) and got[1] == got[-1] < 0.02


def test_sample_with_hot_ids_and_few_long_texts(spark):
    rows = [(1, "the cat sat", 0)] * 400 + [(1, f"the cat sat {i}", 0) for i in range(400)] + [(i, "a bird sang. the tree", 0) for i in range(10, 60)]
    rows += [(100 + i, "you idiot. " + "the bird sat on the tree. " * 3000, 1) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = df.select("doc_id", "toxic").union(df.filter("doc_id = 1").select("doc_id", "toxic"))
    sample, weight = toxicity_mil.sample_texts(df, labels, "toxic", 100, 20_000)
    by_label = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    assert by_label[1] >= 1 and 1 <= by_label[0] <= 220 and weight[1] >= 1


# --- decontamination --------------------------------------------------------------------------

def test_index_in_many_parts_finds_the_same(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    items = [(i if i else None, " ".join(r.choices(words, k=r.choice([3, 12, 60])))) for i in range(150)] + [(7, "one two three four five six")] * 3
    docs = [(i, " ".join(r.choices(words, k=200) + items[i][1].split() + r.choices(words, k=50))) for i in range(100)] + [(200, None), (201, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    paths = containment.index_parts(bench, 40_000)
    assert len(paths) > 4 and sum(len(containment.read_index(p)["items"]) for p in paths) == len(items)
    got = []
    for limit in (64 << 20, 40_000):
        marked = containment.mark(df, bench, index_bytes=limit)
        got.append(sorted((r["doc_id"], str(h["item_id"]), h["n_shared"], h["n_item"]) for r in marked.collect() for h in r["hits"]))
    sets = [(str(i), shingles(t)) for i, t in items]
    want = sorted((d, i, len(s & shingles(t)), len(s)) for d, t in docs for i, s in sets if len(s & shingles(t)) >= 0.8 * len(s))
    assert got[0] == got[1] == want and len(want) > 50


# --- token files ------------------------------------------------------------------------------

def test_a_hot_id_is_spread_over_tasks(spark):
    import public_tokenizers

    r = random.Random(6)
    rows = [(50, f"text {r.randrange(10 ** 6)}" if i % 2 else "the same text") for i in range(600)] + [(i, f"row {i}") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    manifest = token_files.write_token_files(df, public_tokenizers.path("word_bpe_49k.json"))
    assert manifest.agg(F.max("n_docs")).first()[0] < 600
    got = token_files.read_token_files(manifest).orderBy("start").collect()
    ids = [x["doc_id"] for x in got]
    assert ids == sorted(ids) and len(ids) == len(rows)
    ends = np.cumsum([0, *(x["n_tokens"] for x in got)])
    assert [x["start"] for x in got] == ends[:-1].tolist()
    want = defaultdict(int)
    for d, _ in rows:
        want[d] += 1
    assert {d: ids.count(d) for d in want} == want and pa.__version__
