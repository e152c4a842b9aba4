"""Operators 7 and 9: exact sums, held-out accuracy, odd rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from credtrail.llm import ppm_language, toxicity_mil
from tests.conftest import SF_SMALL

SF = SF_SMALL.replace("0.001", "0.01")


def bits_of(text, grams):
    """Code length by walking the contexts from the longest, as the definition says."""
    total, data = 0.0, b"   " + text.encode().lower()
    for i in range(3, len(data)):
        for order in (3, 2, 1, 0, -1):
            if order < 0:
                total += 8
                break
            context = data[i - order:i]
            follow = {}
            for g, n in grams.items():
                if g[3 - order:3] == context:
                    follow[g[3]] = follow.get(g[3], 0) + n
            if not follow:
                continue
            n, d = sum(follow.values()), len(follow)
            if data[i] in follow:
                total -= math.log2(follow[data[i]] / (n + d))
                break
            total -= math.log2(d / (n + d))
    return total


def test_code_lengths_are_exact():
    r = random.Random(1)
    texts = {"a": ["".join(r.choices("abc d", k=60)) for _ in range(5)], "b": ["".join(r.choices("bcé x", k=60)) for _ in range(5)]}
    grams, counts = {}, {}
    for lang, own in texts.items():
        grams[lang] = {}
        for t in own:
            data = b"   " + t.encode()
            for i in range(3, len(data)):
                grams[lang][data[i - 3:i + 1]] = grams[lang].get(data[i - 3:i + 1], 0) + 1
        counts[lang] = (np.array([int.from_bytes(g, "big") for g in grams[lang]]), np.array(list(grams[lang].values())))
    model = ppm_language.freeze(counts)
    probes = ["abc abd", "éé x", "ABC", "zzz", "", "a", *texts["a"][:2], *texts["b"][:2], "cé\U0001F600 d"]
    got = ppm_language.code_lengths(pa.array(probes), model)
    want = [[bits_of(p, grams[lang]) for lang in ("a", "b")] for p in probes]
    assert np.allclose(got, want, atol=1e-3)


def test_language_query_is_accurate_on_held_out_rows(spark):
    got = ppm_language.op9_ppm_language(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 100 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows) and got.count() == docs.count()


def test_language_of_odd_rows(spark):
    train = spark.createDataFrame([(1, "the cat sat", "en"), (2, "der hund", "de"), (3, None, "fr"), (4, "x", None)],
                                  "doc_id long, text string, lang string")
    model = ppm_language.learn(train)
    assert model["languages"] == ["de", "en"]
    odd = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "12 !? ½", 5), (4, "the cat", 5), (4, "the cat", 5), (5, "the " * 200_000, 5)],
                                "doc_id long, text string, score int")
    got = [(r["doc_id"], r["lang_pred"]) for r in ppm_language.predict(odd, model).orderBy("doc_id").collect()]
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "en")]
    nothing = ppm_language.learn(train.limit(0))
    assert {r["lang_pred"] for r in ppm_language.predict(odd, nothing).collect()} == {"und"}
    assert ppm_language.predict(odd.limit(0), model).count() == 0


BAD = ["idiot", "scumbags"]


@pytest.fixture(scope="module")
def insults(spark):
    r = random.Random(8)
    rows = []
    for i in range(900):
        toxic = i % 3 == 0
        sentences = [" ".join(r.choices(["on", "the", "tree", "sat", "bird", "house", "very"], k=8)) for _ in range(r.randint(1, 30))]
        if toxic:
            k = r.randrange(len(sentences))
            sentences[k] += " " + r.choice(BAD)
        rows.append((i, ". ".join(sentences) + ".", int(toxic)))
    return rows


def test_usual_bits_are_the_median_of_all_labelled_rows(spark):
    r = np.random.default_rng(3)
    letters = {"aa": "abcdefgh ", "bb": "qrstuvwx "}
    rows = [(i, "".join(r.choice(list(letters[x]), int(r.integers(3, 60)))), x)
            for i, x in enumerate(["aa"] * 1300 + ["bb"] * 801 + ["cc"] * 7) if x in letters]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = ppm_language.learn(docs)
    frozen = ppm_language.opened(ppm_language.send(spark, model))
    bits = ppm_language.code_lengths(pa.array([x[1] for x in rows]), frozen) / np.array([len(x[1]) for x in rows])[:, None]
    own = {x: np.sort(bits[[i for i, row in enumerate(rows) if row[2] == x], j]) for j, x in enumerate(model["languages"])}
    assert ppm_language.usual_bits(docs, model) == {x: v[(len(v) - 1) // 2] for x, v in own.items()}
    few = docs.filter("lang = 'bb'").limit(ppm_language.LEAST_DOCS - 1)
    assert ppm_language.usual_bits(few, model) == {}


def test_sentences_of_toxic_documents_are_found(spark, insults):
    df = spark.createDataFrame(insults, "doc_id long, text string, toxic int")
    model = toxicity_mil.learn(df, df.filter("doc_id < 600").select("doc_id", "toxic"))
    rows = toxicity_mil.score(df.filter("doc_id >= 600"), model).collect()
    assert sum((r["score"] >= 0.5) == bool(r["toxic"]) for r in rows) >= 0.97 * len(rows)
    right = 0
    for r in rows:
        for span in r["offending"]:
            sentence = r["text"].encode()[span["start"]:].split(b".")[0].decode()
            right += any(b in sentence for b in BAD)
    found = sum(len(r["offending"]) for r in rows)
    assert found >= 95 and right == found


def test_score_is_the_noisy_or_of_sentences(spark):
    weights = np.zeros(toxicity_mil.BUCKETS, np.float32)
    weights[toxicity_mil.features(b"bad")[0]] = 3.0
    model = {"weights": weights, "bias": -2.0}
    p = [1 / (1 + math.exp(2)), 1 / (1 + math.exp(-1))]
    texts = ["fine. BAD bad\nfine", "...", "", None, "bad", "a " * 300_000]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    got = [r["score"] for r in toxicity_mil.score(df, model).orderBy("doc_id").collect()]
    assert np.allclose(got, [1 - (1 - p[0]) ** 2 * (1 - p[1]), 0, 0, 0, p[1], p[0]], atol=1e-6)


def test_without_both_labels_everything_scores_zero(spark):
    df = spark.createDataFrame([(1, "a b", 1), (2, "c d", 1), (3, None, 0), (4, "x", None)], "doc_id long, text string, toxic int")
    assert toxicity_mil.learn(df, df) is None and toxicity_mil.learn(df, df.limit(0)) is None
    both = df.withColumn("toxic", F.col("doc_id").cast("int") % 2)
    assert toxicity_mil.learn(df.limit(0), both) is None
    assert {r["score"] for r in toxicity_mil.score(df, None).collect()} == {0.0}
    assert toxicity_mil.score(df.limit(0), None).count() == 0


def test_toxicity_query_on_held_out_rows(spark):
    got = toxicity_mil.op7_toxicity_mil(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    toxic, clean = [r["score"] for r in rows if r["toxic"]], [r["score"] for r in rows if not r["toxic"]]
    above = np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean])
    assert above > 0.85
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.filter(F.col("predicted") != (F.col("score") >= 0.5).cast("int")).count() == 0
