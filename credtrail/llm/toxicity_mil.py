"""Operator 7: toxicity by multiple-instance learning.

Labels are known for documents only. A document is a bag of sentences; each sentence has a
logistic score p = sigmoid(bias + the weights of its words), and the bag's score is their
noisy-or, 1 - product(1 - p). A sentence without evidence has p0 = sigmoid(bias); at most
``FLOOR_SENTENCES`` such factors count, and all other sentences count by (1 - p) / (1 - p0), so that a
document does not become toxic by its length. Training fits the weights to the document labels through
that product, so it finds for itself which sentences make a document toxic; the same sentence scores
then locate them.

A word counts as itself and by its beginnings of 4, 5 and 6 letters, hashed into ``BUCKETS``
weights. Sentences end at . ! ? and line ends. A-Z are lower-cased; words are runs of ASCII
letters, digits and bytes above 127.

Training uses about ``MAX_DOCS`` labelled documents and ``MAX_BYTES`` of text of each label: the
ids are chosen by a hash from the distinct labels alone, and that bounded list is broadcast to find
their texts, so no text is shuffled. Equal texts of one id teach once; of the texts found, a hash of id and
text keeps as many as the bounds allow, and the first by it of each label in any case. Features are made on the executors, the fit is numpy
over the sample (buckets in fewer than ``MIN_DOCS`` of its documents are left out; weights can't be
negative, as evidence only adds up), and each label is weighted back to its share of all labelled
rows. Scoring covers every whole text.

Defined cases: a null, empty or wordless text scores 0; without both labels in the training rows
every text scores 0. A null label teaches nothing. Rows with one id and several labels teach
each; repeated rows of ``labels`` count once. Columns named like the results are replaced; all others pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credtrail.llm.common import (TwoGenerationCache, fold_of, read_table, ship_package, slices, text_bytes,
                                  write_snapshot)
from credtrail.llm.words import FOLD_ASCII, words_of

BUCKETS = 1 << 18
MAX_DOCS = 3000
MAX_BYTES = 5 << 20
EPOCHS = 60
MIN_DOCS = 5
BIAS = -9.0
L2 = 2e-6
FLOOR_SENTENCES = 100
THRESHOLD = 0.5
RESULTS = ("score", "offending")
#: letters, digits and all bytes of characters outside ASCII
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
ENDS = np.zeros(256, bool)
ENDS[list(b".!?\n\r")] = True


def features(word: bytes) -> list[int]:
    """Buckets of a word and its beginnings."""
    text = word.decode("utf-8", "replace")
    return [xxhash.xxh32_intdigest(word) % BUCKETS] + [
        xxhash.xxh32_intdigest(text[:k].encode(), seed=k) % BUCKETS for k in (4, 5, 6) if len(text) >= k]


def sentences_of(data: np.ndarray, off: np.ndarray):
    """(distinct words, each word's index, number of the sentence of each word, the row of each
    sentence that has words, byte position of each word); sentences count from 0 over all rows."""
    distinct, index, rows, at = words_of(FOLD_ASCII[data], off, WORD)
    marks = np.cumsum(ENDS[data])[at] if len(at) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(off) - 1), np.diff(rows))
    new = np.ones(len(at), bool)
    new[1:] = (marks[1:] != marks[:-1]) | (row[1:] != row[:-1])
    return distinct, index, np.cumsum(new) - 1, row[new], at


# --- training -------------------------------------------------------------------------------

def sample_texts(docs: DataFrame, labels: DataFrame, label: str, max_docs: int, max_bytes: int):
    """((label, text, h) of the sampled documents as a written table, {label: weight of one});
    None without both labels."""
    known = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")) \
        .filter("label in (0, 1) and doc_id is not null").distinct() \
        .withColumn("h", F.pmod(F.xxhash64("doc_id", F.lit("mil")), F.lit(1_000_000)))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None

    def of_label(value: dict):
        return F.when(F.col("label") == 1, value[1]).otherwise(value[0])

    share = {k: min(1.0, max_docs / n) for k, n in counts.items()}
    picked = F.broadcast(known.filter(F.col("h") < of_label(share) * 1_000_000).drop("h"))  # about 2 * max_docs distinct rows
    row = F.pmod(F.xxhash64("doc_id", "text", F.lit("row")), F.lit(1_000_000_000))
    found = write_snapshot(docs.select("doc_id", "text").filter("text is not null").join(picked, "doc_id")
                           .select("label", "text", row.alias("h")).dropDuplicates(["label", "h"]), "mil-sample")
    sizes = {r["label"]: r for r in found.groupBy("label").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.min("h").alias("first")).collect()}
    if len(sizes) < 2:
        return None
    kept = {k: min(1.0, 1.5 * max_docs / r["n"], max_bytes / max(r["bytes"], 1)) for k, r in sizes.items()}
    below = {k: max(kept[k] * 1e9, sizes[k]["first"] + 0.5) for k in kept}
    return found.filter(F.col("h") < of_label(below)), {k: 1 / (share[k] * min(1.0, below[k] / 1e9)) for k in kept}


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_docs: int = MAX_DOCS,
          max_bytes: int = MAX_BYTES, epochs: int = EPOCHS) -> dict | None:
    """Weights and bias from ``docs`` (doc_id, text) and ``labels`` (doc_id, 0/1); None without
    both labels."""
    ship_package(docs.sparkSession)
    sampled = sample_texts(docs, labels, label, max_docs, max_bytes)
    if sampled is None:
        return None
    sample, weight = sampled

    def bags(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                distinct, index, sentence, row, _ = sentences_of(*text_bytes(part.column("text")))
                made = list(map(features, distinct))
                n = np.array([len(m) for m in made], np.int64)
                pool = np.array([x for m in made for x in m], np.int32)
                begin = np.cumsum(n) - n
                bounds = np.searchsorted(sentence, np.arange(len(row) + 1))
                firsts = np.searchsorted(row, np.arange(part.num_rows + 1))
                for i in range(part.num_rows):
                    feats, lens = [], []
                    for s in range(firsts[i], firsts[i + 1]):
                        words = np.unique(index[bounds[s]:bounds[s + 1]])
                        feats += [pool[begin[w]:begin[w] + n[w]] for w in words]
                        lens.append(int(n[words].sum()))
                    yield pa.RecordBatch.from_pydict({
                        "label": part.column("label").slice(i, 1), "h": part.column("h").slice(i, 1),
                        "feats": pa.array([np.concatenate(feats).tobytes() if feats else b""], pa.binary()),
                        "lens": pa.array([np.array(lens, np.int32).tobytes()], pa.binary())})

    got = sample.mapInArrow(bags, "label int, h long, feats binary, lens binary").collect()
    got.sort(key=lambda r: (r["h"], r["label"], bytes(r["feats"])))
    if len({r["label"] for r in got}) < 2:
        return None
    return fit(np.array([r["label"] for r in got]), [np.frombuffer(r["feats"], np.int32) for r in got],
               [np.frombuffer(r["lens"], np.int32) for r in got], weight, epochs)


def fit(labels: np.ndarray, feats: list, lens: list, weight: dict, epochs: int = EPOCHS) -> dict:
    """Fit by Adam on the noisy-or likelihood of all sampled bags."""
    size = np.array([len(x) for x in lens])
    flat = np.concatenate(feats)
    length = np.concatenate(lens)
    sentence = np.repeat(np.arange(len(length), dtype=np.int32), length)
    documents = np.zeros(BUCKETS, np.int32)
    for x in feats:
        documents[np.unique(x)] += 1
    known = documents[flat] >= MIN_DOCS
    sentence = sentence[known]
    used, flat = np.unique(flat[known], return_inverse=True)
    flat = flat.astype(np.int32)
    bag = np.repeat(np.arange(len(labels)), size)
    floor = np.minimum(size, FLOOR_SENTENCES)
    importance = np.array([weight[int(k)] for k in labels])
    importance = importance / importance.sum()
    w, bias = np.zeros(len(used)), BIAS
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, epochs + 1):
        z = bias + np.bincount(sentence, w[flat], len(length))
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        base, p0 = np.logaddexp(0, bias), 1 / (1 + np.exp(-bias))
        total = np.bincount(bag, np.logaddexp(0, z) - base, len(labels)) + base * floor
        clean = np.exp(-total)
        pull = np.where(labels == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) * importance
        g = pull[bag]
        grad = np.append(np.bincount(flat, (g * p)[sentence], len(used)) + L2 * w,
                         (g * (p - p0)).sum() + (pull * floor).sum() * p0)
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad ** 2
        move = 0.25 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
        w = np.maximum(w - move[:-1], 0)  # evidence only adds up
        bias -= move[-1]
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = w
    return {"weights": weights, "bias": float(bias), "base": float(np.logaddexp(0, bias))}


# --- scoring --------------------------------------------------------------------------------

def sentence_scores(data: np.ndarray, off: np.ndarray, model: dict, cache: TwoGenerationCache):
    """(logit, row, number of the sentence of each word, byte position of each word)."""
    distinct, index, sentence, row, at = sentences_of(data, off)
    weights = np.array(cache.values_of(distinct)) if distinct else np.zeros(0)
    if len(index):  # a word counts once a sentence
        pair = np.unique(sentence * len(distinct) + index)
        z = model["bias"] + np.bincount(pair // len(distinct), weights[pair % len(distinct)], len(row))
    else:
        z = np.zeros(0)
    return z, row, sentence, at


def score(df: DataFrame, model: dict | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``score`` and ``offending``: (byte offset of the first word, probability) of
    every sentence whose own probability reaches ``threshold``. ``base`` of the model is -log(1 - p) of a
    sentence without evidence; it is taken off the sentences beyond ``FLOOR_SENTENCES`` (a model without it
    has the plain product)."""
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS weights whatever the input
    keep = [f for f in df.schema.fields if f.name not in RESULTS]
    names = [f.name for f in keep]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("p", pa.float64())]))

    def run(batches):
        fitted = shared.value or {"weights": np.zeros(BUCKETS, np.float32), "bias": -np.inf}
        weights = fitted["weights"]
        cache = TwoGenerationCache(150_000, lambda words: [float(weights[features(w)].sum()) for w in words])
        for batch in batches:
            for part in slices(batch, text, 2 << 20):
                data, off = text_bytes(part.column(text))
                z, row, sentence, at = sentence_scores(data, off, fitted, cache)
                base = fitted.get("base", 0.0)
                total = np.bincount(row, np.maximum(np.logaddexp(0, z) - base, 0), part.num_rows)
                total = total + base * np.minimum(np.bincount(row, minlength=part.num_rows), FLOOR_SENTENCES)
                found: list = [[] for _ in range(part.num_rows)]
                p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                firsts = np.searchsorted(sentence, np.arange(len(row)))
                for s in np.flatnonzero(p >= threshold).tolist():
                    found[row[s]].append({"start": int(at[firsts[s]] - off[row[s]]), "p": float(p[s])})
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(-np.expm1(-total)), pa.array(found, kind)],
                    [*names, *RESULTS])

    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("p", T.DoubleType())]))
    return df.select(*names).mapInArrow(
        run, T.StructType([*keep, T.StructField("score", T.DoubleType()), T.StructField("offending", spans)]))


def training_labels(labels: DataFrame) -> DataFrame:
    """The labels that may be learned from: those outside fold 0."""
    return labels.select("doc_id", "toxic").filter(fold_of(F.col("doc_id")) != 0)


def op7_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from the labels outside fold 0, then score every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, training_labels(read_table(spark, sf_dir, "labels")))
    scored = score(docs, model)
    return scored.select(
        "doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("offending.start").alias("offending_starts"))
