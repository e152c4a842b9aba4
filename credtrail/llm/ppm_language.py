"""Operator 9: language by prediction by partial matching (PPM).

For every language a context tree of order ``ORDER`` over bytes holds how often each byte
followed each context of up to ``ORDER`` bytes. A byte that a context has seen ``c`` times
among ``n`` bytes of ``d`` kinds costs -log2(c / (n + d)) bits; an unseen one costs the escape,
-log2(d / (n + d)), and then its cost in the next shorter context, down to 8 bits for any byte.
A context that was never seen costs nothing to leave. The statistics are frozen after training,
so the code length of a whole text under each language is an exact sum, and the shortest wins.

Frozen costs depend on the longest known context and the next byte only. They are tabulated once
for each language (its contexts x its bytes), so scoring is one table look-up per byte and language. The tables
are files that the workers map into memory, one for each language: they grow with the number of
languages, the driver holds one at a time, and the workers of an executor share their pages. A-Z
are lower-cased; each text begins in the context of spaces.

Training uses about ``MAX_DOCS`` documents and ``MAX_BYTES`` of text per language, chosen by a
hash of id and text, and at least one document of every language, the first by that hash, however long it is. Equal
rows teach once. The counting is a Spark aggregation and its result is bounded by that sample, not
by the corpus.

Defined cases: null text, empty text and text without a letter give ``und`` with score 0; so do
all texts if nothing could be learned. Rows without text or language teach nothing. Ties go to
the language that sorts first. The score is the posterior of the language under equal priors.
Columns named like the results are replaced; all others pass through; repeated rows are each
scored.

``known_language`` tells which texts are in a learned language at all. The shortest code of a text
must not exceed LIMIT_FACTOR times the usual bits per byte of that language, the median of all its
labelled rows (and never ``MOST_BITS``, what a byte costs without any model); a text is
granted that for SHORT_BYTES bytes more than it has, so that a few rare letters don't reject a
short one. The median stays right with up to half of the rows mislabelled. A language with fewer
than LEAST_DOCS such rows has no limit, and if no language was learned every text with a letter
passes: without a measure nothing is rejected.
"""

from __future__ import annotations

import io
import os

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credtrail.llm.common import (fold_of, read_table, scratch_path, ship_package, slices, text_bytes, write_shared,
                                  write_snapshot)
from credtrail.llm.words import FOLD_ASCII

ORDER = 3
MAX_DOCS = 1500
MAX_BYTES = 4 << 20
SLICE_BYTES = 1 << 20
LEAST_DOCS = 30
LIMIT_FACTOR = 2.5
MOST_BITS = 8.0
SHORT_BYTES = 16
BINS = 4096  # of one bit per byte, in which the median is looked for first
RESULTS = ("lang_pred", "score")


def padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The folded bytes with ORDER spaces before each row; each byte's position; row offsets."""
    data, off = text_bytes(column)
    rows = np.repeat(np.arange(len(off) - 1), np.diff(off))
    at = np.arange(len(data)) + (rows + 1) * ORDER
    wide = np.full(len(data) + ORDER * (len(off) - 1), 0x20, np.uint8)
    wide[at] = FOLD_ASCII[data]
    return wide, at, off


# --- training -------------------------------------------------------------------------------

def chosen(labelled: DataFrame, text: str, lang: str, doc_id: str, max_docs: int, max_bytes: int) -> DataFrame | None:
    """(lang, text) of the training rows; None without any."""
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
                           F.xxhash64(F.col(doc_id), F.col(text), F.lit("ppm")).alias("h")) \
        .filter("lang is not null and text is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"),
                                     F.min(F.pmod("h", F.lit(1_000_000))).alias("first"))
    share = F.least(F.lit(max_docs) / F.col("n"), F.lit(max_bytes) / F.greatest("bytes", F.lit(1))) * 1_000_000
    limits = sizes.select("lang", F.greatest(share, F.col("first") + 0.5).alias("below"))  # one row a language
    sample = rows.join(F.broadcast(limits), "lang").filter(F.pmod("h", F.lit(1_000_000)) < F.col("below"))
    return sample.dropDuplicates(["lang", "h"]).select("lang", "text")


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
          max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES) -> dict:
    """The frozen model of the languages in ``labelled``: {"languages": names, "files": of each the path
    of its table}. Every language with a text is in it."""
    spark = labelled.sparkSession
    ship_package(spark)

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                wide, at, off = padded(part.column("text"))
                gram = np.zeros(len(at), np.int64)
                for k in range(ORDER, -1, -1):
                    gram = gram << 8 | wide[at - k]
                langs = part.column("lang").to_pylist()
                names = sorted(set(langs))
                code = np.repeat(np.array([names.index(x) for x in langs]), np.diff(off))
                both, n = np.unique(code << 32 | gram, return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([names[i] for i in (both >> 32).tolist()], pa.string()),
                    "gram": pa.array(both & 0xFFFFFFFF), "n": pa.array(n.astype(np.int64))})

    grams = write_snapshot(chosen(labelled, text, lang, doc_id, max_docs, max_bytes)
                           .mapInArrow(count, "lang string, gram long, n long")
                           .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "ppm-grams")
    languages = sorted(r["lang"] for r in grams.select("lang").distinct().collect())
    folder, files = scratch_path(spark, "ppm-model"), []
    for name in languages:  # one language's table at a time
        own = grams.filter(F.col("lang") == name).select("gram", "n").toArrow()
        files.append(write_shared(folder, ".ppm", [table_bytes(freeze_one(own["gram"].to_numpy(), own["n"].to_numpy()))]))
    return {"languages": languages, "files": files}


def freeze_one(gram: np.ndarray, n: np.ndarray) -> dict:
    """Cost table of a language from its counts of (ORDER + 1)-grams of bytes.

    ``context``: for every ORDER byte classes, the row of the longest context that was seen;
    ``cost``: for each such row and byte class the bits."""
    used = np.unique(np.append(gram & 0xFF, 0x20))
    kinds = len(used) + 1  # class 0: bytes that training has not seen
    classes = np.zeros(256, np.int32)
    classes[used] = np.arange(1, kinds)
    code = np.zeros(len(gram), np.int64)
    for k in range(ORDER, -1, -1):
        code = code * kinds + classes[(gram >> (8 * k)) & 0xFF]
    n = n.astype(np.float64)
    cost = [np.full((1, kinds), 8.0)]  # below order 0: 8 bits a byte
    rows = np.zeros(1, np.int64)  # of each context of the order before, its row in cost
    for order in range(ORDER + 1):
        key, inverse = np.unique(code % kinds ** (order + 1), return_inverse=True)
        tally = np.bincount(inverse, n)
        contexts, row = np.unique(key // kinds, return_inverse=True)
        rows = rows[np.arange(kinds ** order) % kinds ** max(order - 1, 0)]
        table = np.concatenate(cost)[rows[contexts]]
        total, distinct = np.bincount(row, tally), np.bincount(row)
        table += np.log2((total + distinct) / distinct)[:, None]
        table[row, key % kinds] = np.log2((total[row] + distinct[row]) / tally)
        rows[contexts] = sum(map(len, cost)) + np.arange(len(contexts))
        cost.append(table)
    return {"classes": classes, "kinds": kinds, "context": rows.astype(np.int32),
            "cost": np.concatenate(cost).astype(np.float32)}


def freeze(counts: dict) -> dict:
    """A model in memory from each language's (grams, counts)."""
    languages = sorted(counts)
    return {"languages": languages, "tables": [freeze_one(*counts[x]) for x in languages]}


def table_bytes(table: dict) -> bytes:
    """A table as one .npy array of 32-bit words: kinds, classes, contexts, costs."""
    out = io.BytesIO()
    np.save(out, np.concatenate([np.array([table["kinds"]], np.int32), table["classes"], table["context"],
                                 table["cost"].ravel().view(np.int32)]))
    return out.getvalue()


def mapped_table(path: str) -> dict:
    words = np.load(path, mmap_mode="r").view(np.ndarray)
    kinds = int(words[0])
    ends = 257 + kinds ** ORDER
    return {"kinds": kinds, "classes": np.array(words[1:257]), "context": words[257:ends],
            "cost": words[ends:].view(np.float32).reshape(-1, kinds)}


def send(spark: SparkSession, model: dict) -> dict:
    """The model as the workers open it: names of files that Spark brings to every executor."""
    for path in model.get("files", []):
        spark.sparkContext.addFile(path if "://" in path else f"file://{path}")
    return {"languages": model["languages"], "names": [os.path.basename(f) for f in model.get("files", [])]}


def opened(sent: dict) -> dict:
    return {"languages": sent["languages"], "tables": [mapped_table(SparkFiles.get(name)) for name in sent["names"]]}


# --- scoring --------------------------------------------------------------------------------

def code_lengths(column: pa.Array, model: dict) -> np.ndarray:
    """Bits of each whole text under each language."""
    wide, at, off = padded(column)
    out = np.zeros((len(off) - 1, len(model["languages"])))
    full = np.flatnonzero(np.diff(off))
    for j, table in enumerate(model["tables"]):
        code = table["classes"][wide]
        context = np.zeros(len(at), np.int32)
        for k in range(ORDER, 0, -1):
            context *= table["kinds"]
            context += code[at - k]
        if len(full):
            bits = table["cost"][table["context"][context], code[at]]
            out[full, j] = np.add.reduceat(bits, off[full], dtype=np.float64)
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def predict(df: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` for every row."""
    spark = df.sparkSession
    ship_package(spark)
    sent = send(spark, model)
    keep = [f for f in df.schema.fields if f.name not in RESULTS]
    names = [f.name for f in keep]

    def run(batches):
        frozen = opened(sent)
        languages = np.array([*frozen["languages"], "und"], object)
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                column = part.column(text)
                letters = np.fromiter(map(has_letter, (x.as_py() for x in column)), bool, part.num_rows)
                best, score = np.full(part.num_rows, -1), np.zeros(part.num_rows)
                if frozen["languages"]:
                    bits = code_lengths(column, frozen)
                    lead = bits.min(axis=1, keepdims=True)
                    score = np.where(letters, 1 / np.exp2(np.maximum(lead - bits, -1000)).sum(axis=1), 0.0)
                    best = np.where(letters, bits.argmin(axis=1), -1)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(languages[best], pa.string()),
                     pa.array(score)], [*names, *RESULTS])

    schema = T.StructType([*keep, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return df.select(*names).mapInArrow(run, schema)


def usual_bits(labelled: DataFrame, model: dict, text: str = "text", lang: str = "lang") -> dict:
    """{language: median bits per byte of all its rows in ``labelled`` (the lower one of two)}, of those
    with LEAST_DOCS rows."""
    if not model["languages"]:
        return {}
    ship_package(labelled.sparkSession)
    sent = send(labelled.sparkSession, model)
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")) \
        .filter(F.col("lang").isin(model["languages"]) & (F.octet_length("text") > 0))

    def run(batches):
        frozen = opened(sent)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                own = np.array([frozen["languages"].index(x) for x in part.column("lang").to_pylist()])
                bits = np.zeros(part.num_rows)
                for j in np.unique(own).tolist():
                    at = np.flatnonzero(own == j)
                    only = {"languages": frozen["languages"][j:j + 1], "tables": frozen["tables"][j:j + 1]}
                    column = part.column("text").take(pa.array(at))
                    bits[at] = code_lengths(column, only)[:, 0] / np.diff(text_bytes(column)[1])
                yield pa.RecordBatch.from_pydict({"lang": part.column("lang"), "bits": pa.array(bits)})

    # exact without a sort of all rows: the bin of the median, then the values in that bin
    measured = write_snapshot(rows.mapInArrow(run, "lang string, bits double"), "ppm-bits") \
        .withColumn("bin", F.floor(F.col("bits") * BINS))
    upward, all_bins = Window.partitionBy("lang").orderBy("bin"), Window.partitionBy("lang")
    bins = measured.groupBy("lang", "bin").agg(F.count("*").alias("n")).select(
        "lang", "bin", "n", F.sum("n").over(upward).alias("end"), F.sum("n").over(all_bins).alias("rows"))
    middle = F.ceil(F.col("rows") / 2)
    hit = bins.filter((F.col("end") >= middle) & (F.col("end") - F.col("n") < middle)) \
        .select("lang", "bin", middle.alias("middle"), (F.col("end") - F.col("n")).alias("before"), "rows")  # a row a language
    values = measured.join(F.broadcast(hit), ["lang", "bin"]).groupBy("lang", "middle", "before", "rows", "bits") \
        .agg(F.count("*").alias("n"))
    end = F.sum("n").over(Window.partitionBy("lang").orderBy("bits")) + F.col("before")
    found = values.withColumn("end", end).filter(F.col("end") >= F.col("middle")).groupBy("lang") \
        .agg(F.min("bits").alias("bits"), F.max("rows").alias("n")).collect()
    return {r["lang"]: r["bits"] for r in found if r["n"] >= LEAST_DOCS}


def known_language(df: DataFrame, model: dict, usual: dict, text: str = "text") -> DataFrame:
    """``df`` with ``known``: whether the text has a letter and is in a learned language by the
    limits that ``usual`` (from ``usual_bits``) sets."""
    spark = df.sparkSession
    ship_package(spark)
    limits = np.array([min(MOST_BITS, LIMIT_FACTOR * usual[x]) if x in usual else np.inf for x in model["languages"]])
    sent = send(spark, model)
    keep = [f for f in df.schema.fields if f.name != "known"]
    names = [f.name for f in keep]

    def run(batches):
        frozen = opened(sent)
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                column = part.column(text)
                known = np.fromiter(map(has_letter, (x.as_py() for x in column)), bool, part.num_rows)
                if frozen["languages"]:
                    bits = code_lengths(column, frozen)
                    known &= bits.min(axis=1) <= limits[bits.argmin(axis=1)] * (np.diff(text_bytes(column)[1]) + SHORT_BYTES)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(known)], [*names, "known"])

    return df.select(*names).mapInArrow(run, T.StructType([*keep, T.StructField("known", T.BooleanType())]))


def op9_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from the documents outside fold 0, then predict the language of every document."""
    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs.filter(fold_of(F.col("doc_id")) != 0))
    scored = predict(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")
