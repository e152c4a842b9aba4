"""Training-data pipeline over ``documents``: five stages, each written and read again.

Each stage works on every row that the stage before kept and, but for the last, returns the
columns of ``documents``:

1. language ID rejects texts that are in no learned language: no text, not one letter, or far more
   bits per byte in every language than its training rows take (``ppm_language.known_language``);
   without a learned language, texts with a letter stay;
2. toxicity rejects texts that the multiple-instance model scores at 0.5 or more;
3. MinHash near-dedup (Jaccard similarity of 0.85 or more, as op6) keeps one document, the one
   with the smallest doc_id, of each group; rows of one doc_id are one document only if their
   texts are equal (of those: one row); rows without doc_id come after all others, and equal ones are
   one document;
4. benchmark decontamination rejects texts that contain a benchmark item;
5. BPE encodes what is left and decodes it again: doc_id, token ids and digests.

``ORACLE_SQL`` is None: learned models and tokenizers have no SQL; the tests compare the stages with
brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credtrail.llm import containment, forced_bpe, minhash_dedup, ppm_language, toxicity_mil
from credtrail.llm.common import fold_of, read_table, write_snapshot

ORACLE_SQL: str | None = None
NAMELESS = 1 << 62


def _judged(docs: DataFrame, judge: Callable[[DataFrame, str], DataFrame], keep: str) -> DataFrame:
    """The rows of ``docs`` that satisfy ``keep`` after ``judge(rows, name of the text column)``;
    the columns go under neutral names meanwhile, so that no result can clash with one."""
    names = docs.columns
    own = [f"column_{i}" for i in range(len(names))]
    judged = judge(docs.toDF(*own), own[names.index("text")])
    return judged.filter(keep).select(*own).toDF(*names)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages."""
    training = docs.filter(fold_of(F.col("doc_id")) != 0)
    model = ppm_language.learn(training)
    usual = ppm_language.usual_bits(training, model)
    return _judged(docs, lambda rows, text: ppm_language.known_language(rows, model, usual, text), "known")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold."""
    model = toxicity_mil.learn(docs, toxicity_mil.training_labels(read_table(spark, sf_dir, "labels")))
    return _judged(docs, lambda rows, text: toxicity_mil.score(rows, model, text),
                   f"score < {toxicity_mil.THRESHOLD}")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str, percent: int = minhash_dedup.PERCENT,
               terms: int = minhash_dedup.TERMS) -> DataFrame:
    """One document of each group of near-duplicates."""
    names = docs.columns
    own = [f"column_{i}" for i in range(len(names))]
    text = own[names.index("text")]
    rows = docs.toDF(*own).withColumn("digest", minhash_dedup.text_digest(text))
    # rows without doc_id are known by their text, under numbers beyond the ids
    nameless = F.lit(NAMELESS) + F.pmod(F.xxhash64("digest"), F.lit(NAMELESS))
    rows = rows.withColumn("known_as", F.coalesce(F.col(own[names.index("doc_id")]).cast("long"), nameless))
    kept = minhash_dedup.labelled(rows.select(F.col("known_as").alias("doc_id"), F.col(text).alias("text")), percent, terms) \
        .filter("kept").select(F.col("doc_id").alias("known_as"), "digest").distinct()
    # equal rows are combined before the shuffle; the digest spreads the texts of one doc_id
    rows = rows.dropDuplicates(["known_as", "digest"]).join(kept, ["known_as", "digest"], "left_semi")
    return rows.select(*own).toDF(*names)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    benchmark = read_table(spark, sf_dir, "benchmark")
    return _judged(docs, lambda rows, text: containment.mark(rows, benchmark, text), "size(hits) = 0")


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining documents and digests of ids and decoded text."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return forced_bpe.digests(forced_bpe.encode_texts(docs.select("doc_id", "text"), path, decoded="decoded"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_snapshot(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
