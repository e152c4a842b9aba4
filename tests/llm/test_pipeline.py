"""The pipeline: its stages against brute force, and the registered queries of the subpackage."""

import base64
import random

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from credtrail.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_similar import components, shingles

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_queries_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "near_dedup", "decontamination", "bpe"]


def rounded(rows):
    return sorted(str(tuple(r)) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    con.execute(ORACLE[name])
    columns = [d[0] for d in con.description]
    assert sorted(df.columns) == sorted(columns)
    assert rounded(df.select(*columns).collect()) == rounded(con.fetchall())


def test_stages_keep_columns_and_match_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = [shingles(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        kept = {r["doc_id"] for r in after.collect()}
        if name != "bpe":
            assert after.schema.simpleString() == docs.schema.simpleString()
        if name == "near_dedup":
            assert kept == {c for _, c in components(list(before.items())).values()}
        if name == "decontamination":
            hit = {d for d, t in before.items() if any(len(b & shingles(t)) >= 0.8 * len(b) for b in bench)}
            assert hit and kept == set(before) - hit
        if name in ("language_id", "bpe"):
            assert kept == set(before)
        docs = after


def test_stages_on_odd_rows(spark):
    rows = [(None, "a b c d e f", "en", "s", 1, "x"), (None, "a b c d e f", "en", "s", 1, "x"), (1, None, None, None, None, None), (2, "", "en", "s", 0, "y"),
            (3, "the bird sat on the tree", "en", "s", 9, "y"), (3, "the bird sat on the tree", "en", "s", 9, "y"),
            (4, "The bird  sat on the tree", "en", "s", 9, "z"), (6, "12 34", "de", "s", 9, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, lang_pred string")
    docs = df.withColumn("hits", df["lang_pred"]).withColumn("score", df["lang_pred"])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.schema.simpleString() == docs.schema.simpleString()
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
        ids = sorted(str(r["doc_id"]) for r in out.collect())
        if name == "language_id":
            assert ids == ["3", "3", "4", "None", "None"]
        elif name == "near_dedup":  # equal texts without doc_id are copies of each other: one stays
            assert ids == ["1", "2", "3", "6", "None"]
        else:
            assert len(ids) == len(rows)


def test_near_dedup_at_a_lower_threshold(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = {p: {c for _, c in components(rows, percent=p).values()} for p in (80, 85)}
    assert want[80] < want[85]
    got = corpus_pipeline.near_dedup(spark, docs, SF_SMALL, percent=80, terms=16)
    assert {r["doc_id"] for r in got.collect()} == want[80]


def test_near_dedup_keeps_the_different_texts_of_one_id(spark):
    texts = [f"{i} the bird number {i} sat on tree {i} and sang song {i}" for i in range(30)]
    rows = [(5, t, "a") for t in texts] + [(5, texts[0], "a"), (9, texts[1], "b"), (2, texts[2], "c"), (5, None, "a"), (5, None, "a"), (5, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string").repartition(5)
    got = sorted((r["doc_id"], str(r["text"])) for r in corpus_pipeline.near_dedup(spark, docs, SF_SMALL).collect())
    assert got == sorted([(2 if i == 2 else 5, t) for i, t in enumerate(texts)] + [(5, "None"), (5, "")])


def test_language_stage_rejects_what_no_learned_language_explains(spark):
    sample = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang").filter("lang = 'en'")
    r = random.Random(4)
    odd = [(None, t, "en") for t in [  # fold 0: judged, not learned from
        base64.b64encode(r.randbytes(600)).decode(), "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=400)),
        "Все люди рождаются свободными и равными в своем достоинстве и правах.", "人人生而自由,在尊严和权利上一律平等。", "12 34"]]
    docs = sample.union(spark.createDataFrame(odd, sample.schema))
    kept = {(x["doc_id"], x["text"]) for x in corpus_pipeline.language_id(spark, docs, SF_SMALL).collect()}
    assert kept == {(x["doc_id"], x["text"]) for x in sample.collect()}


def test_language_stage_without_a_learned_language(spark):
    docs = spark.createDataFrame([(1, "the bird", None), (2, "12", None), (3, "a tree", None), (4, None, None)],
                                 "doc_id long, text string, lang string")
    assert sorted(x["doc_id"] for x in corpus_pipeline.language_id(spark, docs, SF_SMALL).collect()) == [1, 3]
