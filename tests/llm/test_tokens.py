"""Operators 4 and 5 against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from credtrail.llm import forced_bpe, token_files
from tests.conftest import SF_SMALL

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "b", " ", "  ", "\n", "\n\n", "\t", "\r\n", "'", "'s", "'re", "'LL", "!", "?", ".", ",", "1", "23", "é", "É", "ß",
          "\u00a0", "\u3000", "\u2009", "日本", "ñ", "Ñu", "the", "The", "😀", "\x1c", "\x85", "\x00", "\u0301", "h\u0331",
          "H\u0331", "İ", "ΑΣ", "½", "Ⅷ", "\u212a", "ation", "<|endoftext|>", "<|end", "oftext|>", "--", "\U000F1234"]
TEXTS = st.lists(st.one_of(st.lists(st.sampled_from(PIECES), max_size=30).map("".join),
                           st.text(st.characters(exclude_categories=["Cs"]), max_size=30)), min_size=1, max_size=6)


def library(path):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def byte_side():
    with open(BYTE, encoding="utf-8") as f:
        return forced_bpe.ForcedBoundaryEncoder(f.read(), 500), library(BYTE)


@pytest.fixture(scope="module")
def word_side():
    with open(WORD, encoding="utf-8") as f:
        return token_files.WordPieceCache(f.read(), 500), library(WORD)


def same(encoder, tokenizer, texts):
    flat, off = encoder.encode(pa.array(texts, pa.string()))
    got = [flat[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)]
    assert got == [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_forced_boundaries_give_the_library_ids(byte_side, texts):
    same(*byte_side, [*texts, None, ""])


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_word_pieces_give_the_library_ids(word_side, texts):
    same(*word_side, [*texts, None, ""])


def test_no_token_spans_a_cut(byte_side):
    encoder, _ = byte_side
    text = "It's 12 o'clock,  she said: \n\nwhy?!" * 3
    data, off = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])
    cuts = set(encoder.cuts(data, off).tolist())
    ids, _ = encoder.encode(pa.array([text]))
    ends = set(np.cumsum(encoder.lengths[ids]).tolist()) | {0}
    assert len(cuts) > 20 and cuts <= ends


def test_very_long_text_and_slices(byte_side):
    same(*byte_side, ["word and " * 60_000, "x" * 20_000, "é " * 5000])


def rows(spark):
    return spark.createDataFrame(
        [(3, "Hello  world", "x"), (1, None, "y"), (2, "", None), (3, "Hello  world", "x"), (7, "a <|endoftext|>b", "z")],
        "doc_id long, text string, ids string")


def test_bpe_round_trip_and_clashing_columns(spark):
    coded = forced_bpe.encode_texts(rows(spark), BYTE)
    assert coded.columns == ["doc_id", "ids"]
    got = {(r["doc_id"], r["decoded"]) for r in forced_bpe.decode_ids(coded, BYTE).collect()}
    assert got == {(3, "Hello  world"), (1, ""), (2, ""), (7, "a <|endoftext|>b")}
    odd = spark.createDataFrame([(1, None), (2, [-5, 10 ** 6, 40]), (3, [None, 40])], "doc_id long, ids array<int>")
    table = library(BYTE).decode([40], skip_special_tokens=False)
    assert [r["decoded"] for r in forced_bpe.decode_ids(odd, BYTE).orderBy("doc_id").collect()] == ["", table, table]


def test_bpe_query(spark):
    t = library(BYTE)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in forced_bpe.op5_bpe_forced_boundary(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = t.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1)), max_size=50))
def test_rank_streams_round_trip(ranks):
    control, data = token_files.pack_ranks(np.array(ranks, np.uint32))
    assert len(control) == -(-len(ranks) // 4)
    assert token_files.unpack_ranks(control, data, len(ranks)).tolist() == ranks


def brute_force(docs, tokenizer):
    start, out = 0, []
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_file_query(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    got = token_files.op4_frequency_ranked_token_files(spark, SF_SMALL).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == brute_force(docs, library(WORD))


def test_token_files_of_unordered_rows_with_nulls(spark, tmp_path):
    data = [(5, "five five"), (None, "no id"), (2, None), (9, ""), (2, "again two"), (-4, "minus")] + [
        (100 + k, f"text {k} " * (k % 7)) for k in range(40, 0, -1)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    manifest = token_files.write_token_files(df, WORD, folder=str(tmp_path / "files"), file_tokens=50)
    assert manifest.count() > 4
    got = sorted((tuple(r) for r in token_files.read_token_files(manifest).select("start", "doc_id", "n_tokens", "ids").collect()),
                 key=lambda r: r[0])
    assert [r[1] for r in got] == sorted((d[0] for d in data), key=lambda d: (d is not None, d or 0))
    assert [r[0] for r in got] == np.cumsum([0, *[r[2] for r in got]])[:-1].tolist()
    t = library(WORD)
    texts = sorted(np.frombuffer(r[3], "<u4").tolist() for r in got)
    assert texts == sorted([*t.encode(x or "", add_special_tokens=False).ids, 1] for _, x in data)


def test_token_files_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.read_token_files(token_files.write_token_files(df, WORD)).count() == 0
    assert forced_bpe.encode_texts(df, BYTE).count() == 0
