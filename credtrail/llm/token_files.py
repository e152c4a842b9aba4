"""Operator 4: token ids in byte-aligned variable-length files, ranked by frequency.

Every text is encoded with the tokenizers library; an end id closes each document. The ids are
counted over all documents and replaced by their frequency rank (0: the most frequent id), so
that most take one byte. A file holds consecutive documents in ascending doc_id order:

    header     4 bytes "FRB1", then as little-endian uint64: documents, tokens, data bytes
    documents  int64 doc_id each (nulls: the smallest value, with the flag in the next array)
               uint8 null flag each, uint32 number of tokens each
    control    one byte for four tokens: two bits each, the number of data bytes less one
    data       the ranks, 1 to 4 little-endian bytes each

Control bytes are apart from the data, so the reader gets all lengths with one numpy table
look-up (256 control bytes -> four lengths) and all ranks with a few gathers. ``ranks.bin``
beside the files holds the id of each rank (uint32).

Distinct pieces between white space are encoded once per task cache: the tokenizer drops white
space and never joins anything across it. A piece is simplified only where that can't change
its ids (case of ASCII pieces, punctuation after a letter or digit); the rest goes to the
library as it is, and so do whole texts that hold a string of a special token.

Files are written under new names; only those of committed tasks are in the manifest, so lost
executors and retried tasks leave no trace. Input that is already clustered by doc_id is not
shuffled; otherwise it is range-partitioned by doc_id.

Defined cases: a null or empty text has only the end id; a null doc_id sorts first; rows with
the same doc_id are all written, one after the other; an empty table gives no files and no rows.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from credtrail.llm.common import (TwoGenerationCache, open_shared, read_table, scratch_path, ship_package,
                                  slices, text_bytes, write_shared, write_snapshot)
from credtrail.llm.forced_bpe import byte_alphabet, expand
from credtrail.llm.words import words_of

CACHE_ENTRIES = 300_000
FILE_TOKENS = 8 << 20
MAGIC = b"FRB1"
WHITE = np.ones(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0D]] = False
TAIL = b".,!?;:|*#%&$"


# --- encoding -------------------------------------------------------------------------------

class WordPieceCache:
    """Ids of whole texts by way of the distinct pieces between white space."""

    LETTERS = re.compile("[a-zß-öø-ÿ]+")  # NFC and lower case change none of them

    def __init__(self, tokenizer_json: str, cache_entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        kinds = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if kinds != ["NFC", "Replace", "Lowercase"] or [x.get("type") for x in steps] != ["Split", "ByteLevel"] \
                or steps[0]["behavior"] != "Removed" or not steps[0]["invert"]:
            raise ValueError("pieces between white space are only independent for lower-casing word BPE")
        self.model = self.tokenizer.model
        letter = {b: c for c, b in byte_alphabet().items()}
        self.spell = [letter[b] for b in range(256)]
        added = [re.escape(x["content"]) for x in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(added).encode()) if added else None
        self.pieces = TwoGenerationCache(cache_entries, self._encode)

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        out: list = [None] * len(pieces)
        rest = []
        for i, piece in enumerate(pieces):
            word = piece.decode()
            if word.isascii():
                word = word.lower()
            elif self.LETTERS.fullmatch(low := word[0].lower() + word[1:]):
                word = low
            if self.LETTERS.fullmatch(word):
                spelt = word if word.isascii() else "".join([self.spell[b] for b in word.encode()])
                out[i] = np.array([t.id for t in self.model.tokenize(spelt)], np.uint32).tobytes()
            else:
                rest.append((i, word))
        for at in range(0, len(rest), 4096):
            part = rest[at:at + 4096]
            for (i, _), e in zip(part, self.tokenizer.encode_batch_fast([w for _, w in part],
                                                                        add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, np.uint32).tobytes()
        return out

    def values_of(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece; a tail of punctuation is looked up apart from the word."""
        words, tails = [], []
        for piece in pieces:
            word = piece.rstrip(TAIL)
            if len(word) < len(piece) and word and (word[-1:].isalnum() or word[-1] >= 0x80 and
                                                    word.decode()[-1].lower().isalpha()):
                words.append(word)
                tails.append(piece[len(word):])
            else:
                words.append(piece)
                tails.append(b"")
        known = dict(zip(t := list({x for x in tails if x}), self.pieces.values_of(t), strict=True))
        known[b""] = b""
        return [w + known[x] for w, x in zip(self.pieces.values_of(words), tails, strict=True)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and the n + 1 row offsets into them."""
        data, off = text_bytes(column)
        if self.special is not None and self.special.search(data):
            rows = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(
                [x or "" for x in column.to_pylist()], add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.uint32), *rows]), np.cumsum([0, *map(len, rows)])
        distinct, index, rows, _ = words_of(data, off, WHITE)
        flat, ends = expand(self.values_of(distinct), np.uint32, index)
        return flat, ends[rows]


_encoders: dict = {}


def encode_with_end(df: DataFrame, tokenizer_path: str, end_id: int, text: str = "text",
                    doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc_id, ids: unsigned 32-bit integers as binary) in the order of the input, and
    for each task one row that counts its ids: (counted ids, their counts, first and last
    doc_id, whether the task's doc_ids ascend)."""
    spark = df.sparkSession
    ship_package(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(batches):
        if tokenizer_path not in _encoders:
            _encoders.clear()
            _encoders[tokenizer_path] = WordPieceCache(shared.value)
        encoder = _encoders[tokenizer_path]
        counts = np.zeros(0, np.int64)
        first = last = None
        ascends = True
        for batch in batches:
            for part in slices(batch, "text"):
                flat, off = encoder.encode(part.column("text"))
                found = np.bincount(flat, minlength=end_id + 1)
                found[end_id] += part.num_rows
                if len(found) > len(counts):
                    counts = np.concatenate([counts, np.zeros(len(found) - len(counts), np.int64)])
                counts[:len(found)] += found
                ids = part.column("doc_id")
                ascends = ascends and ids.null_count == 0
                if ascends and part.num_rows:
                    own = ids.to_numpy()
                    ascends = bool((np.diff(own) > 0).all()) and (last is None or last < own[0])
                    first, last = (own[0] if first is None else first), own[-1]
                ends = np.uint32(end_id).tobytes()
                packed = [flat[a:b].tobytes() + ends for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": ids, "ids": pa.array(packed, pa.binary()), "counted": pa.nulls(len(ids), pa.binary()),
                     "first": pa.nulls(len(ids), pa.int64()), "last": pa.nulls(len(ids), pa.int64()),
                     "ascends": pa.nulls(len(ids), pa.bool_())})
        if len(counts):
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": pa.nulls(1, pa.int64()), "ids": pa.nulls(1, pa.binary()),
                 "counted": pa.array([np.stack([used, counts[used]]).astype(np.int64).tobytes()], pa.binary()),
                 "first": pa.array([first], pa.int64()), "last": pa.array([last], pa.int64()),
                 "ascends": pa.array([ascends])})

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, ids binary, counted binary, first long, last long, ascends boolean")


def frequency_ranks(tallies: DataFrame) -> np.ndarray:
    """The id of each rank, most frequent first, ties to the smaller id.

    The tallies are summed on the executors; one row for each id of the vocabulary comes to
    the driver."""
    def unpack(batches):
        for batch in batches:
            for row in batch.column("counted").to_pylist():
                ids, counts = np.frombuffer(row, np.int64).reshape(2, -1)
                yield pa.RecordBatch.from_pydict({"id": pa.array(ids), "n": pa.array(counts)})

    total = (tallies.select("counted").mapInArrow(unpack, "id long, n long")
             .groupBy("id").agg(F.sum("n").alias("n")).collect())
    return np.array([r["id"] for r in sorted(total, key=lambda r: (-r["n"], r["id"]))], np.uint32)


# --- the file format ------------------------------------------------------------------------

CONTROL_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit ranks."""
    ranks = ranks.astype("<u4")
    lens = (1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[:len(ranks)] = lens - 1
    codes = codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)
    return (np.bitwise_or.reduce(codes, axis=1).astype(np.uint8).tobytes(),
            data[np.arange(4) < lens[:, None]].tobytes())


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The first ``n`` ranks of a control and a data stream."""
    lens = CONTROL_LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(lens, dtype=np.int64) - lens
    raw = np.frombuffer(data, np.uint8)
    ranks = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        long = np.flatnonzero(lens > k)
        ranks[long] |= raw[at[long] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def file_chunks(doc_ids: list, ids: list[bytes], rank_of: np.ndarray):
    """The byte chunks of one file."""
    lens = np.array([len(x) // 4 for x in ids], "<u4")
    control, data = pack_ranks(rank_of[np.frombuffer(b"".join(ids), "<u4")])
    yield MAGIC + np.array([len(ids), int(lens.sum()), len(data)], "<u8").tobytes()
    yield np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
    yield np.array([d is None for d in doc_ids], np.uint8).tobytes()
    yield lens.tobytes()
    yield control
    yield data


def read_file(path: str, id_of: np.ndarray):
    """(doc_ids, token counts, ids) of one file."""
    with open_shared(path) as f:
        head = f.read_at(28, 0)
        if head[:4] != MAGIC:
            raise ValueError(f"{path} is no token file")
        docs, tokens, size = np.frombuffer(head[4:], "<u8").astype(int).tolist()
        index = f.read_at(13 * docs, 28)
        names = np.frombuffer(index[:8 * docs], "<i8")
        null = np.frombuffer(index[8 * docs:9 * docs], np.uint8)
        lens = np.frombuffer(index[9 * docs:], "<u4")
        n_control = -(-tokens // 4)
        control = f.read_at(n_control, 28 + 13 * docs)
        data = f.read_at(size, 28 + 13 * docs + n_control)
    return ([None if z else int(d) for d, z in zip(names, null, strict=True)], lens,
            id_of[unpack_ranks(control, data, tokens)])


# --- write and read as Spark jobs -----------------------------------------------------------

def write_token_files(df: DataFrame, tokenizer_path: str, end_id: int = 1, folder: str | None = None,
                      text: str = "text", doc_id: str = "doc_id", file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the files; returns the manifest (path, first, last, n_docs, n_tokens, ranks: the
    path of the rank table), one row a file."""
    spark = df.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    coded = write_snapshot(encode_with_end(df, tokenizer_path, end_id, text, doc_id), "token-ids")
    tallies = coded.filter("counted is not null")
    id_of = frequency_ranks(tallies)
    ranks_path = write_shared(folder, ".ranks.bin", [id_of.astype("<u4").tobytes()])
    rank_of = np.zeros(int(id_of.max()) + 1 if len(id_of) else 1, np.uint32)
    rank_of[id_of] = np.arange(len(id_of), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)  # one number for each id of the vocabulary

    spans = tallies.select("first", "last", "ascends")
    before = F.max("last").over(Window.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    clustered = spans.withColumn("before", before).filter("not ascends or before >= first").isEmpty()
    docs = coded.filter("counted is null").select("doc_id", "ids")
    if clustered:
        docs = docs.withColumn("run", F.input_file_name())
    else:
        # an id that many rows share is spread by their ids' hash, and by their row where those are equal too
        n = max(1, docs.rdd.getNumPartitions())
        order = [F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("row")]
        docs = (docs.withColumn("hash", F.xxhash64("ids")).withColumn("row", F.monotonically_increasing_id())
                .repartitionByRange(n, *order).withColumn("run", F.spark_partition_id().cast("string"))
                .sortWithinPartitions(*order).drop("hash", "row"))

    def run(batches):
        ids, names, tokens, origin = [], [], 0, None

        def flush():
            path = write_shared(folder, ".frb", file_chunks(names, ids, shared.value))
            return pa.RecordBatch.from_pydict(
                {"path": pa.array([path]), "first": pa.array([names[0]], pa.int64()),
                 "last": pa.array([names[-1]], pa.int64()), "n_docs": pa.array([len(ids)], pa.int64()),
                 "n_tokens": pa.array([tokens], pa.int64()), "ranks": pa.array([ranks_path])})

        for batch in batches:
            for name, packed, source in zip(*(batch.column(c) for c in ("doc_id", "ids", "run")), strict=True):
                source = source.as_py()
                if ids and (source != origin or tokens >= file_tokens):
                    yield flush()
                    ids, names, tokens = [], [], 0
                origin = source
                ids.append(packed.as_py())
                names.append(name.as_py())
                tokens += len(ids[-1]) // 4
        if ids:
            yield flush()

    return write_snapshot(docs.mapInArrow(
        run, "path string, first long, last long, n_docs long, n_tokens long, ranks string"), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids: unsigned 32-bit integers as binary), from the files.

    ``start`` counts the ids of all documents before; the running sum goes over the manifest,
    which has one row for each file of millions of tokens."""
    ship_package(manifest.sparkSession)
    order = Window.orderBy(F.col("first").asc_nulls_first(), F.col("last").asc_nulls_first(), "path") \
        .rowsBetween(Window.unboundedPreceding, -1)
    files = write_snapshot(
        manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(order), F.lit(0))), "token-starts")

    def run(batches):
        tables: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["ranks"] not in tables:
                    with open_shared(row["ranks"]) as f:
                        tables[row["ranks"]] = np.frombuffer(f.read_at(f.size(), 0), "<u4")
                names, lens, ids = read_file(row["path"], tables[row["ranks"]])
                ends = np.cumsum(lens, dtype=np.int64)
                begin = ends - lens
                for k in range(0, len(names), 2000):
                    packed = [ids[a:b].astype("<u4").tobytes()
                              for a, b in zip(begin[k:k + 2000].tolist(), ends[k:k + 2000].tolist(), strict=True)]
                    yield pa.RecordBatch.from_pydict(
                        {"doc_id": pa.array(names[k:k + 2000], pa.int64()),
                         "start": pa.array(row["start"] + begin[k:k + 2000]),
                         "n_tokens": pa.array(lens[k:k + 2000].astype(np.int64)),
                         "ids": pa.array(packed, pa.binary())})

    n = max(1, files.count())
    return files.repartition(min(n, 100_000), "path").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")


def op4_frequency_ranked_token_files(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Write all ``documents`` as token files with end id 1, read them back and digest the ids."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    manifest = write_token_files(docs, tokenizer_path or public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def ids_crc32(ids: list[int]) -> int:
    """The digest the query returns, for tests."""
    return zlib.crc32(np.array(ids, "<u4").tobytes())
