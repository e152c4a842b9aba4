"""Operator 5: byte-level BPE encoding by forced-boundary splitting, and decoding.

Two neighbouring bytes that occur in this order inside no vocabulary token can never be joined
by a merge, so the text is certainly cut between them. All such places of a batch are found
with one table look-up per byte. The fragments are encoded independently (each distinct one
once, by the tokenizers library) and the ids concatenated.

A merge-free place is only used if the pre-tokenizer's pattern, too, gives the same pieces on
both sides of it when they are read apart:

* not inside a UTF-8 character, and not before an apostrophe (a fragment that begins with one
  could read as a contraction);
* not after white space, unless that is one white space character by itself (the pattern treats
  the last of several white space characters differently);
* strings of added tokens are fragments of their own.

Defined cases: a null or empty text has no ids and decodes to the empty text; a null id column
decodes to the empty text; other columns pass through untouched, whatever their names; repeated
rows are encoded each. Work per task is bounded by slices of the batch and a bounded cache.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credtrail.llm.common import TwoGenerationCache, read_table, ship_package, slices, text_bytes
from credtrail.llm.words import distinct_pieces

CACHE_ENTRIES = 100_000
SLICE_BYTES = 2 << 20
JOIN = 256


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def token_table(spec: dict) -> list[bytes]:
    """The bytes of every token id (an unused id: none)."""
    alphabet = byte_alphabet()
    vocab = spec["model"]["vocab"]
    added = {x["id"]: x["content"].encode() for x in spec.get("added_tokens", [])}
    table = [b""] * (max([*vocab.values(), *added]) + 1)
    for token, i in vocab.items():
        table[i] = bytes(alphabet[c] for c in token)
    for i, content in added.items():
        table[i] = content
    return table


class ForcedBoundaryEncoder:
    """Encodes batches as the tokenizers library does with the same file."""

    def __init__(self, tokenizer_json: str, cache_entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" \
                or pre.get("add_prefix_space") or not pre.get("use_regex"):
            raise ValueError("forced boundaries are proven for byte-level BPE with its own pattern only")
        if any(x[k] for x in spec.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.table = token_table(spec)
        self.lengths = np.array([len(x) for x in self.table])
        inside = np.zeros(65536, bool)
        for i in spec["model"]["vocab"].values():
            b = np.frombuffer(self.table[i], np.uint8)
            inside[(b[:-1].astype(np.uint16) << 8) | b[1:]] = True
        self.never = ~inside
        added = sorted((x["content"] for x in spec.get("added_tokens", [])), key=len, reverse=True)
        self.added = re.compile(b"|".join(re.escape(x.encode()) for x in added)) if added else None
        self.space = np.zeros(256, bool)
        self.space[:0x21] = True
        self.head = np.ones(256, bool)  # bytes that may begin a fragment
        self.head[0x80:0xC0] = False
        self.head[ord("'")] = False
        self.solid = self.head.copy()  # ... and certainly begin no white space
        self.solid[:0x21] = False
        self.solid[[0xC2, 0xE1, 0xE2, 0xE3]] = False
        self.cache = TwoGenerationCache(cache_entries, self._encode)

    def cuts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Byte positions where fragments begin, row starts among them."""
        n = len(data)
        begin = np.zeros(n + 1, bool)
        if n > 1:
            a, b = data[:-1], data[1:]
            may_be_space = self.space[data]
            may_be_space[1:] |= data[:-1] == 0xC2
            may_be_space[2:] |= (data[:-2] >= 0xE1) & (data[:-2] <= 0xE3)
            lone = self.space[a] & self.solid[b]
            lone[1:] &= ~may_be_space[:n - 2]
            begin[1:n] = self.never[(a.astype(np.uint16) << 8) | b] & self.head[b] & (~may_be_space[:-1] | lone)
        if self.added is not None:
            for m in self.added.finditer(data):
                row = int(np.searchsorted(off, m.start(), side="right")) - 1
                if m.end() <= off[row + 1]:
                    begin[m.start() + 1:m.end()] = False
                    begin[[m.start(), m.end()]] = True
        begin[off] = True
        begin[n] = False
        return np.flatnonzero(begin)

    def _encode(self, fragments: list[bytes]) -> list[bytes]:
        """The ids of each fragment, as bytes of unsigned 32-bit integers.

        Fragments from a space to a plain byte are joined for one library call: the places
        between them are forced boundaries themselves.
        """
        out: list = [None] * len(fragments)
        chain, alone = [], []
        for i, f in enumerate(fragments):
            last = f[-1]
            plain = 0x20 < last < 0x7F and self.never[(last << 8) | 0x20] and len(f) < 64 and not (
                self.added and self.added.search(f))
            (chain if f[0] == 0x20 and plain else alone).append(i)
        groups = [chain[k:k + JOIN] for k in range(0, len(chain), JOIN)] + [[i] for i in alone]
        texts = [b"".join([fragments[i] for i in g]).decode() for g in groups]
        for at in range(0, len(groups), 512):
            for g, e in zip(groups[at:at + 512],
                            self.tokenizer.encode_batch_fast(texts[at:at + 512], add_special_tokens=False),
                            strict=True):
                ids = np.array(e.ids, np.uint32)
                if len(g) == 1:
                    out[g[0]] = ids.tobytes()
                    continue
                ends = np.cumsum(self.lengths[ids])
                last = np.searchsorted(ends, np.cumsum([len(fragments[i]) for i in g]), side="left") + 1
                first = 0
                for i, k in zip(g, last.tolist(), strict=True):
                    out[i] = ids[first:k].tobytes()
                    first = k
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows one after the other, and the n + 1 row offsets into them."""
        data, off = text_bytes(column)
        starts = self.cuts(data, off)
        distinct, index = distinct_pieces(data, starts, np.append(starts[1:], len(data)))
        flat, ends = expand(self.cache.values_of(distinct), np.uint32, index)
        return flat, ends[np.searchsorted(starts, off)]


def expand(values: list[bytes], dtype, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values[index[0]], values[index[1]], ... as one array, and the offsets of each."""
    size = np.dtype(dtype).itemsize
    lens = np.fromiter(map(len, values), np.int64, len(values)) // size
    pool = np.frombuffer(b"".join(values), dtype)
    begin = np.cumsum(lens) - lens
    take = lens[index]
    ends = np.zeros(len(index) + 1, np.int64)
    np.cumsum(take, out=ends[1:])
    return pool[np.repeat(begin[index] - ends[:-1], take) + np.arange(ends[-1])], ends


_encoders: dict = {}


def _encoder(name: str, shared) -> ForcedBoundaryEncoder:
    """One encoder (and cache) for a Python worker, kept while tasks use the same file."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = ForcedBoundaryEncoder(shared.value)
    return _encoders[name]


def _share(spark: SparkSession, path: str):
    """The tokenizer file as a broadcast: one vocabulary, a few MB whatever the input."""
    ship_package(spark)
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _ids_array(flat: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(flat.view(np.int32)))


def _texts(rows, table: list[bytes]) -> pa.Array:
    """The text of each list of ids: ids outside the vocabulary give nothing, bytes that aren't
    UTF-8 give U+FFFD, as in the library."""
    size = len(table)
    return pa.array([b"".join([table[i] for i in (row or ()) if i is not None and 0 <= i < size])
                     .decode("utf-8", "replace") for row in rows], pa.string())


def encode_texts(df: DataFrame, tokenizer_path: str, text: str = "text", ids: str = "ids",
                 decoded: str | None = None) -> DataFrame:
    """``df`` with the token ids of ``text`` (array<int>) in place of the text; with ``decoded``
    also the text that these ids decode to, in the same pass."""
    shared = _share(df.sparkSession, tokenizer_path)
    keep = [f for f in df.schema.fields if f.name not in (text, ids, decoded)]
    names = [f.name for f in keep]
    more = [decoded] if decoded else []

    def run(batches):
        encoder = _encoder(tokenizer_path, shared)
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                flat, off = encoder.encode(part.column(text))
                values = _ids_array(flat, off)
                texts = [_texts(_rows(values), encoder.table)] if decoded else []
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), values, *texts],
                                                 [*names, ids, *more])

    schema = T.StructType([*keep, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False),
                           *[T.StructField(c, T.StringType()) for c in more]])
    return df.select(*names, text).mapInArrow(run, schema)


def decode_ids(df: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids`` added; special tokens are kept."""
    shared = _share(df.sparkSession, tokenizer_path)
    keep = [f for f in df.schema.fields if f.name != text]
    names = [f.name for f in keep]

    def run(batches):
        table = token_table(json.loads(shared.value))
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), _texts(_rows(part.column(ids)), table)], [*names, text])

    return df.select(*names).mapInArrow(run, T.StructType([*keep, T.StructField(text, T.StringType())]))


def _rows(column):
    """The rows of a list column as Python lists, one at a time."""
    if column.null_count or column.values.null_count:
        yield from (row.as_py() for row in column)
        return
    values = column.values.to_numpy()
    off = column.offsets.to_numpy()
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        yield values[a:b].tolist()


def op5_bpe_forced_boundary(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Encode and decode every whole text of ``documents``; digests of the ids and the text."""
    import public_tokenizers

    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encode_texts(docs, path, decoded="decoded"))


def digests(decoded: DataFrame) -> DataFrame:
    """The digest columns of encoded and decoded documents."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
