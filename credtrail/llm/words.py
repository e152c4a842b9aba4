"""Vectorised cutting of whole texts into words and five-word shingles (numpy over the Arrow
buffers of a batch; nothing here looks at less than the whole text)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from credtrail.llm.common import text_bytes

#: [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

FOLD_ASCII = np.arange(256, dtype=np.uint8)
FOLD_ASCII[ord("A"):ord("Z") + 1] += 32

_STEP = np.uint64(0x9E3779B97F4A7C15)


def distinct_pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """The distinct byte strings among data[start:end], and each piece's index into them."""
    lens = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(lens, out=offsets[1:])
    pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = pieces.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)


def words_of(data: np.ndarray, off: np.ndarray, is_word: np.ndarray = NOT_SPACE):
    """Words are the longest runs of bytes that ``is_word`` holds, cut at row ends.

    Returns the distinct words, each word's index into them, the n + 1 row offsets into the
    words and the byte position of each word.
    """
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = off[:-1][off[:-1] < off[1:]]
    first[heads] = inside[heads]  # a row begins a word even where the row before ends in one
    starts = np.flatnonzero(first)
    kept = data[inside[:-1]]
    rank = np.cumsum(inside[:-1]) if len(data) else np.zeros(0, np.int64)
    at = rank[starts] - 1 if len(starts) else np.zeros(0, np.int64)
    distinct, index = distinct_pieces(kept, at, np.append(at[1:], len(kept)))
    return distinct, index, np.searchsorted(starts, off), starts


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), in place on a copy."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingle_rows(column: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Of each row, the 64-bit hashes of its shingles in order (repeats kept).

    A-Z are lower-cased. A text with fewer than ``size`` words has its whole sequence as one
    shingle, a text without words none. Two different shingles share a hash with probability
    2^-64.
    """
    data, off = text_bytes(column)
    distinct, index, rows, _ = words_of(FOLD_ASCII[data], off)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))[index] \
        if len(distinct) else np.zeros(0, np.uint64)
    n = max(len(hashes) - size + 1, 0)
    rolled = hashes[:n].copy()
    for k in range(1, size):
        rolled *= _STEP
        rolled += hashes[k:n + k]
    rolled = mix(rolled)
    out = []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(rolled[a:b - size + 1])
        elif b > a:
            whole = np.uint64(b - a)
            for h in hashes[a:b]:
                with np.errstate(over="ignore"):
                    whole = whole * _STEP + h
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(hashes[:0])
    return out


def shingle_sets(column: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Each row's distinct shingle hashes, sorted."""
    return [np.unique(x) for x in shingle_rows(column, size)]
