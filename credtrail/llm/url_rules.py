"""Operator 1: URL rules in a sorted digest array.

The rules' keys are 64-bit xxhash values in one sorted array, in a file that every executor maps
into memory. A batch of look-ups is one vectorised binary search; a found digest only counts once
the rule's stored full string equals the key, so collisions never decide. Two arrays are kept:
the hosts that have rules, with the lengths of their rules' paths, and host + path of each rule.
A url is looked up by each suffix of its host at a label boundary, and only where such a host has
rules by the path's beginnings of the lengths that occur there.

A rule (host, path, verdict) fits its host and all subdomains if the url's path starts with the
rule's path. The longest rule wins (host and path together; of equal length, the longer host).
Without a fitting rule the verdict is ``default``.

The index file is written once into the shared folder and sent to the executors as a file (disk,
not heap); it is opened by ``numpy.memmap``, so only the touched pages are read.

Defined cases: a null url and one without ``://`` have empty host and path and take the default;
an empty path fits only rules with an empty path. A rule given twice with one verdict counts once;
with two verdicts it is an error. Null hosts or paths of rules count as empty. Without rules
everything takes the default. Columns named like the results are replaced.
"""

from __future__ import annotations

import io
import os
import uuid
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from credtrail.llm.common import read_table, scratch_path, ship_package, write_shared

Rule = tuple[str, str, str]
RESULTS = ("host", "path", "rule", "verdict")
MAGIC = b"DIGA0001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: the rules of the registered query
RULES: list[Rule] = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def xx64(key: bytes) -> int:
    return xxhash.xxh64_intdigest(key)


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) of a url; A-Z of the host are lower-cased."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3:]
    ends = [i for i in map(rest.find, "/?#") if i >= 0]
    cut = min(ends, default=len(rest))
    path = rest[cut:]
    stop = min([i for i in map(path.find, "?#") if i >= 0], default=len(path))
    return rest[:cut].translate(LOWER), path[:stop]


# --- the digest array -----------------------------------------------------------------------

def _section(strings: list[bytes], payload: list[bytes], digest: Callable[[bytes], int]):
    keys = np.array([digest(s) for s in strings], np.uint64)
    order = np.argsort(keys, kind="stable")
    body = [strings[i] for i in order]
    extra = [payload[i] for i in order]
    return (keys[order], np.cumsum([0, *map(len, body)]).astype(np.uint64), b"".join(body),
            np.cumsum([0, *map(len, extra)]).astype(np.uint64), b"".join(extra))


def index_bytes(rules: Iterable[Rule], digest: Callable[[bytes], int] = xx64) -> bytes:
    """The index file of ``rules``: hosts -> path lengths, and host + path -> verdict."""
    verdicts: dict[tuple[str, str], str] = {}
    for host, path, verdict in rules:
        key = ((host or "").translate(LOWER), path or "")
        if verdicts.setdefault(key, verdict) != verdict:
            raise ValueError(f"rule {key[0]}{key[1]} has two verdicts")
    lengths: dict[str, set[int]] = {}
    for host, path in verdicts:
        lengths.setdefault(host, set()).add(len(path))
    parts = [
        _section([h.encode() for h in lengths],
                 [np.array(sorted(x), "<u4").tobytes() for x in lengths.values()], digest),
        _section([f"{h}\0{p}".encode() for h, p in verdicts], [v.encode() for v in verdicts.values()], digest)]
    out = io.BytesIO()
    out.write(MAGIC)
    for keys, off, body, extra_off, extra in parts:
        out.write(np.array([len(keys), len(body), len(extra)], "<u8").tobytes())
        out.write(keys.astype("<u8").tobytes() + off.astype("<u8").tobytes() + extra_off.astype("<u8").tobytes())
        for blob in (body, extra):
            out.write(blob + b"\0" * (-len(blob) % 8))
    return out.getvalue()


class DigestArray:
    """One section of a mapped index file: digests, stored strings and their payloads."""

    def __init__(self, mapped: np.ndarray, at: int):
        def take(n, kind):
            nonlocal at
            view = mapped[at:at + n * np.dtype(kind).itemsize].view(kind)
            at += n * np.dtype(kind).itemsize
            return view

        n, body, extra = take(3, "<u8").astype(int).tolist()
        self.keys, self.off, self.extra_off = take(n, "<u8"), take(n + 1, "<u8"), take(n + 1, "<u8")
        self.body = take(body, np.uint8)
        at += -body % 8
        self.extra = take(extra, np.uint8)
        at += -extra % 8
        self.end = at

    def find(self, strings: list[bytes], digest: Callable[[bytes], int]) -> np.ndarray:
        """Of each string its position, or -1: binary search by digest, then the stored strings
        of that digest are compared in full."""
        out = np.full(len(strings), -1, np.int64)
        if not len(strings) or not len(self.keys):
            return out
        wanted = np.fromiter(map(digest, strings), np.uint64, len(strings))
        at = np.searchsorted(self.keys, wanted)
        hit = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == wanted)
        for i in hit.tolist():
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == wanted[i]:
                if self.body[int(self.off[k]):int(self.off[k + 1])].tobytes() == strings[i]:
                    out[i] = k
                    break
                k += 1
        return out

    def payload(self, k: int) -> bytes:
        return self.extra[int(self.extra_off[k]):int(self.extra_off[k + 1])].tobytes()


class RuleIndex:
    """A memory-mapped index file."""

    def __init__(self, path: str, digest: Callable[[bytes], int] = xx64):
        mapped = np.memmap(path, np.uint8, "r")
        if mapped[:8].tobytes() != MAGIC:
            raise ValueError(f"{path} is no digest array")
        self.digest = digest
        self.hosts = DigestArray(mapped, 8)
        self.rules = DigestArray(mapped, self.hosts.end)

    def judge(self, urls: list[tuple[str, str]]) -> list[tuple[str, str] | None]:
        """Of each (host, path) the (rule string, verdict) of the longest fitting rule."""
        suffixes: dict[str, list[str]] = {}
        for host, _ in urls:
            if host not in suffixes:
                labels = host.split(".")
                suffixes[host] = [".".join(labels[i:]) for i in range(len(labels))]
        names = sorted({s for x in suffixes.values() for s in x})
        known = {}
        for name, k in zip(names, self.hosts.find([n.encode() for n in names], self.digest).tolist(), strict=True):
            if k >= 0:
                known[name] = np.frombuffer(self.hosts.payload(k), "<u4").tolist()
        tries = sorted({(s, path[:n]) for host, path in urls for s in suffixes[host] if s in known
                        for n in known[s] if n <= len(path)})
        keys = [f"{s}\0{p}".encode() for s, p in tries]
        verdicts = {t: self.rules.payload(k).decode()
                    for t, k in zip(tries, self.rules.find(keys, self.digest).tolist(), strict=True) if k >= 0}
        out: list = []
        for host, path in urls:
            fits = [(len(s) + n, len(s), s, path[:n]) for s in suffixes[host] if s in known
                    for n in known[s] if n <= len(path) and (s, path[:n]) in verdicts]
            _, _, s, p = max(fits, default=(0, 0, None, None))
            out.append(None if s is None else (s + p, verdicts[s, p]))
        return out


# --- as a Spark job -------------------------------------------------------------------------

def publish(spark: SparkSession, rules: Iterable[Rule]) -> str:
    """Write the index into the shared folder and send it to the executors; its file name."""
    folder = scratch_path(spark, "url-rules")
    path = write_shared(folder, f"-{uuid.uuid4().hex[:8]}.digests", [index_bytes(rules)])
    spark.sparkContext.addFile(path if "://" in path else f"file://{path}")
    return os.path.basename(path)


def judge_urls(df: DataFrame, rules: Iterable[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with host, path, rule and verdict of its urls."""
    spark = df.sparkSession
    ship_package(spark)
    name = publish(spark, rules)
    keep = [f for f in df.schema.fields if f.name not in RESULTS]
    names = [f.name for f in keep]

    def run(batches):
        index = RuleIndex(SparkFiles.get(name))
        for batch in batches:
            parts = [split_url(u) for u in batch.column(url).to_pylist()]
            distinct = sorted(set(parts))
            of = dict(zip(distinct, index.judge(distinct), strict=True))
            best = [of[p] for p in parts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names),
                 pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string()),
                 pa.array([b[0] if b else None for b in best], pa.string()),
                 pa.array([b[1] if b else default for b in best], pa.string())], [*names, *RESULTS])

    return df.mapInArrow(run, T.StructType([*keep, *(T.StructField(c, T.StringType()) for c in RESULTS)]))


def op1_url_digest_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge the url of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, RULES).select("page_id", *RESULTS)


OP1_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
p AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
rules(h, q, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
f AS (SELECT page_id, h || q AS rule, v, row_number() OVER (
    PARTITION BY page_id ORDER BY length(h || q) DESC, length(h) DESC) AS k
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q))
SELECT p.page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(v, 'allow') AS verdict
FROM p LEFT JOIN f ON f.page_id = p.page_id AND f.k = 1
"""
