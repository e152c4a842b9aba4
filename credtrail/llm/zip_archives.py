"""Operator 3: WARC records in ZIP packages, read by byte ranges.

Writing: each payload becomes a WARC record (one gzip member), the records of a task go into
packages of about ``PACKAGE_BYTES``. A package is a ZIP file with stored (not compressed) members:
``archive/data.warc.gz`` and ``indexes/index.cdx``, which lists offset, length and page of each
record. Of records with equal payloads the one with the smallest page_id is a response, the others
are revisits that refer to it; payloads under ``min_bytes`` are always responses.

Reading: the end record of the ZIP file is found from its tail, then the central directory (with
its ZIP64 records and extra fields, if there are any) is parsed and gives the place of each stored
member, whose local header gives the first byte of its data. The index is read as one range and
each record as a range of its own; nothing is extracted.

Writers use new file names, and readers open what the committed manifest lists, so lost executors
and retried tasks leave no trace. Digests are found with one aggregation (one row per digest and
task is shuffled); the revisit look-up is salted over ``SALTS`` keys, so a payload that a third of
the pages share is spread.

Defined cases: null and empty payloads are records of 0 bytes; a page without page_id is a revisit
if its payload has a page with one, else a response; repeated rows of the response's page_id are
responses themselves; an empty table gives no package and no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credtrail.llm.common import open_shared, read_table, scratch_path, ship_package, write_shared, write_snapshot

PACKAGE_BYTES = 16 << 20
SALTS = 64
DATE = "2024-01-01T00:00:00Z"  # a fixed WARC-Date keeps archives reproducible
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"


# --- records --------------------------------------------------------------------------------

def digest32(sha1_hex: str) -> str:
    """The bare upper-case base32 form of a SHA-1."""
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has the payload's digest and length, not its bytes."""
    revisit = refers_to is not None
    block = b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{json.dumps(page_id)}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {clean(url)}", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Payload-Length: {len(payload)}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{json.dumps(refers_to)}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 4, mtime=0)


def clean(url: str | None) -> str:
    """A url fit for a header line."""
    return "".join(c for c in url or "" if c >= " ")


def parse_record(raw: bytes) -> tuple[dict, bytes]:
    """(headers by lower-case name, block) of one gzip member."""
    data = gzip.decompress(raw)
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    return headers, rest[:int(headers["content-length"])]


# --- packages -------------------------------------------------------------------------------

def package_bytes(records: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """A ZIP package of (index entry, record)s with stored members."""
    out = io.BytesIO()
    index, at = [], 0
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open(zipfile.ZipInfo(ARCHIVE, (2024, 1, 1, 0, 0, 0)), "w", force_zip64=zip64) as member:
            for entry, raw in records:
                member.write(raw)
                index.append(f"{at} {len(raw)} {entry}\n")
                at += len(raw)
        with z.open(zipfile.ZipInfo(INDEX, (2024, 1, 1, 0, 0, 0)), "w", force_zip64=zip64) as member:
            member.write("".join(index).encode())
    return out.getvalue()


class ZipReader:
    """Places of stored members in a seekable file with ``size()`` and ``read_at(n, offset)``."""

    END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"

    def __init__(self, file):
        self.file = file
        size = file.size()
        tail_at = max(0, size - 22 - 0xFFFF)  # the end record may be followed by a comment
        tail = file.read_at(size - tail_at, tail_at)
        at = tail.rfind(self.END)
        while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(self.END, 0, at)
        if at < 0:
            raise ValueError("no end of a central directory")
        entries, length, offset = struct.unpack_from("<HLL", tail, at + 10)
        end = tail_at + at
        if 0xFFFF == entries or 0xFFFFFFFF in (length, offset):
            locator = file.read_at(20, end - 20) if end >= 20 else b""
            if locator[:4] == self.LOCATOR64:
                at64 = struct.unpack_from("<Q", locator, 8)[0]
                record = file.read_at(56, at64)
                if record[:4] != self.END64:
                    raise ValueError("no ZIP64 end record where its locator points")
                entries, length, offset = struct.unpack_from("<QQQ", record, 32)
        self.members = dict(self._directory(file.read_at(length, offset), entries))

    def _directory(self, raw: bytes, entries: int):
        at = 0
        for _ in range(entries):
            if raw[at:at + 4] != self.ENTRY:
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", raw, at + 8)
            packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<LLHHH", raw, at + 20)
            local = struct.unpack_from("<L", raw, at + 42)[0]
            name = raw[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = raw[at + 46 + n_name:at + 46 + n_name + n_extra]
            k = 0
            while k + 4 <= len(extra):
                kind, n = struct.unpack_from("<HH", extra, k)
                if kind == 1:  # ZIP64: 8 bytes for each field that is full above, in this order
                    wide = list(struct.unpack_from(f"<{n // 8}Q", extra, k + 4))
                    plain = wide.pop(0) if plain == 0xFFFFFFFF and wide else plain
                    packed = wide.pop(0) if packed == 0xFFFFFFFF and wide else packed
                    local = wide.pop(0) if local == 0xFFFFFFFF and wide else local
                k += 4 + n
            yield name, (local, packed, method)
            at += 46 + n_name + n_extra + n_comment

    def place(self, name: str) -> tuple[int, int]:
        """(first byte, length) of a stored member's data."""
        local, length, method = self.members[name]
        if method:
            raise ValueError(f"{name} is not stored; its records can't be read by range")
        head = self.file.read_at(30, local)
        if head[:4] != self.LOCAL:
            raise ValueError(f"no local header of {name}")
        n_name, n_extra = struct.unpack_from("<HH", head, 26)
        return local + 30 + n_name + n_extra, length


def read_package(path: str):
    """(headers, block) of each record that the package's index lists, one range each."""
    with open_shared(path) as f:
        z = ZipReader(f)
        at, n = z.place(INDEX)
        index = f.read_at(n, at).decode()
        base, size = z.place(ARCHIVE)
        for line in index.splitlines():
            offset, length = map(int, line.split(" ", 2)[:2])
            if offset + length > size:
                raise ValueError(f"{path}: a record ends outside its member")
            yield parse_record(f.read_at(length, base + offset))


# --- as Spark jobs --------------------------------------------------------------------------

def assign_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with sha1 and, for revisits, the page referred to."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html")) \
        .withColumn("sha1", F.sha1(F.col("html").cast("binary"))) \
        .withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    counted = rows.filter(F.octet_length("html") >= min_bytes).groupBy("sha1").agg(
        F.count("*").alias("copies"), F.min("page_id").alias("first"))
    shared = counted.filter("copies > 1").select(
        "sha1", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return rows.join(write_snapshot(shared, "warc-shared"), ["sha1", "salt"], "left").select(
        "page_id", "url", "html", "sha1",
        F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))


def write_packages(pages: DataFrame, folder: str | None = None, min_bytes: int = 0,
                   package_bytes_limit: int = PACKAGE_BYTES, zip64: bool = False) -> DataFrame:
    """Write all pages; the manifest (path, records) of the committed packages."""
    spark = pages.sparkSession
    ship_package(spark)
    folder = folder or scratch_path(spark, "warc-zip")

    def run(batches):
        held, size = [], 0

        def flush():
            path = write_shared(folder, ".wacz", [package_bytes(held, zip64)])
            return pa.RecordBatch.from_pydict({"path": pa.array([path]), "records": pa.array([len(held)], pa.int64())})

        for batch in batches:
            for page_id, url, html, sha1, refers_to in zip(
                    *(batch.column(c) for c in ("page_id", "url", "html", "sha1", "refers_to")), strict=True):
                page_id, digest = page_id.as_py(), digest32(sha1.as_py())
                raw = record_bytes(page_id, url.as_py(), html.as_py().encode(), digest, refers_to.as_py())
                held.append((json.dumps(page_id), raw))
                size += len(raw)
                if size >= package_bytes_limit:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return write_snapshot(assign_revisits(pages, min_bytes).mapInArrow(run, "path string, records long"), "warc-manifest")


def read_packages(manifest: DataFrame) -> DataFrame:
    """Every record: page_id, url, payload_bytes, payload_digest, record_type, refers_to and, for
    responses, payload (a revisit's payload is that of the page it refers to)."""
    ship_package(manifest.sparkSession)

    def page_of(uri: str):
        return json.loads(uri.removeprefix("<urn:page:").removesuffix(">"))

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held = []
                for h, block in read_package(path):
                    revisit = h["warc-type"] == "revisit"
                    held.append({
                        "page_id": page_of(h["warc-record-id"]), "url": h["warc-target-uri"],
                        "payload_bytes": int(h["x-payload-length"]) if revisit else len(block),
                        "payload_digest": h["warc-payload-digest"].removeprefix("sha1:") if revisit
                        else digest32(hashlib.sha1(block).hexdigest()),
                        "record_type": h["warc-type"],
                        "refers_to": page_of(h["warc-refers-to"]) if revisit else None,
                        "payload": None if revisit else block})
                    if len(held) == 256:
                        yield pa.RecordBatch.from_pylist(held, KIND)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, KIND)

    n = min(max(1, manifest.count()), 100_000)
    return manifest.repartition(n, "path").mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
             "refers_to long, payload binary")


KIND = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                  ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                  ("payload", pa.binary())])


def op3_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all ``pages`` as WARC records in ZIP packages and read them back."""
    manifest = write_packages(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return read_packages(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: base32 by integer arithmetic on the digest's eight groups of 20 bits
OP3_SQL = """
WITH d AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM d GROUP BY h)
SELECT d.page_id, d.payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(d.h, 1 + 5 * (i // 4), 5))::INTEGER) >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN d.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN d.page_id = f.first THEN NULL ELSE f.first END AS refers_to
FROM d JOIN f ON f.h = d.h
"""
