"""Operators 1 and 3: brute force, collisions, ZIP64 and odd rows."""

import base64
import hashlib
import io
import zipfile

import pytest

from credtrail.llm import url_rules, zip_archives
from credtrail.llm.common import open_shared


def brute_force(url, rules, default="allow"):
    host, path = url_rules.split_url(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (host, path, best[2] if best else None, best[3] if best else default)


URLS = [None, "", "no scheme", "http://", "https://WWW.Example.COM/en/1?x=/fr/", "http://example.com", "http://xexample.com/en/",
        "http://example.com/en/", "http://a.example.com/en/#t", "http://net/es/", "http://a.net/fr", "http://a.net/fr/q",
        "ftp://ß.com/é", "http://com/", "http://a.com?b", "x://a.com#b/", "http://..com/", "http://" + "a." * 3000 + "com/" + "p" * 9000]


def test_urls_against_brute_force(spark):
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string")
    got = {(r["page_id"]): (r["host"], r["path"], r["rule"], r["verdict"])
           for r in url_rules.judge_urls(df, url_rules.RULES).collect()}
    assert got == {i: brute_force(u, url_rules.RULES) for i, u in enumerate(URLS * 2)}


@pytest.mark.parametrize("bits", [0, 1, 64])
def test_collisions_never_decide(tmp_path, bits):
    def digest(b):
        return url_rules.xx64(b) >> (64 - bits) if bits else 7

    rules = [(f"h{i}.org", f"/{'p' * (i % 5)}", "block" if i % 2 else "allow") for i in range(60)] + [("org", "", "allow")]
    (tmp_path / "i").write_bytes(url_rules.index_bytes(rules, digest))
    index = url_rules.RuleIndex(str(tmp_path / "i"), digest)
    urls = [f"http://x.h{i}.org/{'p' * k}" for i in range(70) for k in range(6)] + URLS
    parts = [url_rules.split_url(u) for u in urls]
    for u, got in zip(urls, index.judge(parts), strict=True):
        want = brute_force(u, rules, None)
        assert (got or (None, None)) == want[2:]


def test_rules_empty_repeated_contradicting(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert url_rules.judge_urls(df, []).first()["verdict"] == "allow"
    assert url_rules.judge_urls(df.limit(0), url_rules.RULES).count() == 0
    url_rules.index_bytes([("a", "/", "block")] * 2)
    with pytest.raises(ValueError):
        url_rules.index_bytes([("a", "/", "block"), ("a", "/", "allow")])


HTML = [(5, "u5", "same"), (2, "u2", "same"), (9, None, None), (7, "u7\r\nX: y", ""), (11, "é", "é" * 50_000), (12, "u", "a\r\n\r\nWARC/1.1"),
        (2, "u2", "same"), (None, "n", "same"), (None, "n", "only here")]


@pytest.mark.parametrize("zip64,limit", [(False, 1 << 20), (True, 1 << 20), (False, 300)])
def test_records_come_back(spark, tmp_path, zip64, limit):
    df = spark.createDataFrame(HTML, "page_id long, url string, html string")
    manifest = zip_archives.write_packages(df, str(tmp_path / "w"), package_bytes_limit=limit, zip64=zip64)
    got = [(r["page_id"] is not None, r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
           for r in zip_archives.read_packages(manifest).collect()]
    first = {}
    for p, _, h in HTML:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    want = []
    for p, _, h in HTML:
        data = (h or "").encode()
        to = first.get(h or "")
        to = None if to == p else to
        want.append((p is not None, p or 0, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     "response" if to is None else "revisit", to))
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert manifest.agg({"records": "sum"}).first()[0] == len(HTML)


def test_small_payloads_are_never_revisits(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "long one"), (4, "d", "long one")],
                               "page_id long, url string, html string")
    rows = zip_archives.assign_revisits(df, min_bytes=3).collect()
    assert {r["page_id"]: r["refers_to"] for r in rows} == {1: None, 2: None, 3: None, 4: 3}
    assert zip_archives.read_packages(zip_archives.write_packages(df.limit(0))).count() == 0


def test_reader_finds_members_of_any_zip(tmp_path):
    path = tmp_path / "z.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a/é.txt", "stored é".encode())
        z.writestr("packed", b"x" * 1000, zipfile.ZIP_DEFLATED)
        with z.open("big", "w", force_zip64=True) as f:
            f.write(b"PK\5\6 in the data")
        z.comment = b"a comment with PK\5\6 in it"
    with open_shared(str(path)) as f:
        reader = zip_archives.ZipReader(f)
        for name, data in (("a/é.txt", "stored é".encode()), ("big", b"PK\5\6 in the data")):
            at, n = reader.place(name)
            assert f.read_at(n, at) == data
        with pytest.raises(ValueError):
            reader.place("packed")


class Bytes:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at:at + n]


def test_zip64_end_record_and_extra_fields(monkeypatch):
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w") as z:
        z.writestr("one", b"first")
        z.writestr("two", b"second")
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    wide = io.BytesIO()
    with zipfile.ZipFile(wide, "w") as z:
        z.writestr("one", b"first, longer than the limit")
        z.writestr("two", b"second, longer than the limit")
    assert zip_archives.ZipReader.END64 in wide.getvalue() and zip_archives.ZipReader.END64 not in plain.getvalue()
    for out, tail in ((plain, b""), (wide, b", longer than the limit")):
        f = Bytes(out.getvalue())
        reader = zip_archives.ZipReader(f)
        at, n = reader.place("two")
        assert f.read_at(n, at) == b"second" + tail
