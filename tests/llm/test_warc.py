"""WARC archives: exact round trips, revisits and broken files."""

import gzip
import hashlib
import io

import pytest

from tessera.llm import warc
from tessera.llm.common import scratch


def _member(key="1", payload=b"<html>x</html>", refers=None, uri="http://a/"):
    digest = hashlib.sha256(payload).hexdigest()
    return warc.gzip_member(warc.record_bytes(key, uri, payload, digest, len(payload), refers))


def test_one_member_per_record_and_offsets():
    members = [_member(str(i), bytes([i]) * (i * 70_000)) for i in range(6)]
    got = list(warc.read_records(io.BytesIO(b"".join(members))))
    assert [r.payload for r in got] == [bytes([i]) * (i * 70_000) for i in range(6)]
    assert [r.offset for r in got] == [sum(map(len, members[:i])) for i in range(6)]
    assert all(gzip.decompress(m).startswith(b"WARC/1.1\r\n") for m in members)


def test_reads_through_tiny_chunks(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    data = b"".join(_member(str(i), b"body\r\n\r\nbody" * i) for i in range(5))
    assert [r.payload for r in warc.read_records(io.BytesIO(data))] == [b"body\r\n\r\nbody" * i for i in range(5)]


@pytest.mark.parametrize("damage", ["cut", "digest", "length", "junk", "two"])
def test_broken_records_are_refused(damage):
    raw = gzip.decompress(_member())
    data = {"cut": _member()[:-20], "digest": warc.gzip_member(raw.replace(b"<html>x", b"<html>y")),
            "length": warc.gzip_member(raw.replace(b"<html>x", b"<html>xx")), "junk": warc.gzip_member(b"junk\r\n\r\n"),
            "two": warc.gzip_member(raw + raw)}[damage]
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(data)))


def test_keys_survive():
    for key in (None, "", "null", "a b<>/é", "12"):
        assert warc.key_of(warc.record_id(key)) == key


def _pages(spark, rows, extra=", payload string, digest string"):
    return spark.createDataFrame([(*r, "p", "d") for r in rows], "page_id long, url string, html string" + extra)


def _archive(spark, df, **how):
    folder = scratch(spark, "warc-test")
    files = warc.write_archives(df, folder, **how)
    return files, warc.read_archives(files, folder)


def test_round_trip_with_revisits(spark):
    big, other = "b" * 100, "ü" * 50  # 100 bytes each
    rows = [(3, "http://x/ y\r\nZ", big), (2, None, big), (7, "u", big), (None, "n", big), (4, "v", other), (9, "w", other),
            (5, "s", "small"), (6, "t", "small"), (8, "e", None), (10, "f", ""), (11, "g", "long " * 200_000),
            (4, "v2", other), (None, "o", "only null ids" * 20), (None, "o", "only null ids" * 20)]
    files, records = _archive(spark, _pages(spark, rows), file_bytes=2000)
    assert files.count() > 1 and files.agg({"records": "sum"}).first()[0] == len(rows)
    first = {}
    for k, _, h in rows:
        if k is not None:
            first[h or ""] = min(first.get(h or "", k), k)
    want = []
    for k, _, h in rows:
        b = (h or "").encode()
        revisit = len(b) >= 100 and (h or "") in first and first[h or ""] != k
        want.append((None if k is None else str(k), len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response",
                     str(first[h or ""]) if revisit else None))
    got = [(r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.resolve_revisits(records).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    by_key = {r.key: r for r in records.collect()}
    assert by_key["3"].uri == "http://x/ y\r\nZ" and by_key["2"].uri is None and by_key["7"].payload is None
    assert bytes(by_key["11"].payload) == b"long " * 200_000


def test_empty_table(spark):
    files, records = _archive(spark, _pages(spark, []))
    assert files.count() == 0 and records.collect() == [] and warc.resolve_revisits(records).collect() == []


def test_long_urls(spark):
    """A percent-encoded URL of over 2 MB in the header, beside a short one."""
    long = "http://a/" + "ü" * 350_000
    files, read = _archive(spark, _pages(spark, [(1, long, "x" * 200), (2, "http://b/", "y"), (3, long, "x" * 200)]))
    assert {r.key: r.uri for r in read.collect()} == {"1": long, "2": "http://b/", "3": long}
    assert files.agg({"head": "max"}).first()[0] > 2_000_000


def test_header_limit_does_not_hang_on_chunks(monkeypatch):
    data = _member(uri="http://a/" + "x" * 50_000)
    for chunk in (64, 4096, 1 << 18):
        monkeypatch.setattr(warc, "CHUNK", chunk)
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(data), 40_000))
        assert len(list(warc.read_records(io.BytesIO(data), warc.head_bytes(gzip.decompress(data))))) == 1
