"""WARC archives: round trip, ranges of any size, odd rows."""

import hashlib
import zlib

import pytest

from casona.llm import warc

ROWS = [
    (5, "http://a.b/x y\n", "<p>é" + "z" * 200, "h"), (3, None, "<p>é" + "z" * 200, "h"), (9, "u", "<p>é" + "z" * 200, "h"),
    (7, "u", None, "h"), (8, "u", "", "h"), (2, "u", "short", "h"), (1, "u", "short", "h"), (None, "u", "q" * 150, "h"),
    (None, "u", "r" * 150, "h"), (4, "u", "r" * 150, "h"), (3, None, "<p>é" + "z" * 200, "h"),
    (6, "u", "\r\n\r\nWARC/1.0\r\n\r\n" + "\x1f\x08" * 50, "h"), (10, "u", "long " * 300000, "h"),
]


def wanted(rows, url=False):
    first = {}
    for i, _, h, _ in rows:
        p = (h or "").encode()
        if i is not None:
            first[p] = min(i, first.get(p, i))
    out = []
    for i, u, h, _ in rows:
        p = (h or "").encode()
        to = first.get(p) if len(p) >= 100 and first.get(p) != i else None
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "response" if to is None else "revisit", to, None if to is not None else p))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split,file_bytes", [(64, 1), (1000, 400), (1 << 20, 1 << 20)])
def test_round_trip(spark, split, file_bytes):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string, digest string").repartition(3)
    files = warc.write(pages, file_bytes=file_bytes)
    rows = warc.read(files, split_bytes=split)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in rows.collect()]
    assert sorted(got, key=repr) == wanted(ROWS)
    assert {r.url for r in rows.collect()} == {None, "u", "http://a.b/x%20y%0A"}
    assert files.agg({"records": "sum"}).first()[0] == len(ROWS)


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.write(pages)).count() == 0


def test_only_true_members_count(tmp_path):
    """Gzip magic in other data, and members that are not WARC records, are passed over."""
    gz = lambda b: zlib.compressobj(6, zlib.DEFLATED, 31).compress(b"") + _pack(b)
    record = warc.record(1, "u", "x" * 500, hashlib.sha256(b"x" * 500).hexdigest(), 500, None)
    body = b"junk" + warc.MAGIC + b"\x00" * 30 + _pack(b"not a record") + _pack(record) + b"??" + _pack(record)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(body)
    places = [p for p, _ in warc.members(str(path), 0, len(body))]
    assert len(places) == 2
    for size in (1, 7, 50):
        cut = [p for s in range(0, len(body), size) for p, _ in warc.members(str(path), s, s + size)]
        assert cut == places
    assert gz is not None


def _pack(b):
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(b) + c.flush()
