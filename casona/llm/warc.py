"""WARC archives: one gzip member a record, written by tasks and read in byte ranges.

A reader of a range looks for the gzip magic, takes a place for a member only if what it
decodes begins with a WARC version line, and owns the records that start inside its range; the
last one may end beyond it. From a member's end the next one follows without a search.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casona.llm.files import new_file, new_folder, opened, partition
from casona.session import stored

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
FILE_BYTES = 256 << 20
SPLIT_BYTES = 8 << 20
READ_BYTES = 256 << 10
LEVEL = 5
LEAST_SHARED = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def write(
    pages: DataFrame, label: str = "warc", id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_shared: int = LEAST_SHARED, file_bytes: int = FILE_BYTES, level: int = LEVEL,
) -> DataFrame:
    """Write a record for each page and return the archives as (path, bytes, records).

    The payload is the html in UTF-8, empty if null. Of equal payloads of ``least_shared`` bytes or
    more, the one with the smallest id is a response and the others are revisits of it; rows that
    repeat that id are responses too, and so is a null id if there is no other. A null url gives
    no target; spaces and controls in one are percent-encoded. No pages give no archives.

    Only digests are grouped, and those held once drop out before the join, so a payload that a
    third of all pages share is one row on the joined side.
    """
    folder = new_folder(pages.sparkSession, label)
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"), payload.alias("html"),
        F.sha2(payload.cast("binary"), 256).alias("digest"), F.octet_length(payload).alias("bytes"))
    firsts = (
        rows.filter(F.col("bytes") >= least_shared).groupBy("digest")
        .agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL").drop("n")
    )
    marked = rows.join(firsts, "digest", "left").withColumn("refers", F.expr("CASE WHEN id IS DISTINCT FROM first THEN first END"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = partition()
        todo = (row for batch in batches for row in batch.to_pylist())
        row, number = next(todo, None), 0
        while row is not None:
            path, size, count = f"{folder}/part-{part:05d}-{number:03d}.warc.gz", 0, 0
            with new_file(path) as out:
                while row is not None and (not count or size < file_bytes):
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = packer.compress(record(**row)) + packer.flush()
                    out.write(member)
                    size, count, row = size + len(member), count + 1, next(todo, None)
            number += 1
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [count]})

    sent = marked.select("id", "url", F.when(F.col("refers").isNull(), F.col("html")).alias("html"), "digest", "bytes", "refers")
    return stored(sent.mapInArrow(archive, "path string, bytes bigint, records bigint"), f"{label}-files")


def record(id: int | None, url: str | None, html: str | None, digest: str, bytes: int, refers: int | None) -> bytes:
    """One WARC record; html is None for a revisit, which holds the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {bytes}\r\n\r\n".encode()
    block = http + (html or "").encode()
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: {name(id)}",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers is not None:
        head += [f"WARC-Refers-To: {name(refers)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


SCHEMA = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"
)


def read(archives: DataFrame, with_payload: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of the archives (path, bytes), each file cut into ranges of ``split_bytes`` read by separate tasks.

    (page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload). Size and digest
    of a response are computed from the payload that was read, and a digest that differs from the
    record's own fails the task; those of a revisit come from its headers, and its payload is null.
    Empty files give no records; bytes between members that do not decode are passed over.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("bigint")))
    ranges = archives.filter("bytes > 0").select("path", starts.alias("start"))
    # tiny rows that stand for much work: dealt out one by one
    number = archives.filter("bytes > 0").agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    spread = ranges.repartition(int(number))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows, held = [], 0
                for _, raw in members(row["path"], row["start"], row["start"] + split_bytes):
                    rows.append(parsed(raw, with_payload))
                    held += len(raw)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    return spread.mapInArrow(scan, SCHEMA)


ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])


def members(path: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(place, decoded bytes) of the records that start in [start, end)."""
    with opened(path) as f:
        place, last = start, f.size()
        while place < min(end, last):
            f.seek(place)
            window = f.read(READ_BYTES)
            found = window.find(MAGIC)
            if found < 0:
                place += max(1, len(window) - len(MAGIC) + 1)
                continue
            place += found
            if place >= end:
                return
            member = _decoded(f, place)
            if member is None:
                place += 1
                continue
            yield place, member[0]
            place += member[1]


def _decoded(f, place: int) -> tuple[bytes, int] | None:
    """(decoded bytes, encoded length) of the WARC record at ``place``, or None if there is none."""
    f.seek(place)
    decoder, out, size, read = zlib.decompressobj(31), [], 0, 4096
    begun = b""
    while not decoder.eof:
        chunk = f.read(read)
        if not chunk:
            return None
        try:
            out.append(decoder.decompress(chunk))
        except zlib.error:
            return None
        size += len(chunk)
        if len(begun) < len(VERSION):
            begun += out[-1][: len(VERSION)]
            if not begun.startswith(VERSION[: len(begun)]):
                return None
        read = READ_BYTES
    return b"".join(out), size - len(decoder.unused_data)


def parsed(raw: bytes, with_payload: bool) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    number = lambda text: int(m[1]) if text and (m := re.fullmatch(r"<urn:page:(-?\d+)>", text)) else None
    revisit = fields["WARC-Type"] == "revisit"
    if revisit:
        size = int(re.search(rb"(?i)^content-length: (\d+)", http, re.M)[1])
    else:
        size, own = len(payload), hashlib.sha256(payload).hexdigest()
        if own != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} has digest {own}, its record says {digest}")
    return {
        "page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "refers_to": number(fields.get("WARC-Refers-To")), "payload_bytes": size, "payload_digest": digest,
        "payload": payload if with_payload and not revisit else None,
    }
