"""Token ids in wavelet matrix files: access, counting and occurrence lookup from one compressed file.

A shard's distinct ids are numbered densely. The matrix holds one plane of bits for each bit of
these numbers, highest first; below a plane the tokens are ordered by its bit, zeros before ones,
each in the order they had. A directory counts the ones before every 512 bits of a plane.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from casona.llm.files import new_file, new_folder, opened, partition
from casona.llm.tokens import encoded
from casona.session import stored

MAGIC = b"WAVELET1"
SHARD_TOKENS = 1 << 21
#: Pieces of text whose ids a worker remembers, at most.
PIECES = 1 << 21
BLOCK = 512
_zstd = pa.Codec("zstd", compression_level=1)


def build(ids: np.ndarray) -> dict[str, np.ndarray]:
    """Sections of a shard: alphabet, planes of packed bits (lowest bit first), directories and counts of zeros."""
    size = int(ids.max()) + 1 if len(ids) else 0
    seen = np.zeros(size, bool)
    seen[ids] = True
    alphabet = np.flatnonzero(seen).astype(np.uint32)
    levels = max(1, int(len(alphabet) - 1).bit_length()) if len(alphabet) else 0
    number = np.zeros(size, np.uint16 if levels <= 16 else np.uint32)
    number[alphabet] = np.arange(len(alphabet))
    row = number[ids]
    out: dict[str, np.ndarray] = {"alphabet": alphabet}
    zeros = []
    for level in range(levels):
        bit = (row >> (levels - 1 - level)) & 1
        padded = np.packbits(bit.astype(np.uint8), bitorder="little")
        padded = np.concatenate([padded, np.zeros(-len(padded) % (BLOCK // 8), np.uint8)])
        ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
        out[f"plane{level}"] = padded
        out[f"rank{level}"] = np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)
        low, high = row[np.flatnonzero(bit == 0)], row[np.flatnonzero(bit)]
        zeros.append(len(low))
        row = np.concatenate([low, high])
    out["zeros"] = np.array(zeros, np.uint32)
    return out


def dump(out, docs: np.ndarray, known: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> int:
    """Write one shard to a stream; returns its bytes. Documents' ids, whether they are known, and sizes go with it."""
    sections = {"docs": docs.astype(np.int64), "known": known.astype(np.uint8), "sizes": sizes.astype(np.uint64), **build(ids)}
    packed, index, at = [], {}, 0
    for name, values in sections.items():
        raw = np.ascontiguousarray(values).tobytes()
        small = _zstd.compress(raw, asbytes=True)
        index[name] = [at, len(small), len(raw), values.dtype.str, zlib.crc32(small)]
        packed.append(small)
        at += len(small)
    head = json.dumps({"tokens": len(ids), "levels": sum(n.startswith("plane") for n in sections), "sections": index}).encode()
    body = b"".join(packed)
    out.write(MAGIC + struct.pack("<II", len(head), zlib.crc32(head)) + head + body)
    return len(MAGIC) + 8 + len(head) + at


class Shard:
    """A shard over an open file; sections are read when first needed."""

    def __init__(self, f):
        self.file = f
        f.seek(0)
        start = f.read(len(MAGIC) + 8)
        if start[: len(MAGIC)] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        size, crc = struct.unpack("<II", start[len(MAGIC):])
        head = f.read(size)
        if zlib.crc32(head) != crc:
            raise ValueError("the head of a wavelet matrix file is damaged")
        head = json.loads(head)
        self.tokens, self.levels, self.index = head["tokens"], head["levels"], head["sections"]
        self.body = len(start) + size
        self._read: dict[str, np.ndarray] = {}

    def section(self, name: str) -> np.ndarray:
        if name not in self._read:
            at, small, raw, kind, crc = self.index[name]
            self.file.seek(self.body + at)
            packed = self.file.read(small)
            if zlib.crc32(packed) != crc:
                raise ValueError(f"section {name} of a wavelet matrix file is damaged")
            self._read[name] = np.frombuffer(_zstd.decompress(packed, raw), kind)
        return self._read[name]

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a plane before each place."""
        words = self.section(f"plane{level}").view(np.uint64)
        block, inside = at // BLOCK, at % BLOCK
        got = self.section(f"rank{level}")[block].astype(np.int64)
        for w in range(BLOCK // 64):
            n = np.clip(inside - 64 * w, 0, 64).astype(np.uint64)
            word = words[np.minimum(block * (BLOCK // 64) + w, len(words) - 1)]
            mask = np.where(n == 64, np.uint64(2**64 - 1), (np.uint64(1) << (n & np.uint64(63))) - np.uint64(1))
            got += np.bitwise_count(word & mask)
        return got

    def access(self, at) -> np.ndarray:
        """Token ids at the places."""
        at = np.atleast_1d(np.asarray(at, np.int64))
        number = np.zeros(len(at), np.int64)
        for level in range(self.levels):
            plane = self.section(f"plane{level}")
            bit = (plane[at // 8] >> (at % 8).astype(np.uint8)) & 1
            ones = self._ones(level, at)
            at = np.where(bit == 1, int(self.section("zeros")[level]) + ones, at - ones)
            number = number * 2 + bit
        return self.section("alphabet")[number]

    def _code(self, token: int) -> int | None:
        alphabet = self.section("alphabet")
        k = int(np.searchsorted(alphabet, token))
        return k if k < len(alphabet) and alphabet[k] == token else None

    def _span(self, code: int, start: int, end: int) -> tuple[int, int]:
        for level in range(self.levels):
            ones = self._ones(level, np.array([start, end]))
            if code >> (self.levels - 1 - level) & 1:
                start, end = (int(self.section("zeros")[level]) + ones).tolist()
            else:
                start, end = start - int(ones[0]), end - int(ones[1])
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token in [start, end)."""
        code = self._code(token)
        if code is None:
            return 0
        a, b = self._span(code, start, self.tokens if end is None else end)
        return b - a

    def select(self, token: int, k: int) -> int | None:
        """Place of occurrence ``k``, from 0; None if there are not as many."""
        code = self._code(token)
        if code is None or not 0 <= k < self.count(token):
            return None
        at = self._span(code, 0, 0)[0] + k
        for level in reversed(range(self.levels)):
            bit = code >> (self.levels - 1 - level) & 1
            want = at - int(self.section("zeros")[level]) if bit else at
            rank = self.section(f"rank{level}").astype(np.int64)
            before = rank if bit else np.arange(len(rank)) * BLOCK - rank
            block = int(np.searchsorted(before, want, "right")) - 1
            bits = np.unpackbits(self.section(f"plane{level}")[block * BLOCK // 8:(block + 1) * BLOCK // 8], bitorder="little")
            at = block * BLOCK + int(np.flatnonzero(bits == bit)[want - int(before[block])])
        return at

    def ids(self) -> np.ndarray:
        """All tokens in order: the order below each plane undone, from the lowest plane up."""
        row = np.zeros(self.tokens, np.uint16 if self.levels <= 16 else np.uint32)
        for level in reversed(range(self.levels)):
            bit = np.unpackbits(self.section(f"plane{level}"), count=self.tokens, bitorder="little")
            zeros = int(self.section("zeros")[level])
            above = np.empty_like(row)
            above[np.flatnonzero(bit == 0)] = row[:zeros]
            above[np.flatnonzero(bit)] = row[zeros:]
            row = above | (bit.astype(row.dtype) << (self.levels - 1 - level))
        return self.section("alphabet")[row] if self.tokens else np.empty(0, np.uint32)


def write(
    docs: DataFrame, tokenizer: str, end_id: int = 1, label: str = "wavelet", shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write the ids of all documents in ascending id order; (path, part, number, docs, tokens) of the files.

    A document is its text's ids and ``end_id``; a null or empty text has only that id. Null ids
    come first; rows that repeat an id follow each other by text. A shard ends with the document
    that reaches ``shard_tokens``. No documents give no files.

    Documents are range partitioned by id and sorted inside, so parts follow each other.
    """
    folder = new_folder(docs.sparkSession, label)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = partition(), 0
        ids: list[np.ndarray] = []
        docs: list[np.ndarray] = []
        known: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal number
            path = f"{folder}/part-{part:05d}-{number:04d}.wavelet"
            size = np.concatenate(sizes)
            with new_file(path) as out:
                dump(out, np.concatenate(docs), np.concatenate(known), size, np.concatenate(ids))
            row = {"path": [path], "part": [part], "number": [number], "docs": [len(size)], "tokens": [int(size.sum())]}
            number += 1
            for x in (ids, docs, known, sizes):
                x.clear()
            return pa.RecordBatch.from_pydict(row)

        held = 0
        for batch in batches:
            names = batch.column(0)
            valid = names.is_valid().to_numpy(zero_copy_only=False)
            names = names.fill_null(0).to_numpy()
            for first, out, places in encoded(batch.column(1), tokenizer, end_id, PIECES):
                n = len(places) - 1
                ids.append(out)
                docs.append(names[first:first + n])
                known.append(valid[first:first + n])
                sizes.append(np.diff(places))
                held += len(out)
                if held >= shard_tokens:
                    yield close()
                    held = 0
        if sizes:
            yield close()

    # a digest of the text splits rows of one id, as those without one
    ordered = rows.withColumn("digest", F.xxhash64("text")).repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest", "text").drop("digest")
    return stored(ordered.mapInArrow(shards, "path string, part bigint, number bigint, docs bigint, tokens bigint"), f"{label}-files")


def read(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, decoded from the files; start counts all ids before it."""
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy(F.col("part").alias("p")).agg(F.sum("tokens").alias("n")).withColumn(
        "ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    placed = files.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(parts, F.col("part") == F.col("p"))
    todo = placed.select("path", (F.col("ahead") + F.col("inside")).alias("start")).repartition(max(1, files.count()))
    kinds = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
        *([("ids", pa.binary())] if with_ids else []),
    ])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with opened(path) as f:
                    shard = Shard(f)
                    ids, sizes = shard.ids(), shard.section("sizes").astype(np.int64)
                    places = np.concatenate([[0], np.cumsum(sizes)])
                    names = pa.array(shard.section("docs"), pa.int64(), mask=shard.section("known") == 0)
                cuts = [ids[a:b].tobytes() for a, b in zip(places[:-1].tolist(), places[1:].tolist())]
                columns = [names, pa.array(start + places[:-1]), pa.array(sizes), pa.array([zlib.crc32(c) for c in cuts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(cuts, pa.binary())] if with_ids else []), schema=kinds)

    return todo.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if with_ids else ""))
