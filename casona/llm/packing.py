"""Packing documents' token ids into sequences of bounded length, online and in bounded space."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casona.llm.files import partition
from casona.llm.tokens import encoded
from casona.session import stored

LENGTH = 1024
OPEN_WINDOWS = 16
#: A document is cut to fill up a window only if so many ids fit.
LEAST_PIECE = 16
#: Partitions whose leftover windows are merged together.
MERGED_PARTITIONS = 256

PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part bigint, win bigint, offset bigint, whole boolean"


class Windows:
    """At most ``most`` open windows, given as [number, free room, pieces]."""

    def __init__(self, length: int = LENGTH, most: int = OPEN_WINDOWS, least_piece: int = LEAST_PIECE):
        self.length, self.most, self.least_piece = length, most, least_piece
        self.open: list[list] = []
        self.number = 0

    def _new(self, pieces: list, used: int) -> list:
        self.number += 1
        return [self.number - 1, self.length - used, pieces]

    def place(self, doc: int, size: int) -> Iterator[list]:
        """Place ``size`` ids of document ``doc``; yields the windows that are thereby closed.

        Whole windows are cut off first. What is left goes into the open window with the least room
        that still holds it; if none does, the fullest is filled up with a first part, unless its
        room is below ``least_piece``, and closed.
        """
        start = 0
        while size - start >= self.length:
            yield self._new([(doc, start, self.length, 0)], self.length)
            start += self.length
        while start < size:
            rest = size - start
            fits = [w for w in self.open if w[1] >= rest]
            if fits:
                best = min(fits, key=lambda w: (w[1], w[0]))
                best[2].append((doc, start, rest, self.length - best[1]))
                best[1] -= rest
                if not best[1]:
                    self.open.remove(best)
                    yield best
                return
            if len(self.open) < self.most:
                self.open.append(self._new([(doc, start, rest, 0)], rest))
                return
            full = min(self.open, key=lambda w: (w[1], w[0]))
            if full[1] >= self.least_piece:
                full[2].append((doc, start, full[1], self.length - full[1]))
                start += full[1]
                full[1] = 0
            self.open.remove(full)
            yield full


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 0, length: int = LENGTH, open_windows: int = OPEN_WINDOWS,
    least_piece: int = LEAST_PIECE, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of documents in the windows of their partition; ``whole`` tells windows that are closed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = partition()
        windows = Windows(length, open_windows, least_piece)
        held: dict[int, list] = {}  # documents with a part in an open window: id, ids, ids not yet closed
        rows: list[tuple] = []
        number = 0

        def closed(window: list, whole: bool) -> None:
            for doc, start, size, offset in window[2]:
                entry = held[doc]
                cut = entry[1][start - entry[3]:start - entry[3] + size].tobytes()
                rows.append((entry[0], start, size, zlib.crc32(cut), entry[4], part, window[0], offset, whole, *([cut] if with_ids else [])))
                entry[2] -= size
                if not entry[2]:
                    del held[doc]

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * len(kinds)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

        kinds = pa.schema([
            ("doc_id", pa.int64()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "part", "win", "offset")),
            ("whole", pa.bool_()), *([("ids", pa.binary())] if with_ids else []),
        ])
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, ids, places in encoded(batch.column(1), tokenizer, end_id):
                for k, (a, b) in enumerate(zip(places[:-1].tolist(), places[1:].tolist())):
                    size = b - a
                    held[number] = [names[first + k], ids[a:b], size, 0, size]
                    for window in windows.place(number, size):
                        closed(window, True)
                    if number in held and held[number][2] < size:  # keep only what waits in open windows
                        entry = held[number]
                        waits = min(s for w in windows.open for d, s, _, _ in w[2] if d == number)
                        entry[1], entry[3] = entry[1][waits:].copy(), waits
                    elif number in held:
                        held[number][1] = held[number][1].copy()
                    number += 1
                if len(rows) > 4096:
                    yield flush()
        for window in windows.open:
            closed(window, False)
        yield flush()

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(pack, PIECE + (", ids binary" if with_ids else ""))


def packed(docs: DataFrame, tokenizer: str, length: int = LENGTH, merged_partitions: int = MERGED_PARTITIONS, **options) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]): every id of every document in one piece.

    A document is its text's ids and ``end_id``; a null or empty text has only that id. Each
    partition packs its documents in file order with a fixed number of open windows, so space is
    bounded and a long document is cut. Windows that are open at the end (a fixed number a
    partition) are merged as wholes by best fit, in groups of ``merged_partitions`` partitions.
    Rows that repeat an id are documents of their own. No documents give no rows.

    Pieces are written once before the merge: a lost executor cannot pack them in another way.
    """
    cut = stored(pieces(docs, tokenizer, length=length, **options), "packed-pieces")
    left = cut.filter("NOT whole")
    fills = left.groupBy("part", "win").agg(F.sum("length").alias("fill")).withColumn("grp", F.floor(F.col("part") / merged_partitions))

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["fill"].to_pylist(), table["part"].to_pylist(), table["win"].to_pylist()), key=lambda r: (-r[0], r[1], r[2]))
        room: list[list] = []  # free room, sequence
        out = []
        for fill, part, win in rows:
            fits = [r for r in room if r[0] >= fill]
            if fits:
                best = min(fits, key=lambda r: r[0])
            else:
                best = [length, (part << 32) + win]
                room.append(best)
            out.append((part, win, best[1], length - best[0]))
            best[0] -= fill
            if not best[0]:
                room.remove(best)
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("m_part", "m_win", "sequence_id", "shift"), zip(*out))})

    moved = fills.groupBy("grp").applyInArrow(merge, "m_part bigint, m_win bigint, sequence_id bigint, shift bigint")
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + (["ids"] if "ids" in cut.columns else [])
    done = cut.filter("whole").withColumn("sequence_id", F.col("part") * F.lit(2**32) + F.col("win"))
    rest = left.join(moved, (F.col("part") == F.col("m_part")) & (F.col("win") == F.col("m_win"))).withColumn("offset", F.col("offset") + F.col("shift"))
    return done.select(*keep).unionByName(rest.select(*keep))


def padding(sequences: DataFrame, length: int = LENGTH) -> DataFrame:
    """(sequences, ids, padded): totals, where a sequence is padded to ``length`` unless its size is a power of two."""
    sizes = sequences.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    pad = F.when(F.col("n").bitwiseAND(F.col("n") - 1) == 0, 0).otherwise(F.lit(length) - F.col("n"))
    return sizes.agg(F.count("*").alias("sequences"), F.sum("n").alias("ids"), F.sum(pad).alias("padded"))
