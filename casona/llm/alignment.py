"""Alignment of the tokens of two tokenizers by merge-path partitioning.

Both tokenizers cut the same bytes, so a text has two sorted lists of token ends. Binary searches
along evenly spaced diagonals of the merge of both lists cut it into pieces of equal work; the
pieces merge independently, each step giving the pair of tokens that overlap there, and a group
is closed where both lists end at the same byte. Pieces that lie inside a group are stitched by
the running number of closed groups.

A worker reads texts in blocks. Texts are put into chunks of some megabytes; a chunk keeps its
distinct pairs once, and its documents refer to them, so that the counts of the whole corpus come
back as a row for each pair and chunk and not for each pair and document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from casona.llm.files import partition
from casona.llm.tokens import Pieces, pieces
from casona.session import stored

#: Merge steps of a piece.
STEPS = 256
#: Bytes that are read at once; longer texts are read in segments that begin where both tokenizers begin a token.
SEGMENT = 1 << 20
#: Bytes of text of a chunk, or one longer text.
CHUNK = 8 << 20
_BITS = 20  # of a token id in a packed pair
_ID = np.uint64((1 << _BITS) - 1)

LINKS = (
    "chunk bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
    "groups_sha256 array<string>, refs array<bigint>, packed binary, a array<int>, b array<int>, n array<bigint>")
RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


# ---------------------------------------------------------------- merging

def diagonals(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of the sorted lists a and b, a first at ties, stands after every ``steps`` steps: (taken of a, taken of b)."""
    d = np.arange(0, len(a) + len(b), steps)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        first = a[np.minimum(mid, len(a) - 1)] <= b[np.clip(d - 1 - mid, 0, len(b) - 1)]
        low, high = np.where(open_ & first, mid + 1, low), np.where(open_ & ~first, mid, high)
    return low, d - low


def overlaps(a: np.ndarray, b: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token of a, token of b) of every overlap, and (tokens of a, tokens of b) before each group's end.

    ``a`` and ``b`` are the sorted ends of tokens that cover the same bytes. All pieces advance
    one step at a time together.
    """
    if not len(a) or not len(b):
        return (np.empty(0, np.int64),) * 4
    i, j = diagonals(a, b, steps)
    far = np.iinfo(np.int64).max
    ends_a, ends_b = np.append(a, far), np.append(b, far)
    at_i, at_j = np.empty((steps, len(i)), np.int32), np.empty((steps, len(i)), np.int32)
    kind = np.empty((steps, len(i)), np.int8)  # 0 an overlap, 1 the second half of a tie, 2 beyond the end
    for step in range(steps):
        end_a, end_b = ends_a[i], ends_b[j]
        take_a = end_a <= end_b
        tie = ~take_a & (ends_a[i - 1] == end_b)
        at_i[step], at_j[step] = i, j
        kind[step] = tie + 2 * ((end_a == far) & (end_b == far))
        i = np.minimum(i + take_a, len(a))
        j = np.minimum(j + ~take_a, len(b))
    at_i, at_j, kind = (x.T.ravel() for x in (at_i, at_j, kind))  # pieces one after the other
    hit, cut = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
    return at_i[hit], at_j[hit], at_i[cut].astype(np.int64), at_j[cut].astype(np.int64) + 1


def _decimals(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of the numbers below ``most``, left aligned, and how many they are."""
    text = np.char.encode(np.arange(most).astype(str), "ascii")
    size = np.char.str_len(text)
    digits = np.zeros((most, int(size.max()) + 1), np.uint8)
    digits[:, :-1] = text.view(np.uint8).reshape(most, -1)
    return digits, size


class Sides:
    """Both tokenizers with the bytes of their ids."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = pieces(a_path, True), pieces(b_path)
        self.bytes = [_table(self._of_a()), _table(self._of_b())]
        self.digits, self.width = _decimals(max(len(t[1]) for t in self.bytes))

    def _of_a(self) -> list[bytes]:
        # byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [x for x in range(256) if x not in set(plain)]
        letter = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(rest)}
        model = self.a.tokenizer
        names = [model.id_to_token(k) or "" for k in range(model.get_vocab_size(with_added_tokens=True))]
        return [bytes(letter[c] for c in n) if all(c in letter for c in n) else n.encode() for n in names]

    def _of_b(self) -> list[bytes]:
        model = self.b.model
        return [
            bytes([int(model.id_to_piece(k)[3:5], 16)]) if model.is_byte(k) else model.id_to_piece(k).replace("▁", " ").encode()
            for k in range(model.get_piece_size())]

    def cut(self, side: int, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, places of each text's ids, sizes of the ids' bytes, whether their bytes are the text)."""
        model: Pieces = (self.a, self.b)[side]
        flat, size, start = self.bytes[side]
        ids, at = model.encode(data, offsets)
        width = size[ids]
        place = np.concatenate([[0], np.cumsum(width)])
        same = place[at[1:]] - place[at[:-1]] == np.diff(offsets)
        if place[-1] == len(data) and same.all():
            differs = flat[np.repeat(start[ids] - place[:-1], width) + np.arange(place[-1])] != data
            if differs.any():
                same[np.searchsorted(offsets, np.flatnonzero(differs), "right") - 1] = False
        else:  # a text's bytes are not all there: compare each on its own
            for k in np.flatnonzero(same):
                own = ids[at[k]:at[k + 1]]
                joined = np.concatenate([flat[start[x]:start[x] + size[x]] for x in own]) if len(own) else flat[:0]
                same[k] = np.array_equal(joined, data[offsets[k]:offsets[k + 1]])
        return ids, at, width, same


def _table(names: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(n) for n in names], np.int64)
    return np.frombuffer(b"".join(names), np.uint8), size, np.cumsum(size) - size


class Part:
    """What a segment of a text gives."""

    __slots__ = ("ok", "n", "groups", "pairs", "times")

    def __init__(self, ok=False, n=(0, 0, 0, 0), groups=b"", pairs=None, times=None):
        self.ok, self.n, self.groups, self.pairs, self.times = ok, n, groups, pairs, times


def align(sides: Sides, data: np.ndarray, offsets: np.ndarray) -> list[Part]:
    """Groups and overlapping pairs of texts, each beginning with a space."""
    ids_a, at_a, width_a, same_a = sides.cut(0, data, offsets)
    ids_b, at_b, width_b, same_b = sides.cut(1, data, offsets)
    ok = same_a & same_b & (np.diff(offsets) > 0)
    if not ok.all():  # only texts that both sides spell out are merged
        keep_a, keep_b = np.repeat(ok, np.diff(at_a)), np.repeat(ok, np.diff(at_b))
        ids_a, width_a, ids_b, width_b = ids_a[keep_a], width_a[keep_a], ids_b[keep_b], width_b[keep_b]
        at_a = np.concatenate([[0], np.cumsum(np.diff(at_a) * ok)])
        at_b = np.concatenate([[0], np.cumsum(np.diff(at_b) * ok)])
    i, j, group_a, group_b = overlaps(np.cumsum(width_a), np.cumsum(width_b))
    row = np.searchsorted(at_a, i, "right") - 1
    key = (row.astype(np.uint64) << np.uint64(2 * _BITS)) | (ids_a[i].astype(np.uint64) << np.uint64(_BITS)) | ids_b[j].astype(np.uint64)
    key, times = np.unique(key, return_counts=True)
    of = np.searchsorted(key >> np.uint64(2 * _BITS), np.arange(len(ok) + 1).astype(np.uint64))
    pair = key & np.uint64((1 << 2 * _BITS) - 1)
    closed = np.searchsorted(group_a, at_a, "right")
    linked = np.searchsorted(row, np.arange(len(ok) + 1))
    text, place = _spelled(sides, ids_a, ids_b, group_a, group_b)
    place = place[at_a + at_b]
    out = []
    for k in range(len(ok)):
        if not ok[k]:
            out.append(Part())
            continue
        n = (at_a[k + 1] - at_a[k], at_b[k + 1] - at_b[k], closed[k + 1] - closed[k], linked[k + 1] - linked[k])
        out.append(Part(True, n, text[place[k]:place[k + 1] - 1], pair[of[k]:of[k + 1]], times[of[k]:of[k + 1]]))
    return out


def _spelled(sides: Sides, ids_a, ids_b, group_a, group_b) -> tuple[memoryview, np.ndarray]:
    """All groups as text, a separator after each id, and where the text after so many ids begins."""
    size_a, size_b = np.diff(group_a, prepend=0), np.diff(group_b, prepend=0)
    place_a = np.arange(len(ids_a)) + np.repeat(group_b - size_b, size_a)
    place_b = np.arange(len(ids_b)) + np.repeat(group_a, size_b)
    ids, mark = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
    ids[place_a], ids[place_b] = ids_a, ids_b
    mark[group_a + group_b - size_b - 1], mark[group_a + group_b - 1] = ord("|"), ord(";")
    digits, width = sides.digits[ids], sides.width[ids]
    digits[np.arange(len(ids)), width] = mark
    text = digits[np.arange(digits.shape[1]) <= width[:, None]]
    return memoryview(text.tobytes()), np.concatenate([[0], np.cumsum(width + 1)])


# ---------------------------------------------------------------- texts and chunks

def segments(data: np.ndarray, offsets: np.ndarray, most: int = SEGMENT) -> np.ndarray:
    """Starts of segments: those of the texts, and inside longer ones single spaces between visible ASCII bytes."""
    starts = [offsets[:-1]]
    for k in np.flatnonzero(np.diff(offsets) > most):
        a, b = int(offsets[k]), int(offsets[k + 1])
        at = a + most
        while at < b - 1:
            look = data[at - 1:min(at + most, b)]
            solid = (look > 32) & (look < 127)
            found = np.flatnonzero((look[1:-1] == 32) & solid[:-2] & solid[2:])
            if len(found):
                starts.append(np.array([at + found[0]]))
                at += int(found[0]) + most
            else:
                at += most
    return np.sort(np.concatenate(starts))


def _rows(sides: Sides, texts: pa.Array) -> Iterator[tuple[int, int, Part, list[Part]]]:
    """(row, bytes, first part, further parts) of every text, in order."""
    raw = texts.cast(pa.large_binary()).fill_null(b"")
    none = pc.equal(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False)
    raw = pc.binary_replace_slice(raw, 0, 0, b" ")
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if len(raw) else np.empty(0, np.uint8)
    offsets = offsets - offsets[0] if len(raw) else np.zeros(1, np.int64)
    starts = segments(data, offsets)
    bounds = np.append(starts, offsets[-1])
    owner = np.searchsorted(offsets, starts, "right") - 1
    first, row, parts = 0, 0, []
    while first < len(starts):
        stop = max(first + 1, int(np.searchsorted(bounds, bounds[first] + SEGMENT, "right")) - 1)
        got = align(sides, data[bounds[first]:bounds[stop]], bounds[first:stop + 1] - bounds[first])
        for k, part in enumerate(got, first):
            if owner[k] != row:
                yield row, int(offsets[row + 1] - offsets[row]), parts[0], parts[1:]
                row, parts = int(owner[k]), []
            parts.append(Part() if none[owner[k]] else part)
        first = stop
    if parts:
        yield row, int(offsets[row + 1] - offsets[row]), parts[0], parts[1:]


def _joined(first: Part, more: list[Part]) -> Part:
    """A text's segments as one part; all count only if all are spelled out."""
    if not more:
        return first
    parts = [first, *more]
    if not all(p.ok for p in parts):
        return Part()
    pairs, back = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True)
    times = np.bincount(back, np.concatenate([p.times for p in parts])).astype(np.int64)
    return Part(True, tuple(np.sum([p.n for p in parts], axis=0)), b";".join(p.groups for p in parts), pairs, times)


class _Chunk:
    """Documents gathered until they hold enough text."""

    def __init__(self):
        self.ids, self.parts, self.size = [], [], 0

    def add(self, doc_id, part: Part, size: int) -> None:
        digest = hashlib.sha256(part.groups).hexdigest() if part.ok else ""
        part.groups = b""
        self.ids.append(doc_id)
        self.parts.append((part, digest))
        self.size += size

    def batch(self, number: int) -> pa.RecordBatch:
        empty = np.empty(0, np.uint64)
        own = [p.pairs if p.ok else empty for p, _ in self.parts]
        flat, times = np.concatenate([empty, *own]), np.concatenate([np.empty(0, np.int64), *(p.times for p, _ in self.parts if p.ok)])
        pairs, back = np.unique(flat, return_inverse=True)
        order = np.lexsort((pairs, -np.bincount(back, minlength=len(pairs))))  # frequent pairs get small numbers
        number_of = np.empty(len(order), np.int64)
        number_of[order] = np.arange(len(order))
        total = np.bincount(back, times, minlength=len(pairs))[order].astype(np.int64)
        refs = np.cumsum([0, *map(len, own)])
        packed = pa.compress(number_of[back].astype("<u4").tobytes() + times.astype("<u4").tobytes(), "zstd", asbytes=True) if len(flat) else b""
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        n = np.array([p.n for p, _ in self.parts], np.int64).reshape(-1, 4)
        pairs = pairs[order]
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), one(self.ids, pa.int64()), *(one(n[:, k], pa.int64()) for k in range(4)),
            one([d for _, d in self.parts], pa.string()), one(refs, pa.int64()), pa.array([packed], pa.binary()),
            one((pairs >> np.uint64(_BITS)).astype(np.int32), pa.int32()), one((pairs & _ID).astype(np.int32), pa.int32()), one(total, pa.int64()),
        ], [f.split()[0] for f in LINKS.split(", ")])


def links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row for each chunk of documents: their numbers, their pairs as references, and the chunk's pairs (a, b, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, gathered, number = Sides(a_path, b_path), _Chunk(), partition() << 32
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, size, first, more in _rows(sides, batch.column(1)):
                gathered.add(ids[row], _joined(first, more), size)
                if gathered.size >= chunk:
                    yield gathered.batch(number)
                    gathered, number = _Chunk(), number + 1
        if gathered.ids:
            yield gathered.batch(number)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, LINKS)


def pair_counts(linked: DataFrame) -> DataFrame:
    """(a, b, total, best): how often a pair of ids is linked in all chunks, and whether no other pair of that b is more often.

    A b has at most as many partners as the first vocabulary has ids.
    """
    each = linked.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p"))
    totals = each.groupBy("p.a", "p.b").agg(F.sum("p.n").alias("total"))
    return totals.withColumn("best", F.col("total") == F.max("total").over(Window.partitionBy("b")))


def _counted(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of one chunk with the corpus-wide counts of their links."""
    out = {c: left.column(c).combine_chunks().flatten() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    refs = left.column("refs").combine_chunks().flatten().to_numpy()
    total, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
    place = right.column("place").to_numpy()
    total[place], best[place] = right.column("total").to_numpy(), right.column("best").to_numpy().astype(np.int64)
    n = int(refs[-1])
    raw = pa.decompress(left.column("packed")[0].as_py(), 8 * n, "zstd", asbytes=True) if n else b""
    pair, times = np.frombuffer(raw, "<u4", n), np.frombuffer(raw, "<u4", n, 4 * n).astype(np.int64)
    sums = lambda values: np.diff(np.concatenate([[0], np.cumsum(values * times)])[refs])
    out["n_best"], out["count_sum"] = pa.array(sums(best[pair])), pa.array(sums(total[pair]))
    return pa.table({f.split()[0]: out[f.split()[0]] for f in RESULT.split(", ")})


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Per document: tokens of both tokenizers, groups, links, and the links' corpus-wide counts.

    A text that is null or empty, or whose tokens' bytes are not a space and the text, has zeros
    and an empty digest. Rows are rows: repeated rows and null ids count like any other; an empty
    table gives none. Other columns are not read. The counts grow with the vocabularies, not the
    corpus, and come back to chunks by two joins; a document's own pairs never leave its chunk.
    """
    linked = stored(links(docs, a_path, b_path, id_col, text_col, chunk), "alignment")
    totals = pair_counts(linked).select(F.col("a").alias("t_a"), F.col("b").alias("t_b"), "total", "best")
    each = linked.select("chunk", F.posexplode(F.arrays_zip("a", "b")).alias("place", "p"))
    counts = each.join(totals, (F.col("p.a") == F.col("t_a")) & (F.col("p.b") == F.col("t_b"))).select(
        F.col("chunk").alias("c"), "place", "total", "best")
    chunks = linked.drop("a", "b", "n")
    return chunks.groupBy("chunk").cogroup(counts.groupBy("c")).applyInArrow(lambda k, left, right: _counted(k, left, right), RESULT)
