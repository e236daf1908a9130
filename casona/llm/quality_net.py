"""Quality of whole texts: a convolutional network over bytes, in numpy.

A text is cut into overlapping chunks that cover all of it. Each byte has two channels: the byte
itself, and how far back the four bytes that end there occurred last within the chunk, in steps
of powers of two, which makes repetition visible to short filters. Filters see several bytes of
both channels; each chunk keeps every filter's largest response, a dense layer scores the chunk,
and a text's logit is the mean of its chunks' scores, weighted by the bytes that each adds.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casona.llm.bytehash import blocks
from casona.session import stored

WIDTH, FILTERS, HIDDEN = 6, 24, 16
CHUNK, OVERLAP = 256, 16
BACK = 10  # values of the second channel
#: Labelled rows that are learned from, at most: those with the smallest hashes of each label.
SAMPLE = 3000
#: Characters of a text that is learned from, at most; longer labelled texts are not in the sample.
LONGEST = 20_000
#: Chunks of a text that one pass of training draws, at most; scoring reads all.
CHUNKS_A_PASS = 4
EPOCHS, BATCH, RATE = 8, 64, 0.004


def cut(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, row) of the chunks of rows of bytes; a chunk repeats the last bytes of the one before."""
    size = np.diff(offsets)
    step = CHUNK - OVERLAP
    number = np.where(size > 0, np.maximum(1, -(-(size - OVERLAP) // step)), 0)
    row = np.repeat(np.arange(len(size)), number)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    start = offsets[row] + nth * step
    return start, np.minimum(CHUNK, offsets[row + 1] - start), row


def channels(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, distances, valid) of chunks as matrices; places beyond a chunk's end hold byte 0."""
    at = start[:, None] + np.arange(CHUNK)
    valid = np.arange(CHUNK) < length[:, None]
    x = np.where(valid, data[np.minimum(at, max(0, len(data) - 1))], 0).astype(np.uint8)
    four = x.astype(np.uint32)
    code = four.copy()
    for k in range(1, 4):
        code[:, k:] |= four[:, :-k] << np.uint32(8 * k)
    order = np.argsort(code, axis=1, kind="stable")
    ordered = np.take_along_axis(code, order, 1)
    gap = np.zeros(x.shape, np.int64)
    gap[:, 1:] = np.where(ordered[:, 1:] == ordered[:, :-1], order[:, 1:] - order[:, :-1], 0)
    back = np.zeros(x.shape, np.int64)
    np.put_along_axis(back, order, gap, 1)
    level = np.zeros(x.shape, np.uint8)
    near = back > 0
    level[near] = np.minimum(BACK - 1, 1 + np.log2(back[near]).astype(np.int64)).astype(np.uint8)
    return x, np.where(valid, level, 0).astype(np.uint8), valid


class Net:
    """Tables of filter responses for each byte and distance at each place of a filter, and the dense layers."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        f = np.float32
        self.w = {
            "byte": rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(f), "back": rng.normal(0, 0.15, (WIDTH, BACK, FILTERS)).astype(f),
            "bias": np.zeros(FILTERS, f), "dense": rng.normal(0, 0.3, (FILTERS, HIDDEN)).astype(f), "dense_b": np.zeros(HIDDEN, f),
            "out": rng.normal(0, 0.3, HIDDEN).astype(f), "out_b": np.zeros(1, f),
        }

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.w)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Net:
        net = cls.__new__(cls)
        with np.load(io.BytesIO(raw)) as z:
            net.w = {k: z[k] for k in z.files}
        return net

    def pooled(self, x: np.ndarray, back: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(largest response, its place) of every filter in every chunk; filters start at bytes of the chunk."""
        n = CHUNK - WIDTH + 1
        total = np.broadcast_to(self.w["bias"], (len(x), n, FILTERS)).copy()
        for k in range(WIDTH):
            total += self.w["byte"][k][x[:, k:k + n]]
            total += self.w["back"][k][back[:, k:k + n]]
        total[~valid[:, :n]] = -30
        place = total.argmax(axis=1)
        return np.take_along_axis(total, place[:, None, :], 1)[:, 0], place

    def scores(self, x, back, valid) -> np.ndarray:
        top, _ = self.pooled(x, back, valid)
        return np.tanh(np.maximum(top, 0) @ self.w["dense"] + self.w["dense_b"]) @ self.w["out"] + self.w["out_b"][0]

    def texts(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 for every text; an empty one has the probability of no evidence at all."""
        out = np.empty(len(texts))
        for first, data, offsets in blocks(texts, 1 << 18):
            start, length, row = cut(offsets)
            logit, weight = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
            for s in range(0, len(start), 64):
                p = slice(s, s + 64)
                score = self.scores(*channels(data, start[p], length[p]))
                np.add.at(logit, row[p], score * length[p])
                np.add.at(weight, row[p], length[p])
            out[first:first + len(logit)] = np.where(weight > 0, logit / np.maximum(weight, 1), self.w["out_b"][0])
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def train(texts: list[str | None], labels: list[int], epochs: int = EPOCHS, seed: int = 11, chunks: int = CHUNKS_A_PASS) -> Net:
    """A network fitted by backpropagation (Adam) to texts, of each at most ``chunks`` random chunks a pass; both labels weigh the same in sum."""
    net = Net(seed)
    labels = np.array(labels, float)
    if not len(labels) or labels.min() == labels.max():
        net.w["out_b"][:] = 0 if not len(labels) else (4 if labels[0] else -4)
        net.w["out"][:] = 0
        return net
    data, offsets = b"", [0]
    parts = [(t or "").encode() for t in texts]
    offsets = np.cumsum([0] + [len(p) for p in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    start, length, row = cut(offsets)
    begin = np.searchsorted(row, np.arange(len(parts) + 1))
    ones = labels.mean()
    weight = np.where(labels == 1, 0.5 / ones, 0.5 / (1 - ones))
    rng = np.random.default_rng(seed)
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(parts))
        for s in range(0, len(order), BATCH):
            docs = order[s:s + BATCH]
            # of each text some chunks a pass, others in the next one
            picks = [rng.permutation(np.arange(begin[d], begin[d + 1]))[:chunks] for d in docs]
            chunk = np.concatenate(picks)
            if not len(chunk):
                continue
            owner = np.repeat(np.arange(len(docs)), [len(p) for p in picks])
            share = length[chunk] / np.maximum(1, np.bincount(owner, length[chunk], len(docs)))[owner]
            x, back, valid = channels(data, start[chunk], length[chunk])
            top, place = net.pooled(x, back, valid)
            active = np.maximum(top, 0)
            hidden = np.tanh(active @ net.w["dense"] + net.w["dense_b"])
            score = hidden @ net.w["out"] + net.w["out_b"][0]
            logit = np.bincount(owner, score * share, len(docs))
            error = (1 / (1 + np.exp(-logit)) - labels[docs]) * weight[docs] / len(docs)
            d_score = (error[owner] * share).astype(np.float32)
            g = {"out_b": np.array([d_score.sum()]), "out": hidden.T @ d_score}
            d_hidden = d_score[:, None] * net.w["out"] * (1 - hidden**2)
            g["dense"], g["dense_b"] = active.T @ d_hidden, d_hidden.sum(axis=0)
            d_top = (d_hidden @ net.w["dense"].T) * (top > 0)
            g["bias"] = d_top.sum(axis=0)
            g["byte"], g["back"] = np.zeros_like(net.w["byte"]), np.zeros_like(net.w["back"])
            which = np.arange(len(chunk))[:, None]
            column = np.broadcast_to(np.arange(FILTERS), place.shape)
            for k in range(WIDTH):
                np.add.at(g["byte"][k], (x[which, place + k], column), d_top)
                np.add.at(g["back"][k], (back[which, place + k], column), d_top)
            step += 1
            for key, (m, v) in state.items():
                grad = g[key].astype(np.float32)
                m *= 0.9
                m += 0.1 * grad
                v *= 0.99
                v += 0.01 * grad * grad
                net.w[key] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Net:
    """A network fitted to a bounded sample of the labelled rows, half of it for each label as far as there are.

    ``labels`` holds the rows that may be learned from; rows with a null label or id are passed
    over, as are labels other than 0 and 1 and texts of over ``LONGEST`` characters. The sample has
    the rows with the smallest hashes of their id, so reruns agree. Without labels every score is 0.5.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).filter("_id IS NOT NULL AND _y IN (0, 1)")
    known = known.groupBy("_id").agg(F.max("_y").alias("_y")).withColumn("_h", F.xxhash64(F.lit(5), "_id"))
    short = docs.filter(F.coalesce(F.length(text_col), F.lit(0)) <= LONGEST).select(F.col(id_col).alias("_id")).distinct()
    known = stored(known.join(short, "_id"), "quality-labels")
    picked = None
    for y in (0, 1):
        some = known.filter(F.col("_y") == y).orderBy("_h", "_id").limit(sample // 2)
        picked = some if picked is None else picked.unionByName(some)
    rows = docs.filter(F.coalesce(F.length(text_col), F.lit(0)) <= LONGEST).select(F.col(id_col).alias("_d"), F.col(text_col).alias("_t"))
    rows = rows.join(picked, F.col("_d") == F.col("_id"))
    rows = rows.groupBy("_d").agg(F.min("_t").alias("t"), F.max("_y").alias("y"), F.max("_h").alias("h")).orderBy("h", "_d").collect()
    return train([r["t"] for r in rows], [r["y"] for r in rows])


def score(docs: DataFrame, net: Net, id_col: str = "doc_id", text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """The documents with ``out``, the probability of label 1 by their whole text; null texts are empty. A column ``out`` that they have is replaced."""
    raw = net.dump()
    docs = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Net.load(raw)
        for batch in batches:
            yield batch.append_column(out, pa.array(own.texts(batch.column(batch.schema.get_field_index(text_col))), pa.float64()))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, kinds + f", `{out}` double")


def held_out(id_col: str, folds: int, fold: int):
    """Whether crc32 of the id as text has the given remainder."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))
