"""Language of whole texts: a bidirectional gated recurrent network over bytes, in numpy.

The network reads words with the space before them: its state starts anew there, between a letter
and punctuation, and after every ``LONGEST`` bytes of a longer piece. It labels each byte with
language probabilities, and a text's are the means over all its bytes. Equal pieces have equal
labels wherever they stand, so a worker computes each once and remembers the sums.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from casona.llm.bytehash import SpanTable, blocks
from casona.llm.tokens import cuts

UNITS = 12
LONGEST = 24
#: Documents of each language that are learned from, at most: equally many of each bucket of ids.
SAMPLE, SAMPLE_BUCKETS = 400, 16
#: Characters of such a document; a longer one gives so many in equal pieces spread over its whole length.
SAMPLE_CHARS, SAMPLE_PIECES = 20_000, 10
#: Words of the sample that are learned from, at most, for each language.
SAMPLE_WORDS = 6000
STEPS, BATCH, RATE = 700, 256, 0.01
UNKNOWN = "und"
SLOTS = 1 << 20


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


class Net:
    def __init__(self, languages: list[str], seed: int = 3):
        rng, f, h, n = np.random.default_rng(seed), np.float32, UNITS, max(1, len(languages))
        self.languages = languages
        self.w = {}
        for side in "fb":
            self.w["x" + side] = rng.normal(0, 0.3, (256, 3 * h)).astype(f)
            self.w["u" + side] = rng.normal(0, 1 / np.sqrt(h), (h, 3 * h)).astype(f)
            self.w["c" + side] = np.zeros(3 * h, f)
        self.w["out"] = rng.normal(0, 0.3, (2 * h, n)).astype(f)
        self.w["out_b"] = np.zeros(n, f)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.w)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes, languages: list[str]) -> Net:
        net = cls.__new__(cls)
        net.languages = languages
        with np.load(io.BytesIO(raw)) as z:
            net.w = {k: z[k] for k in z.files}
        return net

    def _run(self, x: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """States after each byte, [place, word, unit]; the backward side reads from the end."""
        h, (n, length) = UNITS, x.shape
        table, u, c = self.w["x" + side], self.w["u" + side], self.w["c" + side]
        state, out = np.zeros((n, h), np.float32), np.empty((length, n, h), np.float32)
        for t in range(length) if side == "f" else range(length - 1, -1, -1):
            a, b = table[x[:, t]], state @ u + c
            gates = _sigmoid(a[:, : 2 * h] + b[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = 2 * _sigmoid(2 * (a[:, 2 * h:] + r * b[:, 2 * h:])) - 1
            if keep is not None:
                keep.append((t, state, z, r, new, b[:, 2 * h:]))
            state = new + z * (state - new)
            out[t] = state
        return out

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Language probabilities of every byte of words of one length, [place, word, language]."""
        logits = np.concatenate([self._run(x, "f"), self._run(x, "b")], axis=2) @ self.w["out"] + self.w["out_b"]
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        return p / p.sum(axis=2, keepdims=True)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy of all bytes, by backpropagation through time."""
        h, (n, length) = UNITS, x.shape
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self._run(x, s, kept[s]) for s in "fb"], axis=2)
        logits = states @ self.w["out"] + self.w["out_b"]
        p = np.exp(logits - logits.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(n), y] -= 1
        p /= n * length
        g = {"out": np.einsum("tnh,tnl->hl", states, p), "out_b": p.sum(axis=(0, 1))}
        into = p @ self.w["out"].T
        for k, side in enumerate("fb"):
            u = self.w["u" + side]
            g["x" + side], g["u" + side], g["c" + side] = (np.zeros_like(self.w[c + side]) for c in "xuc")
            carried = np.zeros((n, h), np.float32)
            for t, before, z, r, new, inner in reversed(kept[side]):
                d = into[t][:, k * h:(k + 1) * h] + carried
                d_new = d * (1 - z) * (1 - new**2)
                d_z = d * (before - new) * z * (1 - z)
                d_r = d_new * inner * r * (1 - r)
                d_in = np.concatenate([d_z, d_r, d_new], axis=1)
                d_state = np.concatenate([d_z, d_r, d_new * r], axis=1)
                np.add.at(g["x" + side], x[:, t], d_in)
                g["u" + side] += before.T @ d_state
                g["c" + side] += d_state.sum(axis=0)
                carried = d * z + d_state @ u.T
        return g


class Reader:
    """A network with the sums of the words that it has read."""

    def __init__(self, net: Net):
        self.net = net
        self.table = SpanTable(SLOTS, LONGEST // 8)
        self.sums = np.zeros((SLOTS, max(1, len(net.languages))), np.float32)

    def _words(self, data: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
        out = np.zeros((len(starts), self.sums.shape[1]), np.float32)
        for size in np.unique(length):
            of = np.flatnonzero(length == size)
            for s in range(0, len(of), 2048):
                part = of[s:s + 2048]
                out[part] = self.net.positions(data[starts[part][:, None] + np.arange(size)]).sum(axis=0)
        return out

    def texts(self, texts: pa.Array) -> np.ndarray:
        """Mean language probabilities of every text; zeros if it is empty."""
        out = np.zeros((len(texts), self.sums.shape[1]))
        for first, data, offsets in blocks(texts, 1 << 21):
            starts, ends, row = pieces(data, offsets)
            if not len(starts):
                continue
            slot, known, first_of, same = self.table.look(data, starts, ends)
            sums = self.sums[slot]
            if len(first_of):
                got = self._words(data, starts[first_of], (ends - starts)[first_of])
                sums[~known] = got[same]
                own = self.table.keep(slot, ends - starts, first_of)
                self.sums[slot[first_of[own]]] = got[own]
            begin = np.searchsorted(row, np.arange(len(offsets)))
            total = np.concatenate([np.zeros((1, sums.shape[1])), np.cumsum(sums, axis=0, dtype=np.float64)])
            size = np.concatenate([[0], np.cumsum(ends - starts)])
            n = size[begin[1:]] - size[begin[:-1]]
            out[first:first + len(n)] = (total[begin[1:]] - total[begin[:-1]]) / np.maximum(1, n)[:, None]
        return out


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the pieces that are read on their own; together they cover all bytes."""
    starts = cuts(data, offsets)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    row = np.searchsorted(offsets, starts, "right") - 1
    number = -(-(ends - starts) // LONGEST)
    nth = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    start = np.repeat(starts, number) + nth * LONGEST
    return start, np.minimum(np.repeat(ends, number), start + LONGEST), np.repeat(row, number)


def train(rows: list[tuple[str, str]], seed: int = 3, steps: int = STEPS) -> Net:
    """A network fitted to (text, language) rows: words of each language, some of them in upper case."""
    languages = sorted({lang for _, lang in rows})
    net = Net(languages, seed)
    if len(languages) < 2:
        return net
    rng = np.random.default_rng(seed)
    by_length: dict[int, list[tuple[bytes, int]]] = {}
    for y, lang in enumerate(languages):
        raw = [text.encode() for text, own in rows if own == lang]
        data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
        starts, ends, _ = pieces(data, offsets)
        for k in rng.permutation(len(starts))[:SAMPLE_WORDS]:
            w = data[starts[k]:ends[k]].tobytes()
            if rng.random() < 0.15:
                w = w.decode(errors="ignore").upper().encode()[:LONGEST]
            by_length.setdefault(len(w), []).append((w, y))
    sizes = sorted(n for n in by_length if n)
    table = {n: (np.frombuffer(b"".join(w for w, _ in by_length[n]), np.uint8).reshape(-1, n), np.array([y for _, y in by_length[n]])) for n in sizes}
    share = np.array([len(table[n][1]) * n for n in sizes], float)
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items()}
    for step in range(1, steps + 1):
        x, y = table[sizes[rng.choice(len(sizes), p=share / share.sum())]]
        pick = rng.integers(0, len(y), BATCH)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for key, grad in net.gradients(x[pick], y[pick]).items():
            m, v = state[key]
            grad = np.clip(grad, -1, 1).astype(np.float32)
            m *= 0.9
            m += 0.1 * grad
            v *= 0.99
            v += 0.01 * grad * grad
            net.w[key] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Net:
    """A network fitted to a bounded sample of ``docs``: those of each language and id bucket with the smallest hashes of their id.

    Rows with a null text, language or id are not learned from; of rows that repeat an id and
    language the smallest text is. No language is left out, however long or short its texts are.
    """
    rows = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l"))
    rows = rows.filter("d IS NOT NULL AND t IS NOT NULL AND l IS NOT NULL")
    first = Window.partitionBy("l", "b").orderBy("h", "d")  # buckets split a language that has most rows
    keys = rows.select("l", "d").distinct().withColumns({
        "h": F.xxhash64(F.lit(9), "d"), "b": F.pmod(F.xxhash64(F.lit(10), "d"), F.lit(SAMPLE_BUCKETS))}).withColumn("n", F.row_number().over(first))
    picked = keys.filter(F.col("n") <= -(-sample // SAMPLE_BUCKETS))
    size, piece = F.length("t"), SAMPLE_CHARS // SAMPLE_PIECES
    spread = F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(SAMPLE_PIECES - 1)),
        lambda k: F.substr("t", F.floor(k * (size - piece) / (SAMPLE_PIECES - 1)).cast("int") + 1, F.lit(piece))), " ")
    chosen = rows.join(picked.select("d", "l"), ["d", "l"]).groupBy("l", "d").agg(F.min("t").alias("t"))
    chosen = chosen.withColumn("t", F.when(size > SAMPLE_CHARS, spread).otherwise(F.col("t")))
    return train([(r["t"], r["l"]) for r in chosen.orderBy("l", "d").collect()])


def predict(docs: DataFrame, net: Net, text_col: str = "text") -> DataFrame:
    """The documents with ``lang_pred`` and ``lang_score``, the pooled probability of that language by the whole text.

    A null text, one without a letter, and any text if nothing was learned are ``und`` with score 0.
    Columns of these names that the documents have already are replaced.
    """
    raw, languages = net.dump(), net.languages
    docs = docs.drop("lang_pred", "lang_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Net.load(raw, languages))
        names = np.array(languages or [UNKNOWN], object)
        for batch in batches:
            p = reader.texts(batch.column(batch.schema.get_field_index(text_col)))
            best = p.argmax(axis=1)
            batch = batch.append_column("lang_pred", pa.array(names[best], pa.string()))
            yield batch.append_column("lang_score", pa.array(np.clip(p[np.arange(len(p)), best], 0, 1), pa.float64()))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    read = docs.mapInArrow(run, kinds + ", lang_pred string, lang_score double")
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)) if languages else F.lit(False)
    return read.withColumn("lang_pred", F.when(letters, F.col("lang_pred")).otherwise(UNKNOWN)).withColumn(
        "lang_score", F.when(letters, F.col("lang_score")).otherwise(0.0))


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id as text has the given remainder."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))
