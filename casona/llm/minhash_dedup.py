"""Near copies of texts by HyperMinHash: banded compressed registers, corrected estimates, exact checks.

A text is the set of its word shingles. Each shingle falls into one of the registers, which keep
the smallest hash that fell into them, compressed to its leading zeros (6 bits) and the next 10
bits. Registers that stay empty are filled from further rounds of hashing, so every register of
two sets is equal with a probability equal to their Jaccard similarity, plus a chance of equal
compressed values that the estimate subtracts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casona.llm.bytehash import blocks, mix, span_hashes, word_spans
from casona.operators.graph import connected_components
from casona.session import stored

ROUNDS = 6
MANTISSA = 10
#: Rows of one side of a tile.
TILE_ROWS = 128
#: Keys that the rows of one anchor are spread over.
SALTS = 32
#: Standard errors by which an estimate may lie below the threshold before a pair is given up.
ERRORS = 5.0
_EMPTY = np.uint64(2**64 - 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Sketch:
    """Parameters: shingles of ``words`` words; similarity of ``percent`` or more; ``bands`` of ``rows`` registers."""

    def __init__(self, words: int = 3, percent: int = 85, bands: int = 40, rows: int = 7):
        self.words, self.percent, self.bands, self.rows = words, percent, bands, rows
        self.registers = bands * rows
        t = percent / 100
        self.least_estimate = t - ERRORS * math.sqrt(t * (1 - t) / self.registers)

    def shingles(self, texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(first row, sorted distinct shingle hashes of each row) of runs of texts."""
        for first, data, offsets in blocks(texts):
            starts, ends, row = word_spans(data, offsets)
            words = span_hashes(_LOWER[data], starts, ends)
            at = np.searchsorted(row, np.arange(len(offsets)))
            salted = words.copy()
            for k in range(1, self.words):
                n = max(0, len(words) - k)
                salted[:n] = mix(salted[:n] * np.uint64(0x9E3779B97F4A7C15) + words[k:])
            sets = []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                if b - a >= self.words:
                    sets.append(np.unique(salted[a:b - self.words + 1]))
                elif b > a:
                    whole = np.uint64(b - a)
                    for w in words[a:b]:
                        whole = mix(np.array([whole ^ w]))[0]
                    sets.append(np.array([whole]))
                else:
                    sets.append(words[:0])
            yield first, sets

    def registers_of(self, sets: list[np.ndarray]) -> np.ndarray:
        """Compressed registers, one row a set; sets must not be empty."""
        m, size = self.registers, np.array([len(s) for s in sets])
        values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
        low = np.full(len(sets) * m, _EMPTY)
        for r in range(ROUNDS):
            x = mix(values ^ np.uint64(0xA5A5A5A5 * (r + 1)))
            place = owner * m + ((x >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            free = low[place] == _EMPTY
            np.minimum.at(low, place[free], mix(x[free] + np.uint64(r)))
            left = (low.reshape(-1, m) == _EMPTY).any(axis=1)[owner]
            values, owner = values[left], owner[left]
            if not len(values):
                break
        free = np.flatnonzero(low == _EMPTY)
        if len(free):  # the rest take the smallest hash of the whole set, by a hash of their own
            begin = np.concatenate([[0], np.cumsum(size)[:-1]])
            every = np.concatenate(sets)
            for part in np.array_split(free, max(1, int(size[free // m].sum()) >> 20)):
                n = size[part // m]
                ends = np.cumsum(n)
                which = np.arange(ends[-1]) - np.repeat(ends - n - begin[part // m], n)
                seed = mix((part % m).astype(np.uint64) + np.uint64(1 << 40))
                low[part] = np.minimum.reduceat(mix(every[which] ^ np.repeat(seed, n)), ends - n)
        zeros = 53 - np.frexp((low >> np.uint64(11)).astype(np.float64))[1].astype(np.uint64)
        mantissa = (low << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
        return (zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16).reshape(-1, m)

    def band_keys(self, registers: np.ndarray) -> np.ndarray:
        parts = registers.reshape(len(registers), self.bands, self.rows).astype(np.uint64)
        key = np.broadcast_to(mix(np.arange(self.bands, dtype=np.uint64) + np.uint64(77)), parts.shape[:2])
        for k in range(self.rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
        return key.view(np.int64)

    def chance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Probability that registers of unrelated sets of sizes a and b are equal after compression."""
        level = np.arange(54)
        share = lambda n: -np.diff(1 - (1 - 0.5 ** np.append(level, 99)) ** np.maximum(1, n / self.registers)[:, None], axis=1)
        return (share(a) * share(b)).sum(axis=1) / 2**MANTISSA

    def estimate(self, ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
        """Jaccard similarity from equal registers, less those equal by chance."""
        chance = self.chance(na.astype(float), nb.astype(float))
        return ((ra == rb).mean(axis=1) - chance) / (1 - chance)

    def alike(self, both, na, nb):
        return 100 * both >= self.percent * (na + nb - both)


def features(docs: DataFrame, sketch: Sketch, bands: bool) -> DataFrame:
    """(doc, n, node, twin, bands) of every row, or (doc, node, n, registers, shingles) of those with shingles.

    ``node`` and ``twin`` are digests of the shingle set; equal sets have equal digests.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in sketch.shingles(batch.column(1)):
                doc = batch.column(0).slice(first, len(sets))
                n = np.array([len(s) for s in sets])
                some = np.flatnonzero(n)
                node, twin = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
                if len(some):
                    flat, starts = np.concatenate([sets[k] for k in some]), np.cumsum(n[some]) - n[some]
                    node[some] = mix(np.add.reduceat(mix(flat), starts) + n[some].astype(np.uint64)).view(np.int64)
                    twin[some] = np.bitwise_xor.reduceat(mix(flat + np.uint64(99)), starts).view(np.int64)
                registers = sketch.registers_of([sets[k] for k in some]) if len(some) else np.empty((0, sketch.registers), np.uint16)
                if bands:
                    keys = np.zeros((len(sets), sketch.bands), np.int64)
                    keys[some] = sketch.band_keys(registers)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * sketch.bands), pa.array(keys.ravel()))
                    yield pa.RecordBatch.from_arrays([doc, pa.array(n), pa.array(node), pa.array(twin), lists], ["doc", "n", "node", "twin", "bands"])
                elif len(some):
                    yield pa.RecordBatch.from_arrays(
                        [doc.take(pa.array(some)), pa.array(node[some]), pa.array(n[some]), pa.array([r.tobytes() for r in registers], pa.binary()),
                         pa.array([sets[k].tobytes() for k in some], pa.binary())], ["doc", "node", "n", "registers", "shingles"])

    kinds = "doc bigint, n bigint, node bigint, twin bigint, bands array<bigint>" if bands else (
        "doc bigint, node bigint, n bigint, registers binary, shingles binary")
    return docs.mapInArrow(run, kinds)


def near_copies(docs: DataFrame, sketch: Sketch | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    Words are runs of bytes other than white space, A-Z in lower case; a text shorter than a
    shingle is one shingle, a null text or one without words is empty and links with nothing.
    Two texts link if their whole shingle sets (kept as 64-bit hashes) are ``percent`` similar or
    more. Components are those of all links, named by their smallest id; rows that repeat an id
    are one node with the links of all of them. A null id is kept, with a null component. No
    documents give no rows.

    Equal sets are first reduced to one. Sets that share a band are candidates: each is checked
    against the smallest node of its band (a star, never all pairs); bands whose nodes then still
    lie in different components are compared in tiles of bounded size, of which only a spanning
    forest of verified links comes back. Members of the component of a band's smallest node are
    not compared among themselves.
    """
    sketch = sketch or Sketch()
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    known = stored(features(rows, sketch, bands=True), "minhash-bands")
    linkable = known.filter("n > 0 AND doc IS NOT NULL")
    heads = stored(linkable.groupBy("node", "twin", "n").agg(F.min("doc").alias("head"), F.count("*").alias("copies")), "minhash-heads")

    banded = linkable.join(heads.select("node", "twin", F.col("head").alias("doc")), ["node", "twin", "doc"], "left_semi")
    banded = banded.select("node", F.explode("bands").alias("band"))
    anchors = banded.groupBy("band").agg(F.min("node").alias("anchor"), F.max("node").alias("last")).filter("anchor <> last")
    near = stored(banded.join(anchors.select("band", "anchor"), "band").filter("node <> anchor").select("anchor", "node").distinct(), "minhash-near")

    wanted = near.select("node").unionByName(near.select(F.col("anchor").alias("node"))).distinct()
    wanted = heads.join(wanted, "node", "left_semi").select(F.col("head").alias("doc")).distinct()
    profiles = stored(features(rows.join(wanted, "doc", "left_semi"), sketch, bands=False), "minhash-sets")
    profiles = profiles.join(heads.select("node", F.col("head").alias("doc")), ["node", "doc"], "left_semi").dropDuplicates(["node"])

    stars = stored(_verified(_estimated(near, profiles, sketch), profiles, sketch), "minhash-stars")
    parts = connected_components(stars)
    tiles = _tiled(near, parts, profiles, sketch)
    links = stars.unionByName(tiles).distinct()

    names = heads.select("node", "head")
    edges = links.join(names.toDF("a", "doc_a"), "a").join(names.toDF("b", "doc_b"), "b").select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
    copies = linkable.join(heads.filter("copies > 1").select("node", "twin", "head"), ["node", "twin"])
    whole = connected_components(edges.unionByName(copies.select(F.col("doc").alias("a"), F.col("head").alias("b"))))
    component = F.coalesce("component", "doc")
    return known.join(whole, known.doc == whole.id, "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc")).alias("kept"))


def _paired(pairs: DataFrame, profiles: DataFrame, *columns: str) -> DataFrame:
    side = lambda s: profiles.select(F.col("node").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in columns))
    return pairs.join(side("a"), "a").join(side("b"), "b")


def _estimated(near: DataFrame, profiles: DataFrame, sketch: Sketch) -> DataFrame:
    """Candidate pairs (a, b) whose corrected estimate can belong to a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                t = {n: batch.column(n) for n in batch.schema.names}
                regs = [np.frombuffer(b"".join(t[c].to_pylist()), np.uint16).reshape(-1, sketch.registers) for c in ("registers_a", "registers_b")]
                keep = sketch.estimate(*regs, t["n_a"].to_numpy(), t["n_b"].to_numpy()) >= sketch.least_estimate
                yield pa.RecordBatch.from_arrays([t["a"], t["b"]], ["a", "b"]).filter(pa.array(keep))

    pairs = near.select(F.col("node").alias("a"), F.col("anchor").alias("b"))
    sized = F.greatest("n_a", "n_b") * sketch.percent <= F.least("n_a", "n_b") * 100
    return _paired(pairs, profiles, "n", "registers").filter(sized).mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, profiles: DataFrame, sketch: Sketch) -> DataFrame:
    """Pairs that are links by their whole sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("shingles_a"), batch.column("shingles_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                keep.append(bool(sketch.alike(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _paired(pairs, profiles, "shingles").select("a", "b", "shingles_a", "shingles_b").mapInArrow(run, "a bigint, b bigint")


def _tiled(near: DataFrame, parts: DataFrame, profiles: DataFrame, sketch: Sketch) -> DataFrame:
    """Links (a, b) between different components inside the groups around an anchor.

    A group's nodes are those of the anchor's component (side 1) and all others (side 0), each side
    in blocks. Tiles compare two blocks of side 0, or one of side 0 with one of side 1.
    """
    groups = near.unionByName(near.select("anchor", F.col("anchor").alias("node")).distinct())
    labelled = groups.join(parts.toDF("node", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    own = parts.toDF("anchor", "home")
    labelled = labelled.join(own, "anchor", "left").withColumn("side", (F.col("part") == F.coalesce("home", "anchor")).cast("int"))
    labelled = stored(labelled.select("anchor", "node", "part", "side"), "minhash-groups")
    sizes = labelled.groupBy("anchor").agg(F.sum(1 - F.col("side")).alias("out"), F.sum("side").alias("ins")).filter("out > 0")
    count = lambda c: F.ceil(F.col(c) / F.lit(float(TILE_ROWS))).cast("int")
    # a hot anchor's rows meet its sizes under several keys
    sizes = sizes.select("anchor", count("out").alias("outs"), count("ins").alias("ins"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    placed = labelled.withColumn("salt", F.pmod(F.xxhash64(F.lit(3), "node"), F.lit(SALTS)).cast("int")).join(sizes, ["anchor", "salt"])
    block = F.pmod(F.xxhash64("node"), F.when(F.col("side") == 1, F.col("ins")).otherwise(F.col("outs"))).cast("int")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    tile = lambda a, b: F.struct(a.alias("i"), b.alias("j"))
    among = F.filter(
        F.transform(upto("outs"), lambda t: tile(F.least("block", t), F.greatest("block", t))), lambda t: t["i"] < t["j"])
    across = F.when(F.col("side") == 1, F.transform(upto("outs"), lambda t: tile(t, F.col("outs") + F.col("block")))).otherwise(
        F.concat(among, F.transform(upto("ins"), lambda t: tile(F.col("block"), F.col("outs") + t))))
    dealt = placed.withColumn("block", block).withColumn("tile", F.explode(across)).select(
        "anchor", "tile.i", "tile.j", (F.col("block") + F.col("side") * F.col("outs")).alias("own"), (F.col("tile.j") == F.col("outs")).alias("inner"), "node", "part")
    full = dealt.join(profiles.select("node", "n", "registers", "shingles"), "node")

    def compare(table: pa.Table) -> pa.Table:
        node, part, n = (table[c].to_numpy() for c in ("node", "part", "n"))
        left = table["own"].to_numpy() == table["i"][0].as_py()
        wanted = np.triu(np.ones((len(node), len(node)), bool), 1) & (part[:, None] != part[None, :])
        across = left[:, None] != left[None, :]
        wanted &= (across | (left[:, None] & left[None, :])) if table["inner"][0].as_py() else across
        wanted &= 100 * np.minimum(n[:, None], n[None, :]) >= sketch.percent * np.maximum(n[:, None], n[None, :])
        i, j = np.nonzero(wanted)
        regs = np.frombuffer(b"".join(table["registers"].to_pylist()), np.uint16).reshape(len(node), -1)
        step = 8192
        keep = [sketch.estimate(regs[i[s:s + step]], regs[j[s:s + step]], n[i[s:s + step]], n[j[s:s + step]]) >= sketch.least_estimate
                for s in range(0, len(i), step)]
        if keep:
            keep = np.concatenate(keep)
            i, j = i[keep], j[keep]
        if len(i):
            both = _common([np.frombuffer(v.as_buffer(), np.uint64) for v in table["shingles"]])[i, j]
            sure = sketch.alike(both, n[i], n[j])
            i, j = i[sure], j[sure]
        forest = _forest(len(node), i, j)
        moved = np.flatnonzero(forest != np.arange(len(node)))
        return pa.table({"a": node[moved], "b": node[forest[moved]]})

    return stored(full.groupBy("anchor", "i", "j").applyInArrow(compare, "a bigint, b bigint"), "minhash-tiles")


def _common(sets: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """Sizes of all intersections: products of the 0/1 rows over the shingles that several sets hold."""
    values, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    several = held[column] > 1
    number = (np.cumsum(held > 1) - 1)[column[several]]
    owner = owner[several]
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    out = np.zeros((len(sets), len(sets)))
    for start in range(0, int((held > 1).sum()), step):
        a, b = np.searchsorted(number, [start, start + step])
        rows = np.zeros((len(sets), step), np.float32)
        rows[owner[a:b], number[a:b] - start] = 1
        out += rows @ rows.T
    return out


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Root of each of n nodes after joining the pairs."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(i.tolist(), j.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return np.array([find(x) for x in range(n)], np.int64)
