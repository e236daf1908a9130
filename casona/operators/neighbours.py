"""Links between vectors without blocks and without all pairs of equal or crowded rows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from casona.operators.hotkeys import HOT_SHARE, met
from casona.session import stored

SIGNATURE = "node bigint, dims int, size bigint, v array<double>, keys array<bigint>, masks array<bigint>"
ENTRY = "node bigint, dims int, band int, key bigint, home boolean"

#: Blocks that a table is cut into for all pairs, and the components that a block may hold before there are more blocks.
BLOCKS, MOST_CELLS = 24, 2**20
#: Comparisons that take as long as making, shuffling and looking up an entry of a bucket.
ENTRY_COST = 100
#: The same between two tables of near vectors, whose buckets are crowded: an entry then carries its vector.
CROSS_ENTRY_COST = 2_000


def plan_bands(rows: int, min_similarity: float, missed: float, most_bands: int, flips: int) -> tuple[int, int]:
    """(bits of a band, bands) that miss a pair at the threshold with a probability of about ``missed``.

    A band starts with log2(rows) bits and one more for each flipped one, so that strangers rarely
    meet. Where that would take more than ``most_bands`` bands, bands get fewer bits: more
    comparisons, but none left out. How often a band finds a pair is drawn from two normal numbers
    a bit, correlated as the vectors are.
    """
    rng = np.random.default_rng(1)
    most = max(1, math.ceil(math.log2(max(2, rows)))) + flips
    draws = 4000
    x, noise = rng.normal(size=(2, draws, most))
    y = min_similarity * x + math.sqrt(max(0.0, 1 - min_similarity**2)) * noise
    for bits in range(most, 0, -1):
        a, b = x[:, :bits], y[:, :bits]
        differ = (a > 0) != (b > 0)
        found = [~(differ & ~_weak(np.abs(side), min(flips, bits))).any(axis=1) for side in (a, b)]
        share = (found[0] | found[1]).mean()
        share -= 2 * math.sqrt(share * (1 - share) / draws)
        if share >= 1:
            return bits, 1
        if share > 0 and math.log(missed) / math.log(1 - share) <= most_bands:
            return bits, max(1, math.ceil(math.log(missed) / math.log(1 - share)))
    return 1, 1  # one bit, flipped: all meet all


def _weak(sizes: np.ndarray, n: int) -> np.ndarray:
    """True at the n smallest places of the last axis."""
    out = np.zeros(sizes.shape, bool)
    np.put_along_axis(out, np.argsort(sizes, axis=-1)[..., :n], True, -1)
    return out


def vector_classes(rows: DataFrame) -> DataFrame:
    """(node, class_id, n, v): one row for each different vector of rows (id, v); the class goes by its smallest id."""
    classes = rows.groupBy("v").agg(F.min("id").alias("class_id"), F.count("*").alias("n"))
    return stored(classes.select(F.monotonically_increasing_id().alias("node"), "class_id", "n", "v"), "vector-classes")


def lsh_neighbours(
    df: DataFrame, min_similarity: float, id_col: str = "id", vec_col: str = "embedding", missed: float = 1e-3,
    most_bands: int = 64, flips: int = 5, chunk_rows: int = 512, planned_rows: int | None = None,
) -> DataFrame:
    """(id, class_id, class_size, n_links) for every row: how many other rows are at or above a cosine.

    Rows with equal vectors are one class and meet others once. ``links`` says how classes find
    each other; their links are counted where they are found, so neither n equal rows nor n
    neighbours make n * n rows. Vectors that are null, empty or zero or hold null or non-finite
    components, and null ids, are classes of their own without links; vectors of unequal length
    have no links. Rows that repeat an id are rows of their own. ``planned_rows`` sets signatures
    for a table of that size. Where bands cost more than all pairs, all pairs are compared.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    good = _usable(F.col("v")) & F.col("id").isNotNull()
    classes = vector_classes(rows.filter(good))
    counted = _tiles(classes, min_similarity, missed, most_bands, flips, chunk_rows, planned_rows, pairs=False)
    links = counted.groupBy("node").agg(F.sum("n_links").alias("others"))
    keyed = classes.join(links, "node", "left").select("v", "class_id", "n", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    found = met(rows.filter(good), keyed, ["v"], max(1000, int(HOT_SHARE * rows.count())))
    alone = rows.filter(~good).select("id", F.col("id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"), F.lit(0).cast("bigint").alias("n_links"))
    return found.select("id", "class_id", F.col("n").alias("class_size"), "n_links").unionByName(alone)


def lsh_links(
    df: DataFrame, min_similarity: float, id_col: str = "id", vec_col: str = "embedding", missed: float = 1e-3,
    most_bands: int = 64, flips: int = 5, chunk_rows: int = 512, planned_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Links between classes (a, b, similarity), a < b, and membership (id, class_id); as ``lsh_neighbours``.

    Ids are unique here. A signature is the signs of random projections, cut into bands. A class is
    at home in one bucket of each band and is a guest in those that it reaches by flipping any of
    its ``flips`` least certain bits, so that a bounded number of bands is enough. Buckets with a
    single class are left out before vectors are attached; larger ones are cut into chunks, and
    tiles of two chunks compare exact cosines. A pair counts in one place only: its first band in
    which one finds the other, and there the bucket of the larger class if the smaller one is a
    guest in it.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.filter(_usable(F.col("v")) & F.col("id").isNotNull())
    classes = vector_classes(rows)
    found = _tiles(classes, min_similarity, missed, most_bands, flips, chunk_rows, planned_rows, pairs=True)
    name = lambda side: classes.select(F.col("node").alias(side), F.col("class_id").alias(f"{side}_id"))
    named = found.join(name("x"), "x").join(name("y"), "y")
    links = named.select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b"), "similarity")
    members = met(rows, classes.select("v", "class_id", "n"), ["v"], max(1000, int(HOT_SHARE * rows.count())))
    return links, members.select("id", "class_id")


def cross_links(
    queries: DataFrame, base: DataFrame, min_similarity: float, id_col: str = "id", vec_col: str = "embedding", missed: float = 1e-6,
    most_bands: int = 64, flips: int = 2, chunk_rows: int = 512, all_pairs: bool | None = None, seed: int = 7,
) -> DataFrame:
    """Pairs of two tables at or above a cosine: (query_id, base_id, similarity).

    Vectors are compared inside tiles and only pairs that are links leave them. A tile is a block
    of either table or, where bands of sign bits cost less (``all_pairs`` overrides this), a bucket
    that rows of both share. Vectors that are null, empty or zero or hold null or non-finite
    components, and null ids, have no pairs; nor have vectors of unequal length.
    """
    def side(df: DataFrame, number: int) -> DataFrame:
        rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
        return rows.filter(_usable(F.col("v")) & F.col("id").isNotNull()).withColumn("side", F.lit(number).cast("bigint"))

    both = stored(side(queries, 0).unionByName(side(base, 1)).select((F.monotonically_increasing_id() * 2 + F.col("side")).alias("node"), "id", "v"), "cross-rows")
    found = both.agg(F.count("*").alias("rows"), F.max(F.size("v")).alias("width")).first()
    bits, bands = plan_bands(found.rows, min_similarity, missed, most_bands, flips)
    if all_pairs is None:
        all_pairs = found.rows / 2 <= bands * 2**min(flips, bits) * (found.rows / 2**bits + CROSS_ENTRY_COST)
    if all_pairs:
        links = _all_cross(both, min_similarity, found.rows, found.width or 1)
    else:
        links = _banded(both.select("node", F.lit(1).cast("bigint").alias("n"), "v"), found.rows, bits, bands, min_similarity, flips, chunk_rows, pairs=True, cross=True, seed=seed)
        asks = F.col("x") % 2 == 0
        links = links.select(F.when(asks, F.col("x")).otherwise(F.col("y")).alias("x"), F.when(asks, F.col("y")).otherwise(F.col("x")).alias("y"), "similarity")
    name = lambda node, out: both.select(F.col("node").alias(node), F.col("id").alias(out))
    return links.join(name("x", "query_id"), "x").join(name("y", "base_id"), "y").select("query_id", "base_id", "similarity")


def _all_cross(both: DataFrame, least_cosine: float, rows: int, width: int) -> DataFrame:
    """Pairs (x, y, similarity) of even and odd nodes; a row is copied once a block of the other side."""
    blocks = max(1, min(BLOCKS, math.ceil(rows / 2048)), math.ceil(rows * width / (8 * MOST_CELLS)))
    dealt = both.select(F.size("v").alias("dims"), "node", "v", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("block"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asks = F.col("node") % 2 == 0
    spread = dealt.select(
        "dims", F.when(asks, F.col("block")).otherwise(F.col("other")).alias("i"), F.when(asks, F.col("other")).otherwise(F.col("block")).alias("j"), "node", "v")

    def tile(group: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = pd.concat(list(batches), ignore_index=True)
        unit, node = _unit(t["v"]), t["node"].to_numpy()
        left, right = np.flatnonzero(node % 2 == 0), np.flatnonzero(node % 2 == 1)
        rough = unit.astype(np.float32)
        low = np.float32(least_cosine - 2e-7 * (unit.shape[1] + 8))  # below by more than single precision can err
        for a in range(0, len(left), 1024):
            rows_a = left[a:a + 1024]
            for b in range(0, len(right), 4096):
                rows_b = right[b:b + 4096]
                x, y = np.nonzero(rough[rows_a] @ rough[rows_b].T >= low)
                for at in range(0, len(x), 65_536):
                    p, q = rows_a[x[at:at + 65_536]], rows_b[y[at:at + 65_536]]
                    cosines = np.clip((unit[p] * unit[q]).sum(axis=1), -1, 1)
                    close = cosines >= least_cosine
                    if close.any():
                        yield pd.DataFrame({"x": node[p[close]], "y": node[q[close]], "similarity": cosines[close]})

    return spread.groupBy("dims", "i", "j").applyInPandas(tile, PAIRS)


def _usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


PAIRS, COUNTS = "x bigint, y bigint, similarity double", "node bigint, n_links bigint"


def all_pairs_cheaper(rows: int, bits: int, bands: int, flips: int) -> bool:
    """Whether comparing all pairs once takes less than the entries of the bands and the pairs that meet in their buckets.

    Where a low cosine leaves short bands, pairs meet in several of them and all pairs are cheaper at any size.
    """
    probes = bands * 2**min(flips, bits)
    return rows / 2 <= probes * (rows / 2**bits + ENTRY_COST)


def _all_pairs(classes: DataFrame, least_cosine: float, rows: int, pairs: bool) -> DataFrame:
    """As ``_tiles``, but tiles of two blocks hold all pairs once; a row is copied once a block."""
    width = classes.agg(F.max(F.size("v"))).first()[0] or 1
    blocks = max(1, min(BLOCKS, math.ceil(rows / 1024)), math.ceil(rows * width / MOST_CELLS))
    dealt = classes.select("node", F.size("v").alias("dims"), F.col("n").alias("size"), "v", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("block"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    spread = dealt.select("dims", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "size", "v")

    def tile(group: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = pd.concat(list(batches), ignore_index=True)
        _, i, j = map(int, group)
        unit, node, size, block = _unit(t["v"]), t["node"].to_numpy(), t["size"].to_numpy(), t["block"].to_numpy()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        total = np.zeros(len(t), np.int64)
        for a in range(0, len(left), 1024):
            rows_a = left[a:a + 1024]
            for b in range(a if i == j else 0, len(right), 1024):
                rows_b = right[b:b + 1024]
                cosines = np.clip(unit[rows_a] @ unit[rows_b].T, -1, 1)
                close = cosines >= least_cosine
                x, y = np.nonzero(np.triu(close, 1) if i == j and a == b else close)
                if pairs:
                    yield pd.DataFrame({"x": node[rows_a[x]], "y": node[rows_b[y]], "similarity": cosines[x, y]})
                else:
                    np.add.at(total, rows_a[x], size[rows_b[y]])
                    np.add.at(total, rows_b[y], size[rows_a[x]])
        if not pairs:
            found = total > 0
            yield pd.DataFrame({"node": node[found], "n_links": total[found]})

    return spread.groupBy("dims", "i", "j").applyInPandas(tile, PAIRS if pairs else COUNTS)


def _tiles(classes: DataFrame, least_cosine, missed, most_bands, flips, chunk_rows, planned_rows, pairs: bool) -> DataFrame:
    """Pairs (x, y, similarity) of nodes, or (node, n_links) to be added up."""
    count = classes.count()
    bits, bands = plan_bands(planned_rows or count, least_cosine, missed, most_bands, flips)
    flips = min(flips, bits)
    if all_pairs_cheaper(planned_rows or count, bits, bands, flips):
        return _all_pairs(classes, least_cosine, count, pairs)
    return _banded(classes, count, bits, bands, least_cosine, flips, chunk_rows, pairs)


def _banded(classes: DataFrame, count: int, bits: int, bands: int, least_cosine, flips, chunk_rows, pairs: bool, cross: bool = False, seed: int = 7) -> DataFrame:
    """As ``_tiles``, by buckets of bands; with ``cross`` only even nodes meet odd ones."""
    flips = min(flips, bits)
    weights = 1 << np.arange(bits, dtype=np.int64)

    def signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes = {}
        for batch in batches:
            for dims, part in batch.groupby(batch["v"].map(len)):
                if dims not in planes:
                    planes[dims] = np.random.default_rng(seed).normal(size=(dims, bands * bits))
                m = np.vstack(part["v"].to_numpy()).astype(float)
                sides = (m / np.abs(m).max(axis=1, keepdims=True) @ planes[dims]).reshape(len(m), bands, bits)
                yield pd.DataFrame({
                    "node": part["node"], "dims": np.int32(dims), "size": part["n"], "v": part["v"],
                    "keys": list((sides > 0) @ weights), "masks": list(_weak(np.abs(sides), flips) @ weights)})

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chosen = (np.arange(1 << flips)[:, None] >> np.arange(flips)) & 1  # every subset of the flipped bits
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.iloc[start:start + 256]
                if not len(part):
                    continue
                keys, masks = np.vstack(part["keys"].to_numpy()), np.vstack(part["masks"].to_numpy())
                on = (masks[:, :, None] & weights) != 0
                single = np.broadcast_to(weights, on.shape)[on].reshape(*keys.shape, flips)
                probes = keys[:, :, None] ^ (single @ chosen.T.astype(np.int64))
                n = probes.shape[1] * probes.shape[2]
                yield pd.DataFrame({
                    "node": np.repeat(part["node"].to_numpy(), n), "dims": np.repeat(part["dims"].to_numpy(), n),
                    "band": np.tile(np.repeat(np.arange(bands, dtype=np.int32), probes.shape[2]), len(part)),
                    "key": probes.ravel(), "home": np.tile(np.arange(probes.shape[2]) == 0, len(part) * bands)})

    signed = stored(classes.select("node", "n", "v").mapInPandas(signatures, SIGNATURE), "vector-signatures")
    bucket = ["dims", "band", "key"]
    asked = signed.select("node", "dims", "keys", "masks").mapInPandas(entries, ENTRY)
    sizes = asked.groupBy(*bucket).agg(F.count("*").alias("n"), F.max("home").alias("owned")).filter("owned AND n > 1")
    sizes = stored(sizes.select(*bucket, "n", F.ceil(F.col("n") / chunk_rows).cast("int").alias("chunks")), "vector-buckets")
    least = max(1000, int(HOT_SHARE * count * bands * (1 << flips)))
    placed = met(asked, sizes, bucket, least).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    # a large bucket makes groups of its own, small ones share groups of about a chunk
    small = sizes.filter("chunks = 1").agg(F.sum("n")).first()[0] or 0
    hashed = F.xxhash64(*bucket)
    slot = F.when(F.col("chunks") > 1, hashed).otherwise(F.pmod(hashed, F.lit(math.ceil(small / chunk_rows) or 1)))
    spread = placed.select(*bucket, slot.alias("slot"), F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "home", "node")
    full = spread.join(signed.select("node", "size", "v", "keys", "masks"), "node")

    def tile(group: tuple, t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(["band", "key"], ignore_index=True)
        x, y, cosines = _found(t, int(group[2]), int(group[3]), least_cosine, cross)
        nodes, size = t["node"].to_numpy(), t["size"].to_numpy()
        if pairs:
            return pd.DataFrame({"x": nodes[x], "y": nodes[y], "similarity": cosines})
        found, at = np.unique(np.concatenate([nodes[x], nodes[y]]), return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, at, np.concatenate([size[y], size[x]]))
        return pd.DataFrame({"node": found, "n_links": total})

    return full.groupBy("dims", "slot", "i", "j").applyInPandas(tile, PAIRS if pairs else COUNTS)


def _found(t: pd.DataFrame, i: int, j: int, least_cosine: float, cross: bool = False):
    """(row, row, cosine) of the pairs at or above the cosine that count here; rows go by bucket."""
    unit, keys, masks = _unit(t["v"]), np.vstack(t["keys"].to_numpy()), np.vstack(t["masks"].to_numpy())
    chunk, home, node, bands = (t[c].to_numpy() for c in ("chunk", "home", "node", "band"))
    own = t["key"].to_numpy()
    starts = np.flatnonzero(np.r_[True, (bands[1:] != bands[:-1]) | (own[1:] != own[:-1])])
    parts = [(np.empty(0, int), np.empty(0, int), np.empty(0))]
    for start, stop in zip(starts, [*starts[1:], len(t)]):
        rows = np.arange(start, stop)
        left, right = rows[chunk[start:stop] == i], rows[chunk[start:stop] == j]
        cosines = np.clip(unit[left] @ unit[right].T, -1, 1)
        close = (cosines >= least_cosine) & (home[left][:, None] | home[right][None, :])
        if cross:
            close &= (node[left] % 2)[:, None] != (node[right] % 2)[None, :]
        at = np.nonzero(np.triu(close, 1) if i == j else close)
        x, y, score = left[at[0]], right[at[1]], cosines[at]
        band = bands[start]
        for earlier in range(band):
            if not len(x):
                break
            gap = keys[x, earlier] ^ keys[y, earlier]
            new = ((gap & ~masks[x, earlier]) != 0) & ((gap & ~masks[y, earlier]) != 0)
            if not new.all():
                x, y, score = x[new], y[new], score[new]
        # the smaller node is the guest, unless it does not reach the larger one's home
        gap = keys[x, band] ^ keys[y, band]
        first = node[x] < node[y]
        reaches = (gap & ~masks[np.where(first, x, y), band]) == 0
        here = (gap == 0) | (home[np.where(first, y, x)] == reaches)
        parts.append((x[here], y[here], score[here]))
    return tuple(np.concatenate(c) for c in zip(*parts))


def _unit(v: pd.Series) -> np.ndarray:
    m = np.vstack(v.to_numpy()).astype(float)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))
