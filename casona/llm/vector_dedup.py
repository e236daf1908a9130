"""Near copies of vectors: int8 tile products with proven error bounds, doubtful pairs in full precision.

A unit vector u is kept as s * q with whole q in -127..127. With e = |u - s q| and Cauchy's
inequality, |u.w - (s q).(t r)| <= e_u * |t r| + e_w for unit vectors, so a pair whose rounded
product plus this bound stays below the threshold cannot be a link. All others are recomputed
in double precision, and only they decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casona.llm.vectors import matrix, usable
from casona.operators.graph import connected_components
from casona.session import stored

BLOCK_ROWS = 2048
STEP_ROWS = 512
#: What rounding in double arithmetic can add to a cosine.
SLACK = 1e-9


def near_copies(
    vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
    group_col: str = "label", block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row.

    Rows link if their groups are equal and not null, their lengths are equal and their cosine in
    double precision is at least ``threshold``. Vectors that are null, empty or zero, or hold null
    or non-finite components, link with nothing and are their own component. Equal vectors are
    compared once and count as often as they occur; rows that repeat an id are rows of their own
    in n_links and one node of the components. A null id is kept and has a null component. An
    empty table gives no rows.

    A group is cut into blocks by a hash, and a task compares two blocks: a hot group means more
    tasks. Of its links a task returns only sums and a spanning forest, never all pairs.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), F.col(vec_col).alias("v"))
    fit = usable(F.col("v")) & F.exists("v", lambda x: x != 0) & F.col("grp").isNotNull() & F.col("id").isNotNull()
    fit = F.coalesce(fit, F.lit(False))
    heads = stored(
        rows.filter(fit).groupBy("grp", "v").agg(F.min("id").alias("head"), F.count("*").alias("copies")), "vector-heads"
    )
    sizes = heads.groupBy("grp", F.size("v").alias("width")).agg(
        F.ceil(F.count("*") / F.lit(float(block_rows))).cast("int").alias("blocks"))
    placed = heads.withColumn("width", F.size("v")).join(sizes, ["grp", "width"])
    own = F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")
    spread = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiled = spread.select(
        "grp", "width", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "head", "copies", "v")

    def tile(table: pa.Table) -> pa.Table:
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        own = table["own"].to_numpy()
        left = table.filter(pa.array(own == i))
        right = left if i == j else table.filter(pa.array(own == j))
        where, count, root = linked(
            matrix(left["v"], np.float64), left["copies"].to_numpy(), matrix(right["v"], np.float64), right["copies"].to_numpy(),
            threshold, same=i == j)
        both = left if i == j else pa.concat_tables([left, right])
        took = both.take(pa.array(where))
        return pa.table({
            "grp": took["grp"], "v": took["v"], "head": took["head"], "links": count, "root": both["head"].take(pa.array(root)),
        })

    kinds = {f.name: f.dataType.simpleString() for f in heads.schema}
    found = stored(
        tiled.groupBy("grp", "width", "i", "j")
        .applyInArrow(tile, f"grp {kinds['grp']}, v {kinds['v']}, head {kinds['head']}, links bigint, root {kinds['head']}"),
        "vector-links")
    copies = rows.filter(fit).join(heads.filter("copies > 1").select("grp", "v", "head", "copies"), ["grp", "v"])
    parts = connected_components(
        found.select(F.col("head").alias("a"), F.col("root").alias("b"))
        .unionByName(copies.select(F.col("id").alias("a"), F.col("head").alias("b")))
    )
    counts = heads.select("grp", "v", F.lit(0).cast("bigint").alias("links"), "copies").unionByName(
        found.select("grp", "v", "links", F.lit(0).cast("bigint").alias("copies")))
    counts = counts.groupBy("grp", "v").agg((F.sum("links") + F.sum("copies") - 1).alias("n_links")).filter("n_links > 0")
    out = rows.join(counts, ["grp", "v"], "left").select("id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))
    return out.join(parts, "id", "left").select(
        F.col("id").alias(id_col), "n_links", F.coalesce("component", "id").alias("component_id"),
        F.coalesce("component", "id").eqNullSafe(F.col("id")).alias("kept"))


def linked(
    a: np.ndarray, a_copies: np.ndarray, b: np.ndarray, b_copies: np.ndarray, threshold: float, same: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with links in a tile (b's follow a's): row, number of vectors linked, row of their tree's root."""
    shift = 0 if same else len(a)
    total = len(a) + (0 if same else len(b))
    count, parent = np.zeros(total, np.int64), np.arange(total)
    ua, ub = _unit(a), _unit(b)
    (qa, sa, ea), (qb, sb, eb) = _rounded(ua), _rounded(ub)
    size_b = sb * np.linalg.norm(qb.astype(np.float64), axis=1)
    for start in range(0, len(a), STEP_ROWS):
        rows = slice(start, start + STEP_ROWS)
        close = (qa[rows] @ qb.T).astype(np.float64) * sa[rows, None] * sb + ea[rows, None] * size_b + eb
        i, j = np.nonzero(close >= threshold - SLACK)
        i = i + start
        if same:
            i, j = i[i < j], j[i < j]
        sure = _cosine(a, b, i, j) >= threshold
        i, j = i[sure], j[sure]
        np.add.at(count, i, b_copies[j])
        np.add.at(count, j + shift, a_copies[i])
        parent = _joined(parent, i, j + shift)
    where = np.flatnonzero(count)
    return where, count[where], parent[where]


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # squares can neither overflow nor vanish
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _rounded(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers in the int8 range, their scale, and the length of what rounding left out."""
    scale = np.abs(u).max(axis=1) / 127
    q = np.rint(u / scale[:, None])
    # products of int8 are summed exactly by float32 up to 2**24
    kind = np.float32 if u.shape[1] * 127 * 127 < 2**24 else np.float64
    return q.astype(np.int8).astype(kind), scale, np.linalg.norm(u - q * scale[:, None], axis=1)


def _cosine(a, b, i, j, step: int = 65536) -> np.ndarray:
    """dot / (|a| |b|) in double precision for the pairs."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    parts = [
        np.einsum("nd,nd->n", a[i[s:s + step]], b[j[s:s + step]]) / (na[i[s:s + step]] * nb[j[s:s + step]])
        for s in range(0, len(i), step)
    ]
    return np.concatenate(parts) if parts else np.empty(0)


def _joined(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Trees of ``parent`` (flat) after joining the pairs, flat again; the smallest row is the root."""
    while len(i):
        x, y = parent[i], parent[j]
        apart = x != y
        if not apart.any():
            break
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    return parent
