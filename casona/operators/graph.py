"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from casona.session import checkpoint

#: A node with more than this share of all edges is joined by broadcast; there are at most 2 / share such nodes.
HOT_SHARE = 0.001
#: Edges that a partition holds at least, so that small tables are not dealt over many near-empty files.
EDGES_A_PARTITION = 20_000
#: Up to so many edges (16 MB of whole numbers) the rows of one node, however many, fit a task with room to spare.
FEW_EDGES = 1_000_000


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of edges (a, b); the component is its smallest node.

    Alternating star contraction. An edge is kept as (hi, lo). A large star sends the higher
    neighbours of a node to the smallest node around it, a small star does so with the lower
    ones. Both keep components whole, and the edges end as one star around each smallest node,
    after a number of rounds that grows with the logarithm of the longest chain. A round is two
    aggregates that combine before their shuffle and two joins; edges of the few nodes that have
    a large share of them all stay where they are and meet these nodes' rows by broadcast. Up to
    ``FEW_EDGES`` edges a round is two windows instead: that plan of joins, some thirty scans of the
    edges, takes more of the driver's memory than such tables are worth. A round ends in a reliable
    checkpoint, so a lost executor repeats one round only. Its tables have as many partitions as
    their edges need, since every partition of a shuffle costs files.

    Nulls, loops and repeated edges are ignored. Without edges the result is empty.
    """
    kind = edges.schema["a"].dataType
    stars = checkpoint(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"), "a", "b")
        .filter("a <> b").select(F.col("hi").cast(kind), F.col("lo").cast(kind)).distinct()
    )
    before = _fingerprint(stars)
    while before[0]:
        few = -(-before[0] // EDGES_A_PARTITION)
        stars = stars.coalesce(few)
        if before[0] <= FEW_EDGES:
            stars = checkpoint(_round_of_few(stars, few).coalesce(few))
        else:
            least = max(1000, int(HOT_SHARE * before[0]))
            stars = checkpoint(_small_star(_large_star(stars, least).coalesce(few), least).coalesce(few))
        after = _fingerprint(stars)
        if after == before:
            break
        before = after
    heads = stars.select(F.col("lo").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return stars.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(heads)


def _fingerprint(stars: DataFrame) -> tuple:
    row = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.hash("lo", "hi").cast("long"))).first()
    return tuple(row)


def _round_of_few(stars: DataFrame, few: int) -> DataFrame:
    """Both stars, each in one pass over the edges of a node; every step has one row for an edge.

    Neighbours lower than a node are on its edges as ``hi``: the smallest of them, or the node
    itself, comes with each of its edges as ``lo``.
    """
    ends = F.array(
        F.struct(F.col("hi").alias("node"), F.col("lo").alias("low"), F.lit(None).cast(stars.schema["hi"].dataType).alias("high")),
        F.struct(F.col("lo").alias("node"), F.col("lo").alias("low"), F.col("hi").alias("high")))
    large = stars.select(F.inline(ends)).select("high", F.min("low").over(Window.partitionBy("node")).alias("lo"))
    large = large.filter("high IS NOT NULL").select(F.col("high").alias("hi"), "lo").coalesce(few)
    small = large.select("hi", "lo", F.min("lo").over(Window.partitionBy("hi")).alias("lowest")).coalesce(few)
    return small.select(F.when(F.col("lo") == F.col("lowest"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("lowest").alias("lo")).distinct()


def _joined(stars: DataFrame, nodes: DataFrame, key: str, value: str, least: int) -> DataFrame:
    """Edges with ``value`` of their node ``key``; nodes (key, value, n) with over ``least`` edges are broadcast.

    All n add up to at most twice the edges, and ``least`` is a share of these, so the broadcast
    side has at most 2 / HOT_SHARE rows.
    """
    hot = nodes.filter(F.col("n") > least).select(F.col(key).alias("_node"), F.col(value).alias("_value"))
    met = stars.join(F.broadcast(hot), F.col(key) == F.col("_node"), "left")
    cold = nodes.filter(F.col("n") <= least).select(key, value)
    return met.filter("_node IS NOT NULL").select("hi", "lo", F.col("_value").alias(value)).unionByName(
        met.filter("_node IS NULL").select("hi", "lo").join(cold, key).select("hi", "lo", value))


def _large_star(stars: DataFrame, least: int) -> DataFrame:
    """(hi, smallest node among lo and lo's neighbours)."""
    around = (
        stars.select(F.col("hi").alias("lo"), F.col("lo").alias("near"))
        .unionByName(stars.select("lo", F.col("hi").alias("near")))
        .groupBy("lo").agg(F.min("near").alias("near"), F.count("*").alias("n"))
    )
    return _joined(stars, around, "lo", "near", least).select("hi", F.least("lo", "near").alias("lo")).distinct()


def _small_star(stars: DataFrame, least: int) -> DataFrame:
    """Lower neighbours of a node, and the node itself, hang on the smallest of them."""
    lowest = stars.groupBy("hi").agg(F.min("lo").alias("lowest"), F.count("*").alias("n"))
    moved = _joined(stars, lowest, "hi", "lowest", least).filter("lo <> lowest").select(F.col("lo").alias("hi"), F.col("lowest").alias("lo"))
    return moved.unionByName(lowest.select("hi", F.col("lowest").alias("lo"))).distinct()
