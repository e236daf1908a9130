"""From raw documents to packed training sequences, in five stages.

Each stage reads what its predecessor kept, written as Parquet in the shared folder, and all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casona.llm import minhash_dedup, mixing, packing, quality_net, secrets
from casona.llm.places import placed
from casona.llm.queries import table, tokenizer
from casona.session import stored

LEAST_QUALITY = 0.3
#: Word shingles of five, similar by 80 % or more.
SKETCH = {"words": 5, "percent": 80, "bands": 48, "rows": 6}


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network does not reject; it learns from the labelled rows outside fold 0."""
    labels = table(spark, sf_dir, "labels").filter(~quality_net.held_out("doc_id", 5, 0))
    name = "quality_score" + "_" * max(map(len, docs.columns))  # no column of the documents
    scored = quality_net.score(docs, quality_net.fit(docs, labels), out=name)
    return scored.filter(F.col(name) >= LEAST_QUALITY).select(*docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id, null ids last, then the smallest digest of its text.

    Rows are nodes of their own, so equal texts without an id are copies like any others, and rows
    that share an id but not their text both stay. A node is made of a row's file and its place in
    it, the same whenever and by however many executors the table is read.
    """
    docs, node = placed(docs)
    rows = docs.select(node.alias("node"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    found = minhash_dedup.near_copies(rows.select("node", "row.text"), minhash_dedup.Sketch(**SKETCH), id_col="node")
    order = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.xxhash64("row.text"), F.col("node"))
    places = rows.select("node", order.alias("place")).join(found.select("node", "component_id"), "node")
    keep = places.groupBy("component_id").agg(F.min("place").alias("place")).select(F.col("place.node").alias("node"))
    return rows.join(keep, "node", "left_semi").select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets and linked parts of credentials in them replaced by a mark."""
    return secrets.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs, mixing.mix(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 ids."""
    return packing.packed(docs, tokenizer("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality classifier", good), ("near-dedup", distinct), ("secret scans", without_secrets), ("mixing", mixed), ("packing", sequences),
]

#: A trained network and a tokenizer decide; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
