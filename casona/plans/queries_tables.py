"""Queries over table reads and writes: everything goes through the shared folder once."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casona.operators import sync
from casona.plans.catalog import query
from casona.plans.queries_search import CANON_SQL, canon
from casona.session import shared_folder
from casona.sources import tables


def _folder(t, label: str) -> str:
    return f"{shared_folder(t.spark)}/{label}-{uuid.uuid4().hex}"


@query("write_and_read_table", "SELECT id, status, price FROM v_listings WHERE status = 'active'")
def write_and_read_table(t):
    """Listings written by status and read back; the filter reads one partition."""
    root = _folder(t, "tables")
    tables.write_table(t.v_listings.select("id", "status", "price"), f"{root}/listings.parquet", partition_by=["status"])
    return tables.read_table(t.spark, root, "listings").filter("status = 'active'").select("id", F.col("status").cast("string"), "price")


@query("read_raw_pages", "SELECT source, url, octet_length(encode(html)) AS bytes FROM v_details")
def read_raw_pages(t):
    """Fetched pages written as JSON lines and read with the declared schema."""
    path = _folder(t, "pages")
    pages = t.v_details.select("source", "url", "html", F.lit("2024-06-01").cast("timestamp").alias("fetched_at"))
    pages.write.json(path)
    return tables.read_raw_pages(t.spark, path, "json").select("source", "url", F.octet_length("html").cast("bigint").alias("bytes"))


EXPORTED = """
    SELECT id, coalesce(nullif(title_en, ''), nullif(title_es, ''), '(untitled listing)') AS title, 'success' AS status FROM c"""


@query("publish_export", f"""
    WITH c AS ({CANON_SQL}) {EXPORTED}
    UNION ALL SELECT id, NULL, 'dry_run' FROM c""")
def publish_export(t):
    """Documents with their log, and a dry run that leaves a log only."""
    rows = canon(t).withColumns({"year_built": F.lit(None).cast("int"), "hoa_fee_usd": F.col("hoa_fee")})
    documents = sync.publish_documents(rows).select("id", "post.title")
    log = documents.select(F.col("id").alias("canonical_id"), F.lit("success").alias("status"))
    real, dry = _folder(t, "export"), _folder(t, "export")
    tables.publish_export(documents, log, real)
    tables.publish_export(documents, log.withColumn("status", F.lit("dry_run")), dry, dry_run=True)
    sent = tables.read_table(t.spark, real, "documents", "json", "id bigint, title string")
    logged = tables.read_table(t.spark, real, "sync_log", "json", "canonical_id bigint, status string")
    tried = tables.read_table(t.spark, dry, "sync_log", "json", "canonical_id bigint, status string")
    return sent.join(logged, sent.id == logged.canonical_id).select("id", "title", "status").unionByName(
        tried.select(F.col("canonical_id").alias("id"), F.lit(None).cast("string").alias("title"), "status"))
