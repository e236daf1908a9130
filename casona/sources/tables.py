"""Table reads and writes, page arrivals, reference tables and the publish sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casona import refdata, schemas
from casona.session import small_table


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """A table by name under a root folder; ``schema`` is required for text formats."""
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    elif fmt in ("json", "csv"):
        raise ValueError(f"{fmt} needs a declared schema")
    return reader.load(f"{root}/{name}.parquet" if fmt == "parquet" else f"{root}/{name}")


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str, lower: str, upper: str, partitions: int,
    **options: str,
) -> DataFrame:
    """A database table read by parallel range queries over ``partition_column``."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
        numPartitions=str(partitions), **options,
    ).load()


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet table; partition by low-cardinality filter columns such as status or region_slug."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_raw_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Fetched pages (source, url, html, fetched_at)."""
    return spark.read.format(fmt).schema(schemas.RAW_PAGE).load(path)


def stream_raw_pages(spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int = 1000) -> DataFrame:
    """Page files as they arrive in a folder."""
    return (
        spark.readStream.format(fmt)
        .schema(schemas.RAW_PAGE)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
    )


def reference_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Seed tables of the model; each a handful of rows fixed in ``casona.refdata``."""
    region = [(slug, name, None, None, order) for slug, name, order in refdata.REGIONS]
    return {
        "regions": small_table(
            spark, region, "slug string, name string, parent_region string, bbox string, display_order int"),
        "region_boxes": small_table(
            spark, [(i, *box) for i, box in enumerate(refdata.REGION_BOXES)],
            "ord int, region_slug string, min_lat double, max_lat double, min_lng double, max_lng double"),
        "localities": small_table(
            spark, [(i, key, region) for i, (key, region) in enumerate(refdata.GAZETTEER)],
            "ord int, locality string, region_slug string"),
        "airports": small_table(
            spark, refdata.AIRPORTS, "code string, name string, type string, lat double, lng double, region_slug string"),
        "hospitals": small_table(
            spark, refdata.HOSPITALS, "name string, type string, lat double, lng double, region_slug string"),
        "schools": small_table(
            spark, refdata.SCHOOLS, "name string, level string, lat double, lng double, region_slug string"),
        "beaches": small_table(
            spark, refdata.BEACHES, "name string, lat double, lng double, region_slug string"),
        "categories": small_table(spark, refdata.CATEGORIES, "slug string, name string, display_order int"),
        "features": small_table(spark, [(f,) for f in refdata.FEATURE_VOCAB], "feature string"),
        "tags": small_table(spark, [(t,) for t in refdata.TAG_VOCAB], "tag string"),
        "sources": small_table(spark, refdata.SOURCES, "slug string, name string, base_url string"),
        "model_prices": small_table(spark, refdata.MODEL_PRICES, "family string, input double, output double"),
    }


def publish_export(documents: DataFrame, log: DataFrame, path: str, fmt: str = "json", dry_run: bool = False) -> None:
    """Write publish documents and their log rows; a dry run writes the log only."""
    if not dry_run:
        documents.write.mode("overwrite").format(fmt).save(f"{path}/documents")
    log.write.mode("overwrite").format(fmt).save(f"{path}/sync_log")
