"""Session helper and the checkpoint folder that iterative jobs cut lineage with."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def get_spark(app: str = "casona", cores: str = "*", shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the session it hands out."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # methods beyond 8000 bytes of bytecode are never compiled by the JVM: use smaller ones
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # call-site capture per column doubles the time to build long expressions
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def small_table(spark: SparkSession, rows: Sequence, ddl: str) -> DataFrame:
    """Fixed rows (tuples or dicts) as a table whose size Spark knows, so that joins to it broadcast.

    ``createDataFrame`` from Python rows hides the size and would make every join to a handful of
    lookup rows a shuffle of the big side on very few keys.
    """
    names = T.StructType.fromDDL(ddl).names
    records = [r if isinstance(r, dict) else dict(zip(names, r)) for r in rows]
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(records)), f"array<struct<{_colons(ddl)}>>")))


def _colons(ddl: str) -> str:
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(ddl).fields)


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``; made only on a local master (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix=f"casona-{os.getpid()}-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; cuts the lineage of iterative jobs."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: its lineage ends there."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
