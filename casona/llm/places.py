"""Numbers of rows that hold however often, and by however many executors, a written table is read."""

from __future__ import annotations

from itertools import count

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from casona.session import stored


def _head(path: Column, seed: int, low: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), path), low + 1)


def placed(docs: DataFrame) -> tuple[DataFrame, Column]:
    """``docs`` and a column over it: a whole number from 0 that no other row has.

    Its upper bits are a hash of the row's file, its lower bits the row's place in that file, so
    it does not depend on how a scan deals files to tasks, which follows the cores at hand. The
    bits are cut by the longest file, and the hash gets the first seed under which all files
    differ; both are counted, none is assumed. What is not a Parquet table as it was read (made
    rows, filtered or joined ones: told by number, sum and squares of each file's places) is
    written first. An empty table has no numbers.
    """
    try:
        file = docs.metadataColumn("_metadata")
        path, place = file.getField("file_path"), file.getField("row_index")
        files = docs.select(path.alias("path"), place.alias("place")).groupBy("path").agg(
            F.max("place").cast("decimal(18,0)").alias("last"), F.count("*").alias("rows"), F.sum("place").alias("sum"),
            F.sum(F.col("place").cast("decimal(14,0)") * F.col("place").cast("decimal(14,0)")).alias("squares"))
    except AnalysisException:  # no table of files, or one without places
        return placed(stored(docs, "placed"))
    files = stored(files, "placed-files")
    last = F.col("last")
    whole = (F.col("rows") == last + 1) & (2 * F.col("sum") == last * (last + 1)) & (6 * F.col("squares") == last * (last + 1) * (2 * last + 1))
    found = files.agg(F.count("*").alias("n"), F.max("last").alias("last"), F.every(whole).alias("whole")).first()
    if found.n and not found.whole:
        return placed(stored(docs, "placed"))
    low = int(found.last or 0).bit_length()
    for seed in count():
        if files.select(_head(F.col("path"), seed, low).alias("head")).distinct().count() == found.n:
            return docs, F.shiftleft(_head(path, seed, low), low).bitwiseOR(place)
