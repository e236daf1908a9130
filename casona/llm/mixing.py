"""Mixing sources to target weights with Efraimidis-Spirakis keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casona.operators.ranking import running_totals
from casona.session import stored

WORD = r"[^\x20\x09-\x0D]+"
MARK = r"[!-/:-@\[-`{-~]"
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
SEED = "17"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def text_weight(text: Column) -> Column:
    """Quality weight in (0, 1]: the larger the share of ASCII punctuation, the smaller."""
    marks = F.coalesce(F.regexp_count(text, F.lit(MARK)), F.lit(0)).cast("double")
    return F.lit(1.0) / (F.lit(1.0) + F.lit(20.0) * marks / F.greatest(F.coalesce(F.length(text), F.lit(0)), F.lit(1)).cast("double"))


def race_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """-ln(u) / weight with u in (0, 1) from the id: in ascending order, a weighted draw without replacement."""
    digits = F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":" + seed)).cast("binary")), 1, 12)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**48))
    return -F.log(uniform) / weight


def row_key(doc_id: Column, source: Column, text: Column) -> Column:
    """Digest of what makes a document one of its own; nulls differ from all values."""
    said = [F.coalesce(F.sha2(c.cast("string").cast("binary"), 256), F.lit("")) for c in (doc_id, source, text)]
    return F.unhex(F.sha2(F.concat_ws("|", *said).cast("binary"), 256))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one short row a source.

    Sources in code point order, null last, take ``weights`` in turn. The targets share the sum of
    all sizes by weight; none exceeds ``most_repeats`` times its source's size, and what lies above
    goes to the others by weight. With sources in ascending order of that limit per unit of weight,
    those at their limit come first, so running sums find the share of the rest.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = ranked.withColumn("w", turn.cast("double")).withColumn("most", (F.col("source_size") * most_repeats).cast("double"))
    order = Window.orderBy(F.col("most") / F.col("w"), "rank")
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("rest", F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("rest_w", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("place", F.row_number().over(order))
    )
    below = F.when(F.col("most") * F.col("rest_w") >= F.col("w") * F.col("rest"), F.struct("place", "rest", "rest_w"))
    rows = rows.withColumn("cut", F.min(below).over(everything))
    share = F.col("w") * F.col("cut.rest") / F.col("cut.rest_w")
    return rows.select("source", "source_size", F.when(F.col("place") < F.col("cut.place"), F.col("most")).otherwise(share).alias("target"))


def mix(
    docs: DataFrame, weight: Column | None = None, weights: tuple = WEIGHTS, most_repeats: int = MOST_REPEATS,
    seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, row_key): words that the mix takes from every document.

    A source whose target holds e times its size gives every document e times; the rest of the
    target is drawn by ascending race key, and the last document drawn gives the words still
    missing, so the words of a source sum up to its target, rounded down. ``weight`` is the
    documents' quality weight (default: ``text_weight``). A null or empty text has size 0 and gives
    0. Rows that repeat an id, null included, are documents of their own; ``row_key`` tells them
    apart unless source and text repeat too. Reruns agree; no rows give no rows.

    Text is read once; the rest works on short rows. These are range partitioned by (source, key),
    so a hot source fills many buckets; sums of buckets give what comes before each, and only
    inside a bucket rows are summed in order.
    """
    text = F.col(text_col)
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text).alias("size"),
            race_key(F.col(id_col), text_weight(text) if weight is None else weight, seed).alias("key"),
            row_key(F.col(id_col), F.col(source_col), text).alias("row_key")), "mix-sizes")
    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(
        rows.repartitionByRange(buckets, F.asc_nulls_last("source"), "key", "doc_id", "size", "row_key")
        .withColumn("bucket", F.spark_partition_id()), "mix-order")
    sums = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most_repeats)
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0))).drop("words")
    plan = sums.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).select(
        F.col("b.source").alias("s"), F.col("b.bucket").alias("k"), "ahead", "source_size", "target")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "row_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("k")))
    words = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(words / F.greatest("source_size", F.lit(1)))).otherwise(0)
    rest = words - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before") - F.col("ahead")))
    return placed.select("doc_id", "size", "source_size", "target", (epochs * F.col("size") + part).cast("bigint").alias("taken"), "source", "row_key")


def _with_taken(
    docs: DataFrame, plan: DataFrame, id_col: str, text_col: str, source_col: str,
) -> DataFrame:
    """(row, size, taken): the documents that ``plan`` takes words of, whole, with what it takes of each.

    Rows of one key are equal in id, source and text, so any of them may give what the plan takes
    from another. Mostly all give the same. A key whose rows give unequal parts (where a source's
    target is reached: about one a source) has its rows numbered, and the first ones give more.
    """
    want = stored(plan.groupBy(F.col("row_key").alias("want")).agg(
        F.max("size").alias("size"), F.count("*").alias("rows"), F.sum("taken").alias("sum"),
        F.min("taken").alias("least"), F.max("taken").alias("most")).filter("sum > 0"), "mix-wanted")
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), row_key(F.col(id_col), F.col(source_col), F.col(text_col)).alias("key"))
    same = F.col("key") == F.col("want")
    out = keyed.join(want.filter("least = most"), same).select("row", "size", F.col("most").alias("taken"))
    torn = stored(want.filter("least < most"), "mix-torn")
    if torn.isEmpty():
        return out
    rows = keyed.join(torn, same).withColumn("number", F.monotonically_increasing_id())
    order = [F.col("row").getField(c) for c in docs.columns if c not in (id_col, source_col, text_col)] + [F.col("number")]
    rows = running_totals(rows, ["key"], order, {"place": F.lit(1)})
    epochs = F.floor(F.col("least") / F.col("size")) * F.col("size")
    left = F.col("sum") - F.col("rows") * epochs - (F.col("place") - 1) * F.col("size")
    rows = rows.withColumn("taken", epochs + F.greatest(F.lit(0), F.least(F.col("size"), left))).filter("taken > 0")
    return out.unionByName(rows.select("row", "size", "taken"))


def mixed(
    docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_cols: tuple = ("n_chars",),
    source_col: str = "source",
) -> DataFrame:
    """The documents of a mix, with their own columns: each as often as it is taken whole.

    A last part of a document has its first words, joined by one space; columns of ``size_cols``
    follow the text. ``plan`` is what ``mix`` gives for ``docs``; documents it does not take drop
    out. Rows with a null or repeated id give what the plan takes from each of them.
    """
    rows = _with_taken(docs, plan, id_col, text_col, source_col).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.ceil(F.col("taken") / F.col("size")).cast("bigint"))))
    part = F.least(F.col("size"), F.col("taken") - (F.col("copy") - 1) * F.col("size"))
    text = F.col("row").getField(text_col)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = rows.withColumn("part", part).withColumn("cut", F.when(
        F.col("part") < F.col("size"), F.array_join(F.slice(words, F.lit(1), F.col("part").cast("int")), " ")))

    def column(c: str) -> Column:
        old = F.col("row").getField(c)
        if c == text_col:
            return F.coalesce("cut", old).alias(c)
        return (F.when(F.col("cut").isNotNull(), F.length("cut").cast("bigint")).otherwise(old) if c in size_cols else old).alias(c)

    return rows.select(*map(column, docs.columns))
