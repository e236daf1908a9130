"""Secrets in texts, and weaker parts of credentials reported where complementary parts lie close by.

DataFrame functions only. Every kind of part is a pattern; the pieces between its matches and the
matches' own lengths give positions in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casona.session import stored

# fixed values: the patterns that the three base kinds are defined by
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # runs below 16 would be dropped anyhow
LEAST_VALUE, LEAST_ACCESS = 12, 18

# weak parts: names of accounts, addresses of services, long tokens of mixed characters, and short
# matches of the patterns above
IDENTIFIER = r"""(?i:user(?:_?name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
# any scheme; the look behind keeps the search for one to one scan a token, so digits and marks before it belong to the match
ENDPOINT = r"""(?:(?<![A-Za-z0-9+.-])[0-9+.-]*+[A-Za-z][A-Za-z0-9+.-]*+://|(?i:jdbc):)[^\x20\x09-\x0D"'<>]+"""
# the look behind keeps the look ahead to one scan a token
BLOB = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}"

#: kind: (pattern, role, part of the base result)
KINDS = {
    "assign": (ASSIGN, "secret", True), "access": (ACCESS, "id", True), "hex": (HEX, "secret", True),
    "identifier": (IDENTIFIER, "id", False), "endpoint": (ENDPOINT, "endpoint", False), "blob": (BLOB, "secret", False),
    "short_assign": (ASSIGN, "secret", False), "short_access": (ACCESS, "id", False),
}
#: Kinds whose matches below the least length are of a weak kind.
SHORT = {"assign": "short_assign", "access": "short_access"}
#: Code points between the end of one part of a credential and the start of another, at most.
SCOPE = 240


def _kind(pattern: str, match: Column) -> Column:
    """The kind that a match of the pattern of kind ``pattern`` is of; null for none."""
    if pattern == "assign":
        return F.when(F.length(F.regexp_extract(match, ASSIGN, 1)) >= LEAST_VALUE, pattern).otherwise(SHORT[pattern])
    if pattern == "access":
        return F.when(F.length(match) >= LEAST_ACCESS, pattern).otherwise(SHORT[pattern])
    if pattern == "blob":
        return F.when(match.rlike("[a-z]") & match.rlike("[A-Z]"), pattern)
    return F.lit(pattern)


def _found(kind: str, text: Column) -> Column:
    """Array of (pattern, length of the text before the match and after the last one, length of the match, its kind)."""
    pattern = KINDS[kind][0]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    row = lambda m, p: F.struct(
        F.lit(kind).alias("pattern"), F.length(p).alias("gap"), F.length(m).alias("width"), _kind(kind, m).alias("kind"))
    zipped = F.filter(F.zip_with(matches, F.split(text, pattern, -1), row), lambda x: x["width"].isNotNull())
    return F.when(text.rlike(pattern), zipped).otherwise(F.array().cast("array<struct<pattern:string,gap:int,width:int,kind:string>>"))


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, body, kind, start, end) of all parts, weak ones included; body is a hash of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("body"), F.concat(*(_found(k, text) for k in KINDS if k not in SHORT.values())).alias("found"))
    rows = rows.filter(F.size("found") > 0).select("doc_id", "body", F.posexplode("found").alias("place", "part"))
    rows = rows.dropDuplicates(["doc_id", "body", "place"])  # of repeated documents
    so_far = Window.partitionBy("doc_id", "body", "part.pattern").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("part.gap") + F.col("part.width")).over(so_far)
    return (
        rows.withColumn("end", end).filter("part.kind IS NOT NULL")
        .select("doc_id", "body", "part.kind", (F.col("end") - F.col("part.width")).alias("start"), "end")
    )


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Base parts, and the weak ones with their complement in scope.

    An identifier or short access key needs a secret, a long token or short value needs an
    identifier, an endpoint needs both; all parts count as complements. Parts in scope of each
    other do not overlap, and the end of one is at most ``scope`` before the start of the other,
    however long both are. Ends and starts are put in bins as wide as the scope, so the interval
    join is an equality of bins, a neighbour included, and semi joins never multiply rows.
    """
    role = F.create_map(*(F.lit(x) for k, v in KINDS.items() for x in (k, v[1])))
    base = F.col("kind").isin([k for k, v in KINDS.items() if v[2]])
    rows = found.withColumn("role", role[F.col("kind")])
    at = lambda side, place, more=0: F.struct(F.lit(side).alias("side"), (F.floor(F.col(place) / scope) + more).alias("bin"))

    def near(weak: DataFrame, other: str) -> DataFrame:
        # another part's end at or before the start, or its start at or after the end
        w = weak.withColumn("beside", F.explode(F.array(at("end", "start", -1), at("end", "start"), at("start", "end"), at("start", "end", 1))))
        o = rows.filter(F.col("role") == other).select(
            F.col("doc_id").alias("o_id"), F.col("body").alias("o_body"), F.col("start").alias("o_start"), F.col("end").alias("o_end"),
            F.explode(F.array(at("end", "end"), at("start", "start"))).alias("o_beside"))
        apart = F.when(F.col("beside.side") == "end", F.col("start") - F.col("o_end")).otherwise(F.col("o_start") - F.col("end"))
        hit = w.join(
            o, F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("body") == F.col("o_body")) & (F.col("beside") == F.col("o_beside"))
            & apart.between(0, scope), "left_semi")
        return hit.drop("beside").dropDuplicates(["doc_id", "body", "kind", "start"])

    of = lambda *kinds: rows.filter(F.col("kind").isin(*kinds))
    out = rows.filter(base)
    for more in (near(of("identifier", "short_access"), "secret"), near(of("blob", "short_assign"), "id"), near(near(of("endpoint"), "secret"), "id")):
        out = out.unionByName(more)
    return out.select(*found.columns)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(doc_id, body, found): for every document its spans (start, kind, end), by start and then kind as listed.

    Base kinds are matched leftmost and without overlap, each on its own; weak kinds are added as
    ``linked`` says. A null text is empty and has none; of documents with the same id and text all
    rows get the same spans; rows with a null id are documents too.
    """
    rank = F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)))
    spans = linked(stored(parts(docs, id_col, text_col), "secret-parts"), scope).groupBy("doc_id", "body").agg(
        F.array_sort(F.collect_set(F.struct("start", rank[F.col("kind")].alias("rank"), "kind", "end"))).alias("found"))
    spans = spans.withColumnRenamed("doc_id", "s_id").withColumnRenamed("body", "s_body")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("body"))
    return rows.join(spans, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("body") == F.col("s_body")), "left").select(
        "doc_id", "body", F.coalesce("found", F.array().cast(spans.schema["found"].dataType)).alias("found"))


def digest(scanned: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of ``scan``'s rows."""
    base = [k for k, v in KINDS.items() if v[2]]
    said = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    number = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint")
    return scanned.select(
        "doc_id", *(number(k).alias(f"n_{k}") for k in base),
        F.sha2(said(F.filter("found", lambda x: x["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"), said(F.col("found")).alias("spans"))


#: Code points of the blocks that a text is cut into before pieces of it are taken.
BLOCK = 4096


def _piece(blocks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text cut into blocks; only the blocks that hold them are looked at."""
    first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
    cut = lambda block, a, n: F.substr(F.get(blocks, block), (a + 1).cast("int"), n.cast("int"))
    inside = cut(first, start - first * BLOCK, end - start)
    across = F.concat(
        cut(first, start - first * BLOCK, F.lit(BLOCK)), F.array_join(F.slice(blocks, first + 2, last - first - 1), ""), cut(last, F.lit(0), end - last * BLOCK))
    return F.when(end <= start, "").when(first == last, inside).otherwise(across)


def redacted(docs: DataFrame, mark: str = "[secret]", id_col: str = "doc_id", text_col: str = "text", size_cols: tuple = ("n_chars",)) -> DataFrame:
    """The documents with every span, weak ones included, replaced by ``mark``; overlapping spans become one mark.

    The text between marks is found by a running end of the spans and taken out of blocks of the
    text, so the work grows with the text and its spans and not with their product. Columns of
    any names come out as they are.
    """
    spans = scan(docs, id_col, text_col).filter(F.size("found") > 0).dropDuplicates(["doc_id", "body"]).select("doc_id", "body", F.inline("found"))
    ahead = Window.partitionBy("doc_id", "body").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    gaps = spans.withColumn("after", F.coalesce(F.max("end").over(ahead), F.lit(0))).groupBy("doc_id", "body").agg(
        F.array_sort(F.collect_list(F.when(F.col("start") >= F.col("after"), F.struct("start", "after")))).alias("gaps"), F.max("end").alias("tail"))
    gaps = gaps.select(F.col("doc_id").alias("g_id"), F.col("body").alias("g_body"), "gaps", "tail")
    text = F.col("row").getField(text_col)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.withColumn("body", F.xxhash64(F.coalesce(text, F.lit(""))))
    rows = rows.join(gaps, F.col("row").getField(id_col).eqNullSafe(F.col("g_id")) & (F.col("body") == F.col("g_body")), "left")
    rows = rows.withColumn("blocks", F.when(F.col("gaps").isNotNull(), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))
    pieces = F.concat(
        F.transform("gaps", lambda g: _piece(F.col("blocks"), g["after"], g["start"])), F.array(_piece(F.col("blocks"), F.col("tail"), F.length(text).cast("bigint"))))
    touched = F.col("gaps").isNotNull()
    rows = rows.withColumn("clean", F.when(touched, F.array_join(pieces, mark)).otherwise(text))

    def column(c: str) -> Column:
        old = F.col("row").getField(c)
        if c == text_col:
            return F.col("clean").alias(c)
        return (F.when(touched, F.length("clean").cast("bigint")).otherwise(old) if c in size_cols else old).alias(c)

    return rows.select(*map(column, docs.columns))
