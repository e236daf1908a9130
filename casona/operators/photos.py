"""Photos: classification, positions, hero, gallery and edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from casona import refdata
from casona.functions.text import as_col, let
from casona.functions.urls import rewrite_thumb
from casona.operators.ranking import by_size, newest, running_totals, top_n_per_key



def classify_photo(url, width, height) -> Column:
    """Reject reason by the first matching rule, null for a usable photo.

    The word rule uses word boundaries and ``_`` is a word character, so ``site_logo`` passes.
    """
    width, height = as_col(width), as_col(height)

    def reason(lower: Column) -> Column:
        name = F.element_at(F.split(F.regexp_replace(lower, r"\?.*$", ""), "/"), -1)
        out = None
        for subject, pattern, why in refdata.PHOTO_RULES:
            hit = (lower if subject == "url" else name).rlike(pattern)
            out = F.when(hit, why) if out is None else out.when(hit, why)
        aspect = width / height
        tiny = (width < refdata.PHOTO_MIN_WIDTH) | (height < refdata.PHOTO_MIN_HEIGHT)
        odd = (aspect < refdata.PHOTO_MIN_ASPECT) | (aspect > refdata.PHOTO_MAX_ASPECT)
        return out.when(tiny, "tiny").when((height > 0) & odd, "unusual_aspect_ratio")

    sized = width.isNotNull() & height.isNotNull()
    # size rules need both sides; without one of them only the URL rules apply
    width, height = F.when(sized, width), F.when(sized, height)
    return let(F.lower(as_col(url)), reason)


def numbered(photos: DataFrame, order: list[Column], out: str, key: str = "listing_id", position: str = "position") -> DataFrame:
    """1-based number of each photo within its listing, safe for listings with very many photos."""
    return running_totals(photos, [key], order, {out: F.lit(1).cast("bigint")})


def apply_verdicts(photos: DataFrame, verdicts: DataFrame, key: str = "listing_id") -> DataFrame:
    """Vision verdicts (key, i, verdict, reason) counted over the photos the rules let through.

    Photos without a verdict are accepted; a rejection becomes ``vision:`` plus 60 characters.
    """
    kept = F.col("reject_reason").isNull()
    counted = running_totals(
        photos, [key], [F.col("position"), F.col("url")], {"_n": F.when(kept, 1).otherwise(0).cast("bigint")})
    judged = counted.withColumn("_at", F.when(kept, F.col("_n") - 1))
    v = verdicts.groupBy(F.col(key).alias("_key"), F.col("i").cast("bigint").alias("_i")).agg(
        F.max_by(F.struct("verdict", "reason"), F.struct("verdict", "reason")).alias("_v"))
    joined = judged.join(v, (F.col(key) == F.col("_key")) & (F.col("_at") == F.col("_i")), "left")
    vision = F.when(
        F.col("_v.verdict") == "reject", F.concat(F.lit("vision:"), F.substring(F.coalesce("_v.reason", F.lit("")), 1, 60)))
    return joined.withColumn("reject_reason", F.coalesce("reject_reason", vision)).select(*photos.columns)


def new_photos(photos: DataFrame, existing: DataFrame, key: str = "listing_id") -> DataFrame:
    """Photos whose URL, and perceptual hash if any, the listing does not have; one per URL in the batch."""
    ties = [c for c in ("photo_id",) if c in photos.columns]
    first = photos.groupBy(key, "url").agg(
        F.min_by(F.struct(*(c for c in photos.columns if c not in (key, "url"))), F.struct("position", *ties)).alias("_p"))
    batch = first.select(key, "url", "_p.*")
    have_url = existing.select(key, "url").distinct()
    have_hash = existing.filter("phash is not null").select(key, "phash").distinct()
    return batch.join(have_url, [key, "url"], "left_anti").join(have_hash, [key, "phash"], "left_anti")


def assign_positions(photos: DataFrame, existing: DataFrame, hero: DataFrame, key: str = "listing_id") -> DataFrame:
    """Final positions after the listing's stored photos, and one hero: the first usable photo at or
    after the chosen index, for listings without a hero yet. ``hero`` is (key, hero_index)."""
    before = existing.groupBy(key).agg(
        F.max("position").alias("_last"), F.max(F.col("is_hero") & ~F.col("is_rejected")).alias("_has_hero"))
    index = hero.groupBy(key).agg(F.min("hero_index").alias("_hero_index"))
    order = [F.col("position"), F.col("url")]
    few, many = by_size(photos, [key], "new-photos")

    def placed(n: DataFrame) -> DataFrame:
        rows = n.join(before, key, "left").withColumn("position", (F.coalesce("_last", F.lit(-1)) + F.col("_n")).cast("int"))
        rows = rows.join(index, key, "left").withColumn("is_rejected", F.col("reject_reason").isNotNull())
        return rows.withColumn("_eligible", ~F.col("is_rejected") & (F.col("_n") - 1 >= F.coalesce("_hero_index", F.lit(0))))

    def marked(rows: DataFrame) -> DataFrame:
        is_hero = ~F.coalesce("_has_hero", F.lit(False)) & (F.col("position") == F.col("_hero_at")) & F.col(key).isNotNull()
        return rows.withColumn("is_hero", F.coalesce(is_hero, F.lit(False))).drop(
            "_n", "_last", "_has_hero", "_hero_index", "_hero_at", "_eligible")

    # a listing of few photos is numbered, joined and searched for its hero where one shuffle brought it
    mine = Window.partitionBy(key)
    small = placed(few.withColumn("_n", F.row_number().over(mine.orderBy(*order)).cast("bigint")))
    out = marked(small.withColumn("_hero_at", F.min(F.when(F.col("_eligible"), F.col("position"))).over(mine)))
    if many is None:
        return out
    large = placed(numbered(many, order, "_n", key))
    chosen = large.filter("_eligible").groupBy(key).agg(F.min("position").alias("_hero_at"))
    return out.unionByName(marked(large.join(chosen, key, "left")))


def photo_counts(listings: DataFrame, photos: DataFrame, key: str = "listing_id") -> DataFrame:
    counts = photos.groupBy(F.col(key).alias("id")).agg(F.count_if(~F.col("is_rejected")).cast("int").alias("photo_count"))
    return listings.drop("photo_count").join(counts, "id", "left").fillna(0, ["photo_count"])


def set_hero(photos: DataFrame, edits: DataFrame, key: str = "listing_id", photo_id: str = "photo_id") -> DataFrame:
    """The photo that the newest edit (key, photo_id, seq) of a listing names becomes its only hero."""
    e = edits.groupBy(key).agg(F.max_by(photo_id, newest(edits, photo_id)).alias("_hero"))
    edited = F.col("_hero").isNotNull()
    return photos.join(e, key, "left").withColumn(
        "is_hero", F.when(edited, F.col(photo_id) == F.col("_hero")).otherwise(F.col("is_hero"))).drop("_hero")


def append_photo(photos: DataFrame, adds: DataFrame, key: str = "listing_id") -> DataFrame:
    """Hand-added photos (key, photo_id, url, alt, is_hero, seq) after the last position, in their sequence.

    The newest hero add demotes the rest.
    """
    last = photos.groupBy(key).agg(F.max("position").alias("_last"))
    n = running_totals(adds, [key], [newest(adds, "photo_id")], {"_n": F.lit(1).cast("bigint")})
    heroes = adds.filter("is_hero").groupBy(key).agg(F.max_by("photo_id", newest(adds, "photo_id")).alias("_hero"))
    added = n.join(last, key, "left").join(heroes, key, "left").select(
        key, "photo_id", "url", F.col("alt").alias("alt_text"),
        (F.coalesce("_last", F.lit(-1)) + F.col("_n")).cast("int").alias("position"),
        (F.col("photo_id") == F.col("_hero")).alias("is_hero"), F.lit(False).alias("is_rejected"),
        F.lit("manual").alias("photo_type"), F.lit(True).alias("ai_validated"),
        F.lit("manually added by admin").alias("ai_validation_notes"),
    ).withColumn("is_hero", F.coalesce("is_hero", F.lit(False)))
    kept = photos.join(heroes, key, "left").withColumn(
        "is_hero", F.when(F.col("_hero").isNotNull(), F.lit(False)).otherwise(F.col("is_hero"))).drop("_hero")
    return kept.unionByName(added, allowMissingColumns=True)


def gallery(photos: DataFrame, n: int | None = None, key: str = "listing_id") -> DataFrame:
    """All or the first ``n`` photos per listing by position, with the featured one marked: the hero, else the first."""
    first = top_n_per_key(photos, [key], [F.col("position"), F.col("url")], n, "_rank")
    featured = first.groupBy(key).agg(
        F.min(F.struct((~F.col("is_hero")).cast("int"), "position", "url")).alias("_f"))
    marked = first.join(featured, key)
    is_it = (F.col("position") == F.col("_f.position")) & (F.col("url") == F.col("_f.url"))
    return marked.withColumn("featured", is_it).drop("_f", "_rank")


def split_gallery(photos: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Active photos in gallery order, and the rejected ones."""
    active = photos.filter(~F.col("is_rejected")).orderBy("listing_id", "position", "url")
    return active, photos.filter("is_rejected")


def swap_positions(photos: DataFrame, edits: DataFrame, key: str = "listing_id", photo_id: str = "photo_id") -> DataFrame:
    """Each edited photo (photo_id, direction -1 or 1, seq) trades places with its neighbour among active photos.

    One edit per listing is taken, the first by ``seq``; ``surplus_moves`` has the others. An edit
    at the end of the gallery changes nothing.
    """
    active = numbered(photos.filter(~F.col("is_rejected")), [F.col("position"), F.col(photo_id)], "_n", key)
    active = active.select(key, photo_id, "position", "_n")
    order = [c for c in ("seq",) if c in edits.columns]
    e = edits.select(photo_id, *order, F.col("direction").alias("_d"))
    moved = active.join(e, photo_id).groupBy(key).agg(
        F.min(F.struct(*order, "_n", photo_id, "position", "_d")).alias("_m")).select(key, "_m.*")
    a = moved.select(key, F.col(photo_id).alias("_a"), F.col("position").alias("_pa"), (F.col("_n") + F.col("_d")).alias("_n"))
    b = active.select(key, "_n", F.col(photo_id).alias("_b"), F.col("position").alias("_pb"))
    trade = a.join(b, [key, "_n"])
    changes = trade.select(F.col("_a").alias(photo_id), F.col("_pb").alias("_to")).unionByName(
        trade.select(F.col("_b").alias(photo_id), F.col("_pa").alias("_to")))
    return photos.join(changes, photo_id, "left").withColumn("position", F.coalesce("_to", "position")).drop("_to")


def surplus_moves(photos: DataFrame, edits: DataFrame, key: str = "listing_id", photo_id: str = "photo_id") -> DataFrame:
    """Edits (photo_id, direction, seq) that wait because an earlier one of their listing was taken, or name no active photo."""
    named = edits.join(photos.filter(~F.col("is_rejected")).select(photo_id, F.col(key).alias("_key")), photo_id, "left")
    first = named.filter("_key IS NOT NULL").groupBy("_key").agg(F.min("seq").alias("_first"))
    return named.join(first, "_key", "left").filter("_key IS NULL OR seq > _first").select(*edits.columns)


def classify_and_rewrite(photos: DataFrame) -> DataFrame:
    """Full-size URLs and rule verdicts of raw photos (url, width, height, ...)."""
    return photos.withColumn("url", rewrite_thumb("url")).withColumn(
        "reject_reason", classify_photo("url", "width", "height"))
