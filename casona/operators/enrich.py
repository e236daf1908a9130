"""Enrichment: vocabularies, bilingual copy, categories, derived flags, hero choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from casona import refdata
from casona.functions.text import as_col
from casona.operators.ranking import newest


def _strings() -> Column:
    return F.array().cast("array<string>")


def vocab_filter(arr, vocab: Sequence[str]) -> Column:
    """Members of the vocabulary, order and repeats kept; null gives an empty array."""
    words = F.array(*map(F.lit, vocab))
    return F.coalesce(F.filter(as_col(arr), lambda x: F.array_contains(words, x)), _strings())


def feature_fallback(tagged, normalized) -> Column:
    tagged = as_col(tagged)
    return F.when(F.size(tagged) > 0, tagged).otherwise(F.coalesce(as_col(normalized), _strings()))


def derive_categories(property_type, price_usd, beach_km, features, tags) -> Column:
    """Cross-cutting categories in display order; a listing may carry several or none."""
    kind = as_col(property_type)
    features, tags = F.coalesce(as_col(features), _strings()), F.coalesce(as_col(tags), _strings())
    by_feature = F.arrays_overlap(features, F.array(*map(F.lit, ("beachfront", "oceanfront", "walk_to_beach"))))
    near_beach = F.coalesce(as_col(beach_km) <= 5, F.lit(False))
    beach = near_beach | F.coalesce(by_feature, F.lit(False)) | F.array_contains(tags, "beachfront")
    luxury = F.coalesce(as_col(price_usd) >= 1_000_000, F.lit(False)) | F.array_contains(tags, "luxury")
    return F.array_compact(F.array(
        F.when(kind.isin("house", "farm"), "homes-and-villas"),
        F.when(kind == "condo", "condominiums"),
        F.when(kind == "lot", "lots"),
        F.when(F.coalesce(beach, F.lit(False)), "beach-properties"),
        F.when(F.coalesce(luxury, F.lit(False)), "luxury-properties"),
    ))


def backfill_categories(df: DataFrame) -> DataFrame:
    """Categories derived only where none are stored."""
    derived = derive_categories("property_type", "price_usd", "distance_to_beach_km", "features", "tags_ai")
    missing = F.col("categories").isNull() | (F.size("categories") == 0)
    return df.withColumn("categories", F.when(missing, derived).otherwise(F.col("categories")))


def register_sql_functions(spark) -> None:
    """``derive_listing_categories`` for SQL users, as a SQL expression function."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION derive_listing_categories(
            property_type STRING, price_usd DECIMAL(14,2), beach_km DECIMAL(6,1),
            features ARRAY<STRING>, tags ARRAY<STRING>) RETURNS ARRAY<STRING>
        RETURN array_compact(array(
            CASE WHEN property_type IN ('house', 'farm') THEN 'homes-and-villas' END,
            CASE WHEN property_type = 'condo' THEN 'condominiums' END,
            CASE WHEN property_type = 'lot' THEN 'lots' END,
            CASE WHEN beach_km <= 5
                   OR arrays_overlap(coalesce(features, array()), array('beachfront', 'oceanfront', 'walk_to_beach'))
                   OR array_contains(coalesce(tags, array()), 'beachfront') THEN 'beach-properties' END,
            CASE WHEN price_usd >= 1000000 OR array_contains(coalesce(tags, array()), 'luxury')
                 THEN 'luxury-properties' END))
    """)


def backfill_flags(df: DataFrame) -> DataFrame:
    """pool_yn from pool features, parking_yn from counted spaces, only where unstated."""
    spaces = F.coalesce(F.col("parking_spaces") > 0, F.lit(False)) | F.coalesce(F.col("garage_spaces") > 0, F.lit(False))
    return df.withColumns({
        "pool_yn": F.coalesce("pool_yn", F.when(F.size("pool_features") > 0, True)),
        "parking_yn": F.coalesce("parking_yn", F.when(spaces, True)),
    })


def bathrooms_total(full="bathrooms_full", half="bathrooms_half") -> Column:
    zero = F.lit(0).cast("decimal(4,1)")
    half_bath = F.coalesce(as_col(half).cast("decimal(4,1)"), zero) * F.lit("0.5").cast("decimal(2,1)")
    return (F.coalesce(as_col(full).cast("decimal(4,1)"), zero) + half_bath).cast("decimal(4,1)")


def hero_and_alt(photos: DataFrame, choices: DataFrame, key: str = "listing_id", candidates: int | None = None) -> DataFrame:
    """Hero flag and alt text of photos (key, position, alt) from stored choices (key, hero_index, alt_texts).

    ``candidates`` is the number of photos the choice looked at, if it was not all: an index beyond
    it, a negative one and none at all make the first photo the hero. A missing alt text falls
    back to the photo's own.
    """
    c = choices.groupBy(key).agg(F.max_by(F.struct("hero_index", "alt_texts"), "hero_index").alias("_c"))
    joined = photos.join(c, key, "left")
    offered = F.col("_c.hero_index") >= 0
    if candidates is not None:
        offered = offered & (F.col("_c.hero_index") < candidates)
    index = F.coalesce(F.when(offered, F.col("_c.hero_index")), F.lit(0))
    alt = F.try_element_at(F.col("_c.alt_texts"), F.col("position").cast("string"))
    return joined.withColumns({
        "is_hero": F.col("position") == index, "alt_text": F.coalesce(alt, F.col("alt")),
    }).drop("_c")


RESPONSE_FIELDS = ["title_en", "title_es", "description_en", "description_es", "rewritten_en", "rewritten_es"]


def bilingual_copy(df: DataFrame, responses: DataFrame, key: str = "source_listing_id") -> DataFrame:
    """Titles: translation, else the original of the same language. Descriptions: rewrite, else translation.

    Of several replies the newest by ``seq`` counts, where they have one.
    """
    order = newest(responses, F.to_json(F.struct(*RESPONSE_FIELDS)))
    best = responses.groupBy(key).agg(F.max_by(F.struct(*RESPONSE_FIELDS), order).alias("_r"))
    joined = df.join(best, key, "left")
    original = lambda lang: F.when(F.col("language") == lang, F.col("title"))
    return joined.withColumns({
        "title_en": F.coalesce(F.col("_r.title_en"), original("en")),
        "title_es": F.coalesce(F.col("_r.title_es"), original("es")),
        "description_en": F.coalesce("_r.rewritten_en", "_r.description_en"),
        "description_es": F.coalesce("_r.rewritten_es", "_r.description_es"),
        "description_raw": F.col("description"),
    }).drop("_r")


def enrich(df: DataFrame, responses: DataFrame, tagged: DataFrame, key: str = "source_listing_id") -> DataFrame:
    """Normalized -> enriched: copy, vocabulary-checked features and tags, categories, flags, bath total."""
    order = newest(tagged, F.to_json(F.struct("features", "tags")))
    tags = tagged.groupBy(key).agg(F.max_by(F.struct("features", "tags"), order).alias("_t"))
    out = bilingual_copy(df, responses, key).join(tags, key, "left")
    out = out.withColumns({
        "features": feature_fallback(vocab_filter("_t.features", refdata.FEATURE_VOCAB), "features"),
        "tags_ai": vocab_filter("_t.tags", refdata.TAG_VOCAB),
    }).drop("_t")
    out = out.withColumn(
        "categories",
        derive_categories("property_type", "price_usd", "distance_to_beach_km", "features", "tags_ai"),
    ).withColumn("bathrooms_total", bathrooms_total())
    return backfill_flags(out)
