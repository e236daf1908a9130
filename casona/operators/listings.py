"""Search and read views over canonical listings."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from casona import refdata
from casona.functions.text import non_empty, region_label
from casona.operators.entity_resolution import similar_listings

CARD_COLUMNS = [
    "id", "slug", "status", "title_en", "title_es", "property_type", "price_usd", "bedrooms", "bathrooms",
    "bathrooms_total", "interior_sqm", "lot_sqm", "year_built", "region_slug", "locality", "canton", "province",
    "lat", "lng", "community_name", "gated_community", "tags_ai", "tags_human", "features", "view_types",
    "categories", "distance_to_beach_km", "distance_to_airport_km", "nearest_airport_code", "last_seen_at",
    "wp_post_id", "realtor_review_status",
]


def listing_cards(canon: DataFrame, photos: DataFrame, key: str = "listing_id") -> DataFrame:
    """Card columns plus hero_url and fallback_url: cached copy, else source URL, of the lowest-placed
    usable hero and of the lowest-placed usable photo."""
    url = F.coalesce("url_cached", "url_source")
    at = F.struct("position", url.alias("url"))
    usable = ~F.col("is_rejected")
    picked = photos.groupBy(F.col(key).alias("id")).agg(
        F.min(F.when(usable & F.col("is_hero"), at)).alias("_h"), F.min(F.when(usable, at)).alias("_f"))
    cards = canon.select(*(c for c in CARD_COLUMNS if c in canon.columns))
    return cards.join(picked, "id", "left").withColumns(
        {"hero_url": F.col("_h.url"), "fallback_url": F.col("_f.url")}).drop("_h", "_f")


@dataclass
class SearchFilters:
    q: str | None = None
    regions: Sequence[str] = field(default_factory=tuple)
    types: Sequence[str] = field(default_factory=tuple)
    categories: Sequence[str] = field(default_factory=tuple)
    features: Sequence[str] = field(default_factory=tuple)
    min_price: float | None = None
    max_price: float | None = None
    beds: float | None = None
    baths: float | None = None


def text_match(q: str, columns: Sequence[str] = ("title_en", "title_es", "locality")) -> Column:
    """Case-insensitive literal substring in any of the columns; wildcards in ``q`` are plain characters."""
    pattern = "%" + re.sub(r"([%_\\])", r"\\\1", q) + "%"
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(F.col(c).ilike(pattern), F.lit(False))
    return out


def search_filter(filters: SearchFilters) -> Column:
    words = lambda xs: F.array(*map(F.lit, xs))
    cond = F.col("status") == "active"
    if filters.regions:
        cond = cond & F.col("region_slug").isin(list(filters.regions))
    if filters.types:
        cond = cond & F.col("property_type").isin(list(filters.types))
    if filters.min_price is not None:
        cond = cond & (F.col("price_usd") >= filters.min_price)
    if filters.max_price is not None:
        cond = cond & (F.col("price_usd") <= filters.max_price)
    if filters.beds is not None:
        cond = cond & (F.col("bedrooms") >= filters.beds)
    if filters.baths is not None:
        cond = cond & (F.col("bathrooms") >= filters.baths)
    if filters.categories:
        cond = cond & F.arrays_overlap("categories", words(filters.categories))
    if filters.features:
        cond = cond & (F.size(F.array_except(words(filters.features), F.col("features"))) == 0)
    if filters.q:
        cond = cond & text_match(filters.q)
    return cond


def search(
    cards: DataFrame, filters: SearchFilters, page: int = 1, size: int = refdata.SEARCH_PAGE_SIZE
) -> tuple[DataFrame, DataFrame]:
    """(page of rows, exact total): newest seen first, nulls last, id as tie-break."""
    hits = cards.filter(search_filter(filters))
    rows = hits.orderBy(F.desc_nulls_last("last_seen_at"), "id").offset((max(page, 1) - 1) * size).limit(size)
    return rows, hits.agg(F.count("*").alias("total"))


def search_after(cards: DataFrame, filters: SearchFilters, cursor: tuple | None = None, size: int = refdata.SEARCH_PAGE_SIZE) -> DataFrame:
    """The rows after a cursor, in the order of ``search``: the next page, at the cost of a first one.

    The cursor is (last_seen_at, id) of the last row shown; None asks for the first page. What lies
    before it is filtered out at the scan, and every task keeps ``size`` rows at most. On a table
    laid out by ``by_recency`` files and row groups before the cursor are skipped by their bounds.
    """
    hits = cards.filter(search_filter(filters))
    if cursor is not None:
        seen, last = cursor
        if seen is None:
            hits = hits.filter(F.col("last_seen_at").isNull() & (F.col("id") > last))
        else:
            at = F.lit(seen)
            hits = hits.filter(F.col("last_seen_at").isNull() | (F.col("last_seen_at") <= at)).filter(
                F.col("last_seen_at").isNull() | (F.col("last_seen_at") < at) | (F.col("id") > last))
    return hits.orderBy(F.desc_nulls_last("last_seen_at"), "id").limit(size)


#: Rows that a range of ``by_recency`` holds before there are more ranges.
RANGE_ROWS = 250_000


def by_recency(cards: DataFrame, ranges: int) -> DataFrame:
    """Rows range partitioned and sorted as pages show them, to be written as a table for ``search_after``.

    There are ``ranges`` of them, or more where one would hold over RANGE_ROWS rows, so that a task's sort stays small.
    """
    order = [F.desc_nulls_last("last_seen_at"), F.asc("id")]
    return cards.repartitionByRange(max(ranges, -(-cards.count() // RANGE_ROWS)), *order).sortWithinPartitions(*order)


TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
WEIGHTS = [("title_en", "1.0"), ("title_es", "1.0"), ("locality", "0.4"), ("canton", "0.4"), ("province", "0.2"), ("description_en", "0.1")]


def token_index(canon: DataFrame, weights: Sequence[tuple[str, str]] = tuple(WEIGHTS), id_col: str = "id") -> DataFrame:
    """Inverted index (token, id, weight): lower-cased words, no stemming, weights summed per word."""
    def postings(column: str, weight: str) -> Column:
        words = F.filter(F.split(F.lower(F.coalesce(F.col(column), F.lit(""))), TOKEN_SPLIT), lambda t: t != "")
        return F.transform(words, lambda t: F.struct(t.alias("token"), F.lit(weight).cast("decimal(6,2)").alias("weight")))

    parts = [postings(c, w) for c, w in weights if c in canon.columns]
    exploded = canon.select(F.col(id_col).alias("id"), F.explode(F.concat(*parts)).alias("_t")).select("id", "_t.*")
    return exploded.groupBy("token", "id").agg(F.sum("weight").cast("decimal(14,2)").alias("weight"))


def fulltext_rank(index: DataFrame, query: str, n: int | None = None) -> DataFrame:
    """Listings that hold every query word, by summed weight. Partition or bucket a stored index by token.

    Query words are a driver-side literal list, so the scan is filtered by pushed-down equality and
    only matching postings are aggregated.
    """
    words = sorted({w for w in re.split(r"[\W_]+", query.lower()) if w})
    hits = (
        index.filter(F.col("token").isin(words))
        .groupBy("id")
        .agg(F.sum("weight").cast("decimal(14,2)").alias("score"), F.count("*").alias("_words"))
        .filter(F.col("_words") == len(words))
        .drop("_words")
    )
    return hits.orderBy(F.desc("score"), "id").limit(n) if n else hits


@dataclass
class ListingDetail:
    listing: DataFrame
    photos: DataFrame
    agents: DataFrame
    similar: DataFrame | None


def listing_detail(canon: DataFrame, photos: DataFrame, agents: DataFrame, slug: str, listing_id=None) -> ListingDetail:
    """One listing with its ordered photos, the enabled agents by name, and similar listings when its id is given."""
    listing = canon.filter(F.col("slug") == slug)
    mine = photos.join(listing.select(F.col("id").alias("listing_id")), "listing_id").orderBy("position", "photo_id")
    similar = similar_listings(canon, listing_id) if listing_id is not None and "embedding" in canon.columns else None
    return ListingDetail(listing, mine, agents.filter("enabled").orderBy("name", "id"), similar)


def visible_rows(df: DataFrame, table: str, role: str, listings: DataFrame | None = None, regions: Sequence[str] | None = None) -> DataFrame:
    """Rows a role may read. Visitors: active listings and their photos, regions. Realtors: all listings,
    photos, agents, regions, optionally only their own regions. Admins: everything."""
    operational = {
        "runs", "run_logs", "sources", "source_configs", "raw_listings", "alerts", "sync_log", "dedup_links",
        "listing_embeddings", "ai_costs_daily",
    }
    nothing = df.filter(F.lit(False))
    if role == "admin":
        return df
    if table in operational:
        return nothing
    if role == "anon":
        if table == "listings":
            return df.filter("status = 'active'")
        if table == "photos":
            active = listings.filter("status = 'active'").select(F.col("id").alias("listing_id"))
            return df.join(active, "listing_id", "left_semi")
        return df if table == "regions" else nothing
    if regions and table == "agents":
        return df.filter(F.arrays_overlap("regions", F.array(*map(F.lit, regions))))
    if regions and table == "listings":
        return df.filter(F.col("region_slug").isin(list(regions)))
    return df


def data_grid(canon: DataFrame, group: str | None = None, n: int | None = None) -> DataFrame:
    """All or the newest ``n`` listings with the columns of one field group, or of all; missing columns are skipped."""
    hidden = {"description_en", "description_es", "description_raw", "extra_data"}
    if group in refdata.FIELD_GROUPS:
        fields = ["slug", *refdata.FIELD_GROUPS[group]]
    else:
        fields = [f for fs in refdata.FIELD_GROUPS.values() for f in fs if f not in hidden]
    cols = [c for c in dict.fromkeys(["id", *fields]) if c in canon.columns]
    newest = canon.orderBy(F.desc_nulls_last("created_at"), "id")
    return (newest if n is None else newest.limit(n)).select(*cols)


def display_values(df: DataFrame) -> DataFrame:
    """Region label and display title: English, else Spanish, else ``Listing {slug}``."""
    return df.withColumns({
        "region_label": F.coalesce(region_label(non_empty("region_slug")), F.lit("—")),
        "display_title": F.coalesce("title_en", "title_es", F.concat(F.lit("Listing "), F.col("slug"))),
    })
