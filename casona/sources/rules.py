"""Source rules as data: adding a source is adding a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casona import refdata
from casona.session import small_table

RULE_SCHEMA = """
    source string, base_url string, href_pattern string, match_on string, exclude_pattern string,
    entity_types array<string>, id_rule string, image_attributes array<string>, image_exclude string,
    photo_order string, gallery_only boolean, breadcrumb_noise string, breadcrumb_max int,
    classifieds boolean, max_pages int, empty_pages int
"""

GENERIC_HREF = r"(?i)/(property|properties|listing|listings|real-estate|home|homes)/[\w-]+/?$"
RENDERED_HREF = r"(?i)/(property|properties|listing|listings|sales/detail)/[\w-]+/?$"
GENERIC_TYPES = [
    "Product", "RealEstateListing", "Place", "Residence", "SingleFamilyResidence", "House", "Apartment", "Accommodation",
]
WORDS = r"(?i)icon|logo|sprite|placeholder|avatar"


def _rule(source, **overrides):
    base = dict(
        source=source, base_url=dict((s, u) for s, _, u in refdata.SOURCES).get(source), href_pattern=GENERIC_HREF,
        match_on="absolute", exclude_pattern=None, entity_types=GENERIC_TYPES, id_rule="segment",
        image_attributes=["data-src", "data-lazy", "data-lazy-src"], image_exclude=None, photo_order="entity_first",
        gallery_only=False, breadcrumb_noise=refdata.NAV_NOISE_GENERIC, breadcrumb_max=60, classifieds=False,
        max_pages=30, empty_pages=2,
    )
    return base | overrides


def default_rules() -> list[dict]:
    """Rules of the known sources (fixed values)."""
    rows = [
        _rule(
            "encuentra24", base_url="https://www.encuentra24.com", match_on="path",
            href_pattern=r"(?i)^/costa-rica-en/real-estate-for-sale-[a-z-]+/[^/?#]+/\d+$",
            entity_types=["Product", "RealEstateListing", "Place", "Residence", "Offer"],
            image_attributes=["data-src", "data-lazy-src"], image_exclude=r"(?i)\b(icon|sprite|logo|placeholder|avatar)\b",
            breadcrumb_noise=refdata.NAV_NOISE_CLASSIFIEDS, breadcrumb_max=50, classifieds=True, max_pages=50),
        _rule(
            "mlscr", href_pattern=r"""(?i)^https?://(?:www\.)?mls\.cr/properties/[^"' >/]+/?$""", match_on="href",
            entity_types=["Residence", "Place", "Product", "RealEstateListing", "SingleFamilyResidence"],
            id_rule="segment_no_html", image_attributes=["data-src", "data-lazy"], image_exclude=WORDS,
            breadcrumb_noise=None, max_pages=50),
        _rule(
            "point2homes-cr", base_url="https://www.point2homes.com", match_on="href",
            href_pattern=r"""(?i)/CR/(?:Homes-For-Sale|Real-Estate)/[^"' >]*\.html""",
            exclude_pattern=r"(?i)Real-Estate\.html(?:$|\?)", id_rule="long_number",
            entity_types=["SingleFamilyResidence", "Residence", "Place", "Product", "RealEstateListing"],
            image_attributes=["data-src", "data-original"], image_exclude=r"(?i)icon|logo|sprite|placeholder",
            gallery_only=True, breadcrumb_noise=None, max_pages=100),
        _rule(
            "coldwell-banker-cr", href_pattern=r"(?i)/property/|/listing/", match_on="href",
            entity_types=["Residence", "Place", "Product", "RealEstateListing", "SingleFamilyResidence"],
            image_attributes=["data-src", "data-lazy-src"], image_exclude=WORDS, breadcrumb_noise=None, max_pages=50),
        _rule(
            "developers-generic", href_pattern=r"^$", id_rule="host_path", photo_order="open_graph_first",
            entity_types=["Residence", "Product", "Place", "RealEstateListing", "Project", "Apartment", "House"],
            image_attributes=["data-src", "data-lazy-src"], image_exclude=WORDS + "|favicon", breadcrumb_noise=None),
    ]
    rows += [
        _rule(s) for s in (
            "realtor-com-cr", "re-cr", "coldwell-cb-tamarindo", "properties-in-cr", "cr-dream-makers", "rpm-real-estate-cr")
    ]
    rows += [
        _rule(
            s, href_pattern=RENDERED_HREF, image_attributes=["data-src", "data-lazy"],
            breadcrumb_noise=refdata.NAV_NOISE_RENDERED, max_pages=10, empty_pages=1)
        for s in ("sothebys-cr", "dominical-realty", "two-cr-real-estate")
    ]
    return rows


def rule_table(spark: SparkSession, rules: list[dict] | None = None) -> DataFrame:
    return small_table(spark, rules or default_rules(), RULE_SCHEMA)


CONFIG_METADATA = "start_urls array<string>, listing_url_regex string, pagination_param string, max_pages int"


def enabled_sources(sources: DataFrame, configs: DataFrame) -> DataFrame:
    """Sources whose own flag and whose config's flag are both on, by slug."""
    c = configs.filter("enabled").select("source_id", "cron_expression")
    return (
        sources.filter("enabled").join(c, sources.id == c.source_id).drop("source_id")
        .select("id", "slug", "cron_expression").orderBy("slug")
    )


def source_rules(sources: DataFrame, configs: DataFrame) -> DataFrame:
    """Crawl settings per source from the config's JSON metadata, with their defaults."""
    md = F.from_json(F.coalesce("metadata", F.lit("{}")), CONFIG_METADATA)
    c = configs.select("source_id", md.alias("_m"))
    has_base = F.col("base_url").isNotNull() & (F.col("base_url") != "")
    return sources.join(c, sources.id == c.source_id).select(
        "slug",
        F.coalesce("_m.start_urls", F.when(has_base, F.array("base_url")), F.array().cast("array<string>")).alias("start_urls"),
        F.coalesce("_m.listing_url_regex", F.lit(GENERIC_HREF)).alias("listing_url_regex"),
        F.coalesce("_m.pagination_param", F.lit("page")).alias("pagination_param"),
        F.coalesce("_m.max_pages", F.lit(30)).alias("max_pages"),
    )


def source_listing(sources: DataFrame, configs: DataFrame) -> DataFrame:
    """Name, flag and last run of every configured source, by slug."""
    c = configs.select("source_id", "last_run_at")
    return sources.join(c, sources.id == c.source_id).select("slug", "name", "enabled", "last_run_at").orderBy("slug")


def toggle_sources(configs: DataFrame, ids: DataFrame) -> DataFrame:
    """Flip the flag of the configs whose source_id is listed."""
    hit = ids.select(F.col("source_id").alias("_id")).distinct()
    flipped = F.when(F.col("_id").isNotNull(), ~F.col("enabled")).otherwise(F.col("enabled"))
    return configs.join(hit, configs.source_id == F.col("_id"), "left").withColumn("enabled", flipped).drop("_id")
