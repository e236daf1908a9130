"""Listing URLs from search pages: link discovery and the crawl stop rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from casona.functions import html, urls
from casona.operators.ranking import running_totals, top_n_per_key


def page_links(search_pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Listing links on search pages (source, page, html): (source, page, pos, url), absolute.

    ``rules`` has one row per source, joined on the source name.
    """
    r = rules.select("source", "base_url", "href_pattern", "match_on", "exclude_pattern")
    links = search_pages.select("source", "page", F.posexplode(html.hrefs("html")).alias("pos", "href")).join(r, "source")
    path = F.when(F.col("href").rlike("(?i)^https?://"), urls.url_path("href")).otherwise(F.col("href"))
    found = links.withColumn("url", urls.absolutize_url("href", "base_url"))
    subject = F.when(F.col("match_on") == "path", path).when(F.col("match_on") == "href", F.col("href")).otherwise(F.col("url"))
    wanted = F.regexp_like(subject, F.col("href_pattern")) & (F.col("url") != "")
    unwanted = F.coalesce(F.regexp_like("url", F.col("exclude_pattern")), F.lit(False))
    return found.filter(wanted & ~unwanted).select("source", "page", "pos", "url")


def discover_listing_urls(
    search_pages: DataFrame, rules: DataFrame, requested: int | None = None, configured: int | None = None
) -> DataFrame:
    """Distinct listing URLs per source in page order: all, or as many as the smaller limit given."""
    cap = min((n for n in (requested, configured) if n is not None), default=None)
    first = page_links(search_pages, rules).groupBy("source", "url").agg(F.min(F.struct("page", "pos")).alias("_at"))
    if cap is None:  # a source may have any number of URLs: number them over ranges
        return running_totals(first, ["source"], [F.col("_at"), F.col("url")], {"rank": F.lit(1)}).select("source", "url", F.col("rank").cast("int").alias("rank"))
    return top_n_per_key(first, ["source"], [F.col("_at"), F.col("url")], cap).select("source", "url", "rank")


def discover_from_rest(json_pages: DataFrame) -> DataFrame:
    """``link`` of every post in JSON array responses (source, page, body)."""
    posts = F.from_json("body", "array<struct<link:string>>")
    return json_pages.select("source", "page", F.posexplode(posts).alias("pos", "post")).select(
        "source", "page", "pos", F.col("post.link").alias("url")
    ).filter("url is not null")


def crawl_frontier_stop(page_urls: DataFrame, empty_pages: int = 2) -> DataFrame:
    """Pages (source, page, new_urls) up to the first run of pages without a new URL.

    Input is (source, page, url) with a null url for a page without links. URLs are reduced to
    counts per page first, so the window holds one short row per crawled page of a source.
    """
    pages = page_urls.select("source", "page").distinct()
    first = page_urls.filter("url is not null").groupBy("source", "url").agg(F.min("page").alias("page"))
    fresh = first.groupBy("source", "page").agg(F.count("*").alias("new_urls"))
    counted = pages.join(fresh, ["source", "page"], "left").fillna(0, ["new_urls"])
    order = Window.partitionBy("source").orderBy("page")
    recent = F.max("new_urls").over(order.rowsBetween(-(empty_pages - 1), 0))
    seen = F.count("*").over(order.rowsBetween(-(empty_pages - 1), 0))
    streak = counted.withColumn("_stop", ((recent == 0) & (seen == empty_pages)).cast("int"))
    stopped_before = F.coalesce(F.max("_stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return streak.withColumn("_cut", stopped_before).filter("_cut = 0").select("source", "page", "new_urls")
