"""URL expressions: absolute form, photo identity, listing ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from casona import refdata
from casona.functions.text import as_col, let, non_empty, strip


def _remove_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments the way browsers do."""
    segments = F.split(path, "/")
    segments = F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 1, F.lit(0)))
    trailing = path.rlike(r"/\.{1,2}$")

    def step(acc, s):
        parent = F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)
        return F.when(s == "..", parent).when(s == ".", acc).otherwise(F.concat(acc, F.array(s)))

    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    resolved = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(trailing & (F.size(kept) > 0), "/").otherwise(""))
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), resolved).otherwise(path)


# fixed values: characters that the parts of a URL hold as percent codes, beside controls, spaces and all beyond ASCII
_PATH_CODED, _QUERY_CODED, _FRAGMENT_CODED = r"[^\x21-\x7E]|[\"<>`{}]", r"[^\x21-\x7E]|[\"<>']", r"[^\x21-\x7E]|[\"<>`]"


def _coded(part: Column, pattern: str) -> Column:
    """The part with the UTF-8 bytes of the characters in ``pattern`` as percent codes; most parts have none and stay as they are."""
    each = F.transform(F.split(part, ""), lambda c: F.when(c.rlike(pattern), F.regexp_replace(F.hex(c), "(..)", r"%$1")).otherwise(c))
    return F.when(part.rlike(pattern), F.array_join(each, "")).otherwise(part)


def absolutize_url(c, base) -> Column:
    """Absolute form of an href against the page URL; '' when there is nothing to resolve or no page to resolve it against.

    An href that starts with http(s):// comes back as it is. What is resolved against the page has
    scheme and host in lower case, no default port, dots resolved and its parts percent-encoded.
    """
    base = as_col(base)
    scheme = F.lower(F.regexp_extract(base, r"(?i)^([a-z][a-z0-9+.-]*:)//[^/?#]", 1))
    host = F.lower(F.regexp_extract(base, r"(?i)^[a-z][a-z0-9+.-]*://([^/?#]+)", 1))
    host = F.when(scheme == "https:", F.regexp_replace(host, ":443$", "")).when(scheme == "http:", F.regexp_replace(host, ":80$", "")).otherwise(host)
    origin = F.when(scheme != "", F.concat(scheme, F.lit("//"), host)).otherwise("")
    page_path = F.regexp_replace(F.regexp_replace(base, r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")
    folder = F.coalesce(non_empty(F.regexp_extract(page_path, r"^(.*/)", 1)), F.lit("/"))

    def resolve(href: Column) -> Column:
        href_path = F.translate(F.regexp_extract(href, r"^([^?#]*)", 1), "\\", "/")
        query = _coded(F.regexp_extract(href, r"^[^?#]*(\?[^#]*)", 1), _QUERY_CODED)
        fragment = _coded(F.regexp_extract(href, r"(#.*)$", 1), _FRAGMENT_CODED)
        rooted = F.when(href_path.startswith("/"), href_path).otherwise(F.concat(folder, href_path))
        own_path = _coded(F.coalesce(non_empty(page_path), F.lit("/")), _PATH_CODED)
        own_query = _coded(F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1), _QUERY_CODED)
        return (
            F.when(href == "", "")
            .when(href.rlike("(?i)^https?://"), href)
            .when(origin == "", "")
            .when(href.startswith("//"), F.concat(scheme, href))
            .when(href.rlike("(?i)^[a-z][a-z0-9+.-]*:"), href)
            .when(href.startswith("?"), F.concat(origin, own_path, query, fragment))
            .when(href.startswith("#"), F.concat(origin, own_path, own_query, fragment))
            .otherwise(F.concat(origin, _coded(_remove_dots(rooted), _PATH_CODED), query, fragment))
        )

    # line ends and tabs inside an href do not count
    return F.coalesce(let(F.regexp_replace(strip(c), r"[\t\n\r]", ""), resolve), F.lit(""))


def photo_key(url) -> Column:
    """URL without resize parameters and size parts of the path; equal keys are one picture."""
    params = "|".join(refdata.RESIZE_PARAMS)

    def key(u: Column) -> Column:
        origin = F.lower(F.regexp_extract(u, r"(?i)^([a-z][a-z0-9+.-]*://[^/?#]*)", 1))
        path = F.regexp_extract(u, r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
        path = F.regexp_replace(path, r"/\d{2,4}x\d{2,4}/", "/")
        path = F.regexp_replace(path, r"/(w|h|q|c)_[^/]+/", "/")
        path = F.coalesce(non_empty(path), F.lit("/"))
        query = F.split(F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1), "&")
        kept = F.filter(query, lambda p: (p != "") & ~p.rlike(f"(?i)^({params})(=|$)"))
        search = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
        fragment = F.regexp_extract(u, r"(#.+)$", 1)
        return F.when(origin == "", u).otherwise(F.concat(origin, path, search, fragment))

    return let(as_col(url), key)


def dedupe_photo_urls(urls) -> Column:
    """First URL of each picture, original spelling and order kept; empties dropped."""

    def first_of_each(pair: Column) -> Column:
        keys = pair["keys"]
        kept = F.filter(pair["urls"], lambda u, i: F.array_position(keys, F.get(keys, i)) == i + 1)
        return kept

    present = F.filter(as_col(urls), lambda u: u.isNotNull() & (u != ""))
    return let(
        let(present, lambda p: F.struct(p.alias("urls"), F.transform(p, photo_key).alias("keys"))), first_of_each
    )


def rewrite_thumb(url) -> Column:
    """Original-size URL of a ``-WxH`` thumbnail, query kept."""
    return F.regexp_replace(as_col(url), r"""(?i)-(\d+)x(\d+)(\.[a-z]+)(\?[^"']*)?$""", "$3$4")


def url_host(url) -> Column:
    return F.lower(F.regexp_extract(as_col(url), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def url_path(url) -> Column:
    return F.regexp_extract(as_col(url), r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def last_segment(url) -> Column:
    """Last non-empty path segment, or null."""
    return F.try_element_at(F.filter(F.split(url_path(url), "/"), lambda s: s != ""), F.lit(-1))


def source_listing_id(url, id_rule, sku=None, data_id=None) -> Column:
    """Listing id of a page under its source's rule.

    ``segment``: last path segment; ``segment_no_html``: the same without .htm/.html;
    ``long_number``: a number of six or more digits closing the path, else the segment
    without .html; ``host_path``: host plus dashed path. Then the structured-data id, the
    data attribute, and at last the URL itself.
    """
    url, rule = as_col(url), as_col(id_rule)
    path = url_path(url)
    segment = last_segment(url)
    number = non_empty(F.regexp_extract(path, r"(\d{6,})(?:\.html)?$", 1))
    dashed = F.regexp_replace(F.regexp_replace(path, "/+$", ""), "/+", "-")
    by_rule = (
        F.when(rule == "segment_no_html", F.regexp_replace(segment, r"(?i)\.html?$", ""))
        .when(rule == "long_number", F.coalesce(number, F.regexp_replace(segment, r"(?i)\.html$", "")))
        .when(rule == "host_path", F.concat(url_host(url), F.coalesce(non_empty(dashed), F.lit("-root"))))
        .otherwise(segment)
    )
    rest = [non_empty(as_col(c)) for c in (sku, data_id) if c is not None]
    return F.coalesce(non_empty(by_rule), *rest, url)
