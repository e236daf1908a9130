"""Structured data in HTML pages, read with native expressions (no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from casona.functions.text import as_col, decode_entities, let, non_empty, strip

LD_BLOCK = r"""(?is)<script\b[^>]*\btype\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script>"""
META_TAG = r"(?is)<meta\b([^>]*)>"
IMG_TAG = r"(?is)<img\b([^>]*)>"
ANCHOR_TAG = r"(?is)<a\b([^>]*)>"
NO_SCRIPT = r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->"


def visible(html) -> Column:
    """Page without scripts, styles and comments, whose tags are not part of the document tree."""
    return F.regexp_replace(as_col(html), NO_SCRIPT, "")


def attribute(tag: Column, name: str) -> Column:
    """Decoded attribute value of a tag's inner text; null when absent or empty."""
    pattern = rf"""(?is)(?:^|[\s"']){name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    raw = F.concat(*(F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)))
    return let(raw, lambda v: non_empty(F.when(v.contains("&"), decode_entities(v)).otherwise(v)))


def extract_json_ld(html) -> Column:
    """Every JSON-LD object as VARIANT: arrays flattened, @graph members before their wrapper, bad blocks skipped."""
    none = F.array().cast("array<variant>")

    def members(v):
        kind = F.schema_of_variant(v)
        graph = F.try_variant_get(v, '$["@graph"]', "array<variant>")
        return (
            F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>"))
            .when(kind.startswith("OBJECT"), F.concat(F.coalesce(graph, none), F.array(v)))
            .otherwise(none)
        )

    blocks = F.regexp_extract_all(as_col(html), F.lit(LD_BLOCK), F.lit(1))
    parsed = F.filter(F.transform(blocks, F.try_parse_json), lambda v: v.isNotNull())
    flat = F.flatten(F.transform(parsed, members))
    return F.filter(flat, lambda v: F.schema_of_variant(v).startswith("OBJECT"))


def text_field(v: Column, path: str) -> Column:
    """String at a path of a VARIANT, only if it really is a string."""
    return let(
        F.try_variant_get(v, path, "variant"),
        lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")),
    )


def entity_types(v: Column) -> Column:
    """The @type names of an entity as an array (it may be a string or an array)."""
    many = F.try_variant_get(v, '$["@type"]', "array<string>")
    one = text_field(v, '$["@type"]')
    return F.coalesce(many, F.array_compact(F.array(one)))


def find_entity_by_type(ld, types) -> Column:
    """First entity, in document order, one of whose types is in ``types`` (case ignored)."""
    wanted = F.transform(types if isinstance(types, Column) else F.array(*map(F.lit, types)), F.lower)
    hits = F.filter(as_col(ld), lambda v: F.arrays_overlap(F.transform(entity_types(v), F.lower), wanted))
    return F.get(hits, F.lit(0))


def main_entity(ld, types) -> Column:
    return F.coalesce(find_entity_by_type(ld, types), F.get(as_col(ld), F.lit(0)))


def meta_pairs(doc) -> Column:
    """(key, value) of every meta tag with a name and a content, in order; ``doc`` is a visible page."""
    tags = F.regexp_extract_all(as_col(doc), F.lit(META_TAG), F.lit(1))
    pairs = F.transform(
        tags,
        lambda t: F.struct(
            F.coalesce(attribute(t, "property"), attribute(t, "name")).alias("key"),
            attribute(t, "content").alias("value"),
        ),
    )
    return F.filter(pairs, lambda p: p["key"].isNotNull() & p["value"].isNotNull())


def open_graph_of(metas) -> Column:
    """og:, product: and twitter: pairs as a map; a later tag wins over an earlier one."""
    wanted = F.filter(as_col(metas), lambda p: p["key"].rlike("^(og|product|twitter):"))

    def last_of_each(pairs: Column) -> Column:
        keys = F.transform(pairs, lambda p: p["key"])
        later = lambda i: F.slice(keys, i + F.lit(2), F.size(keys))
        return F.map_from_entries(F.filter(pairs, lambda p, i: ~F.array_contains(later(i), p["key"])))

    return let(wanted, last_of_each)


def extract_open_graph(html) -> Column:
    return open_graph_of(meta_pairs(visible(html)))


def inner_text(c) -> Column:
    """Text content of an HTML fragment: tags removed, entities decoded, ends trimmed."""
    return strip(decode_entities(F.regexp_replace(as_col(c), "(?s)<[^>]*>", "")))


def title_of(doc, og) -> Column:
    """og:title, else the first heading, else the title element of a visible page."""
    h1 = non_empty(inner_text(F.regexp_extract(as_col(doc), r"(?is)<h1\b[^>]*>(.*?)</h1>", 1)))
    title = inner_text(F.regexp_extract(as_col(doc), r"(?is)<title\b[^>]*>(.*?)</title>", 1))
    return F.coalesce(non_empty(F.try_element_at(as_col(og), F.lit("og:title"))), h1, title)


def description_of(metas, og) -> Column:
    """og:description, else the description meta, else ''."""
    named = F.filter(as_col(metas), lambda p: p["key"] == "description")
    stated = non_empty(F.try_element_at(as_col(og), F.lit("og:description")))
    return F.coalesce(stated, F.get(F.transform(named, lambda p: p["value"]), F.lit(0)), F.lit(""))


def page_title(html, og) -> Column:
    return title_of(visible(html), og)


def page_description(html, og) -> Column:
    return description_of(meta_pairs(visible(html)), og)


def hrefs(html) -> Column:
    """Decoded href of every anchor, in document order."""
    tags = F.regexp_extract_all(visible(html), F.lit(ANCHOR_TAG), F.lit(1))
    return F.filter(F.transform(tags, lambda t: attribute(t, "href")), lambda h: h.isNotNull())


def image_tags(doc) -> Column:
    """Attribute text of every image of a visible page, in document order."""
    return F.regexp_extract_all(as_col(doc), F.lit(IMG_TAG), F.lit(1))


def image_urls(html, lazy_attributes=("data-src", "data-lazy-src")) -> Column:
    """First filled of src and the lazy-loading attributes of every image, in document order."""
    pick = lambda t: F.coalesce(*(attribute(t, a) for a in ("src", *lazy_attributes)))
    return F.filter(F.transform(image_tags(visible(html)), pick), lambda u: u.isNotNull())


def entity_images(entity) -> Column:
    """URLs of a JSON-LD ``image``: a string, an object with ``url``, or an array of both."""
    image = F.try_variant_get(as_col(entity), "$.image", "variant")

    def urls(v):
        many = F.try_variant_get(v, "$", "array<variant>")
        return F.when(F.schema_of_variant(v).startswith("ARRAY"), many).otherwise(F.array(v))

    def one(v):
        return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(
            text_field(v, "$.url")
        )

    found = let(image, lambda v: F.transform(urls(v), one))
    return F.coalesce(F.filter(found, lambda u: u.isNotNull()), F.array().cast("array<string>"))
