"""Pages to payloads to typed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casona import refdata, schemas
from casona.functions import dom, html, text, urls
from casona.functions.text import as_col, let, non_blank, non_empty, strip

LAZY = ("data-src", "data-lazy", "data-lazy-src", "data-original")
IMAGE_FILE = r"(?i)\.(jpe?g|png|webp|avif)"
PHONE = r"((?:\+?506[-\s]?)?\d{4}[-\s]?\d{4})"
EMAIL = r"([a-zA-Z0-9._-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,})"


# ---------------------------------------------------------------- page -> payload

def with_structured_data(pages: DataFrame) -> DataFrame:
    """JSON-LD objects, Open Graph map, title and description of each page; ``doc`` is its visible part.

    Built in steps, so each page is stripped and its meta tags are read once.
    """
    read = pages.withColumn("doc", html.visible("html")).withColumn("_metas", html.meta_pairs("doc"))
    read = read.withColumns({"json_ld": html.extract_json_ld("html"), "og": html.open_graph_of("_metas")})
    return read.withColumns({
        "title": html.title_of("doc", "og"), "description": html.description_of("_metas", "og"),
    }).drop("_metas")


def harvest_photos() -> Column:
    """Photo URLs of a page: JSON-LD images, page images, og:image; absolute and deduplicated.

    Reads json_ld, og, doc, url, gallery_images and the rule columns.
    """
    def pick(tag):
        allowed = [F.when(F.array_contains("image_attributes", a), html.attribute(tag, a)) for a in LAZY]
        return F.coalesce(html.attribute(tag, "src"), *allowed)

    absolute = lambda arr: F.transform(arr, lambda u: urls.absolutize_url(u, F.col("url")))
    entity = absolute(html.entity_images(html.main_entity("json_ld", F.col("entity_types"))))
    found = F.transform(html.image_tags("doc"), pick)
    page_images = F.when(F.col("gallery_only"), F.col("gallery_images")).otherwise(found)
    shown = F.filter(
        absolute(F.array_compact(page_images)),
        lambda u: u.rlike(IMAGE_FILE) & ~F.coalesce(F.regexp_like(u, F.col("image_exclude")), F.lit(False)),
    )
    og = absolute(F.array_compact(F.array(F.try_element_at("og", F.lit("og:image")))))
    ordered = F.when(F.col("photo_order") == "open_graph_first", F.concat(og, entity, shown)).otherwise(
        F.concat(entity, shown, og)
    )
    return urls.dedupe_photo_urls(ordered)


def _place_names(names: Column, noise, max_len) -> Column:
    trimmed = F.transform(names, strip)
    return F.filter(trimmed, lambda n: (n != "") & (F.length(n) < max_len) & ~F.regexp_like(n, noise))


def extract_breadcrumbs() -> Column:
    """Place names from the first usable BreadcrumbList, else from the visible breadcrumb links.

    Reads json_ld, breadcrumb_links, breadcrumb_noise and breadcrumb_max; sources without a noise
    rule publish none.
    """
    def names(entity):
        items = F.try_variant_get(entity, "$.itemListElement", "array<variant>")

        def name(i):
            plain = F.when(F.schema_of_variant(i) == "STRING", F.try_variant_get(i, "$", "string"))
            return F.coalesce(plain, html.text_field(i, "$.name"), html.text_field(i, "$.item.name"), F.lit(""))

        return F.coalesce(F.transform(items, name), F.array().cast("array<string>"))

    lists = F.filter("json_ld", lambda v: F.array_contains(html.entity_types(v), "BreadcrumbList"))
    cleaned = F.transform(lists, lambda v: _place_names(names(v), F.col("breadcrumb_noise"), F.col("breadcrumb_max")))
    usable = F.get(F.filter(cleaned, lambda c: F.size(c) >= 2), F.lit(0))
    visible = _place_names(F.col("breadcrumb_links"), F.col("breadcrumb_noise"), F.col("breadcrumb_max"))
    return F.when(F.col("breadcrumb_noise").isNotNull(), F.coalesce(usable, F.array_distinct(visible)))


def extract_contact(c) -> Column:
    """First local phone number and first e-mail address of a text."""
    c = as_col(c)
    return F.struct(
        non_empty(F.regexp_extract(c, PHONE, 1)).alias("phone"), non_empty(F.regexp_extract(c, EMAIL, 1)).alias("email")
    )


def body_text(c) -> Column:
    """Text of the page body, scripts included as browsers' textContent does."""
    body = F.regexp_extract(as_col(c), r"(?is)<body\b[^>]*>(.*)", 1)
    return text.decode_entities(F.regexp_replace(body, "(?s)<!--.*?-->|<[^>]*>", ""))


def assemble_payload(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """One raw payload per page (source, url, html): ids, structured data, breadcrumbs, photos.

    The rule table is a row per source and is joined by name. Nested-element fields come from one
    mapInPandas pass in the pages' partitions, which sees the page and one flag; rules join after it.
    """
    flagged = pages.join(rules.select("source", "classifieds"), "source")
    parsed = dom.dom_fields(flagged, pages.columns, classifieds="classifieds")
    data = with_structured_data(parsed.join(rules, "source"))
    entity = html.main_entity("json_ld", F.col("entity_types"))
    sku = F.coalesce(html.text_field(entity, "$.sku"), html.text_field(entity, "$.productID"), html.text_field(entity, "$.identifier"))
    contact = extract_contact(body_text("html"))
    rows = data.withColumns({
        "source_listing_id": urls.source_listing_id("url", "id_rule", sku, "data_id"),
        "breadcrumbs": extract_breadcrumbs(),
        "photo_urls": harvest_photos(),
        "agent": F.when(
            F.col("classifieds"),
            F.struct(F.col("seller_text").alias("name"), contact["phone"].alias("phone"), contact["email"].alias("email")),
        ),
        "detail_text": F.when(F.col("breadcrumb_noise").isNotNull(), F.col("detail_text")),
        "mls_id": F.when(F.col("source") == "mlscr", F.col("mls_text")),
        "site_name": F.when(
            F.col("source") == "developers-generic",
            F.coalesce(F.try_element_at("og", F.lit("og:site_name")), urls.url_host("url")),
        ),
    })
    extracted = F.to_json(F.struct(
        "json_ld", "og", "title", "description", "breadcrumbs", "agent", "detail_text", "mls_id", "site_name",
    ))
    photos = F.transform("photo_urls", lambda u, i: F.struct(u.alias("url"), i.alias("position")))
    return rows.select(
        "source", "source_listing_id", F.col("url").alias("source_url"), F.col("html").alias("raw_html"),
        extracted.alias("raw_extracted"), "breadcrumbs", photos.alias("photos"),
    )


def source_coverage_report(payloads: DataFrame) -> DataFrame:
    """What each source yields: pages, sizes, photos, breadcrumbs, populated fields, usable pages."""
    fields = F.from_json("raw_extracted", "map<string,string>")
    filled = F.filter(F.map_values(fields), lambda v: v.isNotNull() & ~v.isin("", "[]", "null"))
    title = F.get_json_object("raw_extracted", "$.title")
    rows = payloads.select(
        "source", F.length("raw_html").alias("_bytes"), F.size("photos").alias("_photos"),
        F.greatest(F.size(F.coalesce("breadcrumbs", F.array().cast("array<string>"))), F.lit(0)).alias("_crumbs"),
        F.coalesce(F.size(filled), F.lit(0)).alias("_fields"), F.coalesce(F.length(title), F.lit(0)).alias("_title"),
    )
    usable = (F.col("_bytes") > 5000) & ((F.col("_photos") > 0) | (F.col("_title") > 0))
    return rows.groupBy("source").agg(
        F.count("*").alias("urls"), F.sum("_bytes").alias("html_chars"), F.sum("_photos").alias("photos"),
        F.sum("_crumbs").alias("breadcrumbs"), F.sum("_fields").alias("fields"), F.count_if(usable).alias("usable"),
    )


# ---------------------------------------------------------------- reply -> typed record

def parse_tolerant_json(c) -> Column:
    """JSON of a reply that may be fenced or preceded by prose, as VARIANT; null when it does not parse."""
    def body(reply):
        fence = F.regexp_extract(reply, r"(?s)```(?:json)?\s*(.*?)```", 1)
        inner = F.when(reply.rlike(r"(?s)```(?:json)?\s*.*?```"), fence).otherwise(reply)
        return F.coalesce(non_empty(F.regexp_extract(inner, r"(?s)([\[{].*)$", 1)), inner)

    # a value followed by other text is not JSON
    return let(let(as_col(c), body), lambda b: F.when(_complete(b), F.try_parse_json(b)))


def _complete(b: Column) -> Column:
    """True when the text is one JSON value and nothing else (wrapped, it still is one array element)."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), b, F.lit("]")))
    return F.size(F.try_variant_get(wrapped, "$", "array<variant>")) == 1


def _kind(v: Column, field: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))


def _field_ok(v: Column, field: str, kind: str) -> Column:
    def check(value: Column) -> Column:
        have = F.schema_of_variant(value)
        number = have.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
        if kind == "string":
            ok = have == "STRING"
        elif kind == "boolean":
            ok = have == "BOOLEAN"
        elif kind == "number":
            ok = number
        elif kind == "int":
            whole = F.try_variant_get(value, "$", "double")
            ok = number & (whole == F.floor(whole))
        else:
            ok = ~have.startswith("ARRAY") | have.isin("ARRAY<STRING>", "ARRAY<VOID>")
        return F.when(value.isNull(), True).otherwise((have == "VOID") | F.coalesce(ok, F.lit(False)))

    return let(F.try_variant_get(v, f"$.{field}", "variant"), check)


def validate_extracted(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Typed columns of a parsed reply (VARIANT); ``valid`` is false where a type or enum is broken.

    Wrong-typed arrays and maps become empty instead of failing, as the record type declares.
    """
    v = F.col(reply)
    fields = schemas.EXTRACTED_FIELDS
    ok = v.isNotNull() & F.schema_of_variant(v).startswith("OBJECT")
    for field, kind in fields.items():
        ok = ok & _field_ok(v, field, kind)
    for field, allowed in (
        ("language", refdata.LANGUAGES), ("property_type", refdata.PROPERTY_TYPES), ("price_currency", refdata.CURRENCIES),
    ):
        value = F.try_variant_get(v, f"$.{field}", "string")
        ok = ok & (value.isNull() | value.isin(allowed))
    columns = {}
    for field, kind in fields.items():
        value = F.try_variant_get(v, f"$.{field}", schemas.spark_type(field))
        columns[field] = F.coalesce(value, F.array().cast("array<string>")) if kind == "strings" else value
    as_object = lambda f: F.coalesce(
        F.when(_kind(v, f).startswith("OBJECT"), F.to_json(F.try_variant_get(v, f"$.{f}", "variant"))), F.lit("{}"))
    columns["floorplans"] = F.coalesce(
        F.when(_kind(v, "floorplans").startswith("ARRAY"), F.to_json(F.try_variant_get(v, "$.floorplans", "variant"))),
        F.lit("[]"))
    columns["extra_data"] = as_object("extra_data")
    columns["confidence_per_field"] = as_object("confidence_per_field")
    return df.withColumns(columns | {"valid": F.coalesce(ok, F.lit(False))})


def place_levels(breadcrumbs) -> Column:
    return F.filter(as_col(breadcrumbs), lambda b: (b != "") & ~strip(b).rlike(refdata.BREADCRUMB_SKIP))


def breadcrumb_fallback(df: DataFrame) -> DataFrame:
    """Breadcrumb levels fill missing province, canton, district and locality, in that order."""
    with_levels = df.withColumn("_levels", place_levels("breadcrumbs"))
    fill = lambda name, i: F.coalesce(non_empty(name), F.get("_levels", F.lit(i)), F.col(name))
    return with_levels.withColumns({
        name: fill(name, i) for i, name in enumerate(("province", "canton", "district", "locality"))
    }).drop("_levels")


def title_backstop(df: DataFrame) -> DataFrame:
    """Blank title -> title the page stated -> og:title."""
    stated = lambda path: non_empty(strip(F.get_json_object("raw_extracted", path)))
    return df.withColumn(
        "title", F.coalesce(non_blank("title"), stated("$.title"), stated("$.og['og:title']"), F.col("title")))


SALVAGE_NOTE = "salvaged from raw_extracted after AI parse failure"


def salvage_record(df: DataFrame, raw: str = "raw_extracted") -> DataFrame:
    """Minimal record from the page's own structured data, for rows without a usable reply."""
    v = F.try_parse_json(raw)

    def number(*paths):
        first = F.coalesce(*(F.try_variant_get(v, p, "string") for p in paths))
        return first.try_cast("double")

    def string(*paths):
        first = F.coalesce(*(F.try_variant_get(v, p, "variant") for p in paths))
        return let(first, lambda x: F.when(
            F.schema_of_variant(x) == "STRING", non_blank(F.try_variant_get(x, "$", "string"))))

    currency = string("$.priceCurrency", "$.offers.priceCurrency")
    levels = place_levels("breadcrumbs")
    found = {
        "title": string("$.name", "$.title"),
        "description": string("$.description"),
        "language": F.lit("unknown"),
        "price": number("$.price", "$.offers.price"),
        "price_currency": let(currency, lambda c: F.when(c.isin(refdata.CURRENCIES), c)),
        "bedrooms": number("$.numberOfRooms", "$.bedrooms"),
        "bathrooms": number("$.numberOfBathroomsTotal", "$.bathrooms"),
        "interior_sqm": number("$.floorSize"),
        "lot_sqm": number("$.lotSize"),
        "province": F.get(levels, F.lit(0)),
        "canton": F.get(levels, F.lit(1)),
        "district": F.get(levels, F.lit(2)),
        "locality": F.coalesce(F.get(levels, F.lit(3)), string("$.address.addressLocality")),
        "address_line": string("$.address.streetAddress"),
        "lat": number("$.geo.latitude"),
        "lng": number("$.geo.longitude"),
        "notes": F.lit(SALVAGE_NOTE),
    }
    columns = {}
    for field, kind in schemas.EXTRACTED_FIELDS.items():
        empty = F.array().cast("array<string>") if kind == "strings" else F.lit(None).cast(schemas.spark_type(field))
        # a number too large for its column is dropped, not raised
        columns[field] = found[field].try_cast(schemas.spark_type(field)) if field in found else empty
    columns |= {"floorplans": F.lit("[]"), "extra_data": F.lit("{}"), "confidence_per_field": F.lit("{}")}
    return df.withColumns(columns)


def prompt_key(html_col, raw_extracted, breadcrumbs, url) -> Column:
    """Key of a stored reply: SHA-256 over url, breadcrumbs, structured data and the whole page without noise."""
    return F.sha2(F.concat_ws(
        "\n", as_col(url), F.coalesce(F.to_json(as_col(breadcrumbs)), F.lit("")), as_col(raw_extracted),
        text.strip_noise(html_col),
    ), 256)


def apply_extraction(payloads: DataFrame, responses: DataFrame, replied: str | None = None) -> DataFrame:
    """Typed record per payload from stored replies (prompt_key, reply); the rest is salvaged.

    One shuffle join on the key; a key stored twice keeps its greatest reply, so the result does
    not depend on order. ``replied`` names a column that tells whether there was a reply.
    """
    stored = responses.groupBy(F.col("prompt_key").alias("_key")).agg(F.max("reply").alias("_text"))
    keyed = payloads.withColumn("_key", prompt_key("raw_html", "raw_extracted", "breadcrumbs", "source_url"))
    joined = keyed.join(stored, "_key", "left").drop("_key")
    answered = {replied: F.col("_text").isNotNull()} if replied else {}
    parsed = joined.withColumns({**answered, "_reply": parse_tolerant_json("_text")}).drop("_text")
    names = [*schemas.EXTRACTED_FIELDS, "floorplans", "extra_data", "confidence_per_field"]
    read = validate_extracted(parsed, "_reply").drop("_reply")
    typed = title_backstop(breadcrumb_fallback(read)).withColumn("_read", F.struct(*names)).drop(*names)
    both = salvage_record(typed).withColumn("_salvaged", F.struct(*names)).drop(*names)
    chosen = F.when(F.col("valid"), F.col("_read")).otherwise(F.col("_salvaged"))
    return both.withColumn("_r", chosen).select(*payloads.columns, "_r.*", (~F.col("valid")).alias("salvaged"), *answered)
