"""Text clean-up as JVM-side column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from casona import refdata

# Whitespace as browsers define it; Java's \s leaves out the Unicode spaces.
WS_CHARS = "\t\n\x0b\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
WS = r"[\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def strip(c) -> Column:
    """Trim every kind of whitespace from both ends."""
    return F.trim(as_col(c), F.lit(WS_CHARS))


def squeeze(c) -> Column:
    """Collapse runs of whitespace into one space."""
    return F.regexp_replace(as_col(c), f"{WS}+", " ")


def non_empty(c) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def non_blank(c) -> Column:
    c = as_col(c)
    return F.when(strip(c) != "", c)


def _accent_tables() -> tuple[str, str]:
    """Letters that decompose into one base letter plus combining marks."""
    source, target = [], []
    for block in (range(0xC0, 0x250), range(0x370, 0x530), range(0x1E00, 0x2000)):
        for code in block:
            char = chr(code)
            base = "".join(x for x in unicodedata.normalize("NFD", char) if not 0x300 <= ord(x) <= 0x36F)
            if len(base) == 1 and base != char:
                source.append(char)
                target.append(base)
    return "".join(source), "".join(target)


ACCENTED, PLAIN = _accent_tables()


def strip_accents(c) -> Column:
    return F.translate(F.regexp_replace(as_col(c), r"[\u0300-\u036f]", ""), ACCENTED, PLAIN)


def fold_text(c) -> Column:
    """Accent-free, lower-case, trimmed text used as a lookup key."""
    return strip(F.lower(strip_accents(c)))


# ---------------------------------------------------------------- entities

def _decode_references(text: Column, token: str, digits: str, base: int) -> Column:
    """Replace numeric character references; out-of-range ones stay as written."""

    def decode(part):
        number = F.conv(non_empty(F.regexp_extract(part, digits, 1)), base, 10).try_cast("bigint")
        valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        return F.when(part.rlike(f"^{token}$") & valid, char).otherwise(part)

    parts = F.regexp_extract_all(text, F.lit(f"(?s)({token}|[^&]+|&)"), F.lit(1))
    return F.array_join(F.transform(parts, decode), "")


def decode_entities(c) -> Column:
    """Named entities in table order, then decimal, then hexadecimal references; null gives ''."""

    def named(text: Column) -> Column:
        out = text
        for entity, char in refdata.ENTITIES:
            out = F.replace(out, F.lit(entity), F.lit(char))
        return out

    def numeric(text: Column) -> Column:
        decimal = _decode_references(text, "&#[0-9]+;", "^&#0*([0-9]{1,7});$", 10)
        both = _decode_references(decimal, "&#x[0-9a-fA-F]+;", "^&#x0*([0-9a-fA-F]{1,6});$", 16)
        return F.when(text.contains("&#"), both).otherwise(text)

    # most texts hold no entity at all and pass through untouched
    given = F.coalesce(as_col(c), F.lit(""))
    return let(given, lambda t: F.when(t.contains("&"), let(named(t), numeric)).otherwise(t))


# ---------------------------------------------------------------- titles and descriptions

def title_noise(own_brands: Sequence[str] = ()) -> list[str]:
    """Ordered tail patterns; ``own_brands`` are regex names of the publisher's own brand."""
    brands = [rf"(?i) [-|·] {name}.*$" for name in (*refdata.TITLE_PORTAL_NAMES, *own_brands)]
    return brands + refdata.TITLE_COUNTRY_TAILS + [refdata.TITLE_SEARCH_ELLIPSIS] + refdata.TITLE_PRICE_TAILS


def _noise_pass(title: Column, patterns: Sequence[str]) -> Column:
    for pattern in patterns:
        if pattern == refdata.TITLE_SEARCH_ELLIPSIS:
            # the only unanchored pattern: drop its first match only
            body = pattern.removeprefix("(?i)")
            title = F.regexp_replace(title, rf"(?i)\A([\s\S]*?){body}", "$1")
        else:
            title = F.regexp_replace(title, pattern, "")
        title = strip(title)
    return title


def clean_title(c, own_brands: Sequence[str] = ()) -> Column:
    """Decode, drop portal prefixes and up to three layers of tail noise; under 3 chars gives null."""
    patterns = title_noise(own_brands)
    any_noise = "|".join(f"(?:{p})" for p in patterns)

    def passes(title: Column, left: int) -> Column:
        if left == 0:
            return title
        return F.when(
            title.rlike(any_noise),
            let(_noise_pass(title, patterns), lambda t: passes(t, left - 1)),
        ).otherwise(title)

    start = strip(F.regexp_replace(strip(decode_entities(c)), refdata.TITLE_PREFIX_NOISE, ""))
    edge = WS[:-1] + r"\-|·]+"
    done = squeeze(let(start, lambda t: passes(t, 3)))
    done = strip(F.regexp_replace(done, f"^{edge}|{edge}$", ""))
    return let(done, lambda t: F.when(F.length(t) >= 3, t))


def clean_description(c) -> Column:
    return let(strip(squeeze(decode_entities(c))), lambda t: F.when(F.length(t) >= 10, t))


def pick_primary_title(en, es) -> Column:
    return F.coalesce(clean_title(en), clean_title(es))


# ---- fixed values: symbols spelled out in slugs (Spanish locale) ----
SLUG_WORDS = [
    ("&", "y"), ("%", "por ciento"), ("$", "dollar"), ("|", "o"), ("<", "menor que"), (">", "mayor que"),
    ("¢", "centavos"), ("£", "libras"), ("€", "euro"), ("ß", "ss"), ("-", " "),
]


def build_slug(title, locality, key, max_len: int = 60) -> Column:
    """ASCII slug of title, else locality, plus six hex digits of the row key's SHA-256."""
    base = F.coalesce(non_empty(title), non_empty(locality), F.lit("untitled"))
    for char, word in SLUG_WORDS:
        base = F.replace(base, F.lit(char), F.lit(word))
    text = F.regexp_replace(strip_accents(base), "[^A-Za-z0-9" + WS[1:], "")
    slug = F.lower(F.regexp_replace(strip(text), f"{WS}+", "-"))
    capped = F.when(F.length(slug) > max_len, F.rtrim(F.substring(slug, 1, max_len), F.lit("-"))).otherwise(slug)
    suffix = F.substring(F.sha2(as_col(key).cast("string"), 256), 1, 6)
    return F.concat_ws("-", F.coalesce(non_empty(capped), F.lit("untitled")), suffix)


# ---------------------------------------------------------------- HTML as text

def strip_noise(html) -> Column:
    """Drop scripts, styles, comments, page chrome, icons and styling attributes; collapse whitespace."""
    out = as_col(html)
    for tag in ("script", "style", "noscript", "template"):
        out = F.regexp_replace(out, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", "")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->", "")
    for tag in ("header", "footer", "nav", "svg"):
        out = F.regexp_replace(out, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", "")
    out = F.regexp_replace(
        out, r"""(?i)\s(style|onclick|onload|onerror|data-[\w-]+|aria-[\w-]+|class)=("[^"]*"|'[^']*'|[^\s>]+)""", ""
    )
    return strip(squeeze(out))


def truncate_text(c, limit: int = refdata.PROMPT_HTML_CHARS) -> Column:
    c = as_col(c)
    cut = F.concat(F.substring(c, 1, limit), F.lit("\n... [truncated]"))
    return F.when(F.length(c) > limit, cut).otherwise(c)


def humanize(c) -> Column:
    """``ocean_view`` -> ``Ocean View``; later letters keep their case."""
    words = F.split(as_col(c), "[_-]")
    upper_first = F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2))))
    return F.array_join(upper_first, " ")


def region_label(slug) -> Column:
    words = F.split(as_col(slug), "-")
    upper_first = F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2))))
    return F.array_join(upper_first, " ")


# ---------------------------------------------------------------- facts stated in prose

_BEDS = r"(?i)(\d+)\s*-?\s*(?:bed(?:room)?s?|br|habitaci[oó]n(?:es)?|dormitorios?|cuartos?|rec[aá]maras?)\b"
_BATHS = r"(?i)(\d+(?:\.\d)?(?:\s?½)?)\s*-?\s*(?:full\s+)?(?:bath(?:room)?s?|ba|baños?)\b"
_FULL = r"(?i)(\d+)\s*full\b"
_HALF = r"(?i)(\d+)\s*half\b"
_HALF_WORDS = r"(?i)(medio baño|half[- ]bath|powder room|social bathroom)"
_UNIT = r"(m²|m2|mts2|metros cuadrados|sq\.?\s?ft|sqft|square feet|acres?)"
_LOT = r"(?:lot|land|plot|terreno|lote)"
_AREA = rf"(?i)(\d[\d,]*(?:\.\d+)?)\s*{_UNIT}"
_LOT_AREA = rf"(?i)(\d[\d,]*(?:\.\d+)?)\s*{_UNIT}\s*(?:of\s+|de\s+)?{_LOT}\b"
_LOT_BEFORE = rf"(?i)\b{_LOT}[^.\d]{{0,20}}?(\d[\d,]*(?:\.\d+)?)\s*{_UNIT}"
_USD = r"(?i)(?:US\$|USD\s?\$?|\$)\s?(\d[\d,]*(?:\.\d+)?)"
_CRC = r"(?i)(?:₡|CRC\s?)\s?(\d[\d,]*(?:\.\d+)?)"
_ES_WORDS = r"(?i)\b(el|la|los|las|de|en|con|para|casa|venta|baños?|habitaciones|terreno)\b"
_EN_WORDS = r"(?i)\b(the|and|with|for|house|home|sale|bath(?:room)?s?|bed(?:room)?s?|lot)\b"


def _number(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("decimal(14,4)")


def unit_to_sqm(value, unit) -> Column:
    """Square metres, rounded to 2; unknown units give null."""
    unit = F.lower(as_col(unit))
    value = as_col(value).cast("decimal(14,4)")
    factor = (
        F.when(unit.rlike(r"^(m²|m2|mts2|metros cuadrados|sqm)$"), F.lit("1").cast("decimal(10,6)"))
        .when(unit.rlike(r"^(sq\.?\s?ft|square feet)$"), F.lit(refdata.SQM_PER_SQFT).cast("decimal(10,6)"))
        .when(unit.rlike(r"^acres?$"), F.lit(refdata.SQM_PER_ACRE).cast("decimal(10,6)"))
    )
    return F.round(value * factor, 2).cast("decimal(14,2)")


def _area(text: Column, pattern: str) -> Column:
    return unit_to_sqm(_number(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2))


def extract_facts(c) -> Column:
    """Bedrooms, baths, areas, price and language that a text states outright.

    A half bath is a stated ".5", "½", "N half" or one of the half-bath words; an area is
    the lot when a lot word stands next to it, otherwise the interior.
    """

    def facts(text: Column) -> Column:
        baths = F.regexp_extract(text, _BATHS, 1)
        stated_half = baths.rlike(r"\.5|½")
        whole = F.regexp_extract(baths, r"^(\d+)", 1).try_cast("int")
        half = (
            F.when(stated_half, F.lit(1))
            .when(text.rlike(_HALF), F.regexp_extract(text, _HALF, 1).try_cast("int"))
            .when(text.rlike(_HALF_WORDS), F.lit(1))
        )
        full = F.coalesce(F.regexp_extract(text, _FULL, 1).try_cast("int"), whole)
        total = (F.coalesce(full, F.lit(0)) + F.coalesce(half, F.lit(0)) * F.lit(0.5)).cast("decimal(4,1)")
        lot = F.coalesce(_area(text, _LOT_AREA), _area(text, _LOT_BEFORE))
        interior = _area(F.regexp_replace(F.regexp_replace(text, _LOT_AREA, " "), _LOT_BEFORE, " "), _AREA)
        usd, crc = _number(F.regexp_extract(text, _USD, 1)), _number(F.regexp_extract(text, _CRC, 1))
        es, en = F.regexp_count(text, F.lit(_ES_WORDS)), F.regexp_count(text, F.lit(_EN_WORDS))
        return F.struct(
            F.regexp_extract(text, _BEDS, 1).try_cast("int").alias("bedrooms"),
            F.when(full.isNotNull() | half.isNotNull(), total).alias("bathrooms"),
            full.alias("bathrooms_full"),
            half.alias("bathrooms_half"),
            interior.alias("interior_sqm"),
            lot.alias("lot_sqm"),
            F.coalesce(usd, crc).cast("decimal(14,2)").alias("price"),
            F.when(usd.isNotNull(), "USD").when(crc.isNotNull(), "CRC").alias("price_currency"),
            F.when((es == 0) & (en == 0), "unknown")
            .when(es >= 3 * en, "es")
            .when(en >= 3 * es, "en")
            .otherwise("mixed")
            .alias("language"),
        )

    return let(as_col(c), facts)
