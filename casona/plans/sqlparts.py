"""SQL fragments used by several oracle queries (DuckDB dialect)."""

from casona import refdata
from casona.functions.text import SLUG_WORDS, WS_CHARS, title_noise

WS_CLASS = "[" + "".join(c if c not in "\t\n\x0b\f\r" else {"\t": "\\t", "\n": "\\n", "\x0b": "\\x0b", "\f": "\\f", "\r": "\\r"}[c] for c in WS_CHARS) + "]"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


TRIM_LIT = "(" + " || ".join(f"chr({ord(c)})" for c in WS_CHARS) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {TRIM_LIT})"


def squeeze(x: str) -> str:
    return f"regexp_replace({x}, {lit(WS_CLASS + '+')}, ' ', 'g')"


def fold(x: str) -> str:
    return strip(f"lower(strip_accents({x}))")


def half_up(cents: str, divisor: str, digits: str = "14,2") -> str:
    """cents / divisor rounded half up to whole cents, as a decimal of two places (non-negative values)."""
    return f"CAST(((2 * CAST({cents} AS HUGEINT) + {divisor}) // (2 * {divisor})) * 0.01 AS DECIMAL({digits}))"


def usd(amount: str, currency: str) -> str:
    return (
        f"CASE WHEN {currency} IS NULL OR {currency} = 'USD' THEN {amount} "
        f"WHEN {currency} = 'CRC' THEN {half_up(f'{amount} * 100', '540')} END")


def price_usd(t: str = "l") -> str:
    return usd(f"{t}.price", f"{t}.price_currency")


def per_sqm(price: str, sqm: str) -> str:
    return f"CASE WHEN {sqm} > 0 THEN {half_up(f'({price}) * 100', sqm, '12,2')} END"


def decode(x: str) -> str:
    out = f"coalesce({x}, '')"
    for entity, char in refdata.ENTITIES:
        out = f"replace({out}, {lit(entity)}, {lit(char)})"
    for token, digits, number in (
        ("&#[0-9]+;", "^&#0*([0-9]{1,7});$", "TRY_CAST(regexp_extract(p, '^&#0*([0-9]{1,7});$', 1) AS INTEGER)"),
        ("&#x[0-9a-fA-F]+;", "^&#x0*([0-9a-fA-F]{1,6});$", "TRY_CAST('0x' || regexp_extract(p, '^&#x0*([0-9a-fA-F]{1,6});$', 1) AS INTEGER)"),
    ):
        out = (
            f"array_to_string(list_transform(regexp_extract_all({out}, '(?s)({token}|[^&]+|&)'), "
            f"lambda p: CASE WHEN regexp_full_match(p, '{token}') AND {number} BETWEEN 1 AND 1114111 "
            f"AND NOT {number} BETWEEN 55296 AND 57343 THEN chr({number}) ELSE p END), '')")
    return out


def title_sql(source: str, column: str, keys: str) -> str:
    """Nested SELECTs cleaning one title column of a relation; result column clean_title."""
    sql = f"SELECT {keys}, {strip(decode(column))} AS t FROM {source}"
    sql = f"SELECT {keys}, {strip('regexp_replace(t, ' + lit(refdata.TITLE_PREFIX_NOISE) + ', %s)' % lit(''))} AS t FROM ({sql})"
    for _ in range(3):
        for pattern in title_noise():
            sql = f"SELECT {keys}, {strip('regexp_replace(t, ' + lit(pattern) + ', %s)' % lit(''))} AS t FROM ({sql})"
    edge = WS_CLASS[:-1] + "|·\\-]+"
    tidy = strip(f"regexp_replace({squeeze('t')}, {lit('^' + edge + '|' + edge + '$')}, '', 'g')")
    return f"SELECT {keys}, CASE WHEN length({tidy}) >= 3 THEN {tidy} END AS clean_title FROM ({sql})"


def slug(title: str, locality: str, key: str) -> str:
    out = f"coalesce(nullif({title}, ''), nullif({locality}, ''), 'untitled')"
    for char, word in SLUG_WORDS:
        out = f"replace({out}, {lit(char)}, {lit(word)})"
    out = f"regexp_replace(strip_accents({out}), {lit('[^A-Za-z0-9' + WS_CLASS[1:] )}, '', 'g')"
    out = f"lower(regexp_replace({strip(out)}, {lit(WS_CLASS + '+')}, '-', 'g'))"
    capped = f"CASE WHEN length({out}) > 60 THEN rtrim(substr({out}, 1, 60), '-') ELSE {out} END"
    return f"coalesce(nullif({capped}, ''), 'untitled') || '-' || substr(sha256(CAST({key} AS VARCHAR)), 1, 6)"


def haversine(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    a = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin(radians({lng2} - {lng1}) / 2), 2)")
    return f"2 * 6371.0e0 * asin(least(1.0e0, sqrt({a})))"


IN_COUNTRY = "lat BETWEEN 7.5e0 AND 12.0e0 AND lng BETWEEN -86.5e0 AND -82.0e0"

# nearest place of each kind for every listing: id, kind, km, name
NEAREST = f"""
SELECT id, kind, round(min(km), 1) AS km, arg_min(name, (km, ord)) AS name FROM (
  SELECT l.id, p.kind, p.ord, p.name, {haversine('l.lat', 'l.lng', 'p.p_lat', 'p.p_lng')} AS km
  FROM v_listings l JOIN f_places p ON l.lat BETWEEN 7.5e0 AND 12.0e0 AND l.lng BETWEEN -86.5e0 AND -82.0e0
) WHERE km <= 200 GROUP BY id, kind"""

NEAREST_WIDE = f"""
SELECT id,
 CAST(max(km) FILTER (kind = 'beach') AS DECIMAL(6,1)) AS distance_to_beach_km,
 CAST(max(km) FILTER (kind = 'airport') AS DECIMAL(6,1)) AS distance_to_airport_km,
 max(name) FILTER (kind = 'airport') AS nearest_airport_code,
 CAST(max(km) FILTER (kind = 'hospital') AS DECIMAL(6,1)) AS distance_to_hospital_km,
 max(name) FILTER (kind = 'hospital') AS nearest_hospital_name,
 CAST(max(km) FILTER (kind = 'school') AS DECIMAL(6,1)) AS distance_to_school_km,
 max(name) FILTER (kind = 'school') AS nearest_school_name
FROM ({NEAREST}) GROUP BY id"""


def region_of(x: str) -> str:
    """Region of one place name: exact gazetteer key, else the first key contained in it."""
    exact = f"(SELECT arg_min(region, ord) FROM f_localities g WHERE g.key = {fold(x)})"
    within = f"(SELECT arg_min(region, ord) FROM f_localities g WHERE contains({fold(x)}, g.key))"
    return f"CASE WHEN nullif({x}, '') IS NOT NULL THEN coalesce({exact}, {within}) END"


BOX_OF = "(SELECT arg_min(region, ord) FROM f_boxes b WHERE lat BETWEEN b.lat1 AND b.lat2 AND lng BETWEEN b.lng1 AND b.lng2)"


def category_list(kind: str, price: str, beach: str, features: str, tags: str) -> str:
    return f"""list_filter([
  CASE WHEN {kind} IN ('house', 'farm') THEN 'homes-and-villas' END,
  CASE WHEN {kind} = 'condo' THEN 'condominiums' END,
  CASE WHEN {kind} = 'lot' THEN 'lots' END,
  CASE WHEN coalesce({beach} <= 5, false) OR list_has_any(coalesce({features}, []), ['beachfront', 'oceanfront', 'walk_to_beach'])
         OR list_contains(coalesce({tags}, []), 'beachfront') THEN 'beach-properties' END,
  CASE WHEN coalesce({price} >= 1000000, false) OR list_contains(coalesce({tags}, []), 'luxury') THEN 'luxury-properties' END
], lambda x: x IS NOT NULL)"""


def stamp(x: str) -> str:
    """Timestamp as text, free of any session time zone."""
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"
