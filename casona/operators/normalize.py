"""Normalization: money, places, distances, slugs and clean copy.

Everything row-wise is one projection; only table-sized lookups (gazetteers of
coordinates, long place lists) shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from casona import refdata
from casona.functions import geo, money, text
from casona.functions.text import as_col, let, non_empty
from casona.operators.hotkeys import hot_join
from casona.session import checkpoint, stored

def to_usd(df: DataFrame, amount: str, currency: str, rates: DataFrame, out: str) -> DataFrame:
    """USD value of an amount column through a rates table (currency, rate per USD)."""
    return fees_to_usd(df, {amount: out}, currency, rates)


def fees_to_usd(df: DataFrame, columns: dict[str, str], currency: str, rates: DataFrame) -> DataFrame:
    """USD value of several amount columns sharing one currency column (in -> out), by one join.

    No hint: Spark broadcasts the rates when their size is under its threshold.
    """
    lookup = rates.groupBy(F.col("currency").alias("_cur")).agg(F.max("rate").alias("_rate"))
    joined = df.join(lookup, df[currency] == F.col("_cur"), "left")
    return joined.withColumns(
        {out: money.usd_amount(name, currency, "_rate") for name, out in columns.items()}
    ).drop("_cur", "_rate")


# ---------------------------------------------------------------- regions

def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _exact(folded: Column, gazetteer) -> Column:
    first: dict[str, str] = {}
    for key, region in gazetteer:
        first.setdefault(key, region)
    table = F.expr("map(" + ", ".join(f"{_quoted(k)}, {_quoted(r)}" for k, r in first.items()) + ")")
    return F.try_element_at(table, folded)


def _contained(folded: Column, gazetteer) -> Column:
    rows = ", ".join(f"named_struct('key', {_quoted(k)}, 'region', {_quoted(r)})" for k, r in gazetteer)
    hits = F.filter(F.expr(f"array({rows})"), lambda g: folded.contains(g["key"]))
    return F.get(hits, F.lit(0))["region"]


def region_by_locality_exact(name, gazetteer=tuple(refdata.GAZETTEER)) -> Column:
    """Region of a folded name that is a gazetteer key."""
    return _exact(text.fold_text(name), gazetteer)


def region_by_locality_contains(name, gazetteer=tuple(refdata.GAZETTEER)) -> Column:
    """Region of the first gazetteer key, in list order, that occurs in the folded name."""
    return let(text.fold_text(name), lambda folded: _contained(folded, gazetteer))


#: Characters of the longest gram that lists a key, and of the keys that are sent to the names instead.
LONGEST_GRAM, SHORT_KEY = 6, 3
#: Short keys, or ends of grams, that may be broadcast.
MOST_SENT = 100_000


def region_by_gazetteer(df: DataFrame, gazetteer: DataFrame, name: str = "locality", out: str = "region_slug") -> DataFrame:
    """Rows with the region of the first gazetteer row (ord, key, region), by ``ord``, whose key occurs in the folded name.

    For gazetteers of any length. Keys of up to SHORT_KEY characters go to the names. Longer ones
    are listed under themselves, or their rarest gram if they have over LONGEST_GRAM characters. Each
    distinct name asks for those of its own grams that begin and end like a listed one, by its
    number; its text goes along only where a found key must still be looked for. Keys are folded
    already; a null name, key or order has no region, and an empty key occurs in every name that is
    not null.
    """
    keys = stored(gazetteer.select("ord", "key", "region").filter("ord IS NOT NULL AND key IS NOT NULL").groupBy("key").agg(
        F.min(F.struct("ord", "region")).alias("_g")).select("key", "_g.*"), "gazetteer-keys")
    folded = df.withColumn("_folded", text.fold_text(name))
    names = folded.select("_folded").filter("_folded IS NOT NULL").distinct()
    names = stored(names.select(F.monotonically_increasing_id().alias("_id"), "_folded"), "gazetteer-names")
    own, size = F.col("_folded"), F.length("key")
    places = names.withColumn("_i", F.explode(F.sequence(F.lit(1), F.greatest(F.length(own), F.lit(1)))))

    def pieces(rows: DataFrame, c, lengths: Sequence[int], name: str) -> DataFrame:
        """The pieces of ``c`` of some lengths that begin at place _i."""
        each = rows.withColumn("_n", F.explode(F.array(*map(F.lit, lengths)))).withColumn(name, F.substr(c, F.col("_i"), F.col("_n")))
        return each.filter(F.length(name) == F.col("_n"))

    def sent(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if rows.limit(MOST_SENT + 1).count() <= MOST_SENT else rows

    def asked(listed: DataFrame, lengths: Sequence[int], *carried: str) -> DataFrame:
        """Grams of the names that begin and end like one of ``listed``."""
        tail = F.expr(f"right(_gram, {SHORT_KEY})").alias("_tail")
        heads = listed.select(F.substring("_gram", 1, SHORT_KEY).alias("_head")).distinct()
        tails = listed.select(F.length("_gram").alias("_n"), tail).distinct()
        begun = places.withColumn("_head", F.substr(own, F.col("_i"), F.lit(SHORT_KEY))).join(sent(heads), "_head", "left_semi")
        whole = pieces(begun, own, lengths, "_gram").select("_id", *carried, "_gram", "_n", tail)
        return whole.join(sent(tails), ["_n", "_tail"], "left_semi").select("_id", *carried, "_gram")

    short, middle, long = keys.filter(size <= SHORT_KEY), keys.filter((size > SHORT_KEY) & (size <= LONGEST_GRAM)), keys.filter(size > LONGEST_GRAM)
    by_short = pieces(places, own, range(SHORT_KEY + 1), "key").filter("_n > 0 OR _i = 1").select("_id", "key").join(sent(short), "key")
    middle = middle.withColumnRenamed("key", "_gram")
    by_middle = asked(middle, range(SHORT_KEY + 1, LONGEST_GRAM + 1)).join(middle, "_gram")
    parts = pieces(long.withColumn("_i", F.explode(F.sequence(F.lit(1), size))), F.col("key"), [LONGEST_GRAM], "_gram").drop("_i", "_n").distinct()
    common = parts.groupBy("_gram").agg(F.count("*").alias("_n"))
    index = parts.join(common, "_gram").groupBy("key", "ord", "region").agg(F.min_by("_gram", F.struct("_n", "_gram")).alias("_gram"))
    index = stored(index, "gazetteer-grams")
    by_long = asked(index, [LONGEST_GRAM], "_folded").join(index, "_gram").filter(own.contains(F.col("key")))
    first = [rows.select("_id", "ord", "region").groupBy("_id").agg(F.min(F.struct("ord", "region")).alias("_g")) for rows in (by_short, by_middle, by_long)]
    found = first[0].unionByName(first[1]).unionByName(first[2]).groupBy("_id").agg(F.min("_g").alias("_g"))
    regions = names.join(found, "_id").select(own.alias("_name"), F.col("_g.region").alias("_region"))
    return folded.join(regions, own == F.col("_name"), "left").withColumn(out, F.col("_region")).drop("_folded", "_name", "_region")


def region_from_levels(*names, gazetteer=tuple(refdata.GAZETTEER)) -> Column:
    """First name that yields a region; for each name the exact key goes before containment."""
    def region(name) -> Column:
        folded = text.fold_text(non_empty(as_col(name)))
        return let(folded, lambda f: F.coalesce(_exact(f, gazetteer), _contained(f, gazetteer)))

    return F.coalesce(*(region(name) for name in names))


def assign_region(df: DataFrame) -> DataFrame:
    """Region from the place names, else from (geocoded) coordinates."""
    return df.withColumn(
        "region_slug",
        F.coalesce(
            region_from_levels("locality", "canton", "district", "province"), geo.region_by_bbox("lat", "lng")
        ),
    )


# ---------------------------------------------------------------- geocoding

def geocode_query() -> Column:
    """Most specific to least specific address parts; null when only the country is known."""
    parts = F.array_compact(F.array(*(
        non_empty(F.col(c)) for c in ("address_line", "locality", "district", "canton", "province")
    )))
    return F.when(F.size(parts) > 0, F.concat_ws(", ", F.array_join(parts, ", "), F.lit("Costa Rica")))


def geocode_lookup(df: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Coordinates for rows without them, from a table (query, lat, lng, place_type).

    Hits outside the country are dropped. Confidence follows the place type; coordinates
    given by the source are ``exact``. The join key is the distinct query text, so Spark
    picks broadcast or sort-merge by the gazetteer's real size and AQE splits hot queries. Rows
    that need no lookup get keys of their own that meet nothing, not one null key.
    """
    kind = F.col("place_type")
    confidence = (
        F.when(kind == "address", "exact")
        .when(kind == "neighborhood", "neighborhood")
        .when(kind.isin("place", "locality"), "block")
        .otherwise("region")
    )
    places = (
        gazetteer.filter(geo.in_country("lat", "lng"))
        .groupBy(F.col("query").alias("_q"))
        .agg(F.min_by(F.struct(F.col("lat").alias("lat"), F.col("lng").alias("lng"), confidence.alias("conf")),
                      F.struct("lat", "lng", "place_type")).alias("_hit"))
    )
    known = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    asked = df.withColumn("_ask", F.coalesce(
        F.when(~known, geocode_query()), F.concat(F.lit("\u0000"), F.xxhash64("lat", "lng").cast("string"))))
    joined = asked.join(places, F.col("_ask") == F.col("_q"), "left")
    found = F.col("_hit").isNotNull()
    return joined.withColumns({
        "geocode_confidence": F.when(known, "exact").when(found, F.col("_hit.conf")),
        "lat": F.when(known | ~found, F.col("lat")).otherwise(F.col("_hit.lat")),
        "lng": F.when(known | ~found, F.col("lng")).otherwise(F.col("_hit.lng")),
    }).drop("_ask", "_q", "_hit")


# ---------------------------------------------------------------- nearest places

def nearest_pois_all(df: DataFrame, max_km: float = refdata.MAX_POI_KM) -> DataFrame:
    """Nearest airport, hospital, school and beach of every listing, in one pass without a join."""
    kinds = {
        "airport": [(code, lat, lng) for code, _, _, lat, lng, _ in refdata.AIRPORTS],
        "hospital": [(name, lat, lng) for name, _, lat, lng, _ in refdata.HOSPITALS],
        "school": [
            (name, lat, lng) for name, level, lat, lng, _ in refdata.SCHOOLS if level in refdata.SCHOOL_LEVELS
        ],
        "beach": [(name, lat, lng) for name, lat, lng, _ in refdata.BEACHES],
    }
    placed = df.withColumns(geo.unit_vector("lat", "lng"))
    squares = placed.withColumns({f"_sq_{k}": geo.nearest_square(v) for k, v in kinds.items()})
    near = squares.withColumns({f"_{k}": geo.nearest_place(f"_sq_{k}", v, max_km) for k, v in kinds.items()})
    km = lambda k: F.round(F.col(f"_{k}.km"), 1).cast("decimal(6,1)")
    return near.withColumns({
        "distance_to_beach_km": km("beach"),
        "distance_to_airport_km": km("airport"),
        "nearest_airport_code": F.col("_airport.name"),
        "distance_to_hospital_km": km("hospital"),
        "nearest_hospital_name": F.col("_hospital.name"),
        "distance_to_school_km": km("school"),
        "nearest_school_name": F.col("_school.name"),
    }).drop("_airport", "_hospital", "_school", "_beach", "_x", "_y", "_z", *(f"_sq_{k}" for k in kinds))


#: Cells of level n have an edge of 4 ** -n degrees, so a cell has 16 children.
LEVELS = 11
CELL = ["level", "cy", "cx"]


def _cell(lat, lng, level) -> list[Column]:
    edges = F.pow(F.lit(4.0), level)
    return [F.floor(lat * edges).alias("cy"), F.floor(lng * edges).alias("cx")]


def place_tree(spots: DataFrame, most_per_cell: int) -> tuple[DataFrame, DataFrame]:
    """(cells, leaves) of a quadtree over spots (p_lat, p_lng, name) that splits crowded cells only.

    A cell has its bounds, one of its spots, and whether it is crowded; the cells are those of
    level 0 and the children of crowded ones. Leaves are the spots by the cell that is not crowded.
    """
    levels = spots.select("*", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level"))
    at = levels.select("*", *_cell(F.col("p_lat"), F.col("p_lng"), F.col("level")))
    every = at.groupBy(*CELL).agg(
        F.min("p_lat").alias("south"), F.max("p_lat").alias("north"), F.min("p_lng").alias("west"), F.max("p_lng").alias("east"),
        F.min(F.struct("p_lat", "p_lng")).alias("spot"), F.count("*").alias("n"))
    every = every.withColumn("crowded", (F.col("n") > most_per_cell) & (F.col("level") < LEVELS - 1)).drop("n")
    split = every.filter("crowded").select((F.col("level") + 1).alias("level"), F.col("cy").alias("py"), F.col("cx").alias("px"))
    parent = every.select("*", F.floor(F.col("cy") / 4).alias("py"), F.floor(F.col("cx") / 4).alias("px"))
    cells = stored(
        every.filter("level = 0").unionByName(parent.join(split, ["level", "py", "px"], "left_semi").select(*every.columns)), "place-cells")
    return cells, at.join(cells.filter("NOT crowded").select(*CELL), CELL)


def nearest_poi_table(
    df: DataFrame, key: str, pois: DataFrame, max_km: float = refdata.MAX_POI_KM, most_per_cell: int = 32
) -> DataFrame:
    """Nearest row of a long place table (name, lat, lng) for each listing: (key, name, km).

    Spots with the same place are merged. A listing goes down the quadtree of the places level by
    level: of the cells it holds on to, those that start farther away than the nearest spot known
    so far are let go, crowded ones are replaced by their children. What it meets in the end are
    the places of a few cells of at most ``most_per_cell``, in a city as in the country. Listings
    of a crowded cell meet its children and its places by broadcast. Exact; equal distances go to
    the smaller name; a key that repeats gets its best hit; listings and places without a position
    have none.
    """
    spots = pois.filter("lat IS NOT NULL AND lng IS NOT NULL").groupBy(
        F.col("lat").cast("double").alias("p_lat"), F.col("lng").cast("double").alias("p_lng")).agg(F.min("name").alias("name"))
    cells, leaves = place_tree(spots, most_per_cell)
    listings = df.select(F.col(key).alias("key"), F.col("lat").cast("double").alias("lat"), F.col("lng").cast("double").alias("lng"))
    listings = checkpoint(listings.filter(geo.in_country("lat", "lng")).withColumn("listing", F.monotonically_increasing_id()))

    # a first distance: the spots that stand for the cells around the listing, at every level
    path = listings.select("*", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level"))
    path = path.select("listing", "lat", "lng", "level", *_cell(F.col("lat"), F.col("lng"), F.col("level")))
    first = hot_join(path, cells.select(*CELL, "spot"), CELL).groupBy("listing").agg(F.min(_spot_km()).alias("best"))
    known = listings.join(first, "listing", "left").withColumn("best", F.least(F.lit(float(max_km)), "best"))

    lat_reach = F.col("best") / geo.EARTH_KM
    polar = lat_reach + F.abs(F.radians("lat")) >= math.pi / 2 - 1e-6  # then any longitude may be in reach
    lng_reach = F.when(polar, 2 * math.pi).otherwise(F.asin(F.sin(lat_reach) / F.cos(F.radians("lat"))))
    around = lambda c, reach: F.explode(F.sequence(F.floor(c - F.degrees(reach) - 1e-6), F.floor(c + F.degrees(reach) + 1e-6)))
    asked = known.withColumn("cy", around(F.col("lat"), lat_reach)).withColumn("cx", around(F.col("lng"), lng_reach))
    # level 0 has at most 180 * 360 cells
    held = _held(asked.join(F.broadcast(cells.filter("level = 0")), ["cy", "cx"]))
    split = cells.filter("level > 0").select(
        *cells.columns, (F.col("level") - 1).alias("pl"), F.floor(F.col("cy") / 4).alias("py"), F.floor(F.col("cx") / 4).alias("px"))
    place = ["key", "listing", "lat", "lng", "best"]
    while not held.filter("crowded").isEmpty():
        parents = held.filter("crowded").select(*place, F.col("level").alias("pl"), F.col("cy").alias("py"), F.col("cx").alias("px"))
        children = hot_join(parents, split, ["pl", "py", "px"]).select(*held.columns)
        held = _held(held.filter("NOT crowded").unionByName(children))
    hits = hot_join(held.select(*place, *CELL), leaves.select(*CELL, "p_lat", "p_lng", "name"), CELL)
    return (
        hits.withColumn("km", geo.haversine_km("lat", "lng", "p_lat", "p_lng")).filter(F.col("km") <= max_km)
        .groupBy(F.col("key").alias(key)).agg(F.min(F.struct("km", "name")).alias("_best"))
        .select(key, F.col("_best.name").alias("name"), F.col("_best.km").alias("km"))
    )


def _spot_km() -> Column:
    return geo.haversine_km("lat", "lng", "spot.p_lat", "spot.p_lng")


def _held(rows: DataFrame) -> DataFrame:
    """Listings with the cells that may hold their nearest place, and the best distance known.

    No place of a cell is nearer than the gap of latitude, or than the meridian of its nearer edge.
    """
    gap = lambda c, low, high: F.radians(F.greatest(F.lit(0.0), F.col(low) - F.col(c), F.col(c) - F.col(high)))
    meridian = F.asin(F.cos(F.radians("lat")) * F.sin(F.least(gap("lng", "west", "east"), F.lit(math.pi / 2))))
    least = F.lit(geo.EARTH_KM) * F.greatest(gap("lat", "south", "north"), meridian)
    near = least <= F.col("best") * (1 + 1e-9) + 1e-9
    known = rows.filter(near).withColumn("best", F.min(F.least("best", _spot_km())).over(Window.partitionBy("listing")))
    return checkpoint(known.filter(near))


# ---------------------------------------------------------------- the stage

def normalize(
    df: DataFrame, rates: DataFrame, gazetteer: DataFrame | None = None, key: str = "source_listing_id",
    own_brands: Sequence[str] = (),
) -> DataFrame:
    """Extracted record -> normalized record; the source's own columns are kept."""
    out = fees_to_usd(
        df,
        {
            "price": "price_usd", "hoa_fee": "hoa_fee_usd", "taxes_annual": "taxes_usd_annual",
            "list_price_original": "list_price_original_usd",
        },
        "price_currency",
        rates,
    ).withColumn("price_per_sqm", money.price_per_sqm("price_usd", "interior_sqm"))
    if gazetteer is None:
        known = F.col("lat").isNotNull() & F.col("lng").isNotNull()
        out = out.withColumn("geocode_confidence", F.when(known, "exact"))
    else:
        out = geocode_lookup(out, gazetteer)
    out = nearest_pois_all(assign_region(out))
    return out.withColumns({
        "slug": text.build_slug("title", "locality", key),
        "title": text.clean_title("title", own_brands),
        "description": text.clean_description("description"),
    })
