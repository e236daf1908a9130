"""Distances and nearest-place lookups."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from casona import refdata
from casona.functions.text import as_col

EARTH_KM = 6371.0


def _chord(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Haversine of the central angle; grows with distance, so it can be compared as is."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lng = F.sin(F.radians(lng2 - lng1) / 2)
    return half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng


def _chord_to_km(chord: Column) -> Column:
    return F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    return _chord_to_km(_chord(*(as_col(c).cast("double") for c in (lat1, lng1, lat2, lng2))))


def in_country(lat, lng) -> Column:
    south, north, west, east = refdata.COUNTRY_BOX
    return as_col(lat).between(south, north) & as_col(lng).between(west, east)


def region_by_bbox(lat, lng, boxes: Sequence[tuple] = tuple(refdata.REGION_BOXES)) -> Column:
    """First box in list order that holds the point, edges included."""
    lat, lng = as_col(lat).cast("double"), as_col(lng).cast("double")
    return F.coalesce(
        *(
            F.when(lat.between(south, north) & lng.between(west, east), F.lit(region))
            for region, south, north, west, east in boxes
        )
    )


def unit_vector(lat, lng) -> dict[str, Column]:
    """Point on the unit sphere as columns _x, _y, _z; null outside the country box."""
    inside = in_country(lat, lng)
    lat, lng = F.radians(as_col(lat).cast("double")), F.radians(as_col(lng).cast("double"))
    return {
        "_x": F.when(inside, F.cos(lat) * F.cos(lng)), "_y": F.when(inside, F.cos(lat) * F.sin(lng)),
        "_z": F.when(inside, F.sin(lat)),
    }


def _squares(places: Sequence[tuple[str, float, float]]) -> list[str]:
    """Squared straight-line distance from (_x, _y, _z) to each place, as SQL text."""
    out = []
    for _, lat, lng in places:
        la, lo = math.radians(lat), math.radians(lng)
        spot = {"_x": math.cos(la) * math.cos(lo), "_y": math.cos(la) * math.sin(lo), "_z": math.sin(la)}
        terms = [f"({axis} - ({v!r}D)) * ({axis} - ({v!r}D))" for axis, v in spot.items()]
        out.append("(" + " + ".join(terms) + ")")
    return out


def nearest_square(places: Sequence[tuple[str, float, float]]) -> Column:
    """Smallest squared distance to a short fixed list of (name, lat, lng), from _x, _y, _z.

    The list is part of the plan, so there is no join and no shuffle, and one place costs a few
    multiplications in generated code: straight-line distances order places as distances on the
    sphere do. Lists of thousands of places belong in ``operators.normalize.nearest_poi_table``.
    """
    squares = _squares(places)
    return F.expr(f"least({', '.join(squares)}, {squares[0]})")


def nearest_place(square: str, places: Sequence[tuple[str, float, float]], max_km: float = refdata.MAX_POI_KM) -> Column:
    """struct(km, name) of the first place at the ``nearest_square`` in that column; null beyond ``max_km``."""
    name = "CASE " + " ".join(
        f"WHEN {sq} = {square} THEN r'{n}'" for sq, (n, _, _) in zip(_squares(places), places)) + " END"
    km = F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(F.col(square)) / 2))
    return F.when(km <= max_km, F.struct(km.alias("km"), F.expr(name).alias("name")))
