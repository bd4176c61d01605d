"""Distances on the sphere and box tests over ``struct<lat, lon>`` columns."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius in metres, and metres per unit.
EARTH_RADIUS_M = 6_371_008.77
UNIT_METRES = {
    "mm": 0.001, "cm": 0.01, "m": 1.0, "km": 1000.0, "in": 0.0254, "ft": 0.3048, "yd": 0.9144,
    "mi": 1609.344, "miles": 1609.344, "nmi": 1852.0,
}


def metres(distance: str | float | int) -> float:
    """``"50km"`` as metres; a bare number already is metres."""
    if isinstance(distance, (int, float)):
        return float(distance)
    found = re.fullmatch(r"\s*([0-9.]+)\s*([a-z]*)\s*", distance.lower())
    if not found or (found[2] or "m") not in UNIT_METRES:
        raise ValueError(f"cannot read distance: {distance}")
    return float(found[1]) * UNIT_METRES[found[2] or "m"]


def haversine(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    """Great-circle distance in metres to a fixed point."""
    half_lat = F.radians(lat - lat0) / 2
    half_lon = F.radians(lon - lon0) / 2
    a = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat)) * math.cos(math.radians(lat0)) * F.pow(F.sin(half_lon), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def in_box(lat: Column, lon: Column, top: float, left: float, bottom: float, right: float) -> Column:
    """Inside the box, edges included. ``left > right`` crosses the date line."""
    in_lat = (lat >= bottom) & (lat <= top)
    if left <= right:
        return in_lat & (lon >= left) & (lon <= right)
    return in_lat & ((lon >= left) | (lon <= right))


def around(lat0: float, lon0: float, distance_m: float) -> tuple[float, float, float, float]:
    """Box (top, left, bottom, right) that holds the circle; ``left > right``
    crosses the date line, with a pole inside it has every longitude."""
    # A hair of slack keeps rounding at the edge of the box from losing rows.
    angle = distance_m / EARTH_RADIUS_M * (1 + 1e-9) + 1e-12
    dlat = math.degrees(angle)
    top, bottom = lat0 + dlat, lat0 - dlat
    if top >= 90 or bottom <= -90:
        return min(top, 90.0), -180.0, max(bottom, -90.0), 180.0
    dlon = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat0)))))
    left, right = lon0 - dlon, lon0 + dlon
    return top, left + 360 if left < -180 else left, bottom, right - 360 if right > 180 else right


def within(lat: Column, lon: Column, lat0: float, lon0: float, distance_m: float) -> Column:
    """Distance test behind a bounding box. The box is made of plain
    comparisons, so it reaches the scan and spares most rows the trigonometry."""
    top, left, bottom, right = around(lat0, lon0, distance_m)
    exact = haversine(lat, lon, lat0, lon0) <= distance_m
    if (left, right) == (-180.0, 180.0):
        return (lat >= bottom) & (lat <= top) & exact
    return in_box(lat, lon, top, left, bottom, right) & exact
