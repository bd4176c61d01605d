"""Cells of a space-filling curve over latitude and longitude.

A cell number interleaves the bits of a point's latitude and longitude, so a
table written in cell order keeps near points in the same files, and a box is
covered by a few ranges of numbers, which the scan compares with the least and
greatest number of each file and row group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 16  # per axis: a cell is about 300 m by 600 m at the equator
MOST_RANGES = 32  # of a cover; the fewer, the coarser
_SIDE = 1 << BITS


def _spread(c: Column) -> Column:
    """Every second bit of the result is one of the 16 bits of ``c``."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return c


def _index(value: Column, least: float, width: float) -> Column:
    place = F.floor((value - least) / width * _SIDE).cast("bigint")
    return F.least(F.greatest(place, F.lit(0).cast("bigint")), F.lit(_SIDE - 1).cast("bigint"))


def cell(lat: Column, lon: Column) -> Column:
    """Cell number of a point; null without a point. Points off the map belong
    to the cells at its edge."""
    both = _spread(_index(lon, -180.0, 360.0)).bitwiseOR(F.shiftleft(_spread(_index(lat, -90.0, 180.0)), 1))
    return F.when(lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon), both)


def _place(value: float, least: float, width: float) -> int:
    return min(max(int((value - least) / width * _SIDE), 0), _SIDE - 1)


def cover(top: float, left: float, bottom: float, right: float, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """Ranges of cell numbers, both ends included, that hold all points of the
    box. ``left > right`` crosses the date line. Squares that lie half inside
    are quartered as long as there are fewer than ``most``."""
    if left > right:
        half = max(2, most // 2)
        return _merged(cover(top, left, bottom, 180.0, half) + cover(top, -180.0, bottom, right, half))
    # One cell of slack on each side for rounding.
    x0, x1 = max(_place(left, -180.0, 360.0) - 1, 0), min(_place(right, -180.0, 360.0) + 1, _SIDE - 1)
    y0, y1 = max(_place(bottom, -90.0, 180.0) - 1, 0), min(_place(top, -90.0, 180.0) + 1, _SIDE - 1)
    whole: list[tuple[int, int]] = []
    partly = [(0, 0, BITS, 0)]  # x, y, level (side 2^level), first number
    while partly:
        if len(whole) + 4 * len(partly) > most and len(partly) > 0 and partly[0][2] < BITS:
            break
        quarters = []
        for x, y, level, first in partly:
            if level == 0:
                whole.append((first, first))
                continue
            half, size = 1 << (level - 1), 1 << 2 * (level - 1)
            for k in range(4):
                qx, qy, at = x + half * (k & 1), y + half * (k >> 1), first + k * size
                if qx > x1 or qx + half - 1 < x0 or qy > y1 or qy + half - 1 < y0:
                    continue
                if x0 <= qx and qx + half - 1 <= x1 and y0 <= qy and qy + half - 1 <= y1:
                    whole.append((at, at + size - 1))
                else:
                    quarters.append((qx, qy, level - 1, at))
        partly = quarters
    whole += [(first, first + (1 << 2 * level) - 1) for _, _, level, first in partly]
    return _merged(whole)


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def among(number: Column, ranges: list[tuple[int, int]]) -> Column:
    """Plain comparisons, so they reach the scan."""
    found = F.lit(False)
    for low, high in ranges:
        found |= (number >= low) & (number <= high)
    return found


def with_cells(df: DataFrame, *fields: str) -> DataFrame:
    """Store the cell numbers of point fields as ``field__cell``; conditions on
    these fields then test the cells first."""
    return df.withColumns({f"{f}__cell": cell(F.col(f)["lat"], F.col(f)["lon"]) for f in fields})


def write_in_cell_order(df: DataFrame, field: str, path: str, files: int | None = None) -> None:
    """Write a table with its cells so that each file holds one stretch of the
    curve. Points that a third of all rows share stand in one stretch; their
    rows are spread over it by a hash."""
    number = f"{field}__cell"
    rows = df if number in df.columns else with_cells(df, field)
    keys = [F.col(number), F.xxhash64(*[c for c in rows.columns if not rows.schema[c].dataType.simpleString().startswith("map")])]
    placed = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    placed.sortWithinPartitions(number).write.parquet(path)
