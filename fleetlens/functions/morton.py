"""A map cell as one number whose order keeps neighbours together (Z-order).

Latitude and longitude are cut into 2^20 steps each (some 19 and 38 m) and their bits interleaved.
Rows sorted by that number make files and row groups that cover small patches of the map, and a
box is a few ranges of numbers, which parquet statistics can refute: the box test alone reaches
the scan as two independent ranges, each of which nearly every file overlaps.

The steps are monotone in the coordinate (the same floating-point operations here and in Spark,
each of them monotone), so a point inside the box, its edges included, is always in a cell of the
box's ranges. The ranges may hold more; the exact test follows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 20
STEPS = 1 << BITS
MAX_RANGES = 32
_LOW, _SPAN = {"latitude": -90.0, "longitude": -180.0}, {"latitude": 180.0, "longitude": 360.0}
# Spreads 32 bits to the even places of 64: shifts and masks of the usual doubling steps.
_SPREAD = [(1 << k, sum(((1 << (1 << k)) - 1) << (i << k + 1) for i in range(64 >> k + 1))) for k in (4, 3, 2, 1, 0)]


def step(value: float, name: str) -> int:
    """The step of a coordinate; what lies outside the globe counts as its edge."""
    scaled = (value - _LOW[name]) * (STEPS / _SPAN[name])
    if math.isinf(scaled):
        return STEPS - 1 if scaled > 0 else 0
    return min(max(math.floor(scaled), 0), STEPS - 1)


def _step(value: Column, name: str) -> Column:
    scaled = (value - F.lit(_LOW[name])) * F.lit(STEPS / _SPAN[name])
    low, high = F.lit(0).cast("long"), F.lit(STEPS - 1).cast("long")
    # least and greatest pass over NULL
    return F.when(value.isNotNull(), F.least(F.greatest(F.floor(scaled), low), high))


def _spread(x: Column) -> Column:
    for shift, mask in _SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask & 0x7FFFFFFFFFFFFFFF).cast("long"))
    return x


def cell_of(latitude: Column, longitude: Column) -> Column:
    """The cell's number, NULL if a coordinate is."""
    return F.shiftleft(_spread(_step(latitude, "latitude")), 1).bitwiseOR(
        _spread(_step(longitude, "longitude"))
    )


def _interleave(y: int, x: int) -> int:
    return sum(((y >> i & 1) << 2 * i + 1) | ((x >> i & 1) << 2 * i) for i in range(BITS))


def box_ranges(
    north: float, east: float, south: float, west: float, max_ranges: int = MAX_RANGES
) -> list[tuple[int, int]]:
    """At most ``max_ranges`` ranges of cells (ends included) that cover the box."""
    if not (south <= north and west <= east):  # upside down, or not a number
        return []
    y0, y1 = step(south, "latitude"), step(north, "latitude")
    x0, x1 = step(west, "longitude"), step(east, "longitude")
    inside: list[tuple[int, int]] = []
    edge = [(0, 0, BITS)]  # squares of 2^level steps: lower corner and level
    # squares across the border are quartered until they are many, or single cells
    while edge and len(inside) + len(edge) <= 4 * max_ranges:
        quarters = []
        for y, x, level in edge:
            half = 1 << level - 1
            quarters += [(y + dy, x + dx, level - 1) for dy in (0, half) for dx in (0, half)]
        edge = []
        for y, x, level in quarters:
            size = 1 << level
            if y > y1 or x > x1 or y + size <= y0 or x + size <= x0:
                continue
            whole = y0 <= y and y + size - 1 <= y1 and x0 <= x and x + size - 1 <= x1
            (inside if whole or level == 0 else edge).append((y, x, level))
    ranges: list[list[int]] = []
    for low, level in sorted((_interleave(y, x), level) for y, x, level in inside + edge):
        high = low + (1 << 2 * level) - 1
        if ranges and ranges[-1][1] + 1 == low:
            ranges[-1][1] = high
        else:
            ranges.append([low, high])
    while len(ranges) > max_ranges:  # close the smallest gap
        i = min(range(len(ranges) - 1), key=lambda k: ranges[k + 1][0] - ranges[k][1])
        ranges[i : i + 2] = [[ranges[i][0], ranges[i + 1][1]]]
    return [(a, b) for a, b in ranges]


def cell_in_box(
    cell: Column, north: float, east: float, south: float, west: float, max_ranges: int = MAX_RANGES
) -> Column:
    """True for every cell that a point of the box can be in (plain comparisons, pushed down)."""
    out = F.lit(False)
    for low, high in box_ranges(north, east, south, west, max_ranges):
        out = out | cell.between(low, high)
    return out
