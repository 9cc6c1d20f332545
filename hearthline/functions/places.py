"""Places on a space-filling curve, and a box as ranges of it.

The curve interleaves 16 bits of latitude and of longitude (Z order): what lies close on
the map mostly lies close on the curve, so files sorted by it hold compact areas.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 16
_CELLS = 1 << BITS
_SOUTH, _WEST, _HEIGHT, _WIDTH = -90.0, -180.0, 180.0, 360.0
# Steps that put a zero between all bits of a number below 2 ** 16.
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _cell(value: Column, least: float, extent: float) -> Column:
    place = F.floor((value - F.lit(least)) * F.lit(_CELLS / extent)).cast("long")
    return F.greatest(F.lit(0), F.least(place, F.lit(_CELLS - 1))).cast("long")


def _spread(bits: Column) -> Column:
    for shift, mask in _SPREAD:
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return bits


def curve(latitude: Column, longitude: Column) -> Column:
    """The place on the curve (long); NULL without both coordinates.

    Coordinates beyond the globe count as at its edge.
    """
    known = latitude.isNotNull() & longitude.isNotNull()
    north = _spread(_cell(latitude, _SOUTH, _HEIGHT))
    east = _spread(_cell(longitude, _WEST, _WIDTH))
    return F.when(known, F.shiftleft(north, 1).bitwiseOR(east))


def _cell_of(value: float, least: float, extent: float) -> int:
    return max(0, min(int((value - least) * (_CELLS / extent) // 1), _CELLS - 1))


def curve_ranges(
    south: float | None, north: float | None, west: float | None, east: float | None, most: int = 32
) -> list[tuple[int, int]]:
    """At most ``most`` ranges (inclusive) of the curve that hold every place of the box.

    Squares of the curve are quartered as long as the ranges are few; a square partly
    outside counts whole, so an exact test of the coordinates must follow.
    """
    low = (_cell_of(_SOUTH if south is None else south, _SOUTH, _HEIGHT), _cell_of(_WEST if west is None else west, _WEST, _WIDTH))
    high = (
        _cell_of(_SOUTH + _HEIGHT if north is None else north, _SOUTH, _HEIGHT),
        _cell_of(_WEST + _WIDTH if east is None else east, _WEST, _WIDTH),
    )
    if low[0] > high[0] or low[1] > high[1]:
        return []
    squares, size = [(0, 0, 0)], _CELLS  # start on the curve, row, column

    def joined(parts: list[tuple[int, int, int]], side: int) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for start, _, _ in sorted(parts):
            end = start + side * side - 1
            if out and out[-1][1] == start - 1:
                out[-1] = (out[-1][0], end)
            else:
                out.append((start, end))
        return out

    while size > 1:
        half = size // 2
        finer = []
        for start, row, column in squares:
            for k in range(4):
                r, c = row + half * (k >> 1), column + half * (k & 1)
                if r <= high[0] and r + half > low[0] and c <= high[1] and c + half > low[1]:
                    finer.append((start + k * half * half, r, c))
        if len(joined(finer, half)) > most or len(finer) > 64 * most:
            break
        squares, size = finer, half
    return joined(squares, size)
