"""Space-filling clustering: a Z-order cell for a place, and a box as ranges.

A place's cell is the bits of its column and row on a 2^bits grid of the globe,
taken in turns. Rows stored by cell lie by place, so a file's and row group's
least and greatest cell bound a small area. A box is covered by a few ranges of
cells: squares of the quadtree that lie in it or cross its border, neighbours
joined. Range tests on the stored cell go down to the Parquet reader and skip
files and row groups; the box test itself decides on the rows that are left.
"""

from __future__ import annotations

import heapq
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramline.functions.predicates import in_box

#: 2^20 columns and rows: a cell is 38 m high and at most as wide.
BITS = 20


def _axis(value: Column, least: float, span: float, bits: int) -> Column:
    cells = 1 << bits
    at = F.floor((value - F.lit(least)) / F.lit(span) * F.lit(float(cells))).cast("long")
    return F.greatest(F.least(at, F.lit(cells - 1).cast("long")), F.lit(0).cast("long"))


def _axis_of(value: float, least: float, span: float, bits: int) -> int:
    cells = 1 << bits
    return max(0, min(cells - 1, int((value - least) / span * float(cells) // 1)))


def _spread(value: Column) -> Column:
    """The low 32 bits with a 0 before each."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def cell(lat: str, lon: str, bits: int = BITS) -> Column:
    """The cell of a place; NULL where a coordinate is."""
    y = _axis(F.col(lat), -90.0, 180.0, bits)
    x = _axis(F.col(lon), -180.0, 360.0, bits)
    both = F.shiftleft(_spread(y), 1).bitwiseOR(_spread(x))
    return F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), both)


def cover(*, north: float, east: float, south: float, west: float, bits: int = BITS,
          most: int = 32) -> list[tuple[int, int]]:
    """At most ``most`` closed ranges of cells that hold every cell of the box,
    in order. The largest square that crosses the border is split next."""
    x0, x1 = (_axis_of(v, -180.0, 360.0, bits) for v in (west, east))
    y0, y1 = (_axis_of(v, -90.0, 180.0, bits) for v in (south, north))
    inside: list[tuple[int, int]] = []
    border = [(-bits, 0, 0, 0)]  # size (negative power of two), first cell, column, row
    while border and len(inside) + len(border) + 3 <= most:
        if border[0][0] == 0:
            break
        size, first, x, y = heapq.heappop(border)
        half, part = -size - 1, 1 << 2 * (-size - 1)
        for k in range(4):
            sx, sy = x + ((k & 1) << half), y + ((k >> 1) << half)
            ex, ey = sx + (1 << half) - 1, sy + (1 << half) - 1
            if sx > x1 or ex < x0 or sy > y1 or ey < y0:
                continue
            if x0 <= sx and ex <= x1 and y0 <= sy and ey <= y1:
                inside.append((first + k * part, first + (k + 1) * part - 1))
            else:
                heapq.heappush(border, (-half, first + k * part, sx, sy))
    ranges = sorted(inside + [(f, f + (1 << -2 * s) - 1) for s, f, _, _ in border])
    joined: list[tuple[int, int]] = []
    for low, high in ranges:
        if joined and low == joined[-1][1] + 1:
            joined[-1] = (joined[-1][0], high)
        else:
            joined.append((low, high))
    return joined


def in_cells(column: str, ranges: list[tuple[int, int]]) -> Column:
    tests = [F.col(column).between(F.lit(a), F.lit(b)) for a, b in ranges]
    while len(tests) > 1:  # a balanced tree: a chain of many would be a deep one
        tests = [reduce(or_, tests[i:i + 2]) for i in range(0, len(tests), 2)]
    return tests[0] if tests else F.lit(False)


def in_box_clustered(column: str, lat: str, lon: str, *, bits: int = BITS, most: int = 32,
                     **box: float) -> Column:
    """The closed box test, on rows stored by ``cell`` in ``column``."""
    return in_cells(column, cover(**box, bits=bits, most=most)) & in_box(lat, lon, **box)
