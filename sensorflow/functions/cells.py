"""Cells of a latitude-longitude grid, numbered along a space-filling curve.

At level ``l`` the grid has ``2 ** l`` columns and rows; a cell's number has the
bits of its column and row in turn (Z-order).  So the cell around it at a coarser
level is its number shifted right by two bits a level, and cells that lie
together mostly have numbers that do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FINEST = 28  # two bits a level, in a bigint

# Shift and mask of each step that spreads 32 bits over the even ones of 64.
SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333),
          (1, 0x5555555555555555))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _spread(x: Column) -> Column:
    for shift, mask in SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def cell(latitude, longitude, level: int) -> Column:
    """Cell number at ``level``; NULL where a coordinate is NULL, NaN or infinite or
    the latitude beyond a pole.  Longitudes turn around (180 is -180, 190 is
    -170); the north pole lies in the uppermost row."""
    if not 0 <= level <= FINEST:
        raise ValueError(f"level must be 0 to {FINEST}")
    lat, lon, size = _c(latitude), _c(longitude), 2 ** level
    known = lat.between(-90, 90) & ~F.isnan(lon) & (F.abs(lon) < float("inf"))
    turned = F.pmod(lon + 180.0, F.lit(360.0))
    # a tiny negative turns into 360 itself
    column = F.least(F.floor(turned / 360.0 * size), F.lit(size - 1))
    row = F.least(F.floor((lat + 90.0) / 180.0 * size), F.lit(size - 1))
    return F.when(known, _spread(column).bitwiseOR(F.shiftleft(_spread(row), 1)))


def coarser(number, levels: int) -> Column:
    """The cell around a cell, ``levels`` up."""
    return F.shiftright(_c(number), 2 * levels)
