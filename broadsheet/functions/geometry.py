"""Arithmetic of boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap_share(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Overlap of two spans as a share of the shorter one."""
    return F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0)) / F.greatest(F.least(a1 - a0, b1 - b0), F.lit(1.0))


def directory_limit(width: Column, heading_x1: Column, next_column: Column) -> Column:
    """Right edge of a directory column: the least of a share of the page, the heading's edge and the middle of the gap."""
    return F.least(0.28 * width, heading_x1 + 0.04 * width, (heading_x1 + next_column) / 2)


def rail(width: Column) -> Column:
    """Left and right edge of a directory printed in the right margin."""
    return F.struct((0.81 * width).alias("left"), (0.995 * width).alias("right"))


def even_round(x: Column, digits: int = 0) -> Column:
    """Halves to even."""
    return F.bround(x, digits)
