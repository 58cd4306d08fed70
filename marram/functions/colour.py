"""Arithmetic on colours held as three channels or packed into one integer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marram.functions import fixed
from marram.functions.columns import ColumnLike, as_column
from marram.functions.numbers import idiv


def pack(r: ColumnLike, g: ColumnLike, b: ColumnLike) -> Column:
    """Three channels as one integer 0xRRGGBB."""
    return (
        F.shiftleft(as_column(r), 16) + F.shiftleft(as_column(g), 8) + as_column(b)
    ).cast("int")


def channel(rgb: ColumnLike, which: int) -> Column:
    """Channel 2 is red, 1 green, 0 blue; bits above the three are ignored."""
    if which not in (0, 1, 2):
        raise ValueError(f"channel must be 0, 1 or 2, not {which}")
    return F.shiftright(as_column(rgb), 8 * which).bitwiseAND(F.lit(255)).cast("int")


def unpack(rgb: ColumnLike) -> tuple[Column, Column, Column]:
    return channel(rgb, 2), channel(rgb, 1), channel(rgb, 0)


def mean_gray(r: ColumnLike, g: ColumnLike, b: ColumnLike) -> Column:
    return idiv(as_column(r) + as_column(g) + as_column(b), 3).cast("int")


def shift_gray(r: ColumnLike, g: ColumnLike, b: ColumnLike) -> Column:
    """The bitwise gray value; it is not an average, and kept as it is."""
    masked = as_column(r).bitwiseAND((as_column(g) + 255).bitwiseAND(F.lit(255)))
    mixed = (F.shiftright(masked, 1) + as_column(b)).bitwiseAND(F.lit(255))
    return F.shiftright(mixed, 1).cast("int")


def sepia(r: ColumnLike, g: ColumnLike, b: ColumnLike) -> tuple[Column, Column, Column]:
    """Single-precision weighted sums, cut to whole numbers and to 255."""

    def weighted(weights: tuple[float, float, float]) -> Column:
        red, green, blue = (
            as_column(c).cast("float") * F.lit(w).cast("float")
            for c, w in zip((r, g, b), weights, strict=True)
        )
        return F.least((red + green + blue).cast("int"), F.lit(255))

    red, green, blue = (weighted(row) for row in fixed.SEPIA)
    return red, green, blue


def quantise(value: ColumnLike, colours: int = fixed.COLOURS) -> Column:
    """The nearest of ``colours`` evenly spread values from 0 to 255."""
    if not 2 <= colours <= 256:
        raise ValueError(f"colours must be from 2 to 256, not {colours}")
    step = F.shiftright(as_column(value) * F.lit(colours), 8)
    return idiv(step * F.lit(255), colours - 1).cast("int")


def clamp(value: ColumnLike, rounding: str = "trunc") -> Column:
    """The value as an integer from 0 to 255, cut off or rounded half up."""
    column = as_column(value)
    if rounding == "nearest":
        column = F.floor(column + F.lit(0.5))
    elif rounding != "trunc":
        raise ValueError(f"rounding must be 'trunc' or 'nearest', not {rounding!r}")
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(255.0), column.cast("double")))
    return bounded.cast("int")


def edge_threshold(threshold: int) -> int:
    if threshold < 0:
        raise ValueError(f"edge threshold must be at least zero, not {threshold}")
    return threshold
