"""Integer arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marram.functions.columns import ColumnLike, as_column

_TWO_31 = 2147483648
_TWO_32 = 4294967296


def idiv(left: ColumnLike, right: ColumnLike | int) -> Column:
    """Integer division that truncates towards zero."""
    divisor = F.lit(right) if isinstance(right, int) else as_column(right)
    return F.call_function("div", as_column(left), divisor)


def wrap_int32(value: ColumnLike) -> Column:
    """The value a 32-bit signed integer would hold after overflowing.

    Feed it whole 64-bit results; Spark itself raises on overflow.
    """
    shifted = as_column(value).cast("bigint") + F.lit(_TWO_31).cast("bigint")
    return (F.pmod(shifted, F.lit(_TWO_32)) - F.lit(_TWO_31)).cast("int")


def doubled(value: ColumnLike) -> Column:
    column = as_column(value)
    return column + column


def squared(value: ColumnLike) -> Column:
    column = as_column(value)
    return column * column


def incremented(value: ColumnLike) -> Column:
    return as_column(value) + F.lit(1)
