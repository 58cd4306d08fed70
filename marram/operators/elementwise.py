"""Ordered element-wise steps over a column of integers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.functions.numbers import doubled, incremented, squared, wrap_int32


def chain(elements: DataFrame, column: str = "value", int32: bool = False) -> DataFrame:
    """Adds ``result``: the value doubled, then squared, then incremented.

    With ``int32`` every step wraps as 32-bit integers do; otherwise a result
    beyond 64 bits is an error.
    """
    result = F.col(column).cast("bigint")
    for step in (doubled, squared, incremented):
        result = step(result)
        if int32:
            result = wrap_int32(result).cast("bigint")
    return elements.withColumn("result", result)
