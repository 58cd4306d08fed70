"""Small helpers shared by the column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    """A name becomes a column reference; a column stays as it is."""
    return F.col(value) if isinstance(value, str) else value


def map_get(mapping: ColumnLike, key: ColumnLike) -> Column:
    """Map lookup that gives NULL, not an error, for a missing key."""
    return F.try_element_at(as_column(mapping), as_column(key))
