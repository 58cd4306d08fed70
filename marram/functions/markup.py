"""Extraction of elements from page markup by pattern.

An element's name matches as a prefix, as patterns do: ``id`` also finds
``<idx>``, and the first match anywhere in the text wins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marram.functions import fixed
from marram.functions.columns import ColumnLike, as_column


def elements(markup: ColumnLike, name: str) -> Column:
    """All elements of that name, tags included, in order."""
    return F.regexp_extract_all(
        as_column(markup), F.lit(fixed.ELEMENT.format(name=name)), F.lit(1)
    )


def element_text(markup: ColumnLike, name: str) -> Column:
    """The content of the first element of that name, '' if there is none."""
    return F.regexp_extract(as_column(markup), fixed.ELEMENT_TEXT.format(name=name), 1)


def id_or_default(text: ColumnLike) -> Column:
    """The text as an integer, -1 if it is empty; other text is an error."""
    column = as_column(text)
    return F.when(column == "", F.lit(fixed.MISSING_ID).cast("bigint")).otherwise(
        column.cast("bigint")
    )


def utc_instant(text: ColumnLike, on_bad: str = "fail") -> Column:
    """An ISO-8601 UTC instant as a zone-free timestamp in UTC.

    Years taken from it do not depend on the session's time zone. Text of
    another form raises an error, or gives NULL with ``on_bad='null'``.
    """
    column = as_column(text)
    plain = F.rtrim(column, F.lit("Z"))
    if on_bad == "null":
        return F.when(column.rlike(fixed.UTC_INSTANT), plain.try_cast("timestamp_ntz"))
    if on_bad != "fail":
        raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")
    problem = F.raise_error(F.concat(F.lit("not an ISO-8601 UTC instant: "), column))
    return F.when(column.rlike(fixed.UTC_INSTANT), plain.cast("timestamp_ntz")).otherwise(
        problem.cast("timestamp_ntz")
    )


def instant_text(ts: ColumnLike) -> Column:
    """The timestamp as ISO-8601 text, fractions in groups of three digits."""
    shown = F.split(as_column(ts).cast("string"), "[ .]")
    seconds = F.concat(shown[0], F.lit("T"), shown[1])
    fraction = F.coalesce(F.get(shown, F.lit(2)), F.lit(""))
    width = F.when(F.length(fraction) > 3, 6).otherwise(3)
    padded = F.when(fraction == "", "").otherwise(
        F.concat(F.lit("."), F.rpad(fraction, width, F.lit("0")))
    )
    return F.concat(seconds, padded, F.lit("Z"))


def has_element(markup: ColumnLike, name: str) -> Column:
    """Whether there is any element of that name; stops at the first."""
    return as_column(markup).rlike(fixed.ELEMENT.format(name=name))


def revision_texts(revision: ColumnLike) -> Column:
    """The parts of one revision element that are always needed, as text."""
    return F.struct(
        as_column(revision).alias("element"),
        element_text(revision, "id").alias("id"),
        element_text(revision, "username").alias("user"),
        element_text(revision, "timestamp").alias("timestamp"),
    )


def revision_struct(texts: Column, on_bad_ts: str = "fail") -> Column:
    """``revision_texts`` as ``struct<rid, contributor, ts>``.

    The contributor is the user name, else the address, else ''.
    """
    contributor = F.when(texts["user"] != "", texts["user"]).otherwise(
        element_text(texts["element"], "ip")
    )
    return F.struct(
        id_or_default(texts["id"]).alias("rid"),
        contributor.alias("contributor"),
        utc_instant(texts["timestamp"], on_bad_ts).alias("ts"),
    )
