"""Tokenising and matching of text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from marram.functions import fixed
from marram.functions.columns import ColumnLike, as_column


def line_parts(text: ColumnLike) -> Column:
    """The text cut at every line end; a closing line end leaves an empty part."""
    return F.split(as_column(text), fixed.LINE_END)


def drop_empty_tail(parts: ColumnLike) -> Column:
    """Without the empty part behind the last line end, which is no line."""
    column = as_column(parts)
    return F.when(
        F.element_at(column, -1) == "", F.slice(column, F.lit(1), F.size(column) - 1)
    ).otherwise(column)


def whitespace_tokens(text: ColumnLike) -> Column:
    """Pieces between whitespace runs; leading whitespace leaves an empty first piece."""
    return F.split(as_column(text), fixed.WHITESPACE_RUN)


def separator_tokens(text: ColumnLike) -> Column:
    """Non-empty pieces between blanks, tabs, line ends and form feeds."""
    return F.filter(F.split(as_column(text), fixed.SEPARATOR_RUN), lambda t: t != "")


def index_tokens(line: ColumnLike, stop_words: Sequence[str] = ()) -> Column:
    """Pieces between whitespace or punctuation, stop words left out.

    Stop words match exactly, case included.
    """
    pieces = F.split(as_column(line), fixed.DELIMITER_RUN)
    if stop_words:
        return F.filter(pieces, lambda t: (t != "") & ~t.isin(*stop_words))
    return F.filter(pieces, lambda t: t != "")


def is_word(token: ColumnLike) -> Column:
    return as_column(token).rlike(fixed.WORD)


def is_number(word: ColumnLike) -> Column:
    return as_column(word).rlike(fixed.NUMBER)


def is_palindrome(word: ColumnLike) -> Column:
    """Longer than two characters and the same both ways, ignoring case."""
    lowered = F.lower(as_column(word))
    return (F.length(as_column(word)) > 2) & (lowered == F.reverse(lowered))


def word_kind(word: ColumnLike) -> Column:
    """``number``, ``palindrome`` or NULL; a number is never also a palindrome."""
    return F.when(is_number(word), "number").when(is_palindrome(word), "palindrome")


def first_letter(word: ColumnLike) -> Column:
    return F.substring(as_column(word), 1, 1)


def index_of(line: ColumnLike, target: str) -> Column:
    """Offset from 0 of the first occurrence, -1 if there is none."""
    return F.instr(as_column(line), target) - 1


def length_bucket(word: ColumnLike, buckets: int = fixed.INDEX_BUCKETS) -> Column:
    """The length range a word falls in, counted in UTF-8 bytes, from 0."""
    scaled = F.octet_length(as_column(word)) * F.lit(buckets)
    bucket = F.ceil(scaled / F.lit(float(fixed.INDEX_MAX_WORD_BYTES))) - 1
    return F.least(bucket, F.lit(buckets - 1).cast("bigint")).cast("int")


def header_document_id(header: ColumnLike) -> Column:
    """The integer between the first two double quotes of a header line."""
    return F.split(as_column(header), '"')[1].cast("bigint")
