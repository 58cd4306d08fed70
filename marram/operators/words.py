"""Word and line questions over a text column.

Word order in a text is ``pos``, the place among all pieces of that text, so
``(doc_id, pos)`` is the order of a whole table and no line numbers are
needed. Every count here is reduced in the reading task before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marram.functions import fixed, text


def word_stream(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per word: ``doc_id, pos, word``.

    Words are the whitespace-separated pieces made of English letters only.
    Line ends are whitespace, so a whole text gives the words of its lines.
    """
    pieces = documents.select(
        F.col(id_column).alias("doc_id"),
        F.posexplode(text.whitespace_tokens(text_column)).alias("pos", "word"),
    )
    return pieces.where(text.is_word("word"))


def count_words(words: DataFrame) -> DataFrame:
    return words.agg(F.count(F.lit(1)).alias("n_words"))


def unique_words(words: DataFrame) -> DataFrame:
    """Distinct words, last in the alphabet first; capitals sort before small letters."""
    return words.select("word").distinct().orderBy(F.desc("word"))


def longest_word(words: DataFrame) -> DataFrame:
    """The longest word, the first one in the table if several are; no row if none."""
    length = F.length("word")
    return words.orderBy(F.desc(length), "doc_id", "pos").limit(1).select(
        "word", length.alias("n_letters")
    )


def count_words_of_length(words: DataFrame, letters: int = 3) -> DataFrame:
    return words.agg(F.count_if(F.length("word") == letters).alias("n_words"))


def average_word_length(words: DataFrame) -> DataFrame:
    """Letters per word in one pass; NULL for no words."""
    mean = F.try_divide(F.sum(F.length("word")), F.count(F.lit(1)))
    return words.agg(mean.alias("avg_letters"))


def word_counts(words: DataFrame) -> DataFrame:
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def words_by_first_letter(words: DataFrame) -> DataFrame:
    """The set of words of each first letter, as distinct ``letter, word`` rows.

    A letter's set grows with the vocabulary, so it stays rows.
    """
    return words.select("word").distinct().select(text.first_letter("word").alias("letter"), "word")


def letter_set_sizes(words: DataFrame) -> DataFrame:
    return words_by_first_letter(words).groupBy("letter").agg(F.count(F.lit(1)).alias("n_words"))


def find_lines(
    lines: DataFrame,
    target: str,
    matcher: Callable[[Column, str], Column] = text.index_of,
    k: int = fixed.LINES_SHOWN,
) -> DataFrame:
    """The ``k`` lines where ``target`` occurs furthest to the right.

    ``matcher`` gives a line's index for the target, negative for no match.
    Lines with equal indexes keep the table's order.
    """
    found = lines.select(
        matcher(F.col("line"), target).alias("idx"), "doc_id", "line_id", "line"
    ).where(F.col("idx") >= 0)
    return found.orderBy(F.desc("idx"), "doc_id", "line_id").limit(k)


def frequent_words(
    documents: DataFrame, text_column: str = "text", min_count: int = fixed.FREQUENT_WORD_MINIMUM
) -> DataFrame:
    """``word, n`` of all whitespace-separated pieces that occur at least so often."""
    pieces = documents.select(F.explode(text.separator_tokens(text_column)).alias("word"))
    return word_counts(pieces).where(F.col("n") >= min_count)


def sorted_by_word(counts: DataFrame) -> DataFrame:
    return counts.orderBy("word")
