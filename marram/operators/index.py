"""A positional inverted index over numbered lines ``doc_id, line_id, line``.

The index is kept as three flat tables, since a common word's entry has no
size limit: postings per word, document and line, line counts per word and
document, and totals per word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Window, WindowSpec
from pyspark.sql import functions as F

from marram.functions import fixed, text
from marram.operators.skew import SHARES, with_parts

LINES_PER_BLOCK = 100_000
BLOCKS_PER_GROUP = 1_000
# Postings that a task hands on at once.
ROWS_PER_BATCH = 65_536


def occurrences(lines: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """``word, doc_id, line_id, pos`` for every word that is no stop word.

    ``pos`` counts a line's kept words from 0.
    """
    return lines.select(
        "doc_id",
        "line_id",
        F.posexplode(text.index_tokens("line", stop_words)).alias("pos", "word"),
    ).select("word", "doc_id", "line_id", "pos")


def occurrences_without(lines: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Like ``occurrences``, with the stop words in a table ``word``.

    A word counts once in the table, however often it stands there. Spark
    broadcasts the table if its size permits and shuffles it otherwise. Positions
    are counted after the removal, within one line's words.
    """
    stops = stop_words.select("word").distinct()
    kept = occurrences(lines).join(stops, "word", "left_anti")
    in_line = Window.partitionBy("doc_id", "line_id").orderBy("pos")
    return kept.select(
        "word", "doc_id", "line_id", (F.row_number().over(in_line) - 1).alias("pos")
    )


def postings(lines: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """``word, doc_id, line_id, pos, n``: first position and count per line.

    A line is one row, so its repeats are brought together within a batch of
    lines; no shuffle is needed. Where the same document and line number can
    stand in several rows, apply ``merge_postings``.
    """
    told = lines.select("doc_id", "line_id", text.index_tokens("line", stop_words).alias("words"))

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            codes = words.flatten().dictionary_encode()
            row = np.repeat(np.arange(len(lengths)), lengths)
            place = row * max(1, len(codes.dictionary)) + codes.indices.to_numpy(zero_copy_only=False)
            _, first, n = np.unique(place, return_index=True, return_counts=True)
            pos = first - (np.cumsum(lengths) - lengths)[row[first]]
            # Strings of a batch that repeats them may pass what one array holds.
            for start in range(0, len(first), most):
                part = slice(start, start + most)
                found = [codes.dictionary.take(codes.indices.take(pa.array(first[part])))]
                found += [batch.column(name).take(pa.array(row[first[part]])) for name in ("doc_id", "line_id")]
                found += [pa.array(pos[part].astype(np.int32)), pa.array(n[part].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(found, names)

    most, names = ROWS_PER_BATCH, ["word", "doc_id", "line_id", "pos", "n"]
    types = [told.schema[name].dataType.simpleString() for name in ("doc_id", "line_id")]
    schema = f"word string, doc_id {types[0]}, line_id {types[1]}, pos int, n bigint"
    return told.mapInArrow(gathered, schema)


def merge_postings(rows: DataFrame) -> DataFrame:
    """One posting per word, document and line; the first position stays."""
    return rows.groupBy("word", "doc_id", "line_id").agg(
        F.min("pos").alias("pos"), F.sum("n").alias("n")
    )


def count_occurrences(rows: DataFrame) -> DataFrame:
    """Postings from occurrences, by grouping."""
    return merge_postings(rows.withColumn("n", F.lit(1).cast("bigint")))


def document_counts(rows: DataFrame) -> DataFrame:
    """``word, doc_id, n_lines, n`` from postings: distinct lines and occurrences."""
    return rows.groupBy("word", "doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("n").alias("n")
    )


def word_totals(rows: DataFrame) -> DataFrame:
    """``word, n`` from postings or from document counts."""
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def token_totals(lines: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """``word, n`` straight from lines: what ``word_totals`` gives, without sorting lines into postings."""
    words = lines.select(F.explode(text.index_tokens("line", stop_words)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def distinct_words(rows: DataFrame) -> DataFrame:
    return rows.select("word").distinct()


def number_words(words: DataFrame) -> DataFrame:
    """``first_digit, n_words`` over distinct words that are pure numbers."""
    return (
        words.where(text.word_kind("word") == "number")
        .groupBy(text.first_letter("word").alias("first_digit"))
        .agg(F.count(F.lit(1)).alias("n_words"))
    )


def palindromes(words: DataFrame) -> DataFrame:
    """``n_words`` that are palindromes, over distinct words."""
    return words.agg(F.count_if(text.word_kind("word") == "palindrome").alias("n_words"))


def observe_words(words: DataFrame, name: str = "index") -> tuple[DataFrame, Observation]:
    """Counts palindromes and numbers by first digit while the words are used.

    Returns the words to go on with and the observation to ask afterwards:
    ``palindromes`` and ``first_digit_0`` to ``first_digit_9``.
    """
    observation = Observation(name)
    kind = text.word_kind("word")
    digits = [
        F.count_if((kind == "number") & (text.first_letter("word") == str(digit))).alias(
            f"first_digit_{digit}"
        )
        for digit in range(10)
    ]
    counted = F.count_if(kind == "palindrome").alias("palindromes")
    return words.observe(observation, counted, *digits), observation


def by_length(words: DataFrame) -> DataFrame:
    """Rows of each partition sorted by word length, longest first, then by word."""
    return words.sortWithinPartitions(F.desc(F.length("word")), "word")


def with_bucket(rows: DataFrame, buckets: int = fixed.INDEX_BUCKETS) -> DataFrame:
    """Adds ``bucket``, the word's length range."""
    return rows.withColumn("bucket", text.length_bucket("word", buckets))


def place_by_bucket(
    rows: DataFrame, buckets: int = fixed.INDEX_BUCKETS, shares: int = SHARES
) -> DataFrame:
    """Rows with ``bucket`` and ``part``, placed by both.

    Ranges differ much in size, so one with more than a ``shares``-th of all
    rows is dealt out to parts by a hash of the word.
    """
    number = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("bigint")
    parted = with_parts(with_bucket(rows, buckets), "bucket", number, shares)
    return parted.repartition("bucket", "part")


def tree_rows(rows: DataFrame, buckets: int = fixed.INDEX_BUCKETS) -> DataFrame:
    """The index as lines of a tree, from postings.

    ``text`` is the word with its total, indented below it each document with
    its number of lines, and below that each line with its first position.
    Sort by ``bucket``, ``length`` descending, ``word``, ``doc_id`` and
    ``line_id`` to bring the lines in order: parents have NULL where their
    children have numbers.
    """
    # Words and documents come from one pass over the postings.
    counted = rows.groupingSets([["word", "doc_id"], ["word"]], "word", "doc_id").agg(
        F.grouping("doc_id").alias("is_word"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("n").alias("n"),
    )
    nobody = F.lit(None).cast("bigint")
    is_word = F.col("is_word") == 1

    def level(frame: DataFrame, doc_id: Column, line_id: Column, *fields: Column | str) -> DataFrame:
        return frame.select(
            "word",
            doc_id.cast("bigint").alias("doc_id"),
            line_id.cast("bigint").alias("line_id"),
            F.concat_ws("\t", *fields).alias("text"),
        )

    empty = F.lit("")
    doc_id, line_id = F.col("doc_id"), F.col("line_id")
    numbers = F.when(is_word, F.col("n")).otherwise(F.col("n_lines")).cast("string")
    heading = F.when(is_word, F.col("word")).otherwise(F.concat(F.lit("\t"), doc_id.cast("string")))
    parents = level(counted, doc_id, nobody, heading, numbers)
    lines = level(rows, doc_id, line_id, empty, empty, line_id.cast("string"), F.col("pos").cast("string"))
    return with_bucket(parents.unionByName(lines), buckets).withColumn("length", F.length("word"))


def carry_documents(
    lines: DataFrame,
    lines_per_block: int = LINES_PER_BLOCK,
    blocks_per_group: int = BLOCKS_PER_GROUP,
) -> DataFrame:
    """Document and line numbers for files given as ``file, line_no, line``.

    ``line_no`` counts a file's lines from 1 without gaps. A header line opens
    a document and is its line 0; lines before any header belong to document
    0 and count from 1.

    A file may be of any size: lines are handled in blocks and blocks in
    groups. One row per block takes part in carrying the last header over to
    the next block of a group, and one per group to the next group.
    """
    is_header = F.col("line").startswith(fixed.DOCUMENT_HEADER)
    block = F.floor((F.col("line_no") - 1) / lines_per_block).cast("bigint")
    marked = lines.select(
        "file",
        block.alias("block"),
        "line_no",
        "line",
        F.when(is_header, F.col("line_no")).alias("at"),
        F.when(is_header, text.header_document_id("line")).alias("doc_id"),
    )

    def latest(column: str, window: WindowSpec) -> Column:
        return F.last(column, ignorenulls=True).over(window)

    def carry(rows: DataFrame, within: list[str], step: str, prefix: str) -> DataFrame:
        """The last header before each step: ``<prefix>_at``, ``<prefix>_doc_id``."""
        before = Window.partitionBy(*within).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
        return rows.select(
            *within,
            step,
            latest("at", before).alias(f"{prefix}_at"),
            latest("doc_id", before).alias(f"{prefix}_doc_id"),
        )

    last = [F.max("at").alias("at"), F.max_by("doc_id", "at").alias("doc_id")]
    group = F.floor(F.col("block") / blocks_per_group).cast("bigint").alias("group")
    blocks = marked.groupBy("file", "block").agg(*last).select("*", group)
    groups = carry(blocks.groupBy("file", "group").agg(*last), ["file"], "group", "group")
    carried = (
        carry(blocks, ["file", "group"], "block", "block")
        .join(groups, ["file", "group"])
        .select(
            "file",
            "block",
            F.coalesce("block_at", "group_at").alias("carried_at"),
            F.coalesce("block_doc_id", "group_doc_id").alias("carried_doc_id"),
        )
    )
    so_far = (
        Window.partitionBy("file", "block")
        .orderBy("line_no")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    in_block = marked.withColumns({"at": latest("at", so_far), "doc_id": latest("doc_id", so_far)})
    zero = F.lit(0).cast("bigint")
    start = F.coalesce("at", "carried_at", zero)
    return in_block.join(carried, ["file", "block"]).select(
        "file",
        F.coalesce("doc_id", "carried_doc_id", zero).alias("doc_id"),
        (F.col("line_no") - start).cast("bigint").alias("line_id"),
        "line",
    )
