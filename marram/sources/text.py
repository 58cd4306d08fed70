"""Plain text, word lists and collections of documents in text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marram.functions import fixed, text


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per line: ``line``. Files and directories may be mixed.

    A path that does not exist is an error.
    """
    return spark.read.text(list(paths)).withColumnRenamed("value", "line")


def read_numbered_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per line: ``file, line_no, line``, lines of a file counted from 1 without gaps.

    Files may be split anywhere. A block's lines are numbered among
    themselves, blocks are counted, and the sums of the counts of a file's
    earlier blocks are added. Only a block's lines meet in one task, which the
    reader's settings bound, and one row per block takes part in the sums.
    Empty lines count, an empty file has none.
    """
    placed = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )
    # A task reads a block in order, so numbers grow along it.
    in_block = placed.withColumn("n", F.row_number().over(Window.partitionBy("file", "block").orderBy("at")))
    counts = placed.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n_lines"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("file", "block", F.coalesce(F.sum("n_lines").over(before), F.lit(0)).alias("offset"))
    return in_block.join(offsets, ["file", "block"]).select(
        "file", (F.col("offset") + F.col("n")).alias("line_no"), "line"
    )


def numbered_table_lines(numbered: DataFrame) -> DataFrame:
    """Numbered lines of files as those of documents, ``doc_id, line_id, line``: the file is the document.

    So line search, longest words and the index keep the order of the files.
    """
    return numbered.select(F.col("file").alias("doc_id"), F.col("line_no").alias("line_id"), "line")


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One row per distinct line: ``word``."""
    return read_lines(spark, path).select(F.col("line").alias("word")).distinct()


def read_document_collection(spark: SparkSession, *paths: str) -> DataFrame:
    """Documents that follow one another in text files, cut at their header lines.

    Each record is one document with its header line, so the reader can split
    files anywhere without losing track of the document: ``doc_id, text``. What
    stands before a file's first header is document 0. The first record of a
    file is told by its place: it is the first that the file's first block gave.
    """
    reader = spark.read.option("lineSep", "\n" + fixed.DOCUMENT_HEADER)
    placed = reader.text(list(paths)).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),
    )
    # A window's rows are those of one block, which the reader's settings bound.
    earliest = F.min("n").over(Window.partitionBy("file", "block"))
    first = (F.col("block") == 0) & (F.col("n") == earliest)
    return documents_from_records(placed.select("value", first.alias("first")))


def documents_from_records(records: DataFrame) -> DataFrame:
    """Documents from records ``value`` cut in front of their header lines.

    ``first`` tells a file's first record, from which the cut took nothing
    away: it is text before any header, document 0, unless it starts with one.
    All others lack the header's opening, which is put back. A header without
    an integer between its first two quotes fails the job.
    """
    header = fixed.DOCUMENT_HEADER
    whole = F.when(F.col("first"), F.col("value")).otherwise(F.concat(F.lit(header), "value"))
    head = F.regexp_extract("text", r"^[^\r\n]*", 0)
    return records.select(whole.alias("text")).select(
        F.when(F.col("text").startswith(header), text.header_document_id(head))
        .otherwise(F.lit(0).cast("bigint"))
        .alias("doc_id"),
        "text",
    )


def document_lines(documents: DataFrame) -> DataFrame:
    """Numbered lines of a document collection: ``doc_id, line_id, line``.

    A header line has number 0. Text before any header counts from 1. An empty
    last line of a document, which has no words, is not listed.
    """
    first = F.when(F.col("text").startswith(fixed.DOCUMENT_HEADER), 0).otherwise(1)
    parts = documents.select("doc_id", first.alias("first"), text.line_parts("text").alias("parts"))
    return parts.select(
        "doc_id", "first", F.posexplode(text.drop_empty_tail("parts")).alias("at", "line")
    ).select("doc_id", (F.col("at") + F.col("first")).alias("line_id"), "line")


def table_lines(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Numbered lines of a text column: ``doc_id, line_id, line``, counted from 0."""
    parts = documents.select(
        F.col(id_column).alias("doc_id"), text.line_parts(text_column).alias("parts")
    )
    return parts.select(
        "doc_id", F.posexplode(text.drop_empty_tail("parts")).alias("line_id", "line")
    )
