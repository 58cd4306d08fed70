"""Text outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_key_values(rows: DataFrame, path: str, *columns: str, single_file: bool = False) -> None:
    """One line per row: the columns, tab-separated.

    ``single_file`` sends all rows through one task, for small reports only.
    """
    names = columns or tuple(rows.columns)
    lines = rows.select(F.concat_ws("\t", *[F.col(name).cast("string") for name in names]))
    (lines.coalesce(1) if single_file else lines).write.text(path)


def write_index_tree(tree: DataFrame, path: str, files: int | None = None) -> None:
    """The rows of ``tree_rows`` as text, one directory per length range.

    The files of a directory, taken by name, are in order from the longest
    word to the shortest. Rows are spread by ranges of the whole order, so a
    large length range, and even one word's entry, is written by many tasks.
    Finding the ranges reads the rows once more than writing them does: for a
    large corpus build the tree from postings that were stored as a table.
    """
    order = [
        F.col("bucket").asc(),
        F.col("length").desc(),
        F.col("word").asc(),
        F.col("doc_id").asc_nulls_first(),
        F.col("line_id").asc_nulls_first(),
    ]
    spread = (
        tree.repartitionByRange(*order) if files is None else tree.repartitionByRange(files, *order)
    )
    spread.sortWithinPartitions(*order).select("bucket", "text").write.partitionBy("bucket").text(path)
