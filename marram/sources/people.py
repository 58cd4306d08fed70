"""Persons from headerless ``name,gender,birth_year`` files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_persons(spark: SparkSession, *paths: str) -> DataFrame:
    """``name, gender, birth_year, source_order``.

    Fields are cut at commas without quoting, those after the third are
    ignored, and a line without a whole-number year fails the job.
    ``source_order`` sorts rows as they stand in the files: by file, by the
    block the reader cut it into, and by the row's place in the task that
    read the block.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    lines = spark.read.text(list(paths)).select("value", place.alias("source_order"))
    return persons_from_lines(lines)


def persons_from_lines(lines: DataFrame) -> DataFrame:
    """The same from rows ``value, source_order``."""
    fields = F.split("value", ",")
    return lines.select(
        fields[0].alias("name"),
        fields[1].alias("gender"),
        fields[2].cast("int").alias("birth_year"),
        "source_order",
    )
