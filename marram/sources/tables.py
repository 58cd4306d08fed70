"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


PARTITIONS = "spark.marram.inputPartitions"


def spread(frame: DataFrame) -> DataFrame:
    """Rows as they were read, or dealt out to as many tasks as the session asks for.

    The setting ``spark.marram.inputPartitions`` is for inputs of a few files
    that cannot be split, ahead of work that costs far more than moving them.
    It is unset by default, and then nothing is shuffled.
    """
    wanted = frame.sparkSession.conf.get(PARTITIONS, None)
    return frame if wanted is None else frame.repartition(int(wanted))
