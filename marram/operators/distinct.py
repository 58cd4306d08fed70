"""Distinct contributors over any years of any datasets, from small stored tables.

Two forms of table, both per year, both mergeable: bitmaps over dense numbers
of the contributors, which are exact, and theta sketches, which have a fixed
size and a known error. Neither reads the revisions again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Contributors are numbered in so many parts of the names' hashes.
PARTS = 4096
# A sketch keeps so many hashes, as a power of two.
LOG_ENTRIES = 12


def contributor_numbers(*datasets: DataFrame, parts: int = PARTS) -> DataFrame:
    """``contributor, number``: all contributors of all datasets, numbered from 0 without gaps.

    Names are dealt into parts by their hash and numbered within; the sums of
    the sizes of earlier parts are added. A part holds one in ``parts`` of the
    names, and one row per part takes part in the sums. Revisions without a
    contributor are not numbered.
    """
    names = datasets[0].select("contributor")
    for more in datasets[1:]:
        names = names.unionAll(more.select("contributor"))
    dealt = names.where("contributor IS NOT NULL").distinct().withColumn("part", F.pmod(F.xxhash64("contributor"), F.lit(parts)))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("contributor"))
    return (
        dealt.withColumn("n", within)
        .join(F.broadcast(offsets), "part")
        .select("contributor", (F.col("offset") + F.col("n") - 1).cast("bigint").alias("number"))
    )


def year_bitmaps(revisions: DataFrame, numbers: DataFrame) -> DataFrame:
    """``year, bucket, bits``: which numbers occur in each year, 32,768 numbers a row.

    Names meet their numbers once a year and name, so a busy contributor's
    revisions are reduced first.
    """
    pairs = revisions.select(F.year("ts").alias("year"), "contributor").distinct()
    numbered = pairs.join(numbers, "contributor")
    # The functions count from 1.
    number = F.col("number") + 1
    return numbered.groupBy("year", F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )


def merged_bitmaps(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Bitmaps of all years together, or per ``by``: ``*by, bucket, bits``. Also merges those of newer revisions."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted_bitmaps(merged: DataFrame, *by: str) -> DataFrame:
    """How many contributors merged bitmaps hold: ``*by, n_contributors``."""
    total = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n_contributors")
    return merged.groupBy(*by).agg(total) if by else merged.agg(total)


def common_bitmaps(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bitmaps ``bucket, bits`` of what is in both of two tables of them, which share their numbers."""
    both = left.select("bucket", "bits").unionAll(right.select("bucket", "bits"))
    met = both.groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("sides"))
    return met.where("sides = 2").drop("sides")


def year_sketches(revisions: DataFrame, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """``year, sketch``: a theta sketch of each year's contributors, of bounded size."""
    return revisions.groupBy(F.year("ts").alias("year")).agg(
        F.theta_sketch_agg("contributor", F.lit(log_entries)).alias("sketch")
    )


def merged_sketches(sketches: DataFrame, *by: str, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """Sketches of all years together, or per ``by``: ``*by, sketch``. Also merges those of newer revisions."""
    union = F.theta_union_agg("sketch", F.lit(log_entries)).alias("sketch")
    return sketches.groupBy(*by).agg(union) if by else sketches.agg(union)


def estimate(sketch: str = "sketch") -> Column:
    return F.theta_sketch_estimate(sketch)


def common_estimate(left: DataFrame, right: DataFrame) -> DataFrame:
    """``n_contributors`` in both of two single sketches, estimated.

    The error is that of the larger side's size, not of the result's.
    """
    a, b = left.select(F.col("sketch").alias("a")), right.select(F.col("sketch").alias("b"))
    # One row on either side.
    return a.join(b, F.lit(True)).select(estimate(F.theta_intersection("a", "b")).alias("n_contributors"))


def error(log_entries: int = LOG_ENTRIES, deviations: float = 4.0) -> float:
    """Relative error that an estimate keeps within, but for one in thousands at four deviations.

    Up to ``2 ** log_entries`` contributors are counted exactly.
    """
    return deviations / math.sqrt(2**log_entries - 1)
