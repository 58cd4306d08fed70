"""Image files as pixel tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.functions.colour import channel

RASTER_COLUMNS = ("image_id", "width", "height", "x", "y", "r", "g", "b")


def read_images(spark: SparkSession, *paths: str) -> DataFrame:
    """Pixels of image files, ``image_id`` being the file's address.

    A file that is no image fails the job; transparency is dropped.
    """
    return pixels_of_images(spark.read.format("image").load(list(paths)))


def pixels_of_images(images: DataFrame) -> DataFrame:
    """Pixels of an ``image`` column in the layout of Spark's image source.

    Each image is cut into rows before it is cut into pixels, so what a task
    holds at once is one pixel row. Bytes are blue, green, red (and alpha) per
    pixel, or one gray byte. An entry without pixels, as the source gives for
    a file that is no image, fails the job.
    """
    problem = F.raise_error(F.concat(F.lit("not an image: "), F.col("image.origin")))
    valid = F.when(
        (F.col("image.width") > 0) & (F.col("image.height") > 0), True
    ).otherwise(problem.cast("boolean"))
    fields = images.where(valid).select(
        F.col("image.origin").alias("image_id"),
        F.col("image.width").alias("width"),
        F.col("image.height").alias("height"),
        F.col("image.nChannels").alias("stride"),
        F.col("image.data").alias("data"),
    )
    rows = fields.select("*", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y"))
    row_bytes = F.col("width") * F.col("stride")
    cut = rows.select(
        "image_id",
        "width",
        "height",
        "y",
        "stride",
        F.substring("data", F.col("y") * row_bytes + 1, row_bytes).alias("row"),
    )
    at = F.col("x") * F.col("stride") + 1
    pixel = F.substring("row", at, F.least("stride", F.lit(3)))
    packed = cut.select(
        "image_id",
        "width",
        "height",
        "stride",
        F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("x"),
        "y",
        "row",
    ).select(
        "image_id",
        "width",
        "height",
        "x",
        "y",
        "stride",
        F.conv(F.hex(pixel), 16, 10).cast("int").alias("bgr"),
    )
    gray = F.col("stride") == 1
    return packed.select(
        "image_id",
        "width",
        "height",
        "x",
        "y",
        F.when(gray, F.col("bgr")).otherwise(channel("bgr", 0)).alias("r"),
        F.when(gray, F.col("bgr")).otherwise(channel("bgr", 1)).alias("g"),
        F.when(gray, F.col("bgr")).otherwise(channel("bgr", 2)).alias("b"),
    )
