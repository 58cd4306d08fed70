"""Point operators on pixel tables.

A raster table holds any number of images, one row per pixel: ``image_id,
width, height, x, y, r, g, b``. Point operators are projections and filters,
so they run inside the reading task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.functions import colour, fixed
from marram.functions.numbers import idiv
from marram.operators.skew import lookup_join
from marram.sources.images import RASTER_COLUMNS


def grayscale(raster: DataFrame, mode: str = "mean") -> DataFrame:
    """All channels set to one gray value, by ``mean`` or by the bitwise ``shift`` form."""
    rules = {"mean": colour.mean_gray, "shift": colour.shift_gray}
    if mode not in rules:
        raise ValueError(f"mode must be 'mean' or 'shift', not {mode!r}")
    gray = rules[mode]("r", "g", "b")
    return raster.withColumns({"r": gray, "g": gray, "b": gray})


def sepia(raster: DataFrame) -> DataFrame:
    red, green, blue = colour.sepia("r", "g", "b")
    return raster.withColumns({"r": red, "g": green, "b": blue})


def half(raster: DataFrame) -> DataFrame:
    """Every second pixel of every second row; an odd last row or column is dropped."""
    kept = raster.where(
        (F.col("x") % 2 == 0)
        & (F.col("y") % 2 == 0)
        & (F.col("x") + 1 < F.col("width"))
        & (F.col("y") + 1 < F.col("height"))
    )
    return kept.withColumns({name: idiv(name, 2).cast("int") for name in ("width", "height", "x", "y")})


def reduce_colours(raster: DataFrame, colours: int = fixed.COLOURS) -> DataFrame:
    """Each channel reduced to ``colours`` values, 2 to 256."""
    return raster.withColumns({c: colour.quantise(c, colours) for c in ("r", "g", "b")})


def merge_mask(mask: DataFrame, other: DataFrame, mask_colour: int = fixed.WHITE) -> DataFrame:
    """``other`` where the mask has exactly ``mask_colour``, the mask elsewhere.

    A place of the mask that ``other`` lacks fails the job.
    """
    place = ["image_id", "x", "y"]
    under = other.select(*place, F.lit(True).alias("_met"), *[F.col(c).alias(f"other_{c}") for c in ("r", "g", "b")])
    open_here = colour.pack("r", "g", "b") == mask_colour
    missing = F.raise_error(
        F.concat_ws(" ", F.lit("no pixel under the mask at"), *[F.col(c).cast("string") for c in place])
    )
    met = mask.join(under, place, "left").where(
        F.when(F.col("_met"), True).otherwise(missing.cast("boolean"))
    )
    return met.select(
        "image_id",
        "width",
        "height",
        "x",
        "y",
        *[F.when(open_here, F.col(f"other_{c}")).otherwise(F.col(c)).alias(c) for c in ("r", "g", "b")],
    )


def packed(raster: DataFrame) -> DataFrame:
    """Channels packed: ``image_id, width, height, x, y, rgb``."""
    return raster.select(
        "image_id", "width", "height", "x", "y", colour.pack("r", "g", "b").alias("rgb")
    )


def unpacked(raster: DataFrame) -> DataFrame:
    """The reverse of ``packed``; bits above the colours, such as alpha, are dropped."""
    red, green, blue = colour.unpack("rgb")
    return raster.select(
        "image_id", "width", "height", "x", "y", red.alias("r"), green.alias("g"), blue.alias("b")
    )


def dimensions(raster: DataFrame) -> DataFrame:
    """``image_id, width, height`` as found in the pixels."""
    return raster.groupBy("image_id").agg(
        (F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height")
    )


def with_dimensions(pixels: DataFrame) -> DataFrame:
    """Adds the sizes to pixels ``image_id, x, y, r, g, b`` that lack them."""
    sized = lookup_join(pixels, dimensions(pixels), "image_id")
    return sized.select(*RASTER_COLUMNS)


def require_size(raster: DataFrame, width: int, height: int) -> DataFrame:
    """The raster, failing the job if an image has another size, whichever columns are used."""
    fits = (F.col("width") == width) & (F.col("height") == height)
    problem = F.raise_error(
        F.concat(F.lit("incorrect image size: "), F.col("image_id").cast("string"))
    ).cast("boolean")
    return raster.where(F.when(fits, True).otherwise(problem))
