"""Raster outputs as parquet tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marram.functions.columns import ColumnLike, as_column

LAYERS = ("cartoon", "colours", "edges", "blurred")


def cartoon_name(name: ColumnLike, layer: str = "cartoon") -> Column:
    """``photo.JPG`` as ``photo_cartoon.jpg``; NULL for a name without an extension."""
    column = as_column(name)
    base = F.regexp_extract(column, r"(?s)^(.+)\.[^.]*\z", 1)
    extension = F.lower(F.regexp_extract(column, r"(?s)^.+(\.[^.]*)\z", 1))
    return F.when(base != "", F.concat(base, F.lit(f"_{layer}"), extension))


def edited_name(name: ColumnLike) -> Column:
    """``photo.png`` as ``photo_edited.png``; NULL for names that end in neither .png nor .jpg."""
    column = as_column(name)
    return F.when(
        column.endswith(".png") | column.endswith(".jpg"),
        F.regexp_replace(column, r"(\.png|\.jpg)\z", "_edited$1"),
    )


def write_layers(layers: Mapping[str, DataFrame], path: str) -> None:
    """Each raster under ``layer=<name>``."""
    for name, raster in layers.items():
        raster.write.parquet(f"{path}/layer={name}")


def write_cartoon(layers: DataFrame, path: str, intermediate: bool = False) -> None:
    """The result of ``cartoon_layers`` under ``layer=cartoon``.

    With ``intermediate`` the other stages are written too, all from one
    computation.
    """
    wanted = LAYERS if intermediate else LAYERS[:1]
    others = [name for name in layers.columns if name not in LAYERS]
    stages = F.array(
        *[F.struct(F.lit(name).alias("layer"), F.col(name).alias("rgb")) for name in wanted]
    )
    rows = layers.select(*others, F.explode(stages).alias("stage")).select(
        *others, "stage.rgb.r", "stage.rgb.g", "stage.rgb.b", "stage.layer"
    )
    rows.write.partitionBy("layer").parquet(path)
