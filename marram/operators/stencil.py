"""Neighbourhood operators on pixel tables.

The work is cut into square tiles. Pixels near a tile's border are also given
to the tiles beyond it, so that each tile can be finished on its own: there is
one shuffle, by image and tile, however many filters follow one another, and
no task holds more than one tile's row or column at a time even if one image
makes up most of the table. Within a tile a filter is two windows, along the
rows and along the columns; both, and those of the next filter, reuse the
placing by tile.

Where channels are known to be 0 to 255, the three travel in one integer, 20
bits apart. Sums of weighted channels are then sums of these integers, done for
all channels at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marram.functions import colour, fixed
from marram.functions.columns import ColumnLike, as_column
from marram.functions.numbers import idiv
from marram.operators.raster import RASTER_COLUMNS

TILE = 256
# Steps up to this length fall back to the next shorter one beyond the border,
# longer ones to the row's last pixel; equal weights over more than twice as
# many pixels are running sums.
NEAR = 4

Kernel = Sequence[Sequence[int]]

_LANE_BITS = 20
_LANE_MASK = (1 << _LANE_BITS) - 1
_LANE_OFFSET = 1 << (_LANE_BITS - 1)
_ALL_OFFSETS = _LANE_OFFSET * (1 + (1 << _LANE_BITS) + (1 << 2 * _LANE_BITS))
_PLACE = ("image_id", "width", "height", "x", "y")


# Kernels --------------------------------------------------------------------


def square_kernel(weights: Sequence[int]) -> Kernel:
    """Rows of a square filter given as one flat list."""
    size = int(round(len(weights) ** 0.5))
    if not weights or size * size != len(weights):
        raise ValueError(f"non-square filter: {list(weights)}")
    return [list(weights[i : i + size]) for i in range(0, len(weights), size)]


def _checked(kernel: Kernel) -> list[list[int]]:
    rows = [list(row) for row in kernel]
    if not rows or any(len(row) != len(rows) for row in rows):
        raise ValueError(f"non-square filter: {rows}")
    return rows


def _reach(kernel: Kernel) -> int:
    return len(kernel) // 2


def _transposed(kernel: Kernel) -> list[list[int]]:
    return [list(column) for column in zip(*kernel, strict=True)]


def _profile(row: Sequence[int]) -> tuple[tuple[int, ...], int]:
    """A filter row as (smallest row in proportion, factor), so that rows share sums."""
    factor = gcd(*row)
    if factor == 0:
        return tuple(row), 0
    if next(weight for weight in row if weight) < 0:
        factor = -factor
    return tuple(weight // factor for weight in row), factor


# Channels in one integer ----------------------------------------------------


def _lanes(r: ColumnLike, g: ColumnLike, b: ColumnLike) -> Column:
    """Three channels of 0 to 255 in one integer; others fail the job."""
    red, green, blue = (as_column(c).cast("bigint") for c in (r, g, b))
    packed = F.shiftleft(red, 2 * _LANE_BITS) + F.shiftleft(green, _LANE_BITS) + blue
    all_bits = red.bitwiseOR(green).bitwiseOR(blue)
    problem = F.raise_error(F.lit("channels must be 0 to 255")).cast("bigint")
    return F.when(all_bits.between(0, 255), packed).otherwise(problem)


def _channels(lanes: ColumnLike) -> tuple[Column, Column, Column]:
    """The channel sums; the offset keeps negative ones out of their neighbours."""
    lifted = as_column(lanes) + F.lit(_ALL_OFFSETS)

    def one(place: int) -> Column:
        bits = F.shiftright(lifted, place * _LANE_BITS).bitwiseAND(F.lit(_LANE_MASK))
        return (bits - F.lit(_LANE_OFFSET)).cast("int")

    return one(2), one(1), one(0)


# Tiles ----------------------------------------------------------------------


def _tile_count(size: ColumnLike, tile: int) -> Column:
    return idiv(as_column(size) + (tile - 1), tile)


def _tile_number(x: Column, y: Column, tile: int) -> Column:
    return (idiv(y, tile) * _tile_count("width", tile) + idiv(x, tile)).cast("int")


def _in_tiles(raster: DataFrame, reach: int, tile: int, value: Column) -> DataFrame:
    """``value`` of every pixel in each tile that is within ``reach`` of it."""
    if tile < 1:
        raise ValueError(f"tile must be at least 1, not {tile}")

    def tiles(position: str, size: str) -> Column:
        last = _tile_count(size, tile) - 1
        low = idiv(F.greatest(F.col(position) - reach, F.lit(0)), tile)
        high = idiv(F.greatest(F.col(position) + reach, F.lit(0)), tile)
        return F.sequence(F.least(low, last), F.least(high, last))

    columns = raster.select(
        *_PLACE, value.alias("value"), F.explode(tiles("x", "width")).alias("tile_x")
    )
    cells = columns.select(
        *_PLACE, "value", "tile_x", F.explode(tiles("y", "height")).alias("tile_y")
    )
    number = F.col("tile_y") * _tile_count("width", tile) + F.col("tile_x")
    return cells.select(*_PLACE, "value", number.cast("int").alias("tile")).repartition(
        "image_id", "tile"
    )


def _at_home(tiled: DataFrame, tile: int) -> DataFrame:
    """Only the pixels that belong to their tile."""
    return tiled.where(F.col("tile") == _tile_number(F.col("x"), F.col("y"), tile))


# Filters inside tiles -------------------------------------------------------


def _along(axis: str) -> WindowSpec:
    across = "y" if axis == "x" else "x"
    return Window.partitionBy("image_id", "tile", across).orderBy(axis)


def _whole(axis: str) -> WindowSpec:
    return _along(axis).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _with_steps(tiled: DataFrame, axis: str, steps: dict[str, set[int]]) -> DataFrame:
    """Adds ``<column>@<step>``, the column's value so many pixels further along.

    Beyond the image the nearest pixel counts: a step that finds nothing
    falls back to the next shorter one, a long one to ``<column>@end<sign>``,
    the last pixel that the tile has in this direction. So the number of
    columns grows with the reach and not with its square.
    """
    window = _along(axis)
    reached = {}
    for column, wanted in steps.items():
        for sign, step, end in ((-1, F.lag, F.first), (1, F.lead, F.last)):
            lengths = {sign * length for length in wanted if sign * length > 0}
            if max(lengths, default=0) > NEAR:
                reached[f"{column}@end{sign}"] = end(column).over(_whole(axis))
            else:
                lengths = range(1, max(lengths, default=0) + 1)
            for length in lengths:
                reached[f"{column}@{sign * length}"] = step(column, length).over(window)
    if reached:
        tiled = tiled.select("*", *[found.alias(name) for name, found in reached.items()])
    return tiled


def _step(column: str, step: int, wanted: set[int]) -> Column:
    """``column`` at ``step``, where ``wanted`` are all steps that were asked for."""
    if step == 0:
        return F.col(column)
    sign = 1 if step > 0 else -1
    if max(sign * each for each in wanted) > NEAR:
        return F.coalesce(F.col(f"`{column}@{step}`"), F.col(f"`{column}@end{sign}`"))
    nearer = [F.col(f"`{column}@{length * sign}`") for length in range(abs(step), 0, -1)]
    return F.coalesce(*nearer, F.col(column))


def _weighted(terms: Iterable[tuple[Column, int]]) -> Column:
    """The sum of columns times weights, without the zero ones."""
    total = None
    for column, weight in terms:
        if weight == 0:
            continue
        term = column if weight == 1 else column * F.lit(weight)
        total = term if total is None else total + term
    return F.lit(0).cast("bigint") if total is None else total


def _filtered(
    tiled: DataFrame, value: str, kernels: dict[str, Kernel], axes: str = "xy"
) -> DataFrame:
    """Adds one column of weighted sums of ``value`` per kernel to a tiled table."""
    return _all_filtered(tiled, {name: (value, kernel) for name, kernel in kernels.items()}, axes)


def _all_filtered(
    tiled: DataFrame, kernels: dict[str, tuple[str, Kernel]], axes: str = "xy"
) -> DataFrame:
    """Adds one column of weighted sums per name: of which column, and by which kernel.

    ``axes`` is the order of the two passes, each a sort for all columns
    together. Rows of the kernels that are multiples of one another are summed
    once.
    """
    kept = tiled.columns
    profiles: dict[tuple[str, tuple[int, ...]], str] = {}
    plan: dict[str, list[tuple[int, str, int]]] = {}
    for name, (value, kernel) in kernels.items():
        plan[name] = []
        for place, row in enumerate(kernel if axes == "xy" else _transposed(kernel)):
            profile, factor = _profile(row)
            if factor:
                column = profiles.setdefault((value, profile), f"{value}_row{len(profiles)}")
                plan[name].append((place - _reach(kernel), column, factor))

    def terms_of(profile: tuple[int, ...]) -> list[tuple[int, int]]:
        return [(place - len(profile) // 2, weight) for place, weight in enumerate(profile) if weight]

    first_steps: dict[str, set[int]] = {}
    for value, profile in profiles:
        first_steps.setdefault(value, set()).update(step for step, _ in terms_of(profile))
    stepped = _with_steps(tiled, axes[0], first_steps)
    sums = stepped.select(
        *kept,
        *[
            _weighted(
                (_step(value, step, first_steps[value]), weight) for step, weight in terms_of(profile)
            ).alias(column)
            for (value, profile), column in profiles.items()
        ],
    )
    second_steps: dict[str, set[int]] = {}
    for terms in plan.values():
        for step, column, _ in terms:
            second_steps.setdefault(column, set()).add(step)
    stepped = _with_steps(sums, axes[1], second_steps)
    return stepped.select(
        *kept,
        *[
            _weighted(
                (_step(column, step, second_steps[column]), factor) for step, column, factor in terms
            ).alias(name)
            for name, terms in plan.items()
        ],
    )


def _box_pass(tiled: DataFrame, axis: str, columns: Sequence[str], before: int, after: int) -> DataFrame:
    """``columns`` replaced by their sums from ``before`` pixels back to ``after`` pixels on.

    A sum is the difference of two running sums, whatever its length. Beyond
    the border the nearest pixel counts, as often as the sum reaches over it.
    """
    along, whole = _along(axis), _whole(axis)
    running = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = [name for name in tiled.columns if name not in columns]
    ends = [F.first(axis).over(whole).alias("low@"), F.last(axis).over(whole).alias("high@")]
    found = [
        function(column).over(window).alias(f"{column}@{name}")
        for column in columns
        for name, function, window in (
            ("run", F.sum, running), ("all", F.sum, whole), ("first", F.first, whole), ("last", F.last, whole)
        )
    ]
    summed = tiled.select(*kept, *ends, *found)
    reached = [
        step(f"{column}@run", length).over(along).alias(f"{column}@{name}")
        for column in columns
        for name, step, length in (("upper", F.lead, after), ("lower", F.lag, before + 1))
    ]
    over = F.col(axis) + after - F.col("high@")
    under = F.col("low@") - F.col(axis) + before

    def total(column: str) -> Column:
        upper = F.coalesce(f"{column}@upper", F.col(f"{column}@all") + over * F.col(f"{column}@last"))
        lower = F.coalesce(f"{column}@lower", -under * F.col(f"{column}@first"))
        return (upper - lower).alias(column)

    return summed.select("*", *reached).select(*kept, *[total(column) for column in columns])


def _blurred(tiled: DataFrame, value: str, rounding: str = "trunc") -> DataFrame:
    """Adds ``blurred``, the blurred ``value``, both as integers of three channels."""
    summed = _filtered(tiled, value, {"sum": _checked(fixed.GAUSSIAN)}, "xy")
    if rounding == "trunc":
        mean = [idiv(total, fixed.GAUSSIAN_TOTAL) for total in _channels("sum")]
    else:
        mean = [
            colour.clamp(total / F.lit(float(fixed.GAUSSIAN_TOTAL)), rounding)
            for total in _channels("sum")
        ]
    return summed.withColumn("blurred", _lanes(*mean)).drop("sum")


def _edge_strength(tiled: DataFrame, value: str) -> DataFrame:
    """Adds ``strength``, the size of the colour change in both directions.

    The passes start along y, as the blur's end there.
    """
    kernels = {
        "vertical": _checked(fixed.SOBEL_VERTICAL),
        "horizontal": _checked(fixed.SOBEL_HORIZONTAL),
    }
    changes = _filtered(tiled, value, kernels, "yx")
    parts = [F.abs(c) for name in kernels for c in _channels(name)]
    return changes.withColumn("strength", sum(parts[1:], parts[0])).drop(*kernels)


def _raster_of(tiled: DataFrame, channels: Sequence[Column]) -> DataFrame:
    red, green, blue = (c.cast("int") for c in channels)
    return tiled.select(*_PLACE, red.alias("r"), green.alias("g"), blue.alias("b"))


# Operators ------------------------------------------------------------------


def convolve(raster: DataFrame, kernel: Kernel, edge: str = "clamp", tile: int = TILE) -> DataFrame:
    """Weighted sums of each pixel's neighbourhood, per channel, as bigint and not clamped.

    Channels may be any integers, such as the sums of another filter, so they
    are summed each on its own.

    ``kernel`` is a square of integers in reading order. Beyond the image the
    nearest pixel counts, or with ``edge='reflect'`` the mirrored one; images
    must then be at least as wide and high as the kernel reaches.

    Rows of the kernel that are multiples of one another are summed once, so
    one that is a column times a row costs two passes of its length. A large
    one of equal weights is ``box_sums``, at the same cost for any size.
    """
    rows = _checked(kernel)
    weights = {weight for row in rows for weight in row}
    if len(rows) > 2 * NEAR and len(weights) == 1:
        sums, factor = box_sums(raster, len(rows), edge, tile), F.lit(weights.pop())
        return sums.select(*_PLACE, *[(F.col(c) * factor).cast("bigint").alias(c) for c in "rgb"])
    summed = _channels_in_tiles(raster, _reach(rows), edge, tile)
    summed = _all_filtered(summed, {f"{name}_sum": (name, rows) for name in "rgb"})
    return _sums_at_home(summed, [f"{name}_sum" for name in "rgb"], tile)


def box_sums(raster: DataFrame, size: int, edge: str = "clamp", tile: int = TILE) -> DataFrame:
    """Sums of the ``size`` by ``size`` pixels around each, per channel, as ``convolve`` with ones gives them.

    Running sums inside the tiles, along the rows and then along the columns:
    two numbers of each are enough for a sum, so work and plan are the same for
    any size, but for the pixels near borders that neighbouring tiles get too.
    """
    if size < 1:
        raise ValueError(f"size must be at least 1, not {size}")
    before, after = size // 2, size - 1 - size // 2
    summed = _channels_in_tiles(raster, before, edge, tile)
    for axis in "xy":
        summed = _box_pass(summed, axis, ["r", "g", "b"], before, after)
    return _sums_at_home(summed, ["r", "g", "b"], tile)


def _channels_in_tiles(raster: DataFrame, reach: int, edge: str, tile: int) -> DataFrame:
    """Pixels in their tiles, with each channel in a column of its own."""
    if edge == "reflect":
        raster = _mirrored(raster, reach)
    elif edge != "clamp":
        raise ValueError(f"edge must be 'clamp' or 'reflect', not {edge!r}")
    channels = F.struct(*[F.col(c).cast("bigint").alias(c) for c in ("r", "g", "b")])
    return _in_tiles(raster, reach, tile, channels).withColumns({c: F.col(f"value.{c}") for c in "rgb"})


def _sums_at_home(summed: DataFrame, columns: Sequence[str], tile: int) -> DataFrame:
    """Sums of the image's own pixels, each from the tile it belongs to."""
    inside = (
        F.col("x").between(0, F.col("width") - 1) & F.col("y").between(0, F.col("height") - 1)
    )
    channels = [F.col(c).cast("bigint").alias(name) for c, name in zip(columns, "rgb", strict=True)]
    return _at_home(summed.where(inside), tile).select(*_PLACE, *channels)


def _mirrored(raster: DataFrame, reach: int) -> DataFrame:
    """The raster with ``reach`` mirrored pixels outside each border."""

    def copies(position: str, size: str) -> Column:
        at, end = F.col(position), F.col(size)
        outside = F.filter(
            F.array(-1 - at, 2 * end - 1 - at), lambda p: (p >= -reach) & (p < end + reach)
        )
        return F.when(end >= reach, F.concat(F.array(at), outside)).otherwise(
            F.raise_error(F.lit("image smaller than the filter's reach")).cast("array<int>")
        )

    others = [name for name in RASTER_COLUMNS if name not in ("x", "y")]
    wide = raster.select(*others, F.explode(copies("x", "width")).alias("x"), "y")
    return wide.select(*others, "x", F.explode(copies("y", "height")).alias("y"))


def gaussian_blur(raster: DataFrame, rounding: str = "trunc", tile: int = TILE) -> DataFrame:
    """The 5 by 5 blur; means are cut off, or rounded with ``rounding='nearest'``."""
    tiled = _in_tiles(raster, _reach(fixed.GAUSSIAN), tile, _lanes("r", "g", "b"))
    done = _at_home(_blurred(tiled, "value", rounding), tile)
    return _raster_of(done, _channels("blurred"))


def edge_strength(raster: DataFrame, tile: int = TILE) -> DataFrame:
    """``image_id, width, height, x, y, strength`` of the colour change."""
    tiled = _in_tiles(raster, _reach(fixed.SOBEL_VERTICAL), tile, _lanes("r", "g", "b"))
    return _at_home(_edge_strength(tiled, "value"), tile).select(*_PLACE, "strength")


def sobel_edges(raster: DataFrame, threshold: int = fixed.EDGE_THRESHOLD, tile: int = TILE) -> DataFrame:
    """Black where the colour changes by ``threshold`` or more, white elsewhere."""
    colour.edge_threshold(threshold)
    shade = F.when(F.col("strength") >= threshold, 0).otherwise(255)
    return _raster_of(edge_strength(raster, tile), [shade, shade, shade])


def cartoon(
    raster: DataFrame,
    threshold: int = fixed.EDGE_THRESHOLD,
    colours: int = fixed.COLOURS,
    tile: int = TILE,
) -> DataFrame:
    """Edges of the blurred image in black over the image in few colours.

    Blur, edges, colour reduction and merge in one pass: the original colour
    travels along with the blurred one, so the merge is no join.
    """
    layers = cartoon_layers(raster, threshold, colours, tile)
    return layers.select(*_PLACE, *[F.col(f"cartoon.{c}").alias(c) for c in ("r", "g", "b")])


def cartoon_layers(
    raster: DataFrame,
    threshold: int = fixed.EDGE_THRESHOLD,
    colours: int = fixed.COLOURS,
    tile: int = TILE,
) -> DataFrame:
    """All stages side by side: ``blurred, edges, colours, cartoon``, structs of r, g, b."""
    colour.edge_threshold(threshold)
    reach = _reach(fixed.GAUSSIAN) + _reach(fixed.SOBEL_VERTICAL)
    tiled = _in_tiles(raster, reach, tile, _lanes("r", "g", "b"))
    done = _at_home(_edge_strength(_blurred(tiled, "value"), "blurred"), tile)
    reduced = [colour.quantise(c, colours) for c in _channels("value")]
    is_edge = F.col("strength") >= threshold

    def layer(channels: Iterable[Column]) -> Column:
        return F.struct(*[c.cast("int").alias(n) for c, n in zip(channels, "rgb", strict=True)])

    shade = F.when(is_edge, 0).otherwise(255)
    return done.select(
        *_PLACE,
        layer(_channels("blurred")).alias("blurred"),
        layer([shade, shade, shade]).alias("edges"),
        layer(reduced).alias("colours"),
        layer([F.when(is_edge, 0).otherwise(c) for c in reduced]).alias("cartoon"),
    )


def neighbours(raster: DataFrame, offsets: Sequence[tuple[int, int]]) -> DataFrame:
    """Each pixel with the colours at the given ``(dx, dy)`` offsets.

    Adds ``dx, dy, nr, ng, nb``, one row per pixel and offset; beyond the
    image the nearest pixel counts. A self-join, for callers who want the
    neighbours themselves; sums over them are cheaper with ``convolve``.
    """
    wanted = F.array(
        *[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in offsets]
    )

    def clamped(position: str, step: str, size: str) -> Column:
        return F.greatest(F.lit(0), F.least(F.col(size) - 1, F.col(position) + F.col(step)))

    asked = (
        raster.select(*RASTER_COLUMNS, F.explode(wanted).alias("offset"))
        .select(*RASTER_COLUMNS, "offset.dx", "offset.dy")
        .withColumns({"at_x": clamped("x", "dx", "width"), "at_y": clamped("y", "dy", "height")})
    )
    found = raster.select(
        "image_id",
        F.col("x").alias("at_x"),
        F.col("y").alias("at_y"),
        *[F.col(c).alias(f"n{c}") for c in ("r", "g", "b")],
    )
    return asked.join(found, ["image_id", "at_x", "at_y"]).select(
        *RASTER_COLUMNS, "dx", "dy", "nr", "ng", "nb"
    )
