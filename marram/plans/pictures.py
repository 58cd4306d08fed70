"""Raster queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marram.functions import colour
from marram.operators import raster, stencil
from marram.operators.stack import RasterStack, run_commands
from marram.plans.tables import file_names, images, rasters, strip, with_tables
from marram.sinks.rasters import cartoon_name, edited_name
from marram.sources.images import pixels_of_images

_KERNEL = ((1, -2, 3), (0, 5, -1), (-4, 2, 1))
_HEAVY = ((0, -3, 0), (2, 100, 0), (0, 0, -7))
_THRESHOLD = 260
_STRIP_THRESHOLD = 300
_TILE = 48
# A box of 31 pixels a side, and one of 17 applied twice.
_BOX, _SMALL_BOX = 31, 17
_SLOPE = [*range(1, _SMALL_BOX + 1), *range(_SMALL_BOX - 1, 0, -1)]
_TENT = [[a * b for b in _SLOPE] for a in _SLOPE]


def _merged(spark, sf):
    """Edges over the sepia version, put together by the general mask merge."""
    original = rasters(spark, sf)
    mask = stencil.sobel_edges(original, _THRESHOLD)
    return raster.merge_mask(mask, raster.sepia(original))


def _stacked(spark, sf):
    """The cartoon put together step by step on a stack."""
    stack = RasterStack(rasters(spark, sf))
    stack.apply(stencil.gaussian_blur)
    stack.apply(stencil.sobel_edges, _THRESHOLD)
    edges = len(stack) - 1
    stack.clone(0).apply(raster.reduce_colours, 3)
    return stack.merge_mask(edges).current


def _clamped(spark, sf):
    """Kernel sums brought back to colours by clamping."""
    sums = stencil.convolve(rasters(spark, sf), _KERNEL)
    return sums.withColumns(
        {c: colour.clamp(F.col(c) / F.lit(5.0), "nearest") for c in ("r", "g", "b")}
    )


def _layers(spark, sf):
    layers = stencil.cartoon_layers(rasters(spark, sf), _THRESHOLD)
    return layers.select(
        "image_id",
        "x",
        "y",
        *[
            colour.pack(f"{layer}.r", f"{layer}.g", f"{layer}.b").alias(layer)
            for layer in ("blurred", "edges", "colours", "cartoon")
        ],
    )


QUERIES = {
    "raster_gray_mean": lambda s, d: raster.grayscale(rasters(s, d)),
    "raster_gray_shift": lambda s, d: raster.grayscale(rasters(s, d), mode="shift"),
    "raster_sepia": lambda s, d: raster.sepia(rasters(s, d)),
    "raster_half": lambda s, d: raster.half(rasters(s, d)),
    "raster_quantise": lambda s, d: raster.reduce_colours(rasters(s, d), 5),
    "raster_packed": lambda s, d: raster.packed(rasters(s, d)),
    "raster_unpacked": lambda s, d: raster.unpacked(raster.packed(rasters(s, d))),
    "raster_dims": lambda s, d: raster.dimensions(rasters(s, d)),
    "image_pixels": lambda s, d: pixels_of_images(images(s, d)),
    "output_names": lambda s, d: file_names(s, d).select(
        "name", cartoon_name("name").alias("cartoon"), edited_name("name").alias("edited")
    ),
    "raster_sized": lambda s, d: raster.with_dimensions(rasters(s, d).drop("width", "height")),
    "raster_strip": strip,
    "raster_blur": lambda s, d: stencil.gaussian_blur(rasters(s, d)),
    "raster_blur_nearest": lambda s, d: stencil.gaussian_blur(rasters(s, d), rounding="nearest"),
    "raster_edges": lambda s, d: stencil.sobel_edges(rasters(s, d), _THRESHOLD),
    "raster_merge": _merged,
    "raster_cartoon": lambda s, d: stencil.cartoon(rasters(s, d), _THRESHOLD),
    "raster_cartoon_layers": _layers,
    "raster_cartoon_stack": _stacked,
    "raster_strip_cartoon": lambda s, d: stencil.cartoon(
        strip(s, d), _STRIP_THRESHOLD, tile=_TILE
    ),
    "raster_convolve": lambda s, d: stencil.convolve(rasters(s, d), _KERNEL),
    "raster_convolve_twice": lambda s, d: stencil.convolve(
        stencil.convolve(rasters(s, d), _HEAVY), _HEAVY
    ),
    "raster_convolve_reflect": lambda s, d: stencil.convolve(
        strip(s, d), _KERNEL, edge="reflect", tile=_TILE
    ),
    "raster_box": lambda s, d: stencil.box_sums(strip(s, d), _BOX, tile=_TILE),
    "raster_tent": lambda s, d: stencil.convolve(strip(s, d), _TENT, tile=_TILE),
    "raster_clamped": _clamped,
    "raster_neighbours": lambda s, d: stencil.neighbours(
        rasters(s, d), [(1, 0), (0, -1), (-2, 2)]
    ),
    "raster_command_chain": lambda s, d: run_commands(
        rasters(s, d), ["grayscale", "undo", "half", "sepia", "colours"]
    ),
}

_ALL = "image_id, width, height, x, y, r, g, b"
_PLACE = "image_id, width, height, x, y"

_GAUSSIAN = ((2, 4, 5, 4, 2), (4, 9, 12, 9, 4), (5, 12, 15, 12, 5), (4, 9, 12, 9, 4), (2, 4, 5, 4, 2))
_VERTICAL = ((-1, 0, 1), (-2, 0, 2), (-1, 0, 1))
_HORIZONTAL = ((1, 2, 1), (0, 0, 0), (-1, -2, -1))


def _sums(
    source: str, kernels: dict[str, tuple], edge: str = "clamp", kind: str = "INTEGER"
) -> str:
    """Weighted sums by an offset self-join: columns r_<name>, g_<name>, b_<name>."""
    size = len(next(iter(kernels.values())))
    weights = ", ".join(
        f"{{dx: {dx - size // 2}, dy: {dy - size // 2}, "
        + ", ".join(f"w_{name}: {kernel[dy][dx]}" for name, kernel in kernels.items())
        + "}"
        for dy in range(size)
        for dx in range(size)
    )
    sums = ", ".join(
        f"CAST(sum(n.{c} * p.k.w_{name}) AS {kind}) AS {c}_{name}" for name in kernels for c in "rgb"
    )

    def at(position: str, end: str) -> str:
        moved = f"{position} + k.d{position}"
        if edge == "clamp":
            return f"greatest(0, least({end} - 1, {moved}))"
        return f"""CASE WHEN {moved} < 0 THEN -1 - ({moved})
        WHEN {moved} >= {end} THEN 2 * {end} - 1 - ({moved}) ELSE {moved} END"""

    return f"""(SELECT p.image_id, p.width, p.height, p.x, p.y, {sums}
    FROM (SELECT *, {at("x", "width")} AS at_x, {at("y", "height")} AS at_y
      FROM (SELECT {_PLACE}, unnest([{weights}]) AS k FROM {source})) p
    JOIN {source} n ON n.image_id = p.image_id AND n.x = p.at_x AND n.y = p.at_y
    GROUP BY ALL)"""


def _blurred(source: str) -> str:
    return f"""(SELECT {_PLACE}, r_s // 159 AS r, g_s // 159 AS g, b_s // 159 AS b
    FROM {_sums(source, {"s": _GAUSSIAN})})"""


def _edges(source: str, threshold: int) -> str:
    total = " + ".join(f"abs({c}_{k})" for k in "vh" for c in "rgb")
    shade = f"CASE WHEN {total} >= {threshold} THEN 0 ELSE 255 END"
    return f"""(SELECT {_PLACE}, {shade} AS r, {shade} AS g, {shade} AS b
    FROM {_sums(source, {"v": _VERTICAL, "h": _HORIZONTAL})})"""


def _quantised(colours: int) -> str:
    return ", ".join(
        f"CAST(floor({c} * {colours} / CAST(256 AS DOUBLE)) AS INTEGER) * 255 // {colours - 1} AS {c}"
        for c in "rgb"
    )


def _sepia() -> str:
    rows = (("r", 0.393, 0.769, 0.189), ("g", 0.349, 0.686, 0.168), ("b", 0.272, 0.534, 0.131))
    return ", ".join(
        "CAST(least(trunc("
        + " + ".join(
            f"CAST({c} AS FLOAT) * CAST({w} AS FLOAT)" for c, w in zip("rgb", weights, strict=True)
        )
        + f"), 255) AS INTEGER) AS {out}"
        for out, *weights in rows
    )


def _cartoon(threshold: int) -> str:
    merged = ", ".join(f"CASE WHEN e.r = 255 THEN q.{c} ELSE e.{c} END AS {c}" for c in "rgb")
    return f""", blurred AS {_blurred("rasters")}, edges AS {_edges("blurred", threshold)},
  reduced AS (SELECT {_PLACE}, {_quantised(3)} FROM rasters)
SELECT {", ".join("e." + c for c in _PLACE.split(", "))}, {merged}
FROM edges e JOIN reduced q USING (image_id, x, y)"""


def _packed(frame: str) -> str:
    return f"{frame}.r * 65536 + {frame}.g * 256 + {frame}.b"


def _from_rasters(then: str, source: str = "rasters") -> str:
    return with_tables(source, then=then)


_GRAY_SHIFT = "((((r & ((g + 255) & 255)) >> 1) + b) & 255) >> 1"



def _box_along(source: str, axis: str, reach: int) -> str:
    """Sums along one axis by frames; the border's pixels as often as the sum reaches beyond."""
    size, across = ("width", "y") if axis == "x" else ("height", "x")
    sums = ", ".join(
        f"""CAST(sum({c}) OVER near + greatest(0, {reach} - {axis}) * first({c}) OVER whole
  + greatest(0, {axis} + {reach} - ({size} - 1)) * last({c}) OVER whole AS BIGINT) AS {c}"""
        for c in "rgb"
    )
    frame = f"PARTITION BY image_id, {across} ORDER BY {axis} ROWS BETWEEN"
    return f"""(SELECT {_PLACE}, {sums} FROM {source}
  WINDOW near AS ({frame} {reach} PRECEDING AND {reach} FOLLOWING),
    whole AS ({frame} UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"""


def _box(source: str, reach: int) -> str:
    return _box_along(_box_along(source, "x", reach), "y", reach)


def _slope_along(source: str, axis: str, reach: int) -> str:
    """Sums weighted by a slope on both sides, term by term."""
    size, across = ("width", "y") if axis == "x" else ("height", "x")
    sums = ", ".join(f"CAST(sum(n.{c} * (1 + {reach} - abs(s))) AS BIGINT) AS {c}" for c in "rgb")
    at = {axis: f"greatest(0, least(p.{size} - 1, p.{axis} + s))", across: f"p.{across}"}
    place = ", ".join(f"p.{c}" for c in _PLACE.split(", "))
    return f"""(SELECT {place}, {sums} FROM {source} p CROSS JOIN range(-{reach}, {reach} + 1) k(s)
  JOIN {source} n ON n.image_id = p.image_id AND n.x = {at["x"]} AND n.y = {at["y"]} GROUP BY {place})"""


ORACLE = {
    "raster_gray_mean": _from_rasters(
        f"SELECT {_PLACE}, v AS r, v AS g, v AS b FROM (SELECT *, (r + g + b) // 3 AS v FROM rasters)"
    ),
    "raster_gray_shift": _from_rasters(
        f"SELECT {_PLACE}, v AS r, v AS g, v AS b FROM (SELECT *, {_GRAY_SHIFT} AS v FROM rasters)"
    ),
    "raster_sepia": _from_rasters(f"SELECT {_PLACE}, {_sepia()} FROM rasters"),
    "raster_half": _from_rasters(
        """SELECT image_id, width // 2 AS width, height // 2 AS height, x // 2 AS x, y // 2 AS y, r, g, b
FROM rasters WHERE x % 2 = 0 AND y % 2 = 0 AND x // 2 < width // 2 AND y // 2 < height // 2"""
    ),
    "raster_quantise": _from_rasters(f"SELECT {_PLACE}, {_quantised(5)} FROM rasters"),
    "raster_packed": _from_rasters(f"SELECT {_PLACE}, {_packed('rasters')} AS rgb FROM rasters"),
    "raster_unpacked": _from_rasters(f"SELECT {_ALL} FROM rasters"),
    "raster_dims": _from_rasters("SELECT DISTINCT image_id, width, height FROM rasters"),
    "image_pixels": """WITH sized AS (SELECT vec_id, embedding, len(embedding) AS n,
    unnest(range(0, 2 * len(embedding))) AS p FROM embeddings),
  shades AS (SELECT vec_id, n, p, CAST(floor((CAST(embedding[CASE WHEN p < n THEN p + 1 ELSE 2 * n - p END] AS DOUBLE)
    + 1) * CAST(127.5 AS DOUBLE)) AS INTEGER) AS v FROM sized)
SELECT 'vec/' || vec_id AS image_id, CAST(n AS INTEGER) AS width, 2 AS height, CAST(p % n AS INTEGER) AS x,
  CAST(p // n AS INTEGER) AS y, v AS r, 255 - v AS g, v // 2 AS b FROM shades""",
    "output_names": r"""WITH names AS (SELECT p_name || ['.JPG', '.png', '.jpg', '.tar.gif', ''][p_partkey % 5 + 1] AS name FROM part)
SELECT name, CASE WHEN contains(name, '.') THEN regexp_extract(name, '^(.+)\.[^.]*$', 1) || '_cartoon'
    || lower(regexp_extract(name, '(\.[^.]*)$', 1)) END AS cartoon,
  CASE WHEN name LIKE '%.png' OR name LIKE '%.jpg' THEN name[:-5] || '_edited' || name[-4:] END AS edited FROM names""",
    "raster_sized": _from_rasters(f"SELECT {_ALL} FROM rasters"),
    "raster_strip": _from_rasters(f"SELECT {_ALL} FROM rasters", "strip"),
    "raster_blur": _from_rasters(f"SELECT {_ALL} FROM {_blurred('rasters')}"),
    "raster_blur_nearest": _from_rasters(
        f"""SELECT {_PLACE}, {", ".join(
            f"CAST(floor({c}_s / CAST(159 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS INTEGER) AS {c}"
            for c in "rgb")}
FROM {_sums("rasters", {"s": _GAUSSIAN})}"""
    ),
    "raster_edges": _from_rasters(f"SELECT {_ALL} FROM {_edges('rasters', _THRESHOLD)}"),
    "raster_merge": _from_rasters(
        f""", edges AS {_edges("rasters", _THRESHOLD)}, brown AS (SELECT {_PLACE}, {_sepia()} FROM rasters)
SELECT {", ".join("e." + c for c in _PLACE.split(", "))},
  {", ".join(f"CASE WHEN e.r = 255 THEN o.{c} ELSE e.{c} END AS {c}" for c in "rgb")}
FROM edges e JOIN brown o USING (image_id, x, y)"""
    ),
    "raster_cartoon": _from_rasters(_cartoon(_THRESHOLD)),
    "raster_cartoon_stack": _from_rasters(_cartoon(_THRESHOLD)),
    "raster_strip_cartoon": _from_rasters(_cartoon(_STRIP_THRESHOLD), "strip"),
    "raster_cartoon_layers": _from_rasters(
        f""", blurred AS {_blurred("rasters")}, edges AS {_edges("blurred", _THRESHOLD)},
  reduced AS (SELECT {_PLACE}, {_quantised(3)} FROM rasters)
SELECT image_id, x, y, {_packed("b")} AS blurred, {_packed("e")} AS edges, {_packed("q")} AS colours,
  CASE WHEN e.r = 255 THEN {_packed("q")} ELSE 0 END AS cartoon
FROM blurred b JOIN edges e USING (image_id, x, y) JOIN reduced q USING (image_id, x, y)"""
    ),
    "raster_convolve": _from_rasters(
        f"SELECT {_PLACE}, r_s AS r, g_s AS g, b_s AS b FROM {_sums('rasters', {'s': _KERNEL}, kind='BIGINT')}"
    ),
    "raster_convolve_twice": _from_rasters(
        f""", once AS (SELECT {_PLACE}, r_s AS r, g_s AS g, b_s AS b
  FROM {_sums("rasters", {"s": _HEAVY}, kind="BIGINT")})
SELECT {_PLACE}, r_s AS r, g_s AS g, b_s AS b FROM {_sums("once", {"s": _HEAVY}, kind="BIGINT")}"""
    ),
    "raster_convolve_reflect": _from_rasters(
        f"""SELECT {_PLACE}, r_s AS r, g_s AS g, b_s AS b
FROM {_sums("rasters", {"s": _KERNEL}, "reflect", "BIGINT")}""",
        "strip",
    ),
    "raster_box": _from_rasters(f"SELECT {_PLACE}, r, g, b FROM {_box('rasters', _BOX // 2)}", "strip"),
    "raster_tent": _from_rasters(
        f""", once AS {_slope_along("rasters", "x", _SMALL_BOX - 1)}
SELECT {_PLACE}, r, g, b FROM {_slope_along("once", "y", _SMALL_BOX - 1)}""",
        "strip",
    ),
    "raster_clamped": _from_rasters(
        f"""SELECT {_PLACE}, {", ".join(
            f"CAST(greatest(0, least(255, floor({c}_s / CAST(5 AS DOUBLE) + CAST(0.5 AS DOUBLE)))) AS INTEGER) AS {c}"
            for c in "rgb")}
FROM {_sums("rasters", {"s": _KERNEL})}"""
    ),
    "raster_neighbours": _from_rasters(
        """SELECT p.*, k.dx, k.dy, n.r AS nr, n.g AS ng, n.b AS nb
FROM rasters p CROSS JOIN (VALUES (1, 0), (0, -1), (-2, 2)) k(dx, dy)
JOIN rasters n ON n.image_id = p.image_id
  AND n.x = greatest(0, least(p.width - 1, p.x + k.dx))
  AND n.y = greatest(0, least(p.height - 1, p.y + k.dy))"""
    ),
    "raster_command_chain": _from_rasters(
        f""", small AS (SELECT image_id, width // 2 AS width, height // 2 AS height,
    x // 2 AS x, y // 2 AS y, r, g, b FROM rasters WHERE x % 2 = 0 AND y % 2 = 0),
  brown AS (SELECT {_PLACE}, {_sepia()} FROM small)
SELECT {_PLACE}, {_quantised(3)} FROM brown"""
    ),
}
