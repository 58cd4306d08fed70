import struct
import zlib

import numpy as np
import pytest
from conftest import exchanges, plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marram.functions import colour, fixed
from marram.operators import raster, stencil
from marram.operators.stack import RasterStack, run_commands
from marram.plans import tables
from marram.sinks.rasters import cartoon_name, edited_name, write_cartoon, write_layers
from marram.sources.images import read_images

SCHEMA = "image_id bigint, width int, height int, x int, y int, r int, g int, b int"
SF = "/root/testdata/sf0.001"


def frame_of(spark, *images):
    rows = []
    for image_id, pixels in enumerate(images):
        height, width, _ = pixels.shape
        rows += [
            (image_id, width, height, x, y, *map(int, pixels[y, x]))
            for y in range(height)
            for x in range(width)
        ]
    return spark.createDataFrame(rows, SCHEMA)


def pixels_of(frame, image_id=0, columns=("r", "g", "b")):
    collected = frame if isinstance(frame, list) else frame.collect()
    rows = [r for r in collected if r.image_id == image_id]
    if not rows:
        return np.zeros((0, 0, 3), int)
    out = np.full((rows[0].height, rows[0].width, len(columns)), -(10**9))
    for row in rows:
        out[row.y, row.x] = [row[c] for c in columns]
    assert len(rows) == rows[0].height * rows[0].width
    return out


def convolved(pixels, kernel, mode="edge"):
    kernel = np.array(kernel)
    before = len(kernel) // 2
    after = len(kernel) - 1 - before
    padded = np.pad(pixels, ((before, after), (before, after), (0, 0)), mode=mode)
    height, width, _ = pixels.shape
    return sum(
        kernel[i][j] * padded[i : i + height, j : j + width]
        for i in range(len(kernel))
        for j in range(len(kernel))
    )


def blurred(pixels):
    return convolved(pixels, fixed.GAUSSIAN) // fixed.GAUSSIAN_TOTAL


def strength(pixels):
    return (
        np.abs(convolved(pixels, fixed.SOBEL_VERTICAL)).sum(2)
        + np.abs(convolved(pixels, fixed.SOBEL_HORIZONTAL)).sum(2)
    )


def quantised(pixels, colours):
    return (pixels * colours // 256) * 255 // (colours - 1)


def cartooned(pixels, threshold=128, colours=3):
    edges = strength(blurred(pixels)) >= threshold
    return np.where(edges[..., None], 0, quantised(pixels, colours))


def random_image(seed, height, width):
    return np.random.default_rng(seed).integers(0, 256, (height, width, 3))


SPECIAL = {
    "one pixel": random_image(1, 1, 1),
    "one row": random_image(2, 1, 9),
    "one column": random_image(3, 9, 1),
    "two by two": random_image(4, 2, 2),
    "black": np.zeros((5, 6, 3), int),
    "white": np.full((5, 6, 3), 255),
    "dot": np.pad(np.full((1, 1, 3), 255), ((3, 3), (3, 3), (0, 0))),
    "random": random_image(5, 13, 17),
}


# Point operators


def test_quantise_values(spark):
    expected = {
        2: {0: 0, 127: 0, 128: 255, 255: 255},
        3: {0: 0, 85: 0, 86: 127, 170: 127, 171: 255, 255: 255},
        26: {0: 0, 9: 0, 10: 10, 19: 10, 20: 20, 246: 244, 247: 255, 255: 255},
    }
    for colours, values in expected.items():
        frame = spark.createDataFrame([(v,) for v in values], "v int")
        found = frame.select("v", colour.quantise("v", colours).alias("q")).collect()
        assert {r.v: r.q for r in found} == values


def test_quantise_equals_the_rounded_form_everywhere(spark):
    frame = spark.range(256).select(F.col("id").cast("int").alias("v"))
    found = frame.select("v", *[colour.quantise("v", n).alias(f"q{n}") for n in range(2, 257)])
    for row in found.collect():
        for n in range(2, 257):
            scaled = np.float32(row.v) / np.float32(256) * np.float32(n) - np.float32(0.5)
            assert row[f"q{n}"] == int(np.floor(float(scaled) + 0.5)) * 255 // (n - 1)


def test_parameters_are_checked(spark):
    frame = frame_of(spark, SPECIAL["two by two"])
    for bad in (0, 1, 257):
        with pytest.raises(ValueError):
            raster.reduce_colours(frame, bad)
    with pytest.raises(ValueError):
        stencil.sobel_edges(frame, -1)
    with pytest.raises(ValueError):
        stencil.cartoon(frame, threshold=-1)
    with pytest.raises(ValueError):
        stencil.square_kernel([1, 2, 3])
    with pytest.raises(ValueError):
        stencil.convolve(frame, [[1, 2], [3]])
    with pytest.raises(ValueError):
        stencil.convolve(frame, [[1]], edge="wrap")
    with pytest.raises(ValueError):
        raster.grayscale(frame, mode="luma")
    with pytest.raises(ValueError):
        run_commands(frame, ["sepia", "flip"])


def test_clamp_cuts_or_rounds(spark):
    values = [-300.0, -1.0, -0.4, 0.0, 0.5, 1.5, 254.49, 254.99, 255.0, 255.5, 554.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    cut = [r.c for r in frame.select(colour.clamp("v").alias("c")).collect()]
    near = [r.c for r in frame.select(colour.clamp("v", "nearest").alias("c")).collect()]
    assert cut == [0, 0, 0, 0, 0, 1, 254, 254, 255, 255, 255]
    assert near == [0, 0, 0, 0, 1, 2, 254, 255, 255, 255, 255]


def test_packing(spark):
    frame = spark.createDataFrame([(0x88, 0x99, 0xAB)], "r int, g int, b int")
    rgb = frame.select(colour.pack("r", "g", "b").alias("rgb")).first().rgb
    assert rgb == 0x8899AB
    opaque = spark.createDataFrame([(0xFF8899AB - 2**32,)], "rgb int")
    row = opaque.select(*[c.alias(n) for c, n in zip(colour.unpack("rgb"), "rgb", strict=True)]).first()
    assert tuple(row) == (0x88, 0x99, 0xAB)
    with pytest.raises(ValueError):
        colour.channel("rgb", 3)


def test_gray_values(spark):
    red = np.array([[[255, 0, 0]]])
    assert (pixels_of(raster.grayscale(frame_of(spark, red))) == 0x55).all()
    grid = np.array([[[r, g, b] for g in range(0, 256, 15)] for r in range(0, 256, 17) for b in (0, 3, 127, 200, 255)])
    found = pixels_of(raster.grayscale(frame_of(spark, grid), mode="shift"))
    r, g, b = grid[..., 0], grid[..., 1], grid[..., 2]
    expected = ((((r & ((g + 255) & 255)) >> 1) + b) & 255) >> 1
    assert (found == expected[..., None]).all()


def test_sepia_in_single_precision(spark):
    pixels = random_image(7, 40, 50)
    found = pixels_of(raster.sepia(frame_of(spark, pixels)))
    f = np.float32
    r, g, b = (pixels[..., i].astype(f) for i in range(3))
    for channel, (wr, wg, wb) in enumerate(fixed.SEPIA):
        total = (r * f(wr) + g * f(wg)) + b * f(wb)
        assert (found[..., channel] == np.minimum(total.astype(int), 255)).all()


@pytest.mark.parametrize("shape", [(4, 6), (5, 7), (1, 8), (2, 1)])
def test_half_drops_odd_ends(spark, shape):
    pixels = random_image(8, *shape)
    height, width = shape
    found = raster.half(frame_of(spark, pixels))
    expected = pixels[: height // 2 * 2 : 2, : width // 2 * 2 : 2]
    if expected.size == 0:
        assert found.count() == 0
    else:
        assert (pixels_of(found) == expected).all()


def test_sizes(spark):
    frame = frame_of(spark, SPECIAL["random"], SPECIAL["one row"])
    assert sorted(map(tuple, raster.dimensions(frame).collect())) == [(0, 17, 13), (1, 9, 1)]
    bare = frame.drop("width", "height")
    sized = raster.with_dimensions(bare)
    assert sized.columns == frame.columns
    assert sized.exceptAll(frame).count() == 0 and sized.count() == frame.count()
    assert raster.require_size(frame.where("image_id = 0"), 17, 13).count() == 13 * 17
    with pytest.raises(PySparkException, match="incorrect image size"):
        raster.require_size(frame, 17, 13).collect()
    with pytest.raises(PySparkException, match="incorrect image size"):
        raster.require_size(frame, 9, 9).agg({"r": "sum"}).collect()


def test_a_mask_without_a_pixel_under_it_fails(spark):
    frame = frame_of(spark, SPECIAL["random"])
    with pytest.raises(PySparkException, match="no pixel under the mask"):
        raster.merge_mask(frame, frame.where("x > 0")).agg({"r": "sum"}).collect()


def test_sums_may_be_filtered_again(spark):
    kernel = [[0, 0, 0], [0, 1000, 0], [0, 0, -1]]
    frame = frame_of(spark, SPECIAL["random"])
    once = stencil.convolve(frame, kernel)
    twice = pixels_of(stencil.convolve(once, kernel, tile=5))
    plain = SPECIAL["random"].astype(int)
    for _ in range(2):
        edge = np.pad(plain, ((0, 1), (0, 1), (0, 0)), mode="edge")
        plain = 1000 * plain - edge[1:, 1:]
    assert (twice == plain).all()
    with pytest.raises(PySparkException, match="channels must be 0 to 255"):
        stencil.gaussian_blur(once).collect()


def test_a_file_that_is_no_image_fails(spark, tmp_path):
    (tmp_path / "x.png").write_text("not an image")
    with pytest.raises(PySparkException, match="not an image"):
        read_images(spark, str(tmp_path)).agg({"r": "sum"}).collect()


def test_point_operators_do_not_shuffle(spark):
    frame = tables.rasters(spark, SF)
    chained = raster.reduce_colours(raster.half(raster.sepia(raster.grayscale(frame))))
    assert "Exchange" not in plan_of(chained)


# Neighbourhoods


@pytest.mark.parametrize("tile", [3, 256])
def test_stencils_on_special_images(spark, tile):
    frame = frame_of(spark, *SPECIAL.values())
    blur = stencil.gaussian_blur(frame, tile=tile).collect()
    edges = stencil.sobel_edges(frame, 300, tile=tile).collect()
    cartoon = stencil.cartoon(frame, tile=tile).collect()
    for image_id, (name, pixels) in enumerate(SPECIAL.items()):
        assert (pixels_of(blur, image_id) == blurred(pixels)).all(), name
        shade = np.where(strength(pixels) >= 300, 0, 255)
        assert (pixels_of(edges, image_id) == shade[..., None]).all(), name
        assert (pixels_of(cartoon, image_id) == cartooned(pixels)).all(), name


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    seed=st.integers(0, 10**6),
    height=st.integers(1, 12),
    width=st.integers(1, 12),
    size=st.integers(1, 6),
    tile=st.integers(1, 9),
)
def test_any_kernel_on_any_tiles(spark, seed, height, width, size, tile):
    pixels = random_image(seed, height, width)
    kernel = np.random.default_rng(seed).integers(-9, 10, (size, size)).tolist()
    found = stencil.convolve(frame_of(spark, pixels), kernel, tile=tile)
    assert (pixels_of(found) == convolved(pixels, kernel)).all()


def test_heavy_kernels(spark):
    pixels = SPECIAL["random"]
    kernel = [[9000, -7000, 1], [0, 12345, -3], [5, 5, -20000]]
    found = stencil.convolve(frame_of(spark, pixels), kernel, tile=4)
    assert (pixels_of(found) == convolved(pixels, kernel)).all()


def test_reflected_edges(spark):
    pixels = SPECIAL["random"]
    kernel = np.random.default_rng(0).integers(-9, 10, (7, 7)).tolist()
    found = stencil.convolve(frame_of(spark, pixels), kernel, edge="reflect", tile=5)
    assert (pixels_of(found) == convolved(pixels, kernel, "symmetric")).all()
    with pytest.raises(PySparkException, match="smaller"):
        stencil.convolve(frame_of(spark, SPECIAL["two by two"]), kernel, edge="reflect").collect()


def test_blur_rounded_to_nearest(spark):
    # Red next to green: the sums are 255 * 142, 104, 55 and 17 of 159 parts.
    pixels = np.zeros((5, 10, 3), int)
    pixels[:, :5, 0] = 255
    pixels[:, 5:, 1] = 255
    frame = frame_of(spark, pixels)
    near = pixels_of(stencil.gaussian_blur(frame, rounding="nearest"))
    cut = pixels_of(stencil.gaussian_blur(frame))
    assert near[2, 2:8].tolist() == [
        [255, 0, 0],
        [228, 27, 0],
        [167, 88, 0],
        [88, 167, 0],
        [27, 228, 0],
        [0, 255, 0],
    ]
    assert cut[2, 3].tolist() == [227, 27, 0]


def test_windows_agree_with_the_self_join(spark):
    kernel = [[1, -2, 3], [0, 5, -1], [-4, 2, 1]]
    frame = tables.rasters(spark, SF).where("image_id < 20")
    weights = {(dx, dy): kernel[dy + 1][dx + 1] for dx in (-1, 0, 1) for dy in (-1, 0, 1)}
    table = spark.createDataFrame([(*k, w) for k, w in weights.items()], "dx int, dy int, w int")
    around = stencil.neighbours(frame, list(weights)).join(F.broadcast(table), ["dx", "dy"])
    place = ["image_id", "width", "height", "x", "y"]
    joined = around.groupBy(*place).agg(
        *[F.sum(F.col(f"n{c}") * F.col("w")).cast("int").alias(c) for c in "rgb"]
    )
    windows = stencil.convolve(frame, kernel)
    assert windows.exceptAll(joined).count() == 0
    assert windows.count() == joined.count() == frame.count()


def test_whole_cartoon_takes_one_shuffle(spark):
    frame = tables.rasters(spark, SF)
    plan = stencil.cartoon(frame)
    assert exchanges(plan) == 1
    assert plan_of(plan).count("Sort [") == 3
    assert "Join" not in plan_of(plan)


def test_several_images_stay_apart(spark):
    images = [SPECIAL["random"], SPECIAL["dot"], SPECIAL["one row"]]
    found = stencil.cartoon(frame_of(spark, *images), tile=4)
    for image_id, pixels in enumerate(images):
        assert (pixels_of(found, image_id) == cartooned(pixels)).all()


# Stack and commands


def test_stack_never_loses_the_original(spark):
    stack = RasterStack(frame_of(spark, random_image(9, 6, 8)))
    assert len(stack) == 1
    stack.apply(raster.half).apply(raster.sepia)
    assert len(stack) == 3
    assert stack.current.first().width == 4
    stack.undo().undo().undo()
    assert len(stack) == 1
    assert stack.current.first().width == 8
    stack.clear()
    assert len(stack) == 0
    with pytest.raises(IndexError):
        stack.pop()
    with pytest.raises(IndexError):
        stack.clone(-1)


def test_stack_positions_and_merge(spark):
    pixels = SPECIAL["random"]
    stack = RasterStack().push(frame_of(spark, pixels)).clone()
    assert len(stack) == 2
    stack.apply(raster.grayscale)
    assert (pixels_of(stack.pop())[..., 0] == pixels.sum(2) // 3).all()
    stack.pop()
    stack.apply(stencil.gaussian_blur).apply(stencil.sobel_edges, 256)
    stack.clone(0).apply(raster.reduce_colours, 3)
    assert len(stack) == 5
    stack.merge_mask(2, fixed.WHITE, -1)
    assert len(stack) == 6
    assert (pixels_of(stack.current) == cartooned(pixels, 256)).all()
    assert stack.at(0) is stack.at(-6)


def test_mask_needs_the_exact_colour(spark):
    mask = np.array([[[255, 255, 255], [255, 255, 254], [0, 0, 0]]])
    other = np.array([[[1, 2, 3], [4, 5, 6], [7, 8, 9]]])
    found = pixels_of(raster.merge_mask(frame_of(spark, mask), frame_of(spark, other)))
    assert found.tolist() == [[[1, 2, 3], [255, 255, 254], [0, 0, 0]]]


def test_commands_run_on_all_images(spark):
    frame = frame_of(spark, random_image(1, 4, 4), random_image(2, 6, 8))
    found = run_commands(frame, ["grayscale", "undo", "half", "sepia"])
    assert found.exceptAll(raster.sepia(raster.half(frame))).count() == 0
    assert found.select("image_id").distinct().count() == 2


# Files


def png(path, rows, kind):
    """A PNG file; ``kind`` 0 is gray, 2 colour, 6 colour with transparency."""

    def chunk(name, body):
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    height, width = len(rows), len(rows[0])
    raw = b"".join(b"\0" + b"".join(bytes(pixel) for pixel in row) for row in rows)
    header = struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)
    path.write_bytes(
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", header)
        + chunk(b"IDAT", zlib.compress(raw))
        + chunk(b"IEND", b"")
    )


def test_images_are_read_as_pixels(spark, tmp_path):
    rows = [[(10, 20, 30), (255, 0, 7), (1, 2, 3)], [(0, 0, 0), (255, 255, 255), (9, 8, 7)]]
    png(tmp_path / "colour.png", rows, 2)
    png(tmp_path / "clear.png", [[(*pixel, 255) for pixel in row] for row in rows], 6)
    png(tmp_path / "gray.png", [[(10,), (200,)]], 0)
    frame = read_images(spark, str(tmp_path))
    found = {}
    for row in frame.collect():
        name = row.image_id.rsplit("/", 1)[1]
        found.setdefault(name, {})[(row.x, row.y)] = (row.r, row.g, row.b)
        assert (row.width, row.height) == ((2, 1) if name == "gray.png" else (3, 2))
    colours = {(x, y): rows[y][x] for y in range(2) for x in range(3)}
    assert found == {
        "colour.png": colours,
        "clear.png": colours,
        "gray.png": {(0, 0): (10, 10, 10), (1, 0): (200, 200, 200)},
    }
    assert "Python" not in plan_of(frame)


def test_output_names(spark):
    names = ["a/b.JPG", "c.d.png", "noext", ".hidden", "x.gif"]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    found = frame.select(cartoon_name("n").alias("c"), edited_name("n").alias("e")).collect()
    assert [r.c for r in found] == ["a/b_cartoon.jpg", "c.d_cartoon.png", None, None, "x_cartoon.gif"]
    assert [r.e for r in found] == [None, "c.d_edited.png", None, None, None]


def test_layers_are_written(spark, tmp_path):
    pixels = SPECIAL["random"]
    frame = frame_of(spark, pixels)
    path = str(tmp_path / "out")
    write_cartoon(stencil.cartoon_layers(frame), path, intermediate=True)
    found = spark.read.parquet(path)
    assert {r.layer for r in found.select("layer").distinct().collect()} == {
        "cartoon",
        "colours",
        "edges",
        "blurred",
    }
    assert (pixels_of(found.where("layer = 'cartoon'")) == cartooned(pixels)).all()
    assert (pixels_of(found.where("layer = 'blurred'")) == blurred(pixels)).all()
    assert (pixels_of(found.where("layer = 'colours'")) == quantised(pixels, 3)).all()
    only = str(tmp_path / "only")
    write_cartoon(stencil.cartoon_layers(frame), only)
    assert spark.read.parquet(only).count() == pixels.shape[0] * pixels.shape[1]
    edited = str(tmp_path / "edited")
    write_layers({"edited": raster.sepia(frame)}, edited)
    assert (pixels_of(spark.read.parquet(edited)) == pixels_of(raster.sepia(frame))).all()


def test_all_channels_are_filtered_in_two_sorts(spark):
    raster = tables.rasters(spark, "/root/testdata/sf0.001")
    plan = plan_of(stencil.convolve(raster, [[1, 2, 1], [0, 3, 0], [1, 2, 1]]))
    assert plan.count("Sort [") == 2
    assert plan.count("+- Window [") + plan.count(":- Window [") == 2


@pytest.mark.parametrize("size, tile", [(1, 4), (2, 5), (7, 4), (12, 7), (31, 6), (31, 256)])
def test_box_sums_of_any_size_on_any_tiles(spark, size, tile):
    pixels = np.random.default_rng(size).integers(-300, 300, (19, 23, 3))
    ones = [[1] * size for _ in range(size)]
    frame = frame_of(spark, pixels, pixels[:5, :2])
    found = stencil.box_sums(frame, size, tile=tile).collect()
    for image_id, image in enumerate((pixels, pixels[:5, :2])):
        assert (pixels_of(found, image_id) == convolved(image, ones)).all()
    times = stencil.convolve(frame, [[-3] * size for _ in range(size)], tile=tile)
    assert (pixels_of(times) == -3 * convolved(pixels, ones)).all()


def test_box_sums_with_mirrored_borders(spark):
    pixels = np.random.default_rng(1).integers(0, 256, (14, 12, 3))
    found = stencil.box_sums(frame_of(spark, pixels), 11, edge="reflect", tile=5)
    assert (pixels_of(found) == convolved(pixels, [[1] * 11] * 11, "symmetric")).all()
    with pytest.raises(ValueError):
        stencil.box_sums(frame_of(spark, pixels), 0)


def test_a_box_costs_the_same_for_any_size(spark):
    raster = tables.rasters(spark, SF)
    small, large = (plan_of(stencil.box_sums(raster, size)) for size in (3, 31))
    assert small.count("\n") == large.count("\n")
    assert large.count("Sort [") == 2 and large.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("tile", [9, 64])
def test_a_large_gaussian_takes_two_passes(spark, tile):
    slope = np.round(np.exp(-(np.arange(-15, 16) ** 2) / 50) * 1000).astype(int).tolist()
    kernel = [[a * b for b in slope] for a in slope]
    pixels = np.random.default_rng(2).integers(0, 256, (24, 33, 3))
    found = stencil.convolve(frame_of(spark, pixels), kernel, tile=tile)
    assert plan_of(found).count("Sort [") == 2
    assert (pixels_of(found) == convolved(pixels, kernel)).all()


def test_large_kernels_without_a_common_row(spark):
    kernel = np.random.default_rng(3).integers(-9, 9, (11, 11)).tolist()
    pixels = np.random.default_rng(4).integers(0, 256, (9, 16, 3))
    found = stencil.convolve(frame_of(spark, pixels), kernel, tile=5)
    assert (pixels_of(found) == convolved(pixels, kernel)).all()
