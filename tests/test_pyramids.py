"""Pyramids against halving whole images."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from patchloom.session import scratch_path
from patchloom.sources.pyramids import TILES, cut_tiles, halved, next_level, read_pyramid, write_pyramid
from patchloom.sources.rasters import read_boxes

IMAGES = "sid string, height int, width int, channels int, pixels binary, x int, y int, level string"


def image_rows(images):
    """Decoded image rows, blue first, from arrays by name (red first)."""
    return [(name, *i.shape, bytearray(np.ascontiguousarray(i[:, :, ::-1]).tobytes()), 0, 0, "clash") for name, i in images.items()]


def plain_half(image):
    height, width, _ = image.shape
    out = np.zeros((-(-height // 2), -(-width // 2), 3), np.uint8)
    for y in range(out.shape[0]):
        for x in range(out.shape[1]):
            square = image[2 * y : 2 * y + 2, 2 * x : 2 * x + 2].astype(int)
            n = square.shape[0] * square.shape[1]
            out[y, x] = (square.sum(axis=(0, 1)) + n // 2) // n
    return out


def whole(rows, tile):
    """Images by (sid, level), put together from tile rows."""
    out = {}
    for r in rows:
        out.setdefault((r["sid"], r["level"]), []).append(r)
    made = {}
    for key, parts in out.items():
        image = np.zeros((max(p["ty"] * tile + p["h"] for p in parts), max(p["tx"] * tile + p["w"] for p in parts), 3), np.uint8)
        for p in parts:
            image[p["ty"] * tile : p["ty"] * tile + p["h"], p["tx"] * tile : p["tx"] * tile + p["w"]] = np.frombuffer(p["pixels"], np.uint8).reshape(p["h"], p["w"], 3)
        made[key] = image
    return made


@pytest.mark.parametrize("shape", [(1, 1), (2, 3), (5, 4), (7, 7)])
def test_halves(shape):
    image = np.random.default_rng(1).integers(0, 256, (*shape, 3), np.uint8)
    assert np.array_equal(halved(image), plain_half(image))
    assert np.array_equal(halved(np.full((3, 3, 3), 255, np.uint8)), np.full((2, 2, 3), 255))


@pytest.mark.parametrize("tile", [2, 6, 16])
def test_every_level_is_the_halved_image(spark, tile):
    rng = np.random.default_rng(tile)
    images = {f"s{k}": rng.integers(0, 256, (h, w, 3), np.uint8) for k, (h, w) in enumerate([(33, 20), (1, 1), (12, 48), (16, 16), (7, 31)])}
    path = scratch_path(spark, "pyramid")
    frame = spark.createDataFrame([*image_rows(images), ("broken", -1, -1, -1, bytearray(), 0, 0, ""), ("none", 3, 3, 3, None, 0, 0, "")], IMAGES)
    levels = write_pyramid(cut_tiles(frame, tile), path, tile)
    assert levels == ((48 - 1) // tile).bit_length()
    found = whole(read_pyramid(spark, path).collect(), tile)
    assert {k for k, _ in found} == set(images)
    for name, image in images.items():
        for level in range(levels + 1):
            assert np.array_equal(found[name, level], image), (name, level)
            image = plain_half(image)
    top = read_pyramid(spark, path, levels).collect()
    assert len(top) == len(images) and all(r["tx"] == r["ty"] == 0 for r in top)


def test_boxes_on_a_level(spark):
    image = np.random.default_rng(5).integers(0, 256, (50, 37, 3), np.uint8)
    path = scratch_path(spark, "pyramid")
    assert write_pyramid(cut_tiles(spark.createDataFrame(image_rows({"s": image}), IMAGES), 8), path, 8, levels=2) == 2
    quarter = np.pad(plain_half(plain_half(image)), ((20, 20), (20, 20), (0, 0)))
    centres = [(0, 0), (18, 25), (36, 49), (3, 41)]
    boxes = spark.createDataFrame([(k, "s", 2, x, y) for k, (x, y) in enumerate(centres)], "patch_id int, sid string, level int, x_center int, y_center int")
    for r in read_boxes(read_pyramid(spark, path), boxes, 6, 8, downsample={2: 4}).collect():
        x, y = ((c - 12) // 4 + 20 for c in centres[r["patch_id"]])
        assert np.array_equal(np.frombuffer(r["pixels"], np.uint8).reshape(6, 6, 3), quarter[y : y + 6, x : x + 6])


def test_a_raster_of_several_images(spark):
    image = np.random.default_rng(6).integers(0, 256, (20, 30, 3), np.uint8)
    rows = []
    for y in range(0, 20, 8):
        for x in range(0, 30, 16):
            part = image[y : y + 8, x : x + 16]
            rows.append(("s", *part.shape, bytearray(np.ascontiguousarray(part[:, :, ::-1]).tobytes()), x, y, ""))
    path = scratch_path(spark, "pyramid")
    write_pyramid(cut_tiles(spark.createDataFrame(rows, IMAGES), 8, origin=("x", "y")), path, 8)
    found = whole(read_pyramid(spark, path).collect(), 8)
    assert np.array_equal(found["s", 0], image) and np.array_equal(found["s", 1], plain_half(image)) and np.array_equal(found["s", 2], plain_half(plain_half(image)))
    with pytest.raises(PySparkException, match="no multiple of 16"):
        cut_tiles(spark.createDataFrame(rows, IMAGES), 16, origin=("x", "y")).collect()


def test_missing_tiles_are_zero_and_repeated_ones_an_error(spark):
    one = bytearray(bytes([200] * 12))
    rows = [("s", 0, 3, 0, one), ("s", 0, 0, 1, one), ("t", 0, 0, 0, None), (None, 0, 0, 0, one)]
    frame = spark.createDataFrame(rows, "sid string, level int, tx int, ty int, pixels binary")
    found = {(r["sid"], r["tx"], r["ty"]): (r["h"], r["w"], bytes(r["pixels"])) for r in next_level(frame, 2).collect()}
    assert found[None, 0, 0] == (1, 1, bytes([200] * 3))
    assert found["s", 1, 0] == (1, 2, bytes([0] * 3 + [200] * 3)) and found["s", 0, 0] == (2, 1, bytes([0] * 3 + [200] * 3)) and len(found) == 3
    with pytest.raises(PySparkException, match="more than once"):
        next_level(frame.filter("tx = 3").unionAll(frame.filter("tx = 3")), 2).collect()
    for tile in (0, 1, 7):
        with pytest.raises(ValueError, match="must be even"):
            next_level(frame, tile)


def test_an_empty_pyramid_and_one_that_stopped(spark, monkeypatch):
    path = scratch_path(spark, "pyramid")
    assert write_pyramid(spark.createDataFrame([], TILES), path, 4) == 0 and read_pyramid(spark, path).collect() == []
    image = np.random.default_rng(7).integers(0, 256, (32, 32, 3), np.uint8)
    frame, path = spark.createDataFrame(image_rows({"s": image}), IMAGES), scratch_path(spark, "pyramid")
    write_pyramid(cut_tiles(frame, 4), path, 4, levels=1)
    before = set(read_pyramid(spark, path, 1).inputFiles())
    broken = cut_tiles(frame, 4).withColumn("pixels", F.raise_error(F.lit("made again")).cast("binary"))
    assert write_pyramid(broken, path, 4) == 3  # level 0 is not asked for again
    assert before <= set(read_pyramid(spark, path).inputFiles())
    assert np.array_equal(whole(read_pyramid(spark, path, 3).collect(), 4)["s", 3], plain_half(plain_half(plain_half(image))))
