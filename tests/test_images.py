import struct
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from patchloom.functions import pixels as px
from patchloom.functions.keys import patch_name, patch_path
from patchloom.operators.featurize import image_featurizer, image_struct, preprocess_images, share_weights
from patchloom.operators.joins import annotate_files
from patchloom.plans.jobs import image_feature_rows, image_rejects
from patchloom.sinks.images import raw_bitmap, save_images
from patchloom.sources.batches import map_batches, materialise
from patchloom.sources.files import Opener
from patchloom.sources.images import attach_content, crop_images, cut_box, scan_files, scan_images, to_rgb
from patchloom.sources.rasters import boxes_to_tiles, read_boxes
from patchloom.sources.tables import read_indexed_csv, scan_path, scan_sql, scan_table


def png(image):
    height, width, _ = image.shape
    raw = b"".join(b"\0" + row.tobytes() for row in image)

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def gallery(tmp_path_factory):
    """Four 8 x 8 images two folders deep, one corrupt file, files at other depths."""
    root = tmp_path_factory.mktemp("x_1-2-3")
    rng = np.random.default_rng(3)
    images = {f"slide_{i}-{i * 10}-5": rng.integers(0, 256, (8, 8, 3), np.uint8) for i in range(4)}
    for i, (name, image) in enumerate(images.items()):
        folder = root / f"a{i % 2}" / "b"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.png").write_bytes(png(image))
    (root / "a0" / "b" / "slide_9-1-1.png").write_bytes(b"no image")
    (root / "a0" / "b" / "notes.txt").write_text("x")
    (root / "a0" / "slide_7-1-1.png").write_bytes(png(images["slide_0-0-5"]))
    (root / "a0" / "b" / "deep").mkdir()
    (root / "a0" / "b" / "deep" / "slide_8-1-1.png").write_bytes(png(images["slide_0-0-5"]))
    return str(root), images


def test_scan_files_depth(spark, gallery):
    root, images = gallery
    two_deep = scan_files(spark, root, "*/*/*.png")
    assert {r["imid"] for r in two_deep.select("imid").collect()} == {*images, "slide_9-1-1"}
    any_depth = scan_files(spark, root, "*.png", recursive=True)
    assert {r["imid"] for r in any_depth.select("imid").collect()} == {*images, "slide_9-1-1", "slide_7-1-1", "slide_8-1-1"}
    named = scan_files(spark, root, "a1/b/slide_?-*.png")
    assert {r["imid"] for r in named.select("imid").collect()} == {"slide_1-10-5", "slide_3-30-5"}
    either = scan_files(spark, root, "{a1,a2}/*/*.png")
    assert either.count() == 2
    assert scan_files(spark, root, "*/*/*.png", modified_after="2999-01-01T00:00:00").count() == 0


def test_paths_do_not_read_content(spark, gallery):
    plan = scan_files(spark, gallery[0], "*/*/*.png").select("imid", "path")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan


def test_decoded_scan_and_crop_are_byte_exact(spark, gallery):
    root, images = gallery
    decoded = scan_images(spark, root, "*/*/*.png")
    found = {r["imid"]: r for r in decoded.collect()}
    assert set(found) == set(images)
    for name, image in images.items():
        row = found[name]
        assert np.array_equal(to_rgb(bytes(row["pixels"]), row["height"], row["width"], row["channels"]), image)
    kept = scan_images(spark, root, "*/*/*.png", drop_invalid=False)
    assert [r["height"] for r in kept.filter("imid = 'slide_9-1-1'").collect()] == [-1]
    for x, y in [(2, 3), (-2, -1), (5, 6), (20, 0), (-9, -9)]:
        boxed = crop_images(decoded.withColumns({"x0": F.lit(x), "y0": F.lit(y)}), 4, ["imid"])
        for row in boxed.collect():
            assert bytes(row["pixels"]) == cut_box(images[row["imid"]], x, y, 4).tobytes()


def test_cut_box_outside_is_zero():
    image = np.arange(48, dtype=np.uint8).reshape(4, 4, 3)
    padded = np.pad(image, ((5, 5), (5, 5), (0, 0)))
    for x in range(-5, 6):
        for y in range(-5, 6):
            assert np.array_equal(cut_box(image, x, y, 3), padded[y + 5 : y + 8, x + 5 : x + 8])


def test_grey_and_alpha():
    assert to_rgb(bytes([7, 9]), 1, 2, 1).tolist() == [[[7, 7, 7], [9, 9, 9]]]
    assert to_rgb(bytes([1, 2, 3, 255]), 1, 1, 4).tolist() == [[[3, 2, 1]]]


def test_annotated_files(spark, gallery):
    root, images = gallery
    rows = [("slide_0", 0, 5, 1), ("slide_3", 30, 5, 0), ("slide_5", 1, 1, 1), ("slide_1", None, 5, 1)]
    annotations = spark.createDataFrame(rows, "sid string, x_center int, y_center int, label int")
    found = annotate_files(spark, annotations, root, "*/*/*.png")
    assert found.columns == ["id", "imid", "slide_id", "x_center", "y_center", "label", "content"]
    assert {r["imid"]: bytes(r["content"]) for r in found.collect()} == {
        name: png(images[name]) for name in ("slide_0-0-5", "slide_3-30-5")
    }
    embed = image_featurizer(share_weights(spark, np.ones((192, 1))), 8, 8)
    # A broken file that nobody annotated doesn't matter.
    assert image_feature_rows(spark, annotations, root, embed, "*/*/*.png").count() == 2
    assert [(r["path"].rsplit("/", 1)[-1], r["reason"]) for r in image_rejects(spark, root, "*/*/*.png").collect()] == [("slide_9-1-1.png", "invalid")]
    features = image_feature_rows(spark, annotations, root, embed, "*/*/*.png", partitions=3, rejects="drop")
    assert features.columns == ["id", "slide_id", "x_center", "y_center", "label", "content", "features"]
    assert {r["slide_id"]: r["features"] for r in features.collect()} == {
        "slide_0": [float(images["slide_0-0-5"].sum())], "slide_3": [float(images["slide_3-30-5"].sum())],
    }
    slim = image_feature_rows(spark, annotations, root, embed, "*/*/*.png", with_content=False, rejects="drop")
    assert slim.columns == ["id", "slide_id", "x_center", "y_center", "label", "features"]


def test_only_annotated_images_reach_the_model(spark, gallery):
    root, images = gallery
    annotations = spark.createDataFrame([("slide_0", 0, 5, 1)], "sid string, x_center int, y_center int, label int")
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("array<float>")
    def embed(batch: pd.DataFrame) -> pd.Series:
        seen.add(len(batch))
        return pd.Series([[1.0]] * len(batch))

    found = image_feature_rows(spark, annotations, root, embed, "*/*/*.png", with_content=False, rejects="drop")
    assert found.count() == 1 and found.select("features").collect() and seen.value == 1


def test_featurizer_takes_any_channels_and_shape(spark):
    rng = np.random.default_rng(8)
    grey, colour, alpha, large = (rng.integers(0, 256, s, np.uint8) for s in ((4, 4, 1), (4, 4, 3), (4, 4, 4), (8, 8, 3)))
    rows = [(i, bytearray(p.tobytes()), *p.shape) for i, p in enumerate((grey, colour, alpha, large))] + [(9, None, None, None, None)]
    frame = spark.createDataFrame(rows, "k int, pixels binary, height int, width int, channels int")
    weights = rng.normal(size=(48, 2))
    embed = image_featurizer(share_weights(spark, weights), 4, 4)
    found = {r["k"]: r["f"] for r in frame.select("k", embed(image_struct()).alias("f")).collect()}
    for k, image in enumerate((np.repeat(grey, 3, axis=2), colour[:, :, ::-1], alpha[:, :, 2::-1], px.resize(large[:, :, ::-1], 4, 4))):
        assert found[k] == pytest.approx(image.reshape(-1).astype(float) @ weights, rel=1e-5)
    assert found[9] is None


def test_file_systems_of_stores():
    opener = Opener()
    assert opener("/a/b")[1] == "/a/b" and opener("file:///a/b")[1] == "/a/b" and opener("dbfs:/x/y")[1] == "/dbfs/x/y"


@pytest.mark.parametrize("shape", [(8, 8), (3, 5)])
def test_saved_images_read_back(spark, tmp_path, shape):
    height, width = shape
    rng = np.random.default_rng(0)
    images = [rng.integers(0, 256, (height, width, 3), np.uint8) for _ in range(6)]
    rows = [(f"slide_{i}", i, 2 * i, bytearray(image.tobytes())) for i, image in enumerate(images)]
    df = spark.createDataFrame(rows, "sid string, x int, y int, pixels binary")
    df = df.withColumn("path", patch_path(f"{tmp_path}/p/q", patch_name("sid", "x", "y"), "bmp"))
    for _ in range(2):
        assert save_images(df, "path", "pixels", height, width, ["sid"]).count() == 6
    back = {r["imid"]: r for r in scan_images(spark, str(tmp_path), "p/q/*.bmp").collect()}
    for i, image in enumerate(images):
        row = back[f"slide_{i}-{i}-{2 * i}"]
        assert np.array_equal(to_rgb(bytes(row["pixels"]), height, width, 3), image)
    content = attach_content(df.select("sid", "path")).orderBy("sid").first()["content"]
    assert bytes(content) == raw_bitmap(images[0].tobytes(), height, width)
    assert scan_files(spark, str(tmp_path), "p/q/*").count() == 6


@pytest.mark.parametrize("salts, downsample", [(1, 1), (4, 1), (1, 2)])
def test_tile_boxes_equal_direct_crops(spark, salts, downsample):
    rng = np.random.default_rng(salts)
    raster = rng.integers(0, 256, (16, 16, 3), np.uint8)
    tiles = [
        ("s", 0, tx, ty, bytearray(raster[ty * 4 : ty * 4 + 4, tx * 4 : tx * 4 + 4].tobytes()))
        for tx in range(4)
        for ty in range(4)
        if (tx, ty) != (2, 1)
    ]
    raster[4:8, 8:12] = 0
    centres = [(x, y) for x in range(-6, 40, 5) for y in range(-6, 40, 7)]
    boxes = spark.createDataFrame(
        [(i, "s", 0, x, y, i % 3) for i, (x, y) in enumerate(centres)],
        "patch_id int, sid string, level int, x_center int, y_center int, label int",
    )
    table = spark.createDataFrame(tiles, "sid string, level int, tx int, ty int, pixels binary")
    found = read_boxes(table, boxes, 6, 4, keep=["label"], downsample=downsample, salts=salts)
    assert found.columns == ["patch_id", "label", "pixels"]
    patches = {r["patch_id"]: bytes(r["pixels"]) for r in found.collect()}
    assert len(patches) == len(centres)
    for i, (x, y) in enumerate(centres):
        left, top = (x - 3 * downsample) // downsample, (y - 3 * downsample) // downsample
        assert patches[i] == cut_box(raster, left, top, 6).tobytes(), (x, y)
    assert boxes_to_tiles(boxes, 6, 4).groupBy("patch_id").count().agg(F.max("count")).first()[0] <= 9


def test_resize_and_crops():
    image = np.arange(2 * 4 * 3, dtype=np.float64).reshape(2, 4, 3)
    assert px.resize_short_side(image, 4).shape == (4, 8, 3)
    assert np.allclose(px.resize(image, 2, 4), image)
    flat = np.full((9, 7, 3), 50.0)
    assert np.allclose(px.resize(flat, 3, 5), 50) and np.allclose(px.resize(flat, 20, 30), 50)
    # Shrinking by two averages with the triangle 1/8 3/8 3/8 1/8 away from the border.
    ramp = np.arange(8.0).reshape(8, 1, 1)
    assert px.resize(ramp, 4, 1)[1, 0, 0] == pytest.approx((1 + 2 * 3 + 3 * 3 + 4) / 8)
    assert px.center_crop(image, 2).tolist() == image[:, 1:3].tolist()
    assert px.center_crop(image, 6).shape == (6, 6, 3)
    planes = px.normalize_planes(px.to_planes(np.full((1, 1, 3), 255.0)))
    assert planes.ravel().tolist() == pytest.approx([(1 - m) / s for m, s in zip(px.CHANNEL_MEAN, px.CHANNEL_STD)])


def test_random_crop_stays_inside_and_follows_the_seed():
    image = np.random.default_rng(1).integers(0, 256, (40, 30, 3)).astype(float)
    for seed in range(30):
        first = px.random_resized_crop(image, 10, np.random.default_rng(seed))
        assert first.shape == (10, 10, 3) and first.min() >= image.min() - 1e-9 and first.max() <= image.max() + 1e-9
        assert np.array_equal(first, px.random_resized_crop(image, 10, np.random.default_rng(seed)))
    thin = px.random_resized_crop(np.ones((2, 400, 3)), 4, np.random.default_rng(0))
    assert np.allclose(thin, 1)
    flips = [px.random_flip(image, np.random.default_rng(s))[0, 0, 0] == image[0, 0, 0] for s in range(40)]
    assert 5 < sum(flips) < 35


def test_preprocess_is_the_same_after_repartition(spark, gallery, rows):
    images = scan_images(spark, gallery[0], "*/*/*.png")
    for train in (False, True):
        once = rows(preprocess_images(images, ["imid"], train=train, size=6, short_side=9))
        again = rows(preprocess_images(images.repartition(5), ["imid"], train=train, size=6, short_side=9, partitions=3))
        assert once == again and len(once[0][1]) == 3 * 6 * 6
    other = rows(preprocess_images(images, ["imid"], train=True, size=6, epoch=1))
    assert other != once


def test_csv(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text(",fare,note\n0,1.5,x\n1,2.5,\n")
    (tmp_path / "b.csv").write_text(",note,fare\n7,z,3\n")
    files = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    expected = [(1.5, "x"), (2.5, None), (3.0, "z")]
    assert rows(read_indexed_csv(spark, files), "fare", "note") == expected
    (tmp_path / "c.csv").write_text(",fare,note\n9,4.5,w\n")
    more = read_indexed_csv(spark, [*files, str(tmp_path / "c.csv")])
    assert more.columns == ["fare", "note"] and rows(more) == sorted([*expected, (4.5, "w")], key=repr)
    with pytest.raises(Exception, match="header"):
        read_indexed_csv(spark, files, schema="i int, fare double, note string").collect()
    typed = read_indexed_csv(spark, files[0], schema="i int, fare double, note string")
    assert typed.columns == ["fare", "note"] and rows(typed) == expected[:2]
    with pytest.raises(ValueError, match="not supported"):
        read_indexed_csv(spark, files, fmt="json")


def test_table_scans(spark, tmp_path, rows):
    spark.range(5).withColumn("v", F.col("id") * 2).write.parquet(str(tmp_path / "t"))
    df = scan_path(spark, str(tmp_path / "t"), ["id"])
    df.createOrReplaceTempView("scan_view")
    assert scan_table(spark, "scan_view", ["id"]).count() == 5
    assert rows(scan_sql(spark, "select id from scan_view where id > :low", {"low": 2})) == [(3,), (4,)]
    assert scan_sql(spark, "select id from scan_view limit 2").count() == 2


def test_materialise_and_batches(spark, rows):
    df = spark.range(10).withColumn("s", F.col("id") % 2).withColumn("r", F.rand())
    stored = materialise(df, partition_by=("s",))
    assert rows(stored) == rows(stored) and stored.count() == 10

    def double(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"twice": frame["id"] * 2})

    assert rows(map_batches(stored, double, "twice bigint", partitions=3)) == sorted([(2 * i,) for i in range(10)], key=repr)


def test_boxes_over_edge_tiles_levels_and_equal_keys(spark):
    """Two rasters with two levels each, 10 x 7 and 5 x 4 pixels in tiles of 4, and one key for all boxes."""
    rng = np.random.default_rng(6)
    stored, images = [], {}
    for sid in ("a", "b"):
        for level, (height, width) in enumerate([(7, 10), (4, 5)]):
            image = images[sid, level] = rng.integers(0, 256, (height, width, 3), np.uint8)
            for ty in range(0, height, 4):
                for tx in range(0, width, 4):
                    part = image[ty : ty + 4, tx : tx + 4]
                    stored.append((sid, level, tx // 4, ty // 4, bytearray(part.tobytes()), *part.shape[:2]))
    tiles = spark.createDataFrame(stored, "sid string, level int, tx int, ty int, pixels binary, h int, w int")
    boxes = spark.createDataFrame([("p", s, v, 6, 4) for s in "ab" for v in (0, 1)], "patch_id string, sid string, level int, x_center int, y_center int")
    found = read_boxes(tiles, boxes, 6, 4, keep=["sid", "level"], downsample={0: 1, 1: 2}).collect()
    assert len(found) == 4
    for r in found:
        x0, y0 = (3, 1) if r["level"] == 0 else (0, -1)
        assert bytes(r["pixels"]) == cut_box(images[r["sid"], r["level"]], x0, y0, 6).tobytes()
    plain = read_boxes(tiles, boxes, 6, 4, downsample={0: 1, 1: 2})
    assert plain.count() == 4
    with pytest.raises(Exception, match="no downsample"):
        read_boxes(tiles, boxes, 6, 4, downsample={0: 1}).collect()


def test_resize_weights_are_made_once_for_a_size_unless_large():
    assert px._taps(8, 12) is px._taps(8, 12) and not px._taps(8, 12).flags.writeable
    assert (px._taps(8, 12) == px._new_taps(8, 12)).all()
    large = px.KEPT_TAPS // 8 + 1
    assert px._taps(large, 8) is not px._taps(large, 8)
