"""Image files and tiled rasters, made from the embeddings table.

Each vector of 64 numbers becomes an 8 x 8 RGB tile; 16 consecutive vectors are
the 4 x 4 tiles of one slide.
"""

import numpy as np
from pyspark.sql import functions as F

from patchloom.functions import pixels as px
from patchloom.functions.keys import box_origin, patch_name, patch_path
from patchloom.functions.pixels import array_to_bytes
from patchloom.operators.featurize import image_featurizer, image_struct, preprocess_images, share_weights
from patchloom.plans.jobs import image_feature_rows, image_rejects
from patchloom.plans.registered import query, table
from patchloom.session import scratch_path
from patchloom.sinks.images import raw_bitmap, save_files, save_images
from patchloom.sources.images import attach_content, crop_images, decode_bitmap, scan_files, scan_images
from patchloom.sources.manifest import list_files, read_manifest, write_manifest
from patchloom.sources.pyramids import cut_tiles, read_pyramid, write_pyramid
from patchloom.sources.rasters import read_boxes
from patchloom.sources.tables import explode_array

TILE, GRID = 8, 4

PIXEL_SQL = """
    SELECT vec_id, label, vec_id // 16 AS slide, i % 8 AS px, i // 8 AS py, i, v AS r, v * 3 % 256 AS g, 255 - v AS b,
           'slide_' || (vec_id // 16) || '-' || (vec_id % 4 * 8) || '-' || (vec_id // 4 % 4 * 8) AS imid
    FROM (SELECT vec_id, label, i, floor((embedding[i + 1]::DOUBLE + 1) * 127.5)::INTEGER AS v
          FROM embeddings, unnest(range(64)) t(i))
"""


def tiles(spark, folder):
    """Tile rows ``(vec_id, label, sid, level, tx, ty, pixels)``."""
    vectors = table(spark, folder, "embeddings")

    def rgb(x):
        value = F.floor((x.cast("double") + 1) * 127.5).cast("int")
        return F.array(value, value * 3 % 256, 255 - value)

    return vectors.select(
        "vec_id",
        "label",
        F.format_string("slide_%d", F.expr("vec_id div 16")).alias("sid"),
        F.lit(0).alias("level"),
        (F.col("vec_id") % GRID).cast("int").alias("tx"),
        F.expr(f"cast(vec_id div {GRID} % {GRID} as int)").alias("ty"),
        array_to_bytes(F.flatten(F.transform("embedding", rgb))).alias("pixels"),
    )


def image_files(spark, folder):
    """Write one image file per tile, two folders deep; returns the root folder."""
    root = scratch_path(spark, "images")
    named = tiles(spark, folder).withColumns({"x": F.col("tx") * TILE, "y": F.col("ty") * TILE})
    where = F.concat(F.lit(f"{root}/"), F.col("sid"), F.lit("/"), F.col("level").cast("string"))
    named = named.withColumn("path", patch_path(where, patch_name("sid", "x", "y"), "bmp"))
    save_images(named, "path", "pixels", TILE, TILE, ["vec_id"]).write.format("noop").mode("overwrite").save()
    return root


PATTERN = "*/*/*.bmp"


@query(
    f"""
    SELECT imid, 246::BIGINT AS length, string_agg(printf('%02X%02X%02X', b, g, r), '' ORDER BY 7 - py, px) AS body
    FROM ({PIXEL_SQL}) GROUP BY imid
    """
)
def binary_file_scan(spark, folder):
    files = scan_files(spark, image_files(spark, folder), PATTERN)
    return files.select("imid", "length", F.hex(F.substring("content", 55, 192)).alias("body"))


@query(
    f"""
    SELECT imid, string_agg(printf('%02X%02X%02X', b, g, r), '' ORDER BY 7 - py, px) AS body
    FROM ({PIXEL_SQL}) WHERE label < 5 GROUP BY imid
    """
)
def content_after_join(spark, folder):
    """Paths are joined with the annotations first; bytes are read for the matches only."""
    paths = scan_files(spark, image_files(spark, folder), PATTERN).select("imid", "path")
    wanted = tiles(spark, folder).filter("label < 5")
    keys = wanted.select(patch_name("sid", F.col("tx") * TILE, F.col("ty") * TILE).alias("imid"))
    matched = attach_content(paths.join(keys, "imid"))
    return matched.select("imid", F.hex(F.substring("content", 55, 192)).alias("body"))


@query(
    f"""
    SELECT imid, label, 246::BIGINT AS length, string_agg(printf('%02X%02X%02X', b, g, r), '' ORDER BY 7 - py, px) AS body
    FROM ({PIXEL_SQL}) WHERE label IN (2, 5) GROUP BY imid, label
    """
)
def manifest_scan(spark, folder):
    """Files listed in tasks, joined with their labels, stored as a manifest and read in parts; only those of two labels are opened."""
    found = list_files(spark, image_files(spark, folder), PATTERN).select("imid", "path", "length")
    labels = tiles(spark, folder).select(patch_name("sid", F.col("tx") * TILE, F.col("ty") * TILE).alias("imid"), "label")
    path = scratch_path(spark, "manifest")
    write_manifest(found.join(labels, "imid"), path, part_bytes=20 * 246)
    files = read_manifest(spark, path, {"label": [2, 5]})
    return files.select("imid", "label", "length", F.hex(F.substring("content", 55, 192)).alias("body"))


@query(
    f"""
    SELECT imid, 8 AS height, 8 AS width, 3 AS channels,
           string_agg(printf('%02X%02X%02X', b, g, r), '' ORDER BY i) AS bgr
    FROM ({PIXEL_SQL}) GROUP BY imid
    """
)
def decoded_image_scan(spark, folder):
    images = scan_images(spark, image_files(spark, folder), PATTERN)
    return images.select("imid", "height", "width", "channels", F.hex("pixels").alias("bgr"))


@query(
    f"""
    WITH p AS ({PIXEL_SQL}), o AS (SELECT DISTINCT imid, length(imid) % 9 - 3 AS x0, vec_id % 4 - 3 AS y0 FROM p),
    c AS (SELECT o.imid, dy * 6 + dx AS pos, x0 + dx AS px, y0 + dy AS py
          FROM o, unnest(range(6)) t1(dx), unnest(range(6)) t2(dy))
    SELECT c.imid, string_agg(coalesce(printf('%02X%02X%02X', r, g, b), '000000'), '' ORDER BY pos) AS box
    FROM c LEFT JOIN p USING (imid, px, py) GROUP BY c.imid
    """
)
def image_box(spark, folder):
    """A 6 x 6 box of every image file, partly outside of it."""
    images = scan_images(spark, image_files(spark, folder), PATTERN)
    x_center = F.length("imid") % 9
    column = F.expr("cast(regexp_extract(imid, '-(\\\\d+)-', 1) as int) div 8")
    boxed = images.withColumns({"x0": box_origin(x_center, 6), "y0": box_origin(column, 6)})
    return crop_images(boxed, 6, ["imid"]).select("imid", F.hex("pixels").alias("box"))


@query(
    f"""
    WITH p AS (SELECT slide, vec_id % 4 * 8 + px AS x, vec_id // 4 % 4 * 8 + py AS y,
                      printf('%02X%02X%02X', r, g, b) AS rgb FROM ({PIXEL_SQL})),
    o AS (SELECT vec_id, vec_id // 16 AS slide, vec_id * 7 % 32 - 6 AS x0, vec_id * 13 % 32 - 6 AS y0 FROM embeddings),
    c AS (SELECT vec_id, slide, dy * 12 + dx AS pos, x0 + dx AS x, y0 + dy AS y
          FROM o, unnest(range(12)) t1(dx), unnest(range(12)) t2(dy))
    SELECT vec_id AS patch_id, string_agg(coalesce(rgb, '000000'), '' ORDER BY pos) AS patch
    FROM c LEFT JOIN p USING (slide, x, y) GROUP BY vec_id
    """
)
def raster_patches(spark, folder):
    """12 x 12 boxes across tile borders, some over the edge of the raster."""
    stored = tiles(spark, folder)
    boxes = stored.select(
        F.col("vec_id").alias("patch_id"),
        "sid",
        "level",
        (F.col("vec_id") * 7 % 32).alias("x_center"),
        (F.col("vec_id") * 13 % 32).alias("y_center"),
    )
    return read_boxes(stored, boxes, 12, TILE).select("patch_id", F.hex("pixels").alias("patch"))


@query(
    f"""
    WITH p AS (SELECT slide, vec_id % 4 * 8 + px AS x, vec_id // 4 % 4 * 8 + py AS y, r, g, b FROM ({PIXEL_SQL})),
    l0 AS (SELECT slide, x, y, coalesce(r, 0) AS r, coalesce(g, 0) AS g, coalesce(b, 0) AS b
           FROM (SELECT * FROM (SELECT DISTINCT slide FROM p), unnest(range(32)) t1(x), unnest(range(32)) t2(y)) LEFT JOIN p USING (slide, x, y)),
    l1 AS (SELECT slide, x // 2 AS x, y // 2 AS y, (sum(r) + 2) // 4 AS r, (sum(g) + 2) // 4 AS g, (sum(b) + 2) // 4 AS b FROM l0 GROUP BY ALL),
    l2 AS (SELECT slide, x // 2 AS x, y // 2 AS y, (sum(r) + 2) // 4 AS r, (sum(g) + 2) // 4 AS g, (sum(b) + 2) // 4 AS b FROM l1 GROUP BY ALL),
    up AS (SELECT 1 AS level, * FROM l1 UNION ALL SELECT 2, * FROM l2),
    o AS (SELECT vec_id, vec_id // 16 AS slide, 1 + vec_id % 2 AS level, floor(vec_id * 7 % 32 / (2.0 + vec_id % 2 * 2))::BIGINT - 5 AS x0,
                 floor(vec_id * 13 % 32 / (2.0 + vec_id % 2 * 2))::BIGINT - 5 AS y0 FROM embeddings),
    c AS (SELECT vec_id, slide, level, dy * 10 + dx AS pos, x0 + dx AS x, y0 + dy AS y FROM o, unnest(range(10)) t1(dx), unnest(range(10)) t2(dy))
    SELECT vec_id AS patch_id, level::INTEGER AS level, string_agg(coalesce(printf('%02X%02X%02X', r::INTEGER, g::INTEGER, b::INTEGER), '000000'), '' ORDER BY pos) AS patch
    FROM c LEFT JOIN up USING (slide, level, x, y) GROUP BY vec_id, level
    """
)
def pyramid_patches(spark, folder):
    """Slides of 32 x 32 pixels as image files, cut to tiles of 12 with small ones at the edge, halved twice; boxes on both levels."""
    stored = tiles(spark, folder)
    slides = stored.select("sid", F.lit(0).alias("level"), F.lit(16).alias("x_center"), F.lit(16).alias("y_center")).distinct()
    whole = read_boxes(stored, slides.withColumn("slide", F.col("sid")), 32, TILE, key="slide")
    root = scratch_path(spark, "slides")
    named = whole.withColumn("path", patch_path(F.concat(F.lit(f"{root}/"), "slide", F.lit("/0")), F.col("slide"), "bmp"))
    save_images(named, "path", "pixels", 32, 32, ["slide"]).write.format("noop").mode("overwrite").save()
    images = scan_images(spark, root, PATTERN, key=None).withColumn("sid", F.regexp_extract("path", r"([^/]*)\.bmp$", 1))
    path = scratch_path(spark, "pyramid")
    write_pyramid(cut_tiles(images, 12), path, 12)
    boxes = stored.select(
        F.col("vec_id").alias("patch_id"),
        "sid",
        (F.col("vec_id") % 2 + 1).cast("int").alias("level"),
        (F.col("vec_id") * 7 % 32).alias("x_center"),
        (F.col("vec_id") * 13 % 32).alias("y_center"),
    )
    found = read_boxes(read_pyramid(spark, path), boxes, 10, 12, keep=["level"], downsample={0: 1, 1: 2, 2: 4})
    return found.select("patch_id", "level", F.hex("pixels").alias("patch"))


@query(
    f"""
    WITH taps AS (SELECT o, i, w / sum(w) OVER (PARTITION BY o) AS w FROM (
        SELECT o, i, greatest(0, 1 - abs(i + 0.5::DOUBLE - (o + 0.5::DOUBLE) * 0.5::DOUBLE)) AS w
        FROM unnest(range(16)) a(o), unnest(range(8)) b(i)) WHERE w > 0),
    ch AS (SELECT imid, px, py, unnest([0, 1, 2]) AS channel, unnest([r, g, b]) AS v FROM ({PIXEL_SQL})),
    big AS (SELECT imid, channel, ty.o AS y, tx.o AS x, sum(v * ty.w * tx.w) AS v
            FROM ch JOIN taps ty ON py = ty.i JOIN taps tx ON px = tx.i
            WHERE ty.o >= 2 AND ty.o < 14 AND tx.o >= 2 AND tx.o < 14 GROUP BY imid, channel, ty.o, tx.o),
    norm AS (SELECT imid, channel, (y - 2) * 12 + x - 2 AS pos,
             ((v / 255.0::DOUBLE - [0.485::DOUBLE, 0.456::DOUBLE, 0.406::DOUBLE][channel + 1])
              / [0.229::DOUBLE, 0.224::DOUBLE, 0.225::DOUBLE][channel + 1])::FLOAT::DOUBLE AS v FROM big)
    SELECT imid, channel, round(sum(v), 3) AS total, round(sum(v * (pos + 1)), 3) AS placed FROM norm GROUP BY imid, channel
    """
)
def image_preprocess(spark, folder):
    images = scan_images(spark, image_files(spark, folder), PATTERN)
    ready = preprocess_images(images, ["imid"], size=12, short_side=16)
    rows = explode_array(ready, ["imid"], "features")
    value = F.col("value").cast("double")
    channel = F.expr("cast(pos div 144 as int)")
    return rows.groupBy("imid", channel.alias("channel")).agg(
        F.round(F.sum(value), 3).alias("total"),
        F.round(F.sum(value * (F.col("pos") % 144 + 1)), 3).alias("placed"),
    )


@query(
    f"""
    SELECT imid, 432 AS width, 432::BIGINT AS n_in_range, true AS repeatable, true AS channels_together
    FROM ({PIXEL_SQL}) GROUP BY imid
    """
)
def image_augment(spark, folder):
    """Random box and flip for training: every value lies in its channel's range, and all of them follow from id and epoch.

    Boxes and flips move the channels together. Green is three times red here and blue its complement, so
    values of red and blue add up to the same at every place, resized or not.
    """
    images = scan_images(spark, image_files(spark, folder), PATTERN)
    ready, again = (preprocess_images(images, ["imid"], train=True, size=12, epoch=1) for _ in range(2))
    both = ready.join(again.select("imid", F.col("features").alias("again")), "imid")
    mean, std = (F.array(*[F.lit(v) for v in values]) for values in (px.CHANNEL_MEAN, px.CHANNEL_STD))
    unit = F.transform("features", lambda v, i: v.cast("double") * F.get(std, F.floor(i / 144).cast("int")) + F.get(mean, F.floor(i / 144).cast("int")))
    alike = F.zip_with(F.slice("unit", 1, 144), F.slice("unit", 289, 144), lambda red, blue: F.abs(red + blue - 1) < 1e-4)
    return both.withColumn("unit", unit).select(
        "imid",
        F.size("features").alias("width"),
        F.size(F.filter("unit", lambda v: (v > -1e-5) & (v < 1 + 1e-5))).cast("bigint").alias("n_in_range"),
        (F.col("features") == F.col("again")).alias("repeatable"),
        F.forall(alike, lambda x: x).alias("channels_together"),
    )


@query(
    f"""
    SELECT imid, j::INTEGER AS pos, sum((r * ((3 * i + j) % 5 - 2) + g * ((3 * i + 1 + j) % 5 - 2)
             + b * ((3 * i + 2 + j) % 5 - 2)) / 4.0::DOUBLE) AS value
    FROM ({PIXEL_SQL}), unnest(range(4)) t(j) GROUP BY imid, j
    """
)
def image_featurize(spark, folder):
    """A fixed linear model on the red-green-blue pixels."""
    place, out = np.meshgrid(np.arange(TILE * TILE * 3), np.arange(4), indexing="ij")
    embed = image_featurizer(share_weights(spark, ((place + out) % 5 - 2) / 4.0), TILE, TILE)
    images = scan_images(spark, image_files(spark, folder), PATTERN)
    rows = explode_array(images.select("imid", embed(image_struct()).alias("features")), ["imid"], "features")
    return rows.withColumn("value", F.col("value").cast("double"))


BITMAP_HEADER = raw_bitmap(bytes(TILE * TILE * 3), TILE, TILE)[:54].hex()
FEATURE_SQL = ", ".join(
    f"sum((r * ((3 * i + {j}) % 5 - 2) + g * ((3 * i + 1 + {j}) % 5 - 2) + b * ((3 * i + 2 + {j}) % 5 - 2)) / 4.0::DOUBLE) AS f{j}"
    for j in range(4)
)


@query(
    f"""
    SELECT sha256(imid) AS id, 'slide_' || slide AS slide_id, px0 AS x_center, py0 AS y_center, label, {FEATURE_SQL},
           sha256(unhex('{BITMAP_HEADER}' || string_agg(printf('%02X%02X%02X', b, g, r), '' ORDER BY 7 - py, px))) AS content_hash
    FROM (SELECT *, (vec_id % 4 * 8)::INTEGER AS px0, (vec_id // 4 % 4 * 8)::INTEGER AS py0 FROM ({PIXEL_SQL}))
    WHERE label < 7 GROUP BY imid, slide, px0, py0, label
    """
)
def image_feature_job(spark, folder):
    """Annotations joined with featurized image files, file bytes attached at the end; some images have no annotation."""
    place, out = np.meshgrid(np.arange(TILE * TILE * 3), np.arange(4), indexing="ij")
    embed = image_featurizer(share_weights(spark, ((place + out) % 5 - 2) / 4.0), TILE, TILE)
    annotations = tiles(spark, folder).filter("label < 7").select(
        "sid", (F.col("tx") * TILE).alias("x_center"), (F.col("ty") * TILE).alias("y_center"), "label"
    )
    rows = image_feature_rows(spark, annotations, image_files(spark, folder), embed, PATTERN, decode=decode_bitmap)
    return rows.select(
        "id",
        "slide_id",
        "x_center",
        "y_center",
        "label",
        *[F.get("features", F.lit(j)).cast("double").alias(f"f{j}") for j in range(4)],
        F.sha2("content", 256).alias("content_hash"),
    )


@query(
    f"""
    SELECT 'unnamed' AS reason, vec_id FROM ({PIXEL_SQL}) WHERE vec_id % 7 = 0 GROUP BY vec_id
    UNION ALL SELECT 'invalid', vec_id FROM ({PIXEL_SQL}) WHERE vec_id % 7 = 3 GROUP BY vec_id
    """
)
def image_rejects_listed(spark, folder):
    """Files whose names hold no key, and files that are no images, among good ones."""
    root = scratch_path(spark, "rejects")
    kind = F.col("vec_id") % 7
    name = F.when(kind == 0, F.format_string("tile%d", "vec_id")).otherwise(F.format_string("t_%d-1-1", "vec_id"))
    path = patch_path(F.concat(F.lit(f"{root}/"), "sid", F.lit("/0")), name, "bmp")
    named = tiles(spark, folder).withColumn("path", path)
    save_images(named, "path", "pixels", TILE, TILE, ["vec_id"]).write.format("noop").mode("overwrite").save()
    broken = named.filter(kind == 3).select("path", F.lit(b"no image").alias("content"))
    save_files(broken, "path", "content").write.format("noop").mode("overwrite").save()
    found = image_rejects(spark, root, PATTERN)
    return found.select("reason", F.regexp_extract("path", r"/t(?:ile|_)(\d+)[^/]*$", 1).cast("bigint").alias("vec_id"))
