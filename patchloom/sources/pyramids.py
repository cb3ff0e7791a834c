"""Rasters made from images: level-0 tiles, and every coarser level from the one below.

A pixel of a level is the mean of up to 2 x 2 pixels of the level below, rounded
half up. Tiles have an even side, so no such square crosses a tile border: each tile is halved where
it lies, and only the halves, a quarter of the pixels, go to their parent tile,
which has at most four children. Nothing larger than a tile is moved or held.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

from patchloom.session import path_exists
from patchloom.sources.images import to_rgb

# Bytes of tiles handed on at once.
BATCH_BYTES = 32 << 20
TILES = StructType([
    StructField("sid", StringType()), StructField("level", IntegerType()), StructField("tx", IntegerType()), StructField("ty", IntegerType()),
    StructField("h", IntegerType()), StructField("w", IntegerType()), StructField("pixels", BinaryType()),
])


def _side(tile: int) -> None:
    if tile < 2 or tile % 2:
        raise ValueError(f"the side of a tile must be even, not {tile}")


def cut_tiles(images: DataFrame, tile: int, sid: str = "sid", origin: Sequence[str] | None = None) -> DataFrame:
    """Decoded images, as :func:`scan_images` gives them, to level-0 tile rows ``(sid, level, tx, ty, h, w, pixels)``.

    Tiles at the right and lower edge are as small as what is left. With
    ``origin``, two columns with the place of the image's upper left pixel in its raster, several images make up
    one raster; places must be multiples of ``tile``. Images that could not be decoded (height below 1) or lack pixels give no tiles.
    """
    _side(tile)
    place = [F.col(c).cast("int") for c in origin] if origin else [F.lit(0), F.lit(0)]
    whole = images.filter("height > 0 AND width > 0 AND pixels IS NOT NULL").select(
        F.col(sid).cast("string").alias("sid"), "height", "width", "channels", "pixels", place[0].alias("x"), place[1].alias("y")
    )

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows, held = [], 0
            for row in frame.itertuples(index=False):
                if row.x % tile or row.y % tile:
                    raise ValueError(f"the place ({row.x}, {row.y}) in {row.sid} is no multiple of {tile}")
                image = to_rgb(row.pixels, row.height, row.width, row.channels)
                for top in range(0, row.height, tile):
                    for left in range(0, row.width, tile):
                        part = image[top : top + tile, left : left + tile]
                        rows.append((row.sid, 0, (row.x + left) // tile, (row.y + top) // tile, *part.shape[:2], part.tobytes()))
                        held += part.size
                        if held >= BATCH_BYTES:
                            yield pd.DataFrame(rows, columns=TILES.names)
                            rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=TILES.names)

    return whole.mapInPandas(cut, TILES)


def halved(image: np.ndarray) -> np.ndarray:
    """Means of 2 x 2 pixels, rounded half up; at an odd edge of the 2 or 1 that there are."""
    height, width = image.shape[:2]
    padded = np.pad(image.astype(np.uint16), ((0, height % 2), (0, width % 2), (0, 0)))
    sums = padded[::2, ::2] + padded[1::2, ::2] + padded[::2, 1::2] + padded[1::2, 1::2]
    down = np.full(sums.shape[0], 2)
    across = np.full(sums.shape[1], 2)
    if height % 2:
        down[-1] = 1
    if width % 2:
        across[-1] = 1
    count = (down[:, None] * across)[:, :, None]
    return ((sums + count // 2) // count).astype(np.uint8)


def next_level(tiles: DataFrame, tile: int) -> DataFrame:
    """The tiles one level up from tile rows ``(sid, level, tx, ty, pixels)``, with or without ``h`` and ``w``.

    Only tiles at the right and lower edge may be small. Missing tiles count as
    zero pixels, up to the farthest child there is; four missing children are a missing tile. Tiles without pixels are missing.
    """
    _side(tile)
    half = tile // 2
    shape = [(F.col(c) if c in tiles.columns else F.lit(tile)).cast("int").alias(c) for c in ("h", "w")]
    given = tiles.filter("pixels IS NOT NULL").select("sid", F.col("level").cast("int").alias("level"), "tx", "ty", *shape, "pixels")

    def shrink(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            small = [halved(np.frombuffer(p, np.uint8).reshape(h, w, 3)) for p, h, w in zip(frame["pixels"], frame["h"], frame["w"], strict=True)]
            yield frame.assign(pixels=[s.tobytes() for s in small], h=[s.shape[0] for s in small], w=[s.shape[1] for s in small])

    children = given.mapInPandas(shrink, given.schema)
    up = {c: F.floor(F.col(c) / 2).cast("int") for c in ("tx", "ty")}
    child = F.struct((F.col("tx") - 2 * up["tx"]).alias("right"), (F.col("ty") - 2 * up["ty"]).alias("down"), "h", "w", "pixels")
    # A tile address holds one tile, so these lists have four entries at most.
    parents = children.select("sid", (F.col("level") + 1).alias("level"), up["tx"].alias("tx"), up["ty"].alias("ty"), child.alias("child"))
    parents = parents.groupBy("sid", "level", "tx", "ty").agg(F.collect_list("child").alias("children"))

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = []
            for parts in frame["children"]:
                if len({(p["right"], p["down"]) for p in parts}) < len(parts):
                    raise ValueError("a tile address occurs more than once")
                height = max(p["down"] * half + p["h"] for p in parts)
                width = max(p["right"] * half + p["w"] for p in parts)
                image = np.zeros((height, width, 3), np.uint8)
                for p in parts:
                    top, left = p["down"] * half, p["right"] * half
                    image[top : top + p["h"], left : left + p["w"]] = np.frombuffer(p["pixels"], np.uint8).reshape(p["h"], p["w"], 3)
                made.append(image)
            yield frame.drop(columns="children").assign(h=[i.shape[0] for i in made], w=[i.shape[1] for i in made], pixels=[i.tobytes() for i in made])

    schema = StructType([*(parents.schema[c] for c in ("sid", "level", "tx", "ty")), *TILES.fields[4:]])
    return parents.mapInPandas(join, schema)


def write_pyramid(tiles: DataFrame, path: str, tile: int, levels: int | None = None) -> int:
    """Store level-0 tiles and the levels above below ``path``, each as ``level=N``; the number of levels above.

    A level is read back from storage for the next one, and has a quarter of its
    tiles. Without ``levels`` they go on until the largest raster is one tile. Levels
    that are there already are not made again, so a job that stopped goes on.
    """
    _side(tile)
    spark = tiles.sparkSession
    shape = [(F.col(c) if c in tiles.columns else F.lit(tile)).cast("int").alias(c) for c in ("h", "w")]
    ground = tiles.select("sid", F.col("tx").cast("int").alias("tx"), F.col("ty").cast("int").alias("ty"), *shape, "pixels")

    def made(level: int) -> bool:
        return path_exists(spark, f"{path}/level={level}/_SUCCESS")

    if not made(0):
        ground.write.mode("overwrite").parquet(f"{path}/level=0")
    if levels is None:
        far = read_pyramid(spark, path, 0).agg(F.greatest(F.max("tx"), F.max("ty")).alias("far")).first()["far"]
        levels = int(far or 0).bit_length()
    for level in range(1, levels + 1):
        if not made(level):
            next_level(read_pyramid(spark, path, level - 1), tile).drop("level").write.mode("overwrite").parquet(f"{path}/level={level}")
    return levels


def read_pyramid(spark: SparkSession, path: str, level: int | None = None) -> DataFrame:
    """Tile rows of all levels, or of one, for :func:`read_boxes`."""
    tiles = spark.read.schema(TILES).parquet(path)
    return tiles.select(*TILES.names) if level is None else tiles.select(*TILES.names).filter(F.col("level") == level)
