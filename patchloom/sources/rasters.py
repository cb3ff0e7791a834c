"""Box reads from rasters stored as tile rows.

A raster too large for one file read is a table of tiles
``(sid, level, tx, ty, pixels)``, each ``tile x tile`` RGB pixels, ``tx``/``ty``
counted in tiles. Smaller tiles, as at a raster's far edges, have their shape in
the columns ``h`` and ``w``. A box read becomes an equi-join on the tile address: the work
is spread over tiles, and no task ever holds a whole raster.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from patchloom.functions.keys import box_origin
from patchloom.operators.skew import lookup_join

ADDRESS = ["sid", "level", "tx", "ty"]


def boxes_to_tiles(boxes: DataFrame, size: int, tile: int, downsample: int | Mapping[int, int] = 1) -> DataFrame:
    """One row per tile a box touches, with the box origin in level pixels.

    ``x_center``, ``y_center`` are level-0 coordinates. ``downsample`` is how many
    of those a pixel of the level spans, one number or one per level; a level that is not in
    the mapping is an error. A box touches at most
    ``(size / tile + 2) ** 2`` tiles, whatever the raster holds.
    """
    def start(centre: str):
        if not isinstance(downsample, Mapping):
            return F.floor(box_origin(centre, size, downsample) / F.lit(downsample)).cast("int")
        unknown = F.raise_error(F.concat(F.lit("no downsample for level "), F.col("level").cast("string"))).cast("int")
        cases = [F.when(F.col("level") == k, F.floor(box_origin(centre, size, d) / F.lit(d)).cast("int")) for k, d in downsample.items()]
        return F.coalesce(*cases, unknown)

    origin = boxes.withColumns({"x0": start("x_center"), "y0": start("y_center")})

    def span(start: str):
        first = F.floor(F.col(start) / tile).cast("int")
        last = F.floor((F.col(start) + size - 1) / tile).cast("int")
        return F.explode(F.sequence(first, last))

    return origin.withColumn("tx", span("x0")).withColumn("ty", span("y0"))


def read_boxes(
    tiles: DataFrame,
    boxes: DataFrame,
    size: int,
    tile: int,
    key: str = "patch_id",
    keep: Sequence[str] = (),
    downsample: int | Mapping[int, int] = 1,
    salts: int = 1,
) -> DataFrame:
    """Patches as ``(key, *keep, pixels)`` for boxes ``(key, sid, level, x_center, y_center)``.

    Tiles that do not exist count as zero pixels. Each tile is cut to its
    overlap with the box before the pixels are brought together per patch, so
    what is shuffled and grouped is the patch area and not whole tiles.
    ``salts`` spreads tiles that very many boxes ask for.
    """
    touched = boxes_to_tiles(boxes, size, tile, downsample).select(*dict.fromkeys([key, *keep, *ADDRESS, "x0", "y0"]))
    # Whole tiles need no shape.
    shape = [(F.col(c) if c in tiles.columns else F.lit(tile)).cast("int").alias(f"_{c}") for c in ("h", "w")]
    joined = lookup_join(touched, tiles.select(*ADDRESS, "pixels", *shape), ADDRESS, salts=salts)

    def overlaps(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts = []
            columns = [frame[c] for c in ("pixels", "_h", "_w", "tx", "ty", "x0", "y0")]
            for p, h, w, tx, ty, x0, y0 in zip(*columns):
                if p is None:
                    parts.append(None)
                    continue
                left, top = max(x0 - tx * tile, 0), max(y0 - ty * tile, 0)
                right, bottom = min(x0 + size - tx * tile, tile), min(y0 + size - ty * tile, tile)
                part = np.zeros((bottom - top, right - left, 3), np.uint8)
                own = np.frombuffer(p, np.uint8).reshape(int(h), int(w), 3)[top:bottom, left:right]
                part[: own.shape[0], : own.shape[1]] = own
                parts.append(part.tobytes())
            yield frame.assign(pixels=parts)

    cut = joined.mapInPandas(overlaps, joined.schema)
    # At most (size / tile + 2) ** 2 parts per patch; one key may name boxes of several rasters.
    parts = cut.groupBy(*dict.fromkeys([key, *keep, "sid", "level", "x0", "y0"])).agg(
        F.collect_list(F.struct("tx", "ty", "pixels")).alias("parts")
    )
    kept = [parts.schema[c] for c in [key, *keep]]
    schema = StructType(kept + [StructField("pixels", BinaryType())])

    def stitch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            images = []
            for x0, y0, pieces in zip(frame["x0"], frame["y0"], frame["parts"]):
                image = np.zeros((size, size, 3), np.uint8)
                for piece in pieces:
                    if piece["pixels"] is None:
                        continue
                    left, top = max(piece["tx"] * tile - x0, 0), max(piece["ty"] * tile - y0, 0)
                    right = min((piece["tx"] + 1) * tile - x0, size)
                    bottom = min((piece["ty"] + 1) * tile - y0, size)
                    image[top:bottom, left:right] = np.frombuffer(piece["pixels"], np.uint8).reshape(
                        bottom - top, right - left, 3
                    )
                images.append(image.tobytes())
            yield frame[[key, *keep]].assign(pixels=images)

    return parts.mapInPandas(stitch, schema)
