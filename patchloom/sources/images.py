"""Image file scans.

File bytes are the heavy part. Scans that only need paths never read them
(``content`` is pruned), and :func:`attach_content` reads them after the joins,
in the task that uses them, so they never go through a shuffle.
"""

from __future__ import annotations

import importlib.util
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from patchloom.functions.keys import PATCH_KEY_PATTERN, parse_key
from patchloom.sources.files import Opener

# File bytes that one Arrow batch holds, about.
BATCH_BYTES = 64 << 20


def _placed(root: str, pattern: str) -> tuple[str, str | None]:
    """The folder to list, and the form of the paths that ``pattern`` means below it.

    The folder is listed as a whole, in parallel, instead of expanding the
    pattern to single files on the driver. Patterns with more than ``*`` and
    ``?`` are left to the file system.
    """
    parts = pattern.split("/")
    while len(parts) > 1 and not re.search(r"[*?\[{\\]", parts[0]):
        root = f"{root.rstrip('/')}/{parts.pop(0)}"
    if re.search(r"[\[{\\]", "/".join(parts)) or re.search(r"[*?\[{]", root):
        return f"{root.rstrip('/')}/{'/'.join(parts)}", None
    forms = [re.escape(p).replace(r"\*", "[^/]*").replace(r"\?", "[^/]") for p in parts]
    folder = re.escape(root.rstrip("/").rsplit("/", 1)[-1])
    return root, f"(^|/){folder}/{'/'.join(forms)}$"


def _load(reader: DataFrameReader, root: str, pattern: str, recursive: bool, path: str) -> DataFrame:
    name = pattern.rsplit("/", 1)[-1]
    folder, form = (root, ".*") if recursive else _placed(root, pattern)
    if form is None:
        return reader.load(folder)
    files = reader.option("recursiveFileLookup", True).option("pathGlobFilter", name).load(folder)
    return files if recursive else files.filter(F.col(path).rlike(form))


def scan_files(
    spark: SparkSession,
    root: str,
    pattern: str = "*/*/*.jpg",
    recursive: bool = False,
    key: str | None = "imid",
    key_pattern: str = PATCH_KEY_PATTERN,
    modified_after: str | None = None,
) -> DataFrame:
    """Files as ``(path, modificationTime, length, content)`` plus the parsed key.

    By default files lie exactly two folders below ``root``. With ``recursive``
    any depth is read and only the last component of ``pattern`` applies.
    """
    reader = spark.read.format("binaryFile")
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    files = _load(reader, root, pattern, recursive, "path")
    return files.withColumn(key, parse_key("path", key_pattern)) if key else files


def attach_content(df: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Add the bytes of the file each row names, read in the row's own task."""
    schema = StructType(df.schema.fields + [StructField(content, BinaryType())])

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opener = Opener()

        def read(path_value: str) -> bytes:
            filesystem, location = opener(path_value)
            with filesystem.open_input_stream(location) as stream:
                return stream.read()

        for frame in frames:
            # Handed on by size: Arrow's binary columns hold at most 2 GB.
            bodies, held, first = [], 0, 0
            for place, one in enumerate(frame[path]):
                bodies.append(read(one))
                held += len(bodies[-1])
                if held >= BATCH_BYTES or place + 1 == len(frame):
                    yield frame.iloc[first : place + 1].assign(**{content: bodies})
                    bodies, held, first = [], 0, place + 1

    return df.mapInPandas(batches, schema)


def scan_images(
    spark: SparkSession,
    root: str,
    pattern: str = "*/*/*.jpg",
    drop_invalid: bool = True,
    recursive: bool = False,
    key: str | None = "imid",
    key_pattern: str = PATCH_KEY_PATTERN,
) -> DataFrame:
    """Images decoded in the JVM: ``(path, height, width, channels, pixels)``.

    ``pixels`` holds the rows top down in the decoder's channel order (blue,
    green, red). Files that are no images are left out, or kept with height -1.
    """
    reader = spark.read.format("image").option("dropInvalid", drop_invalid)
    raw = _load(reader, root, pattern, recursive, "image.origin")
    images = raw.select(
        F.col("image.origin").alias("path"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.data").alias("pixels"),
    )
    return images.withColumn(key, parse_key("path", key_pattern)) if key else images


def decode_bitmap(data: bytes) -> np.ndarray:
    """An uncompressed bitmap of 24 or 32 bits a pixel as a height x width x channels array, top down, blue first."""
    if len(data) < 54 or data[:2] != b"BM":
        raise ValueError("not a bitmap")
    start, = struct.unpack_from("<I", data, 10)
    _, width, height, _, bits, packing = struct.unpack_from("<IiiHHI", data, 14)
    if bits not in (24, 32) or packing or width <= 0 or not height:
        raise ValueError("not an uncompressed bitmap of 24 or 32 bits")
    channels, rows = bits // 8, abs(height)
    line = -(-width * channels // 4) * 4
    if len(data) < start + rows * line:
        raise ValueError("a bitmap that ends early")
    pixels = np.frombuffer(data, np.uint8, rows * line, start).reshape(rows, line)[:, : width * channels]
    return (pixels if height < 0 else pixels[::-1]).reshape(rows, width, channels)


def decode_picture(data: bytes) -> np.ndarray:
    """A picture of any format that Pillow knows, blue first; uncompressed bitmaps need no Pillow."""
    if data[:2] == b"BM":
        return decode_bitmap(data)
    from io import BytesIO

    from PIL import Image

    with Image.open(BytesIO(data)) as picture:
        if picture.mode == "L":
            return np.asarray(picture)[:, :, None]
        alpha = "A" in picture.mode or "transparency" in picture.info
        rgb = np.asarray(picture.convert("RGBA" if alpha else "RGB"))
        return rgb[:, :, [2, 1, 0, 3][: rgb.shape[2]]]


def decoder() -> Callable[[bytes], np.ndarray] | None:
    """:func:`decode_picture` where Pillow is installed, else None."""
    return decode_picture if importlib.util.find_spec("PIL") else None


def decode_content(df: DataFrame, decode: Callable[[bytes], np.ndarray], content: str = "content") -> DataFrame:
    """Add ``height, width, channels, pixels`` of the picture in ``content``; what ``decode`` can't read has height -1, as in :func:`scan_images`."""
    shape = [StructField(c, IntegerType()) for c in ("height", "width", "channels")]
    schema = StructType([*df.schema.fields, *shape, StructField("pixels", BinaryType())])

    def one(data: bytes | None) -> tuple[int, int, int, bytes]:
        try:
            image = decode(data or b"")
        except ImportError:
            raise
        except Exception:  # whatever a decoder says about broken files
            return -1, -1, -1, b""
        return *image.shape, np.ascontiguousarray(image, np.uint8).tobytes()

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            # Pixels are larger than files, so they are handed on a few at a time.
            done, held, first = [], 0, 0
            for place, data in enumerate(frame[content], 1):
                done.append(one(data))
                held += len(done[-1][3]) + len(data or b"")
                if held >= BATCH_BYTES or place == len(frame):
                    columns = dict(zip(("height", "width", "channels", "pixels"), zip(*done, strict=True), strict=True))
                    yield frame.iloc[first:place].assign(**{name: list(values) for name, values in columns.items()})
                    done, held, first = [], 0, place

    return df.mapInPandas(batches, schema)


def to_rgb(pixels: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Decoded pixels (grey, BGR or BGRA) as a height x width x 3 RGB array."""
    image = np.frombuffer(pixels, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return np.repeat(image, 3, axis=2)
    return image[:, :, 2::-1]


def cut_box(image: np.ndarray, x: int, y: int, size: int) -> np.ndarray:
    """The square box at ``(x, y)``; the part outside of the image is zero."""
    box = np.zeros((size, size, image.shape[2]), image.dtype)
    left, top = max(x, 0), max(y, 0)
    right, bottom = min(x + size, image.shape[1]), min(y + size, image.shape[0])
    if left < right and top < bottom:
        box[top - y : bottom - y, left - x : right - x] = image[top:bottom, left:right]
    return box


def crop_images(boxed: DataFrame, size: int, keep: list[str], output: str = "pixels") -> DataFrame:
    """Cut a box out of every decoded image row.

    ``boxed`` holds the columns of :func:`scan_images` and the box origin
    ``x0``, ``y0``; the result is ``keep`` plus the RGB bytes of the box.
    """
    kept = [boxed.schema[c] for c in keep]
    schema = StructType(kept + [StructField(output, BinaryType())])

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            boxes = [
                cut_box(to_rgb(p, h, w, c), int(x), int(y), size).tobytes()
                for p, h, w, c, x, y in zip(
                    frame["pixels"], frame["height"], frame["width"], frame["channels"], frame["x0"], frame["y0"]
                )
            ]
            yield frame[keep].assign(**{output: boxes})

    needed = list(dict.fromkeys([*keep, "pixels", "height", "width", "channels", "x0", "y0"]))
    return boxed.select(*needed).mapInPandas(batches, schema)
