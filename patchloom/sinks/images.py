"""One image file per row."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from patchloom.sources.files import Opener


def raw_bitmap(pixels: bytes, height: int, width: int) -> bytes:
    """RGB rows, top down, as an uncompressed bitmap file: a header and the pixels.

    The file keeps every value, and Spark's image scan reads it.
    """
    rows = np.frombuffer(pixels, np.uint8).reshape(height, width, 3)[::-1, :, ::-1]
    padded = np.pad(rows.reshape(height, width * 3), ((0, 0), (0, -width * 3 % 4)))
    body = padded.tobytes()
    header = struct.pack("<2sIHHI", b"BM", 54 + len(body), 0, 0, 54)
    info = struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, len(body), 2835, 2835, 0, 0)
    return header + info + body


class FileWriter:
    """Writes whole files under a temporary name and moves them; one client per scheme and host, folders made once."""

    def __init__(self) -> None:
        self.open = Opener()
        self.folders: set[str] = set()

    def __call__(self, target: str, data: bytes) -> None:
        filesystem, location = self.open(target)
        folder, name = location.rsplit("/", 1)
        if folder not in self.folders:
            filesystem.create_dir(folder, recursive=True)
            self.folders.add(folder)
        partial = f"{folder}/.{name}.{uuid.uuid4().hex}"
        with filesystem.open_output_stream(partial) as stream:
            stream.write(data)
        filesystem.move(partial, location)


def save_images(df: DataFrame, path: str, pixels: str, height: int, width: int, keep: list[str]) -> DataFrame:
    """Write each row's RGB pixels to the file its ``path`` column names.

    Returns ``keep`` plus ``path``; files are written when that is evaluated.
    A file is written under a temporary name and moved, so a task that runs
    twice leaves one whole file.
    """
    schema = StructType([df.schema[c] for c in keep] + [StructField(path, StringType())])

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        write = FileWriter()
        for frame in frames:
            for target, data in zip(frame[path], frame[pixels]):
                write(target, raw_bitmap(data, height, width))
            yield frame[[*keep, path]]

    return df.select(*keep, path, pixels).mapInPandas(batches, schema)


def save_files(df: DataFrame, path: str, content: str) -> DataFrame:
    """Write each row's bytes to the file its ``path`` column names; returns the paths, lazily like :func:`save_images`."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        write = FileWriter()
        for frame in frames:
            for target, data in zip(frame[path], frame[content]):
                write(target, data)
            yield frame[[path]]

    return df.select(path, content).mapInPandas(batches, StructType([StructField(path, StringType())]))
