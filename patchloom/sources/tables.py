"""Table, SQL-text and CSV scans."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from patchloom.sources.files import open_location


def scan_path(spark: SparkSession, path: str, columns: Sequence[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """A table by path. The format is named, never taken from the session default."""
    df = spark.read.format(fmt).load(path)
    return df.select(*columns) if columns else df


def scan_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table by one-, two- or three-level name."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def scan_sql(spark: SparkSession, text: str, args: dict | list | None = None) -> DataFrame:
    """The result of a SQL text; values go in as named or positional ``args``."""
    return spark.sql(text, args=args) if args else spark.sql(text)


def read_indexed_csv(
    spark: SparkSession, paths: str | Sequence[str], fmt: str = "csv", schema: StructType | str | None = None
) -> DataFrame:
    """CSV files with a header, the first column an index that is dropped.

    Files with the same header are read in one scan. Files whose columns are
    ordered differently are combined by name, absent columns becoming null;
    ``schema`` (index column included) avoids the inference pass.
    """
    if fmt != "csv":
        raise ValueError(f"format {fmt!r} is not supported, only 'csv'")
    files = [paths] if isinstance(paths, str) else list(paths)
    # With enforceSchema off, a file whose header differs from the schema is an error.
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if schema is not None:
        frame = reader.schema(schema).csv(files)
        return frame.drop(frame.columns[0])
    frames = []
    for group in _same_header(spark, files):
        frame = reader.option("inferSchema", True).csv(group)
        frames.append(frame.drop(frame.columns[0]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _same_header(spark: SparkSession, files: list[str]) -> list[list[str]]:
    """The given files or folders grouped by their first line, which tasks read in parallel."""
    if len(files) == 1:
        return [files]

    def first_lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(header=[_first_line(path) for path in frame["path"]])

    # A task opens a few hundred files, so tasks follow from the number of files.
    named = spark.createDataFrame([(f,) for f in files], "path string").repartition(max(min(len(files), 256), len(files) // 256))
    found = named.mapInPandas(first_lines, "path string, header string").collect()
    groups: dict[str, list[str]] = {}
    place = {path: i for i, path in enumerate(files)}
    for row in sorted(found, key=lambda row: place[row["path"]]):
        groups.setdefault(row["header"], []).append(row["path"])
    return list(groups.values())


def _first_line(path: str) -> str:
    """Header of a file, or of the first data file in a folder."""
    from pyarrow import fs

    filesystem, location = open_location(path)
    if filesystem.get_file_info(location).type == fs.FileType.Directory:
        inside = filesystem.get_file_info(fs.FileSelector(location))
        data = [f.path for f in inside if f.is_file and not f.base_name.startswith(("_", "."))]
        location = min(data)
    with filesystem.open_input_stream(location) as stream:
        line = b""
        while b"\n" not in line:
            more = stream.read(65536)
            if not more:
                break
            line += more
    return line.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r")


def explode_array(df: DataFrame, keys: Sequence[str], array: str, pos: str = "pos", value: str = "value") -> DataFrame:
    """One row per array element with its place."""
    return df.select(*keys, F.posexplode(array).alias(pos, value))
