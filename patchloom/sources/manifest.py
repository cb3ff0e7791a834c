"""Files named by a table: listed by tasks, read in parts of like size.

A manifest is a stored table of file paths and any other columns. It is divided
into parts by the bytes of the files, and a task reads the files of one part, so
a join or filter on the table decides what is opened. The driver sees
one line per part and never lists a folder.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from patchloom.functions.keys import PATCH_KEY_PATTERN, parse_key
from patchloom.session import scratch_path
from patchloom.sources.files import Opener

FORMAT = "file_manifest"
# Bytes of files, and rows, that one part holds at most; a larger file is a part of its own.
PART_BYTES, PART_ROWS = 128 << 20, 10_000
# Bytes of files, and rows, handed on at once.
BATCH_BYTES, BATCH_ROWS = 32 << 20, 1024
# Bytes of a row group of the stored rows, so that a part's reader meets few rows of other parts.
GROUP_BYTES = 1 << 20
_FOUND = StructType([
    StructField("path", StringType()), StructField("length", LongType()), StructField("modificationTime", TimestampType()),
])


def _children(name: str, last: bool):
    """Batch function: folders to those entries in them whose names fit, folders or, at the last step, files."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        opener = Opener()
        for frame in frames:
            for folder in frame["path"]:
                filesystem, location = opener(folder)
                wanted = fs.FileType.File if last else fs.FileType.Directory
                found = [
                    (f"{folder.rstrip('/')}/{e.base_name}", e.size, e.mtime)
                    for e in filesystem.get_file_info(fs.FileSelector(location))
                    # Hidden names, as Spark's own file scans have it.
                    if e.type == wanted and not e.base_name.startswith(("_", ".")) and fnmatchcase(e.base_name, name)
                ]
                paths, sizes, times = zip(*found, strict=True) if found else ((), (), ())
                yield pd.DataFrame(
                    {"path": pd.Series(paths, dtype=object), "length": pd.Series(sizes, dtype="Int64"), "modificationTime": pd.to_datetime(pd.Series(times, dtype="datetime64[ns, UTC]"))}
                )

    return work


def list_files(
    spark: SparkSession, root: str, pattern: str = "*/*/*.jpg", key: str | None = "imid", key_pattern: str = PATCH_KEY_PATTERN, tasks: int | None = None
) -> DataFrame:
    """``(path, length, modificationTime)`` and the key parsed from the name, of the files that ``pattern`` means below ``root``.

    Folders are listed level by level inside tasks, one folder at a time, so that
    neither the driver nor a task holds the whole listing. Lazy: nothing is listed before the result is used.
    """
    parts = pattern.split("/")
    while len(parts) > 1 and not re.search(r"[*?\[]", parts[0]):
        root = f"{root.rstrip('/')}/{parts.pop(0)}"
    spread = tasks or spark.sparkContext.defaultParallelism
    found = spark.createDataFrame([(root.rstrip("/"),)], "path string").coalesce(1)
    for place, name in enumerate(parts, 1):
        found = found.select("path").mapInPandas(_children(name, place == len(parts)), _FOUND)
        if place < len(parts):
            found = found.repartition(spread, "path")
    return found.withColumn(key, parse_key("path", key_pattern)) if key else found


def write_manifest(files: DataFrame, path: str, part_bytes: int = PART_BYTES, part_rows: int = PART_ROWS) -> None:
    """Store a table with columns ``path`` and ``length``, divided into parts.

    Rows are dealt out by ranges of their path, so rows of one file are neighbours
    and the file is read once for them; a file that very many rows name is divided over
    several parts by ``part_rows``. Rows without a path are refused.
    """
    schema = StructType([*files.schema.fields, StructField("part", LongType())])

    def numbered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, held, rows, before = TaskContext.get().partitionId() << 32, 0, 0, None
        for frame in frames:
            parts = []
            for name, length in zip(frame["path"], frame["length"], strict=True):
                size = 0 if name == before or pd.isna(length) else int(length)
                if rows and (held + size > part_bytes or rows >= part_rows):
                    part, held, rows = part + 1, 0, 0
                held, rows, before = held + size, rows + 1, name
                parts.append(part)
            yield frame.assign(part=pd.Series(parts, index=frame.index, dtype="int64"))

    named = F.when(F.col("path").isNull(), F.raise_error(F.lit("a row of the manifest has no path")).cast("string")).otherwise(F.col("path"))
    plain = [f.name for f in files.schema.fields if f.name != "path"]
    dealt = files.withColumn("path", named).repartitionByRange(F.col("path"), F.xxhash64(*plain)).sortWithinPartitions("path")
    dealt.mapInPandas(numbered, schema).write.option("parquet.block.size", GROUP_BYTES).parquet(f"{path}/rows")
    stored = files.sparkSession.read.schema(schema).parquet(f"{path}/rows")
    listed = stored.groupBy(F.col("_metadata.file_path").alias("file"), "part").agg(F.count("*").alias("n_rows"))
    listed.coalesce(1).write.parquet(f"{path}/parts")


@dataclass
class _Part(InputPartition):
    file: str
    part: int

    def __init__(self, file: str, part: int):
        super().__init__((file, part))
        self.file, self.part = file, part


class _Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, only: dict[str, list]):
        self.path, self.schema, self.only = path.rstrip("/"), schema, only

    def partitions(self) -> list[InputPartition]:
        import pyarrow.dataset as ds

        filesystem, location = Opener()(f"{self.path}/parts")
        rows = ds.dataset(location, filesystem=filesystem, format="parquet", schema=pa.schema([("file", pa.string()), ("part", pa.int64())])).to_table()
        return [_Part(r["file"], r["part"]) for r in rows.sort_by([("part", "ascending")]).to_pylist()]

    def read(self, partition: _Part | None) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        if partition is None:  # no part at all
            return
        opener = Opener()
        wanted = to_arrow_schema(self.schema)
        test = pc.field("part") == partition.part
        for name, values in self.only.items():
            test &= pc.field(name).isin(pa.array(values, wanted.field(name).type))
        filesystem, location = opener(partition.file)
        body, before = b"", None
        with filesystem.open_input_file(location) as stored:
            for rows in _rows_of(stored, partition.part, [name for name in wanted.names if name != "content"], test):
                bodies, first, held = [], 0, 0
                for place, name in enumerate(rows.column("path").to_pylist(), 1):
                    if name != before:
                        source, where = opener(name)
                        with source.open_input_stream(where) as stream:
                            body, before = stream.read(), name
                    bodies.append(body)
                    held += len(body)
                    if held >= BATCH_BYTES or place == len(rows):
                        table = rows.slice(first, place - first).append_column("content", pa.array(bodies, pa.binary()))
                        yield from table.select(wanted.names).cast(wanted).combine_chunks().to_batches()
                        bodies, first, held = [], place, 0


def _rows_of(stored: pa.NativeFile, part: int, columns: list[str], test: pc.Expression) -> Iterator[pa.Table]:
    """A part's rows that pass ``test``, a few at a time, out of those row groups that can hold any."""
    import pyarrow.parquet as pq

    file = pq.ParquetFile(stored)
    place = file.schema_arrow.names.index("part")
    wanted = []
    for group in range(file.num_row_groups):
        found = file.metadata.row_group(group).column(place).statistics
        if found is None or not found.has_min_max or found.min <= part <= found.max:
            wanted.append(group)
    for batch in file.iter_batches(BATCH_ROWS, wanted, [*columns, "part"], use_threads=False):
        rows = pa.Table.from_batches([batch]).filter(test).select(columns)
        if len(rows):
            yield rows


class FileManifest(DataSource):
    """``spark.read.format("file_manifest").schema(...).load(path)``: the rows of a manifest with the bytes of their files as ``content``.

    The option ``only`` is a JSON object from columns to lists of the values to read. Filters of a
    query are not taken over: Spark keeps the filters that a Python source took for one query with the source, and so for the next query on it.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        raise ValueError("give the schema of the manifest and a binary column content, or use read_manifest")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], schema, json.loads(self.options.get("only", "{}")))


def read_manifest(spark: SparkSession, path: str, only: Mapping[str, Sequence] | None = None) -> DataFrame:
    """The rows of a stored manifest, each with its file's bytes in ``content``.

    ``only`` names columns of texts, numbers or booleans and the values wanted of
    them; other rows' files are not opened. For anything else filter or join the table before it is stored.
    """
    rows = spark.read.parquet(f"{path}/rows").drop("part")
    unknown = set(only or {}) - set(rows.columns)
    if unknown:
        raise ValueError(f"the manifest has no columns {sorted(unknown)}")
    spark.dataSource.register(FileManifest)
    schema = StructType([*rows.schema.fields, StructField("content", BinaryType())])
    listed = json.dumps({name: list(values) for name, values in (only or {}).items()})
    return spark.read.format(FORMAT).schema(schema).option("only", listed).load(path)


def attach_files(df: DataFrame, part_bytes: int = PART_BYTES, keep: Sequence[str] | None = None) -> DataFrame:
    """Rows with ``path`` and ``length`` to rows with ``content``, by way of a manifest in the scratch folder, which is the caller's to empty."""
    path = scratch_path(df.sparkSession, "manifest")
    write_manifest(df.select(*keep, "path", "length") if keep else df, path, part_bytes)
    return read_manifest(df.sparkSession, path)
