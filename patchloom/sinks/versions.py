"""Keyed feature tables in versions: readers stay on one while the next is written.

A version is a small file that names, for each bucket, the folder with its rows.
An upsert writes the merged rows of the buckets it touches to a new folder, once,
and then creates the next version file, which is what makes them visible.
Creating a file that exists fails, so of two writers on one version the second
notices the first: it goes on if they touched different buckets, and is refused if not.
Old versions stay readable until they are expired.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from patchloom.session import discard, path_exists, scratch_path
from patchloom.sinks.feature_table import BROADCAST_BYTES, BUCKET, FeatureTable, KeyViolation, check_updates
from patchloom.sources.batches import materialise

# Times that a writer moves on to a newer version that touched other buckets.
ATTEMPTS = 20


class VersionConflict(RuntimeError):
    """Another writer has changed a bucket since the version that this one started from."""


class VersionExists(FileExistsError):
    """A version of this number is there already."""


@dataclass(frozen=True)
class Manifest:
    """What a version consists of: for each filled bucket the folder of its rows."""

    version: int
    table: FeatureTable
    schema: StructType
    folders: Mapping[int, str]
    touched: tuple[int, ...]

    def to_json(self) -> str:
        table = {k: getattr(self.table, k) for k in ("name", "primary_keys", "time_key", "buckets", "bucket_by_time")}
        return json.dumps(
            {"version": self.version, "table": table, "schema": self.schema.jsonValue(), "folders": self.folders, "touched": self.touched}
        )

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        held = json.loads(text)
        table = held["table"] | {"primary_keys": tuple(held["table"]["primary_keys"])}
        folders = {int(b): f for b, f in held["folders"].items()}
        return cls(held["version"], FeatureTable(**table), StructType.fromJson(held["schema"]), folders, tuple(held["touched"]))


@dataclass(frozen=True)
class Staged:
    """Merged buckets that no version names yet."""

    base: Manifest
    folder: str
    touched: tuple[int, ...]


class _Files:
    """Whole small files on the file system that Spark uses for a path."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        self.system = self._path(root).getFileSystem(self.conf)

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> dict[str, float]:
        """Names in a folder, with the second of their last change."""
        if not self.system.exists(self._path(folder)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in self.system.listStatus(self._path(folder))}

    def read(self, path: str) -> str:
        stream = self.system.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        self.system.delete(self._path(path), True)

    def create(self, path: str, text: str) -> None:
        """Make a file with all of its text at once; VersionExists if it is there."""
        whole = urlsplit(self.system.makeQualified(self._path(path)).toString())
        if whole.scheme == "file":
            self.link(re.sub("^/+", "/", whole.path), text)
        else:
            self.rename(path, text)

    def link(self, path: str, text: str) -> None:
        """On a local disk: a hidden file is linked into place, which fails if the name is taken."""
        folder, name = os.path.split(path)
        hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
        os.makedirs(folder, exist_ok=True)
        with open(hidden, "w", encoding="utf-8") as file:
            file.write(text)
            file.flush()
            os.fsync(file.fileno())
        try:
            os.link(hidden, path)
        except FileExistsError:
            raise VersionExists(path) from None
        finally:
            os.unlink(hidden)

    def rename(self, path: str, text: str) -> None:
        """Elsewhere: a hidden file is renamed without leave to overwrite, which is one step where renames are atomic."""
        folder, name = path.rsplit("/", 1)
        hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
        stream = self.system.create(self._path(hidden), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system.getUri(), self.conf)
        never_overwrite = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._path(hidden), self._path(path), never_overwrite)
        except Py4JJavaError as error:
            self.delete(hidden)
            if self.system.exists(self._path(path)):
                raise VersionExists(path) from error
            raise


class VersionedTable:
    """A feature table below a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = _Files(spark, path)

    @classmethod
    def create(cls, df: DataFrame, table: FeatureTable, path: str) -> VersionedTable:
        """The table with version 0, which is empty and has the columns of ``df``; one with the same key and columns is left as it is."""
        found = cls(df.sparkSession, path)
        missing = [k for k in table.all_keys if k not in df.columns]
        if missing:
            raise KeyViolation(f"key columns {missing} are not in the data")
        schema = StructType([StructField(f.name, f.dataType) for f in df.schema])
        try:
            found._write(Manifest(0, table, schema, {}, ()))
        except VersionExists:
            held = found.manifest()
            same = {f.name: f.dataType for f in held.schema} == {f.name: f.dataType for f in schema}
            if held.table.all_keys != table.all_keys or not same:
                raise ValueError(f"{path} holds a table with another key or other columns") from None
        return found

    def versions(self) -> list[int]:
        """Numbers of the versions that can be read."""
        names = self.files.names(f"{self.path}/versions")
        named = (re.fullmatch(r"(\d{10})\.json", name) for name in names)
        return sorted(int(m[1]) for m in named if m and f"{m[1]}.expired" not in names)

    def latest(self) -> int:
        found = self.versions()
        if not found:
            raise ValueError(f"there is no versioned table at {self.path}")
        return found[-1]

    def manifest(self, version: int | None = None) -> Manifest:
        number = self.latest() if version is None else version
        if version is not None and number not in self.versions():
            raise ValueError(f"version {number} of {self.path} was never written or is expired")
        return self._load(number)

    def read(self, version: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version, by default of the latest there is now.

        The result stays on that version whatever is written later, as long as it isn't expired.
        """
        held = self.manifest(version)
        found = self._rows(held, held.folders).drop(BUCKET)
        return found.select(*columns) if columns else found

    def changes(self, since: int, version: int | None = None) -> DataFrame:
        """Rows of a version whose key is new or whose values differ since an earlier one; only buckets in other folders are read."""
        old, new = self.manifest(since), self.manifest(version)
        moved = [b for b, folder in new.folders.items() if old.folders.get(b) != folder]
        before = self._rows(old, [b for b in moved if b in old.folders]).drop(BUCKET)
        return self._rows(new, moved).drop(BUCKET).exceptAll(before)

    def prepare(self, updates: DataFrame, base: int | None = None) -> Staged | None:
        """Merge a batch with the buckets it touches, in a folder of its own; None for an empty batch.

        Null and repeated keys are errors. The batch is stored once, because its
        buckets are looked at before it is merged, and is deleted afterwards.
        """
        held = self.manifest(base)
        wanted, keys = [f.name for f in held.schema], list(held.table.all_keys)
        if set(wanted) != set(updates.columns):
            raise ValueError(f"columns {sorted(set(wanted) ^ set(updates.columns))} differ from those of {self.path}")
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in held.schema]
        stored = scratch_path(self.spark, "updates")
        batch = materialise(updates.select(*typed).withColumn(BUCKET, held.table.bucket()), stored)
        try:
            n_rows, n_bytes, touched = check_updates(batch, keys)
            if not n_rows:
                return None
            old = self._rows(held, [b for b in touched if b in held.folders])
            names = batch.select(BUCKET, *keys)
            kept = old.join(F.broadcast(names) if n_bytes <= BROADCAST_BYTES else names, [BUCKET, *keys], "left_anti")
            # Old rows stay in the tasks that read them; new ones are gathered by bucket, large buckets in several tasks.
            merged = kept.select(*wanted, BUCKET).unionByName(batch.select(*wanted, BUCKET).hint("rebalance", BUCKET))
            folder = uuid.uuid4().hex
            merged.write.partitionBy(BUCKET).parquet(f"{self.path}/data/{folder}")
        finally:
            if path_exists(self.spark, stored):
                discard(self.spark, stored)
        return Staged(held, folder, tuple(touched))

    def commit(self, staged: Staged) -> int:
        """Make staged buckets the next version; its number.

        Versions that others wrote meanwhile are built upon if they touched other
        buckets. If one touched the same, the merge is out of date: VersionConflict, and nothing is changed.
        """
        base = staged.base
        for _ in range(ATTEMPTS):
            folders = dict(base.folders) | {b: staged.folder for b in staged.touched}
            following = Manifest(base.version + 1, base.table, base.schema, folders, staged.touched)
            try:
                self._write(following)
                return following.version
            except VersionExists:
                other = self._load(base.version + 1)
                common = sorted(set(other.touched) & set(staged.touched))
                if common:
                    self.files.delete(f"{self.path}/data/{staged.folder}")
                    raise VersionConflict(f"version {other.version} has changed buckets {common[:10]} since version {staged.base.version}") from None
                base = other
        raise VersionConflict(f"{ATTEMPTS} versions were written meanwhile; try again")

    def upsert(self, updates: DataFrame) -> int:
        """Insert new keys and replace existing ones; the version that holds them."""
        staged = self.prepare(updates)
        return self.latest() if staged is None else self.commit(staged)

    def expire(self, keep: int = 2, unfinished_after: float = 7 * 86400) -> list[int]:
        """Delete all but the last ``keep`` versions and the folders that only they name; their numbers.

        Folders that no version names belong to writers at work. They go when they
        have not changed for ``unfinished_after`` seconds.
        """
        if keep < 1:
            raise ValueError("at least one version has to stay")
        numbers = self.versions()
        gone, stay = numbers[:-keep], numbers[-keep:]
        needed = {f for n in stay for f in self._load(n).folders.values()}
        doomed = {f for n in gone for f in self._load(n).folders.values()} - needed
        for n in gone:
            # Its file stays, so that the number is not given again and late writers see what it touched.
            self.files.create(self._file(n).replace(".json", ".expired"), "")
        for folder, changed in self.files.names(f"{self.path}/data").items():
            if folder in doomed or (folder not in needed and time.time() - changed > unfinished_after):
                self.files.delete(f"{self.path}/data/{folder}")
        return gone

    def _file(self, version: int) -> str:
        return f"{self.path}/versions/{version:010d}.json"

    def _load(self, version: int) -> Manifest:
        return Manifest.from_json(self.files.read(self._file(version)))

    def _write(self, manifest: Manifest) -> None:
        self.files.create(self._file(manifest.version), manifest.to_json())

    def _rows(self, held: Manifest, buckets: Sequence[int]) -> DataFrame:
        """Rows of some buckets with their number, in one scan of the folders that the version names."""
        paths = [f"{self.path}/data/{held.folders[b]}/{BUCKET}={b}" for b in sorted(buckets)]
        if not paths:
            return self.spark.createDataFrame([], StructType([*held.schema.fields, StructField(BUCKET, IntegerType())]))
        files = self.spark.read.schema(held.schema).parquet(*paths)
        return files.withColumn(BUCKET, F.regexp_extract("_metadata.file_path", rf"/{BUCKET}=(\d+)/[^/]*$", 1).cast("int"))


def resolver(spark: SparkSession, tables: Mapping[str, tuple[str, int | None]]):
    """For feature lookups: name to (folder, version) as a function from names to rows, each pinned when this is called."""
    held = {name: VersionedTable(spark, path) for name, (path, _) in tables.items()}
    pinned = {name: held[name].latest() if version is None else version for name, (_, version) in tables.items()}
    return lambda name: held[name].read(pinned[name])
