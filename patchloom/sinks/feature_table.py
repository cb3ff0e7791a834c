"""Keyed feature tables: create, upsert, read.

A feature table is a catalog table whose rows are identified by a primary key.
It is partitioned by a hash bucket of its whole key, time key included, so an
upsert reads and replaces only the buckets its batch touches, and all times of a
busy key are spread over the buckets. A bucket is written by as many tasks as
its bytes ask for. The key list is kept in the table properties.

An upsert first writes its merged buckets to the shared scratch folder and then
replaces the touched partitions from there. While that lasts, the table property
``patchloom.pending`` names the staged folder. If it fails, :func:`publish`
repeats that last step; repeating a whole upsert is safe too, since equal keys replace each other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.window import Window

from patchloom.session import discard, scratch_path
from patchloom.sinks.tables import ensure_schema_of, quoted
from patchloom.sources.batches import materialise

BUCKET = "_bucket"
KEYS_PROPERTY = "patchloom.primary_keys"
TIME_PROPERTY = "patchloom.time_key"
BUCKETS_PROPERTY = "patchloom.buckets"
# Tables made before the time key took part lack this property and keep their layout.
LAYOUT_PROPERTY = "patchloom.bucket_by"
PENDING_PROPERTY = "patchloom.pending"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"

# The keys of an update batch are broadcast when their measured size, with
# ROW_OVERHEAD bytes added for every row, stays within this many bytes. Larger
# batches are merged by a shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 128

# Stored bytes that one task writes into a bucket, about.
FILE_BYTES = 256 * 1024 * 1024
_FILE = "_file"


class KeyViolation(ValueError):
    """A primary key is null or occurs more than once."""


def parse_keys(text: str) -> tuple[str, ...]:
    """Key columns from a comma-separated setting."""
    return tuple(part.strip() for part in text.split(",") if part.strip())


@dataclass(frozen=True)
class FeatureTable:
    """Name, key and layout of a feature table."""

    name: str
    primary_keys: tuple[str, ...]
    time_key: str | None = None
    buckets: int = 16
    bucket_by_time: bool = True

    @property
    def all_keys(self) -> tuple[str, ...]:
        return self.primary_keys + ((self.time_key,) if self.time_key else ())

    def bucket(self) -> Column:
        """Bucket of a row, by its whole key."""
        keys = self.all_keys if self.bucket_by_time else self.primary_keys
        return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(self.buckets)).cast("int")


def describe(spark: SparkSession, name: str) -> FeatureTable:
    """The descriptor kept in the table's properties."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()
    properties = {row["key"]: row["value"] for row in rows}
    if KEYS_PROPERTY not in properties:
        raise ValueError(f"{name} is not a feature table")
    return FeatureTable(
        name,
        parse_keys(properties[KEYS_PROPERTY]),
        properties.get(TIME_PROPERTY),
        int(properties[BUCKETS_PROPERTY]),
        properties.get(LAYOUT_PROPERTY) == "all",
    )


def time_key_of(spark: SparkSession, name: str) -> str | None:
    """The time key of a feature table; None for one without, and for any other table or view."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType in ("TEMPORARY", "VIEW"):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()
    return {row["key"]: row["value"] for row in rows}.get(TIME_PROPERTY)


def create_feature_table(
    df: DataFrame, table: FeatureTable, location: str | None = None
) -> FeatureTable:
    """Create the empty table for the columns of ``df``.

    Nothing happens when a table with this name, key and columns exists; one
    with another key or other columns is an error. Buckets that already lie at
    ``location`` become part of the table.
    """
    spark = df.sparkSession
    ensure_schema_of(spark, table.name)
    missing = [k for k in table.all_keys if k not in df.columns]
    if missing:
        raise KeyViolation(f"key columns {missing} are not in the data")
    if spark.catalog.tableExists(table.name):
        existing = describe(spark, table.name)
        current = read_feature_table(spark, table.name).schema
        same = {f.name: f.dataType for f in current} == {f.name: f.dataType for f in df.schema}
        if existing.all_keys != table.all_keys or not same:
            raise ValueError(f"{table.name} exists with another key or other columns")
        return existing
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema)
    properties = {KEYS_PROPERTY: ",".join(table.primary_keys), BUCKETS_PROPERTY: str(table.buckets)}
    properties[LAYOUT_PROPERTY] = "all" if table.bucket_by_time else "primary"
    if table.time_key:
        properties[TIME_PROPERTY] = table.time_key
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    at = ""
    if location:
        at = f" LOCATION '{location}'"
        layout = StructType([*df.schema.fields, StructField(BUCKET, IntegerType())])
        spark.createDataFrame([], layout).write.mode("append").partitionBy(BUCKET).parquet(location)
    spark.sql(
        f"CREATE TABLE {quoted(table.name)} ({columns}, {BUCKET} INT) USING parquet "
        f"PARTITIONED BY ({BUCKET}){at} TBLPROPERTIES ({listed})"
    )
    if location:
        spark.sql(f"ALTER TABLE {quoted(table.name)} RECOVER PARTITIONS")
    return table


def read_feature_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The table without its bucket column."""
    df = spark.table(name)
    return df.select(*columns) if columns else df.drop(BUCKET)


def merge_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not updated, and all update rows; lazy.

    Both sides must be unique by ``keys``. The anti join becomes a broadcast or
    a sort-merge join, whichever the sizes allow.
    """
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.select(*updates.columns).unionByName(updates)


def _by_file(df: DataFrame, keys: Sequence[str], n_buckets: int, stored_bytes: int) -> DataFrame:
    """Rows dealt to the tasks that write their bucket, FILE_BYTES each; column ``_file`` tells a bucket's tasks apart."""
    files = max(1, -(-stored_bytes // (FILE_BYTES * max(1, n_buckets))))
    share = F.pmod(F.xxhash64(F.lit("file"), *keys), F.lit(files)).cast("int")
    return df.withColumn(_FILE, share).repartition(files * max(1, n_buckets), BUCKET, _FILE)


def _merge_by_shuffle(target: DataFrame, updates: DataFrame, keys: Sequence[str], n_buckets: int, stored_bytes: int) -> DataFrame:
    """``merge_rows`` with one shuffle on the bucket that the write needs anyway."""
    both = target.withColumn("_newer", F.lit(0)).unionByName(updates.withColumn("_newer", F.lit(1)))
    newest = Window.partitionBy(BUCKET, _FILE, *keys).orderBy(F.desc("_newer"))
    return (
        _by_file(both, keys, n_buckets, stored_bytes)
        .withColumn("_rank", F.row_number().over(newest))
        .filter("_rank = 1")
        .drop("_rank", "_newer", _FILE)
    )


def stored_size(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def publish(spark: SparkSession, name: str, merged_path: str, gather: bool = False) -> None:
    """Replace the buckets present in ``merged_path``; safe to repeat.

    ``gather`` brings the rows of a bucket together first, for files that are
    not laid out by bucket yet.
    """
    target = spark.table(name)
    merged = spark.read.schema(target.schema).parquet(merged_path).select(*target.columns)
    if gather:
        keys = describe(spark, name).all_keys
        n_buckets = merged.select(BUCKET).distinct().count()
        merged = _by_file(merged, keys, n_buckets, stored_size(spark, merged_path)).select(*target.columns)
    spark.sql(f"ALTER TABLE {quoted(name)} SET TBLPROPERTIES ('{PENDING_PROPERTY}' = '{merged_path}')")
    before = spark.conf.get(OVERWRITE_MODE)
    # insertInto takes this mode from the session only; in static mode it would
    # remove the untouched buckets as well.
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        merged.write.insertInto(name, overwrite=True)
    except Exception as error:
        error.add_note(f"staged at {merged_path}; publish() on {name} repeats the last step")
        raise
    finally:
        spark.conf.set(OVERWRITE_MODE, before)
    spark.sql(f"ALTER TABLE {quoted(name)} UNSET TBLPROPERTIES IF EXISTS ('{PENDING_PROPERTY}')")
    spark.catalog.refreshTable(name)


def pending(spark: SparkSession, name: str) -> str | None:
    """The staged folder of an upsert whose last step did not end."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()
    return {row["key"]: row["value"] for row in rows}.get(PENDING_PROPERTY)


def compact(spark: SparkSession, name: str) -> None:
    """Rewrite every bucket into files of about FILE_BYTES, after many small upserts."""
    target = spark.table(name)
    path = scratch_path(spark, "compact")
    target.write.partitionBy(BUCKET).parquet(path)
    if _filled_buckets(spark, name):
        publish(spark, name, path, gather=True)
    discard(spark, path)


def _filled_buckets(spark: SparkSession, name: str) -> set[int]:
    """Buckets that have a partition, from the catalog alone."""
    rows = spark.sql(f"SHOW PARTITIONS {quoted(name)}").collect()
    return {int(row["partition"].rsplit("=", 1)[1]) for row in rows}


def check_updates(updates: DataFrame, keys: Sequence[str]) -> tuple[int, int, list[int]]:
    """Row count, size of the keys and touched buckets; null or repeated keys raise.

    One aggregate by key, combined map-side, so even a key repeated in a third
    of the rows is a single count per task.
    """
    null_key = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0))
    key_bytes = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(ROW_OVERHEAD))
    per_key = updates.groupBy(BUCKET, *keys).agg(F.count(F.lit(1)).alias("n"))
    row = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, 1).otherwise(0)), F.lit(0)).alias("n_repeated"),
        F.coalesce(F.sum(null_key * F.col("n")), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum(key_bytes), F.lit(0)).alias("n_bytes"),
        F.collect_set(BUCKET).alias("touched"),
    ).first()
    if row["n_null"]:
        raise KeyViolation(f"{row['n_null']} rows with a null in {list(keys)}")
    if row["n_repeated"]:
        raise KeyViolation(f"{row['n_repeated']} keys of {list(keys)} occur more than once")
    return row["n_rows"], row["n_bytes"], sorted(row["touched"])


def upsert(df: DataFrame, name: str, keep_staged: bool = False) -> str | None:
    """Insert new keys and replace existing ones.

    Staged data are deleted once the table is written, and stay for
    :func:`publish` when that fails. With ``keep_staged`` they always stay; the
    result is the path that was published. One writer at a time per table.

    The batch is written out once, so an expensive feature function behind it
    runs a single time. Columns must be those of the table.
    """
    spark = df.sparkSession
    table = describe(spark, name)
    target = spark.table(name)
    wanted = [c for c in target.columns if c != BUCKET]
    if set(wanted) != set(df.columns):
        raise ValueError(f"columns {sorted(set(wanted) ^ set(df.columns))} differ from those of {name}")
    keys = list(table.all_keys)
    batch_path = scratch_path(spark, "updates")
    batch = materialise(df.select(*wanted, table.bucket().alias(BUCKET)), batch_path)
    n_rows, n_bytes, touched = check_updates(batch, keys)
    if not n_rows:
        discard(spark, batch_path)
        return None

    if not _filled_buckets(spark, name).intersection(touched):
        # Nothing to merge with, as in a first load.
        publish(spark, name, batch_path, gather=True)
        return _staged(spark, keep_staged, batch_path)

    # Pruned to the touched partitions at planning time.
    old = target.filter(F.col(BUCKET).isin(touched))
    columns = [*wanted, BUCKET]
    if n_bytes <= BROADCAST_BYTES:
        # The old rows are scanned, filtered and written in place; only the batch
        # is shuffled, so that each bucket gets one file of new rows.
        updated = F.broadcast(batch.select(BUCKET, *keys))
        kept = old.join(updated, [BUCKET, *keys], "left_anti")
        merged = kept.select(*columns).unionByName(batch.select(*columns).repartition(BUCKET))
    else:
        size = stored_size(spark, batch_path) + sum(stored_size(spark, f) for f in _folders(spark, name, touched))
        merged = _merge_by_shuffle(old.select(*columns), batch.select(*columns), keys, len(touched), size)
    merged_path = scratch_path(spark, "merged")
    merged.write.partitionBy(BUCKET).parquet(merged_path)
    publish(spark, name, merged_path)
    discard(spark, batch_path)
    return _staged(spark, keep_staged, merged_path)


def _folders(spark: SparkSession, name: str, buckets: Sequence[int]) -> list[str]:
    """Where the given buckets of a table lie; those without a partition are left out."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").filter("col_name = 'Location'").collect()
    root = rows[0]["data_type"].rstrip("/")
    return [f"{root}/{BUCKET}={b}" for b in sorted(_filled_buckets(spark, name).intersection(buckets))]


def _staged(spark: SparkSession, keep: bool, path: str) -> str | None:
    if keep:
        return path
    discard(spark, path)
    return None
