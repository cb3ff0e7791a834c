"""Materialise a split once, then feed it to batch functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from patchloom.session import scratch_path


def materialise(df: DataFrame, path: str | None = None, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as parquet and read it back.

    The result has no lineage into the work behind ``df``, is not recomputed
    when an executor is lost, and can be scanned many times.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, "materialised")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    # The schema is known; reading with it saves the footer inference job.
    ordered = [f for f in df.schema.fields if f.name not in partition_by]
    ordered += [df.schema[c] for c in partition_by]
    return spark.read.schema(StructType(ordered)).parquet(target)


def map_batches(
    df: DataFrame,
    transform: Callable[[pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
    partitions: int | None = None,
) -> DataFrame:
    """Apply a batch function with declared output columns.

    ``partitions`` spreads an expensive function over more tasks than the scan
    has; adaptive execution does not split small scan partitions by itself.
    """

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield transform(frame)

    spread = df.repartition(partitions) if partitions else df
    return spread.mapInPandas(batches, schema)
