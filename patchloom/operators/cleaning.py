"""Row filters, limits and constant columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions.times import timestamp_of

# Open ranges that valid trips lie in.
TRIP_RANGES = {"fare_amount": (0, 1000), "trip_distance": (0, 400)}


def clean_ranges(
    df: DataFrame, ranges: Mapping[str, tuple], drop_nulls: bool = True, subset: Sequence[str] | None = None
) -> DataFrame:
    """Rows without nulls (or NaN) whose columns lie strictly inside their ranges.

    The comparisons are plain predicates and reach the file scan. ``subset``
    limits the null check, and with it the columns that are read.
    """
    for name, (low, high) in ranges.items():
        df = df.filter((F.col(name) > low) & (F.col(name) < high))
    return df.dropna("any", subset=list(subset) if subset else None) if drop_nulls else df


def time_range(df: DataFrame, ts: str, start: str | Column | None = None, end: str | Column | None = None) -> DataFrame:
    """Rows with ``start <= ts < end``; an empty bound leaves that side open."""
    kind = df.schema[ts].dataType
    if start is not None and not (isinstance(start, str) and start == ""):
        df = df.filter(F.col(ts) >= F.lit(start).cast(kind))
    if end is not None and not (isinstance(end, str) and end == ""):
        df = df.filter(F.col(ts) < F.lit(end).cast(kind))
    return df


def compute_features(
    df: DataFrame,
    features: Callable[[DataFrame], DataFrame],
    ts: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Apply a user's feature function to the rows in a time range."""
    ranged = time_range(df, ts, start, end) if ts else df
    return ranged.transform(features)


def limit_rows(df: DataFrame, n: int, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """``n`` rows; with ``order_by`` always the same ones (a distributed top-n)."""
    return df.orderBy(*order_by).limit(n) if order_by else df.limit(n)


def stamp(df: DataFrame, model_version: str, inference_timestamp: str) -> DataFrame:
    """Add the constant ``model_version`` and ``inference_timestamp`` columns."""
    return df.withColumns(
        {
            "model_version": F.lit(str(model_version)),
            "inference_timestamp": timestamp_of(inference_timestamp),
        }
    )
