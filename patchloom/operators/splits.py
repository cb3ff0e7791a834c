"""Reproducible splits."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The seed and the two weightings that training uses.
SPLIT_SEED = 12345
TRAIN_VALIDATION = {"train": 0.7, "validation": 0.3}
TRAIN_VALIDATION_WIDE = {"train": 0.9, "validation": 0.1}

_HASH_RANGE = 2**32


def split_of(keys: Sequence[str], weights: Mapping[str, float], seed: int = SPLIT_SEED) -> Column:
    """Name of the split a row belongs to, by a hash of its key and the seed.

    The answer depends on nothing but the key: not on partitioning, file order
    or the other rows, and it is the same when a task is run again.
    """
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    total, passed = sum(weights.values()), 0.0
    names = list(weights)
    choice = F.lit(names[-1])
    bounds = []
    for name in names[:-1]:
        passed += weights[name]
        bounds.append((int(round(passed / total * _HASH_RANGE)), name))
    for bound, name in reversed(bounds):
        choice = F.when(place < bound, F.lit(name)).otherwise(choice)
    return choice


def hash_split(
    df: DataFrame, keys: Sequence[str], weights: Mapping[str, float], seed: int = SPLIT_SEED, column: str = "split"
) -> DataFrame:
    """Add the split name as a column: one pass, no shuffle."""
    return df.withColumn(column, split_of(keys, weights, seed))


def split_frames(
    df: DataFrame, keys: Sequence[str], weights: Mapping[str, float], seed: int = SPLIT_SEED
) -> dict[str, DataFrame]:
    """One DataFrame per split name; disjoint, and together all rows."""
    return {name: df.filter(split_of(keys, weights, seed) == name) for name in weights}


def random_split(df: DataFrame, weights: Mapping[str, float], seed: int = SPLIT_SEED) -> dict[str, DataFrame]:
    """Seeded random split. Needs an input whose partitions are the same in every run."""
    return dict(zip(weights, df.randomSplit([float(w) for w in weights.values()], seed)))


def process_splits(
    splits: Mapping[str, DataFrame], process: Callable[[DataFrame], DataFrame]
) -> dict[str, DataFrame]:
    """Apply the same row-wise cleaning to every split."""
    return {name: df.transform(process) for name, df in splits.items()}
