"""Lookup joins that survive hot keys.

``lookup_join`` joins many base rows with at most one right row per key. With
adaptive execution on, Spark splits a hot partition of the base side by itself
once it is large. ``salts`` does the same without adaptive execution and also
for partitions below its size limits: keys that hold a large share of the base
rows are found first, and only those are spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

# A key is hot when it holds more than 1/HOT_FRACTION of the rows, so there are
# fewer than HOT_FRACTION hot keys however many rows there are.
HOT_FRACTION = 1000


def hot_keys(df: DataFrame, keys: Sequence[str], fraction: int = HOT_FRACTION) -> DataFrame:
    """Keys with more than ``1 / fraction`` of all rows; fewer than ``fraction`` rows.

    The rows are counted per key with map-side combining, so a hot key costs one
    partial count per task; the total is another group of the same job. What
    comes back to the driver is bounded by ``fraction``.
    """
    columns = [F.col(k) for k in keys]
    counts = df.groupingSets([columns, []], *columns).agg(
        F.count(F.lit(1)).alias("n_rows"), F.grouping_id().alias("_set")
    )
    # The row of all rows together comes first, then the largest keys.
    top = counts.orderBy(F.desc("n_rows")).limit(fraction + 1).collect()
    total = max((row["n_rows"] for row in top if row["_set"]), default=0)
    hot = [tuple(row[k] for k in keys) for row in top if not row["_set"] and row["n_rows"] * fraction > total]
    return df.sparkSession.createDataFrame(hot, df.select(*keys).schema)


def hot_hashes(df: DataFrame, keys: Sequence[str], fraction: int = HOT_FRACTION) -> list[int]:
    """Hashes of the hot keys, fewer than ``fraction`` numbers.

    Rows are told hot by their key's hash being in this list. A key that shares
    a hash with a hot one is treated as hot too, which is harmless.
    """
    return [row[0] for row in hot_keys(df, keys, fraction).select(F.xxhash64(*keys)).collect()]


def lookup_join(
    base: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    salts: int = 1,
    fraction: int = HOT_FRACTION,
) -> DataFrame:
    """Join on ``keys``, base columns first; ``how`` is ``left`` or ``inner``.

    With ``salts > 1`` the rows of hot keys get one of ``salts`` salt values and
    the right rows of those keys, and no others, are repeated once per salt.
    Null keys match nothing but still gather in one task of a left join, so they
    are spread as well.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    hashes = hot_hashes(base, keys, fraction) if salts > 1 else []
    if not hashes:
        return base.join(right, list(keys), how)

    # The salt depends on the row's values and its input partition, both the same
    # when a task is run again, so a lost executor cannot move rows between salts.
    # The partition also spreads rows that are copies of each other.
    plain = [f.name for f in base.schema.fields if f.name not in keys and isinstance(f.dataType, AtomicType)]
    spread = F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.lit(salts)).cast("int")
    left = base.withColumn("_salt", F.when(F.xxhash64(*keys).isin(hashes), spread).otherwise(0))
    # Equal keys of different types hash differently, so the base types are used.
    same_type = [F.col(k).try_cast(base.schema[k].dataType) for k in keys]
    copies = F.when(F.xxhash64(*same_type).isin(hashes), F.sequence(F.lit(0), F.lit(salts - 1)))
    repeated = right.withColumn("_salt", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
    return left.join(repeated, [*keys, "_salt"], how).drop("_salt")
