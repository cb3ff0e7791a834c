"""Mixing sources to target weights with nested hash thresholds (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom.llm.common import store, word_count

# A row's place in its source: the first 52 bits of an MD5, looked at 13 bits at a time.
LEVELS, LEVEL_BITS = 4, 13
TOTAL_BITS = LEVELS * LEVEL_BITS
MAX_REPEATS = 3


def place_of(id_column: str) -> Column:
    """A number below 2^52 that follows from the id alone."""
    digest = F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, TOTAL_BITS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) to (source, source_size, target): shares of the whole by repeating weights.

    Sources are taken by code point, null last. No target exceeds ``most`` times
    its source's size; what is above goes to the others by weight. Sorted by
    size / weight, the capped sources come first, so running sums give the level
    at which the rest shares: no rounds are needed. There is one row per source
    here, which is what meets in the single window.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    by_ratio = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    so_far = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (
        sizes.withColumn("w", weight)
        .withColumn("capped", F.coalesce(F.sum("source_size").over(so_far), F.lit(0)) * most)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("rest_w", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(so_far), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("capped")).cast("double") / F.col("rest_w"))
        # The first source that stays at or below its cap sets the level of all after it.
        .withColumn("open", F.col("level") * F.col("w") <= F.col("source_size") * most)
    )
    last = F.min(F.when(F.col("open"), F.struct(F.col("source_size") / F.col("w"), F.col("level"))))
    level = last.over(everything)["level"]
    target = F.when(F.col("open"), level * F.col("w")).otherwise((F.col("source_size") * most).cast("double"))
    return levels.select("source", "source_size", target.alias("target"))


def thresholds(
    rows: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = MAX_REPEATS
) -> DataFrame:
    """Per source of rows (source, size, place): source_size, target, whole copies and the hash threshold for one more.

    Words are summed by source and the leading hash bits, the bucket that holds
    the budget's end is refined by the next bits, and so on until one hash value
    is left; it is taken or not, whichever ends nearer to the budget (a tie
    leaves it). Buckets are summed before each shuffle, so a hot source is at
    most 8,192 rows per task; documents are never sorted.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    target = F.col("target")
    whole = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(F.lit(0))
    budgets = store(
        source_targets(sizes, weights, most)
        .withColumn("whole", F.least(whole, F.lit(most)).cast("bigint"))
        .withColumn("budget", target - F.col("whole") * F.col("source_size"))
        .withColumn("below", F.lit(0).cast("bigint"))  # words below the boundary bucket
        .withColumn("prefix", F.lit(0).cast("bigint")),  # the boundary bucket's leading bits
        "mix-budgets",
    )
    for level in range(1, LEVELS + 1):
        budgets = store(_refine(rows, budgets, level), f"mix-level-{level}")
    over = F.abs(F.col("below") + F.col("in_bucket") - F.col("budget"))
    end = F.when(over < F.col("budget") - F.col("below"), F.col("prefix") + 1).otherwise(F.col("prefix"))
    return budgets.select("source", "source_size", "target", "whole", end.alias("threshold"))


def _sized(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.col(source_column).alias("source"),
        word_count(text_column).alias("size"),
        place_of(id_column).alias("place"),
    )
    return store(rows, "mix-sizes")


def _copies(place: Column, most: int) -> Column:
    more = F.when(place < F.col("__threshold"), F.lit(1)).otherwise(F.lit(0))
    return F.least(F.col("__whole") + more, F.lit(most)).cast("int")


def _renamed(limits: DataFrame) -> DataFrame:
    return limits.select(
        F.col("source").alias("__source"), F.col("whole").alias("__whole"), F.col("threshold").alias("__threshold"),
        "source_size", "target",
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    most: int = MAX_REPEATS,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """How much of each document the mix takes: (id, size, source_size, target, taken, copies).

    A source whose target is q whole copies and a rest takes every document q
    times, and once more those whose hash lies below the source's threshold.

    Null text has size 0; a null source is a source of its own; rows with the
    same id and source share one decision and all count. Sources without words
    take nothing. An empty table gives an empty result.
    """
    rows = _sized(docs, id_column, text_column, source_column)
    limits = _renamed(thresholds(rows, weights, most))
    copies = _copies(F.col("place"), most)
    return rows.join(limits, F.col("source").eqNullSafe(F.col("__source"))).select(
        F.col("id").alias(id_column),
        "size",
        "source_size",
        "target",
        (F.col("size") * copies).alias("taken"),
        copies.alias("copies"),
    )


def take_mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    most: int = MAX_REPEATS,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with the columns of ``docs``; cases as in :func:`mix`."""
    limits = _renamed(thresholds(_sized(docs, id_column, text_column, source_column), weights, most))
    joined = docs.join(limits, docs[source_column].eqNullSafe(F.col("__source")))
    repeats = F.expr("sequence(1, __copies)")
    return (
        joined.withColumn("__copies", _copies(place_of(id_column), most))
        .filter("__copies > 0")
        .withColumn("__copy", F.explode(repeats))
        .select(*[docs[c] for c in docs.columns])
    )


def _refine(rows: DataFrame, budgets: DataFrame, level: int) -> DataFrame:
    """Move every source's boundary one level down: to the bucket in which its budget ends."""
    shift = TOTAL_BITS - level * LEVEL_BITS
    bucket = F.shiftright("place", shift)
    state = budgets.select(
        F.col("source").alias("__source"), *[c for c in budgets.columns if c not in ("source", "in_bucket")]
    )
    inside = rows.join(
        state.select("__source", F.col("prefix").alias("__prefix")),
        F.col("source").eqNullSafe(F.col("__source")) & (F.shiftright("place", shift + LEVEL_BITS) == F.col("__prefix")),
    )
    histogram = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bucket")
    ends = histogram.withColumn("upto", F.sum("words").over(running)).withColumn(
        "last", F.max("bucket").over(Window.partitionBy("source"))
    )
    found = (
        ends.join(state, F.col("source").eqNullSafe(F.col("__source")))
        # The first bucket that passes the budget, or the last one if none does.
        .filter((F.col("below") + F.col("upto") > F.col("budget")) | (F.col("bucket") == F.col("last")))
        .groupBy("source")
        .agg(F.min(F.struct("bucket", "words", "upto")).alias("edge"))
    )
    return state.join(found, F.col("source").eqNullSafe(F.col("__source"))).select(
        "source",
        "source_size",
        "target",
        "whole",
        "budget",
        (F.col("below") + F.col("edge.upto") - F.col("edge.words")).alias("below"),
        F.col("edge.bucket").alias("prefix"),
        F.col("edge.words").alias("in_bucket"),
    )


