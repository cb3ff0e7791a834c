"""Exact duplicates, found by progressive refinement: length, then prefix, then content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import BITMAP_BITS, bitmap_of, flag_by_bitmap, store, text_of

# Characters that the second step looks at.
PREFIX_CHARS = 256


def content_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: tuple[str, ...] = (),
    prefix_chars: int = PREFIX_CHARS,
    bitmap_bits: int = BITMAP_BITS,
) -> DataFrame:
    """Each row's place among the rows of equal text.

    Returns ``carry`` plus (id, keep_id, group_size, kept), one row per input
    row. Lengths that occur once, then (length, prefix hash) pairs that occur
    once, settle their rows; only the others have their whole content hashed.
    The pairs still in question are told by a bitmap of fixed size, so that no
    text is moved: a wrongly flagged row is hashed for nothing and turns out
    alone. Rows are grouped on (length, SHA-256), counted before the shuffle,
    and the group's verdict is joined back to the rows.

    Null text equals empty text. Of equal texts the largest id is kept; a null
    id loses to any other. Rows with the same id and text share one verdict.
    An empty table gives an empty result. Other columns don't matter.
    """
    text = F.col("__text")
    rows = docs.select(
        *[F.col(c) for c in carry], F.col(id_column).alias("__id"), text_of(text_column).alias("__text")
    ).withColumn("__length", F.octet_length(text).cast("bigint"))
    prefix = F.xxhash64("__length", F.substring(text, 1, prefix_chars))

    pairs = rows.groupBy("__length", prefix.alias("__prefix")).agg(F.count("*").alias("__n"))
    by_length = pairs.groupBy("__length").agg(F.sum("__n").alias("__all"))
    common_lengths = by_length.filter("__all > 1").select("__length")
    common_pairs = pairs.filter("__n > 1").join(common_lengths, "__length", "left_semi")
    flagged = flag_by_bitmap(rows, prefix, bitmap_of(common_pairs, "__prefix", bitmap_bits), "__open", bitmap_bits)

    content = F.when(F.col("__open"), F.sha2(text, 256))
    slim = flagged.select(
        *carry,
        "__id",
        "__length",
        # A settled row joins no group; its own key keeps such rows from meeting in one partition.
        F.coalesce(content, F.concat(F.lit("row "), F.xxhash64("__id").cast("string"))).alias("__key"),
        F.col("__open").alias("__hashed"),
    )
    groups = (
        slim.filter("__hashed")
        .groupBy("__length", "__key")
        .agg(F.max("__id").alias("__keep"), F.count("*").alias("__size"))
        .filter("__size > 1")
    )
    # Stored, so that the join deals out its own sides and can split a large group.
    groups = store(groups, "copies")
    joined = slim.join(groups, ["__length", "__key"], "left")
    alone = F.col("__size").isNull()
    keep = F.when(alone, F.col("__id")).otherwise(F.col("__keep"))
    return joined.select(
        *carry,
        F.col("__id").alias(id_column),
        keep.alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("__id").eqNullSafe(keep).alias("kept"),
    )


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`content_groups` keeps, with all their columns.

    The verdicts on dropped ids are narrow; rows are matched on id and text hash
    by one anti-join. Rows that repeat a kept row wholly (same id, same text)
    stay as they are. A row with a null id is dropped when another row has its text.
    """
    lost = content_groups(
        docs.withColumn("__sha", F.sha2(text_of(text_column), 256)), id_column, text_column, carry=("__sha",)
    ).filter(~F.col("kept"))
    lost = lost.select(F.col(id_column).alias("__lost"), F.col("__sha").alias("__lost_sha")).distinct()
    same = F.col(id_column).eqNullSafe(F.col("__lost")) & (F.sha2(text_of(text_column), 256) == F.col("__lost_sha"))
    return docs.join(lost, same, "left_anti")
