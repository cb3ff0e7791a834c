"""Annotation join and the report on keys that find no partner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.functions.keys import build_key, row_id
from patchloom.operators.skew import lookup_join
from patchloom.sources.images import attach_content, scan_files


def annotate(annotations: DataFrame, content: DataFrame, key: str | Sequence[str], salts: int = 1) -> DataFrame:
    """Inner join of annotations with their content.

    Which side is broadcast is left to the planner's size statistics. ``salts``
    is for one-to-many keys of which few hold most annotations.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return lookup_join(annotations, content, keys, "inner", salts)


def annotate_files(
    spark: SparkSession,
    annotations: DataFrame,
    root: str,
    pattern: str = "*/*/*.jpg",
    recursive: bool = False,
    salts: int = 1,
) -> DataFrame:
    """Annotated image files: ``(id, imid, slide_id, x_center, y_center, label, content)``.

    ``annotations`` has ``sid, x_center, y_center, label``. Only paths take part
    in the join; the bytes of the matched files are read after it.
    """
    keyed = annotations.withColumn("imid", build_key("sid", "x_center", "y_center", strict=True))
    paths = scan_files(spark, root, pattern, recursive).select("imid", "path").filter("imid is not null")
    matched = annotate(keyed, paths, "imid", salts).select(
        row_id("imid").alias("id"), "imid", F.col("sid").alias("slide_id"), "x_center", "y_center", "label", "path"
    )
    return attach_content(matched).drop("path")


def unmatched_report(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: matched and unmatched rows of both sides, and rows without a key.

    Rows are counted per key before they meet, so no row pairs are formed and a
    hot key moves as one count per task.
    """
    keys = [key] if isinstance(key, str) else list(key)

    def tagged(df: DataFrame, is_left: int) -> DataFrame:
        return df.select(*keys, F.lit(is_left).alias("l"), F.lit(1 - is_left).alias("r"))

    per_key = tagged(left, 1).unionByName(tagged(right, 0)).groupBy(*keys)
    counts = per_key.agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    no_key = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))

    def total(value, condition):
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")

    lefts, rights = F.col("l"), F.col("r")
    return counts.agg(
        total(lefts, ~no_key & (rights > 0)).alias("left_matched"),
        total(lefts, ~no_key & (rights == 0)).alias("left_unmatched"),
        total(lefts, no_key).alias("left_without_key"),
        total(rights, ~no_key & (lefts > 0)).alias("right_matched"),
        total(rights, ~no_key & (lefts == 0)).alias("right_unmatched"),
        total(rights, no_key).alias("right_without_key"),
    )
