"""One-hot and standard-scale encoders with a ``fit`` step.

``fit`` is a single aggregate over the data. What returns to the driver is one row
per category, refused, not cut, beyond ``max_categories``: a dense one-hot row is
as wide as that. :func:`category_places` numbers any number of values in a table.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom.session import discard, scratch_path
from patchloom.sources.batches import materialise


def _sorted_categories(values: list) -> tuple:
    """Natural order of the type, null last."""
    present = sorted(value for value in values if value is not None)
    return tuple(present + [None] * (len(present) != len(values)))


def _fit(
    df: DataFrame, categories: Sequence[str], moments: Sequence[str], max_categories: int
) -> tuple[dict[str, tuple], dict[str, Moments]]:
    """Categories and moments of all columns in one pass over ``df``.

    Each row becomes one tagged row per category column; the rows of the first
    tag also carry the values to scale. They are grouped by tag and value, with
    map-side combining, and the few groups are put together here.
    """
    tags = max(len(categories), 1)

    def tagged(i: int) -> Column:
        values = [
            (F.col(c) if i == j else F.lit(None).cast(df.schema[c].dataType)).alias(f"v{j}")
            for j, c in enumerate(categories)
        ]
        scaled = []
        for j, c in enumerate(moments):
            number = F.col(c).cast("double")
            number = F.when(~F.isnan(number), number) if i == 0 else F.lit(None).cast("double")
            scaled.append(number.alias(f"x{j}"))
        return F.struct(F.lit(i).alias("tag"), *values, *scaled)

    groups = ["tag", *[f"v{j}" for j in range(len(categories))]]
    stats = [
        stat(F.col(f"x{j}")).alias(f"{name}{j}")
        for j in range(len(moments))
        for name, stat in (("n", F.count), ("mean", F.avg), ("var", F.var_pop))
    ]
    grouped = df.select(F.inline(F.array(*[tagged(i) for i in range(tags)]))).groupBy(*groups)
    allowed = max_categories * tags
    rows = grouped.agg(*(stats or [F.count(F.lit(1)).alias("n")])).limit(allowed + 1).collect()

    found: dict[str, list] = {c: [] for c in categories}
    if categories:
        for row in rows:
            found[categories[row["tag"]]].append(row[f"v{row['tag']}"])
        too_wide = [c for c, values in found.items() if len(values) > max_categories]
        if too_wide or len(rows) > allowed:
            raise ValueError(f"more than {max_categories} categories in {too_wide or list(categories)}")
    first = [row for row in rows if row["tag"] == 0]
    scales = {c: _pooled([(r[f"n{j}"], r[f"mean{j}"], r[f"var{j}"]) for r in first], c) for j, c in enumerate(moments)}
    return {c: _sorted_categories(values) for c, values in found.items()}, scales


def _pooled(groups: list[tuple], name: str) -> Moments:
    """Moments of all rows from the count, mean and variance of each group."""
    counted = [g for g in groups if g[0]]
    total = sum(n for n, _, _ in counted)
    if not total:
        raise ValueError(f"no values to scale in {name}")
    mean = math.fsum(n * m for n, m, _ in counted) / total
    variance = math.fsum(n * (v + (m - mean) ** 2) for n, m, v in counted) / total
    return Moments(mean, math.sqrt(variance))


@dataclass(frozen=True)
class Moments:
    mean: float
    std: float


def fit_categories(df: DataFrame, columns: Sequence[str], max_categories: int = 10_000) -> dict[str, tuple]:
    """Distinct values of each column in sorted order."""
    return _fit(df, columns, (), max_categories)[0]


def fit_moments(df: DataFrame, columns: Sequence[str]) -> dict[str, Moments]:
    """Mean and population standard deviation, NaN and null left out."""
    return _fit(df, (), columns, 1)[1]


def one_hot(column: Column, categories: Sequence, unseen: str = "error") -> Column:
    """Dense ``array<double>`` with one place per category.

    A value outside ``categories`` raises; ``unseen='ignore'`` gives all zeros.
    """
    if unseen not in ("error", "ignore"):
        raise ValueError(f"unseen must be 'error' or 'ignore', not {unseen!r}")
    width = len(categories)
    known = [value for value in categories if value is not None]
    # In one array with the value, the categories get its type, decimals of any width included.
    typed = F.array(column, *[F.lit(value) for value in known])
    found = F.array_position(F.slice(typed, 2, len(known)), F.get(typed, F.lit(0))) if known else F.lit(0)
    place = [F.nullif(found.cast("int"), F.lit(0))]
    if width > len(known):
        place.append(F.when(column.isNull(), F.lit(width)))
    if unseen == "ignore":
        place.append(F.lit(0))
    else:
        message = F.concat(F.lit("unseen category: "), F.coalesce(column.cast("string"), F.lit("null")))
        place.append(F.raise_error(message).cast("int"))
    # A window on a constant 0 .. 0 1 0 .. 0 that has the 1 at the wanted place,
    # or, for place 0, only zeros.
    zeros = F.array_repeat(F.lit(0.0), width - 1)
    strip = F.concat(zeros, F.array(F.lit(1.0)), zeros, F.array(F.lit(0.0)))
    return F.slice(strip, F.lit(width + 1) - F.coalesce(*place), F.lit(width))


def standard_scale(column: Column, moments: Moments) -> Column:
    """``(x - mean) / std``; a constant column is only centred."""
    return (column.cast("double") - F.lit(moments.mean)) / F.lit(moments.std or 1.0)


# Category types that JSON lacks, by the name under which their text is kept.
_KINDS = {"decimal": Decimal, "timestamp": datetime.fromisoformat, "date": date.fromisoformat}


def _tagged(value) -> dict[str, str]:
    if isinstance(value, Decimal):
        return {"decimal": str(value)}
    if isinstance(value, datetime):
        return {"timestamp": value.isoformat()}
    if isinstance(value, date):
        return {"date": value.isoformat()}
    raise TypeError(f"a category of type {type(value).__name__} can't be kept as text")


def _untagged(value):
    if isinstance(value, dict):
        ((kind, text),) = value.items()
        return _KINDS[kind](text)
    return value


def category_places(df: DataFrame, column: str, path: str | None = None) -> DataFrame:
    """(column, place): every distinct value with its number in sorted order, from 0, null last; any number of values.

    Values are sorted and stored in ranges; a value's number is its place in
    its range plus the sizes of the ranges before. Nothing but those sizes, one
    per partition, is in one place. With ``path`` the result is stored there and the ranges are
    deleted; without it they stay in the scratch folder, because the lazy result reads them.
    """
    spark = df.sparkSession
    ordered = df.select(column).distinct().orderBy(F.col(column).asc_nulls_last())
    ranges = scratch_path(spark, "categories")
    rows = materialise(ordered.withColumn("_row", F.monotonically_increasing_id()), ranges)
    part = F.shiftright("_row", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_offset") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    found = rows.withColumn("_part", part).join(offsets, "_part").select(column, place.alias("place"))
    if path is None:
        return found
    stored = materialise(found, path)
    discard(spark, ranges)
    return stored


def with_places(df: DataFrame, column: str, places: DataFrame, output: str = "place") -> DataFrame:
    """``df`` with the place of each row's value, which is all that a one-hot row of any width holds; null if unseen."""
    right = places.select(F.col(column).alias("_value"), F.col("place").alias(output))
    return df.join(right, df[column].eqNullSafe(F.col("_value")), "left").drop("_value")


@dataclass(frozen=True)
class ColumnEncoder:
    """Fitted encoder: one-hot blocks in the given order, then the scaled columns."""

    categories: dict[str, tuple]
    moments: dict[str, Moments]
    unseen: str = "error"

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        one_hot_columns: Sequence[str],
        scale_columns: Sequence[str],
        unseen: str = "error",
        max_categories: int = 10_000,
    ) -> ColumnEncoder:
        categories, moments = _fit(df, one_hot_columns, scale_columns, max_categories)
        return cls(categories, moments, unseen)

    @property
    def width(self) -> int:
        return sum(len(values) for values in self.categories.values()) + len(self.moments)

    def features(self) -> Column:
        blocks = [one_hot(F.col(c), values, self.unseen) for c, values in self.categories.items()]
        scaled = [standard_scale(F.col(c), m) for c, m in self.moments.items()]
        if scaled:
            blocks.append(F.array(*scaled))
        return F.concat(*blocks)

    def transform(self, df: DataFrame, keep: Sequence[str] = (), output: str = "features") -> DataFrame:
        """``keep`` columns and the feature array; all other columns are dropped."""
        return df.select(*keep, self.features().alias(output))

    def to_json(self) -> str:
        return json.dumps(asdict(self), default=_tagged)

    @classmethod
    def from_json(cls, text: str) -> ColumnEncoder:
        raw = json.loads(text)
        return cls(
            {c: tuple(_untagged(v) for v in values) for c, values in raw["categories"].items()},
            {c: Moments(**m) for c, m in raw["moments"].items()},
            raw["unseen"],
        )
