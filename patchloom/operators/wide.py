"""Encoding of columns with any number of categories, as a Spark ML estimator.

The categories of a column are a stored table of values and places, looked up by
a join whose kind Spark plans by the table's size; none of it comes to the
driver. A row's features are a sparse vector: a one in each column's block, then the scaled numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import nan

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from patchloom.functions.encode import Moments, category_places, fit_moments, standard_scale
from patchloom.session import scratch_path

# Spark's vectors count their places in 32 bits.
MOST_PLACES = (1 << 31) - 1


def _vector(places: list[Column], numbers: list[Column], width: int) -> Column:
    """A vector of ones at the places that aren't null, and of the numbers behind all blocks; sparse where that is smaller.

    It is read from its parts as JSON, the form in which Spark writes vectors too; an assembler would
    keep a name for every place on the driver. A number that is null has no place between
    others in a vector: NaN, which models refuse or skip.
    """
    numbers = [F.coalesce(n, F.lit(nan)) for n in numbers]
    behind = [F.when(n != 0, F.lit(width - len(numbers) + k)) for k, n in enumerate(numbers)]
    known = F.filter(F.array(*places).cast("array<int>"), lambda p: p.isNotNull())
    indices = F.concat(known, F.filter(F.array(*behind).cast("array<int>"), lambda p: p.isNotNull()))
    values = F.concat(F.transform(known, lambda _: F.lit(1.0)), F.filter(F.array(*numbers).cast("array<double>"), lambda n: n != 0))
    parts = F.struct(F.lit(0).alias("type"), F.lit(width).alias("size"), indices.alias("indices"), values.alias("values"))
    text = F.to_json(F.struct(parts.alias("vector")))
    if 1.5 * (len(places) + len(numbers) + 1) >= width:
        each = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.get(values, F.array_position(indices, i).cast("int") - 1), F.lit(0.0)))
        dense = F.to_json(F.struct(F.struct(F.lit(1).alias("type"), each.alias("values")).alias("vector")))
        text = F.when(1.5 * (F.size(indices) + 1) < width, text).otherwise(dense)
    return F.from_json(text, StructType([StructField("vector", VectorUDT())]))["vector"]


class _WideParams(HasInputCols, HasOutputCol):
    scaleCols = Param(Params._dummy(), "scaleCols", "columns of numbers to scale", TypeConverters.toListString)
    unseen = Param(Params._dummy(), "unseen", "what a category does that the fit has not seen: error, or ignore for an empty block", TypeConverters.toString)

    def _check(self) -> None:
        if self.getOrDefault(self.unseen) not in ("error", "ignore"):
            raise ValueError(f"unseen must be 'error' or 'ignore', not {self.getOrDefault(self.unseen)!r}")


class WideEncoder(Estimator, _WideParams, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot blocks of ``inputCols`` and standardised ``scaleCols`` as one sparse vector.

    Null is a category of its own if the fit meets it; NaN and null numbers don't count for
    mean and deviation. The fitted places lie in the scratch folder until the model is saved, which copies them.
    """

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), scaleCols: Sequence[str] = (), outputCol: str = "features", unseen: str = "error"):
        super().__init__()
        self._setDefault(inputCols=[], scaleCols=[], outputCol="features", unseen="error")
        self._set(inputCols=list(inputCols), scaleCols=list(scaleCols), outputCol=outputCol, unseen=unseen)

    def _fit(self, dataset: DataFrame) -> WideEncoderModel:
        self._check()
        names, numbers = self.getInputCols(), self.getOrDefault(self.scaleCols)
        if not names and not numbers:
            raise ValueError("there are no columns to encode")
        path, sizes = scratch_path(dataset.sparkSession, "places"), []
        for k, name in enumerate(names):
            places = category_places(dataset, name, f"{path}/{k}")
            sizes.append(places.count())
            if not sizes[-1]:
                raise ValueError(f"there are no rows to learn the categories of {name} from")
        if sum(sizes) + len(numbers) > MOST_PLACES:
            raise ValueError(f"{sum(sizes)} categories are more than a vector can hold")
        moments = fit_moments(dataset, numbers) if numbers else {}
        model = WideEncoderModel(
            inputCols=names, scaleCols=numbers, outputCol=self.getOutputCol(), unseen=self.getOrDefault(self.unseen), path=path, sizes=sizes,
            means=[moments[c].mean for c in numbers], deviations=[moments[c].std for c in numbers],
        )
        return self._copyValues(model)


class WideEncoderModel(Model, _WideParams, MLReadable, MLWritable):
    """Adds the vector; ``path`` holds a table of values and places for each input column."""

    # Rows without a feature can't be filled with zeros for it: zero may be no category.
    needs_whole_rows = True

    path = Param(Params._dummy(), "path", "folder of the tables of places", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "categories of each input column", TypeConverters.toListInt)
    means = Param(Params._dummy(), "means", "mean of each scaled column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "deviation of each scaled column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(
        self, *, inputCols: list[str] | None = None, scaleCols: list[str] | None = None, outputCol: str | None = None, unseen: str | None = None,
        path: str | None = None, sizes: list[int] | None = None, means: list[float] | None = None, deviations: list[float] | None = None,
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def width(self) -> int:
        return sum(self.getOrDefault(self.sizes)) + len(self.getOrDefault(self.scaleCols))

    def places(self, spark: SparkSession, column: str) -> DataFrame:
        """(value, place) of one input column."""
        found = spark.read.parquet(f"{self.getOrDefault(self.path)}/{self.getInputCols().index(column)}")
        return found.select(F.col(found.columns[0]).alias("value"), "place")

    def _placed(self, dataset: DataFrame) -> DataFrame:
        """``dataset`` with the place of every category as ``_wide_place0``, ...; null if it was not seen."""
        for k, name in enumerate(self.getInputCols()):
            table = self.places(dataset.sparkSession, name).select(F.col("value").alias("_wide_value"), F.col("place").alias(f"_wide_place{k}"))
            dataset = dataset.join(table, F.col(name).eqNullSafe(F.col("_wide_value")), "left").drop("_wide_value")
        return dataset

    def unseen_counts(self, dataset: DataFrame) -> DataFrame:
        """(column, n_unseen): rows whose category the fit has not seen, for all columns in one pass."""
        names = self.getInputCols()
        counted = self._placed(dataset.select(*dict.fromkeys(names))).agg(*[F.count_if(F.col(f"_wide_place{k}").isNull()).alias(f"n{k}") for k in range(len(names))])
        return counted.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{k}").alias("n_unseen")) for k, c in enumerate(names)])))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self._check()
        names, numbers, sizes = self.getInputCols(), self.getOrDefault(self.scaleCols), self.getOrDefault(self.sizes)
        moments = [Moments(m, d) for m, d in zip(self.getOrDefault(self.means), self.getOrDefault(self.deviations), strict=True)]
        kept, placed = dataset.columns, self._placed(dataset)
        places = []
        for k, name in enumerate(names):
            place = F.col(f"_wide_place{k}") + sum(sizes[:k])
            if self.getOrDefault(self.unseen) == "error":
                told = F.concat(F.lit(f"unseen category of {name}: "), F.coalesce(F.col(name).cast("string"), F.lit("null")))
                place = F.coalesce(place, F.raise_error(told).cast("bigint"))
            places.append(place)
        scaled = [standard_scale(F.col(c), m) for c, m in zip(numbers, moments, strict=True)]
        vector = _vector(places, scaled, self.width)
        # Of the width alone: names for all places would be as many objects on the driver.
        vector = vector.alias(self.getOutputCol(), metadata={"ml_attr": {"num_attrs": self.width}})
        return placed.select(*[c for c in kept if c != self.getOutputCol()], vector)

    def write(self) -> MLWriter:
        return _WideWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _WideReader(cls)


class _WideWriter(MLWriter):
    def __init__(self, instance: WideEncoderModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        for k, _ in enumerate(self.instance.getInputCols()):
            source = self.sparkSession.read.parquet(f"{self.instance.getOrDefault(self.instance.path)}/{k}")
            source.write.parquet(f"{path}/places/{k}")


class _WideReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> WideEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        found = self.cls()
        found._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(found, metadata)
        # The model may have been moved since it was saved.
        return found._set(path=f"{path.rstrip('/')}/places")
