"""Array columns as ML vectors, and array helpers."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions.keys import _column


def dense_vector(column: str | Column) -> Column:
    """Array of numbers as a dense vector, converted in the JVM; null stays null."""
    array = _column(column)
    return F.when(array.isNotNull(), array_to_vector(F.coalesce(array, F.array().cast("array<double>"))))


def argmax(scores: str | Column) -> Column:
    """Index of the first greatest element, from 0."""
    array = _column(scores)
    return (F.array_position(array, F.array_max(array)) - 1).cast("int")


class DenseVectorizer(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Pipeline stage around :func:`dense_vector`."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self.setParams(**self._input_kwargs)

    @keyword_only
    def setParams(self, *, inputCol: str | None = None, outputCol: str | None = None):
        return self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), dense_vector(self.getInputCol()))
