"""Fit, package and apply Spark ML models together with their feature lookups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from patchloom.functions.vectors import DenseVectorizer
from patchloom.operators.cleaning import stamp
from patchloom.operators.lookup import FeatureLookup, lookups_from_json, lookups_to_json, with_features
from patchloom.sinks.tables import overwrite_table

# Settings of the classifier and of the regression.
CLASSIFIER_SETTINGS = {"maxIter": 1, "regParam": 0.03, "elasticNetParam": 0.5}
REGRESSION_PENALTY = 1e-4


def classifier(features: str = "features", label: str = "label", **settings) -> Pipeline:
    """Unfitted pipeline: array to vector, assemble, logistic regression."""
    return Pipeline(
        stages=[
            DenseVectorizer(inputCol=features, outputCol="dense_features"),
            VectorAssembler(inputCols=["dense_features"], outputCol="feature"),
            LogisticRegression(labelCol=label, featuresCol="feature", **(CLASSIFIER_SETTINGS | settings)),
        ]
    )


class RidgeRegression(Estimator, HasFeaturesCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Linear regression minimising ``mean((y - wx - b)^2) / 2 + penalty * |w|^2 / 2``.

    Up to 4,096 features it is solved by the normal equations in one pass, beyond
    that by quasi-Newton steps to a tight tolerance; Spark chooses. Spark
    divides its penalty by the label's standard deviation, so that is measured
    first and multiplied back in.
    """

    penalty = Param(Params._dummy(), "penalty", "weight of the squared coefficients", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol: str = "feature", labelCol: str = "label", penalty: float = REGRESSION_PENALTY):
        super().__init__()
        self._setDefault(featuresCol="feature", labelCol="label", penalty=REGRESSION_PENALTY)
        self._set(featuresCol=featuresCol, labelCol=labelCol, penalty=penalty)

    def _fit(self, dataset: DataFrame):
        spread = dataset.agg(F.stddev_pop(self.getLabelCol()).alias("std")).first()["std"]
        return LinearRegression(
            featuresCol=self.getFeaturesCol(),
            labelCol=self.getLabelCol(),
            regParam=self.getOrDefault(self.penalty) * (spread or 0.0),
            elasticNetParam=0.0,
            standardization=False,
            solver="auto",
            maxIter=1000,
            tol=1e-10,
        ).fit(dataset)


def regression(features: str = "features", label: str = "label", penalty: float = REGRESSION_PENALTY) -> Pipeline:
    """Unfitted pipeline: array to vector, ridge regression."""
    return Pipeline(
        stages=[
            DenseVectorizer(inputCol=features, outputCol="feature"),
            RidgeRegression(labelCol=label, penalty=penalty),
        ]
    )


def apply_model(model: PipelineModel, df: DataFrame, keep_stages: bool = False) -> DataFrame:
    """Predictions next to the input columns; intermediate vectors are dropped."""
    scored = model.transform(df)
    return scored if keep_stages else scored.select(*df.columns, "prediction")


@dataclass(frozen=True)
class ModelPackage:
    """A fitted model with the lookups that feed it."""

    model: PipelineModel
    lookups: tuple[FeatureLookup, ...]
    exclude: tuple[str, ...] = ()

    def save(self, path: str) -> None:
        """Write model and lookups below ``path``, with Spark's own file access."""
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.active()
        text = lookups_to_json(self.lookups, exclude=list(self.exclude))
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/lookups")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ModelPackage:
        model = PipelineModel.load(f"{path}/model")
        text = spark.read.text(f"{path}/lookups").first()["value"]
        lookups, extra = lookups_from_json(text)
        return cls(model, tuple(lookups), tuple(extra["exclude"]))


def score_batch(
    package: ModelPackage,
    base: DataFrame,
    resolve: Callable[[str], DataFrame] | None = None,
    base_table: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """Base rows plus ``prediction``; the caller supplies keys, features are looked up.

    A row for which a lookup finds nothing (policy ``keep``), or finds a null
    feature, can't be scored: it stays, with a null prediction.
    """
    rows = with_features(base, package.lookups, resolve, (), base_table, salts)
    names = dict.fromkeys(f for spec in package.lookups for f in spec.features if f in rows.columns)
    whole = reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in names], F.lit(True))
    arrays = [f for f in names if isinstance(rows.schema[f].dataType, ArrayType)]
    n_features = getattr(package.model.stages[-1], "numFeatures", -1)
    fillable = not any(getattr(stage, "needs_whole_rows", False) for stage in package.model.stages)
    if fillable and len(arrays) <= 1 and n_features >= len(names) and not set(names) & set(base.columns):
        # One pass: absent features are filled for the model, and what it makes of them is dropped.
        zeros = {f: F.lit(0).cast(rows.schema[f].dataType) for f in names if f not in arrays}
        zeros |= {f: F.array_repeat(F.lit(0.0), n_features - len(zeros)).cast(rows.schema[f].dataType) for f in arrays}
        filled = rows.withColumn("_whole", whole).withColumns({f: F.coalesce(f, zero) for f, zero in zeros.items()})
        scored = apply_model(package.model, filled)
        return scored.select(*base.columns, F.when(F.col("_whole"), F.col("prediction")).alias("prediction"))
    # Else the model sees whole rows only, and the others pass it by.
    scored = apply_model(package.model, rows.filter(whole)).select(*base.columns, "prediction")
    unscored = rows.filter(~whole).select(*base.columns, F.lit(None).cast("double").alias("prediction"))
    return scored.unionByName(unscored)


def predict_table(
    spark: SparkSession,
    package: ModelPackage,
    input_table: str,
    output_table: str,
    model_version: str,
    inference_timestamp: str,
    resolve: Callable[[str], DataFrame] | None = None,
    location: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """Score a catalog table, stamp the rows and overwrite the output table."""
    scored = score_batch(package, spark.table(input_table), resolve, salts=salts)
    overwrite_table(stamp(scored, model_version, inference_timestamp), output_table, location=location)
    return spark.table(output_table)


def training_set(
    base: DataFrame,
    lookups: Iterable[FeatureLookup],
    label: str = "label",
    exclude: Sequence[str] = (),
    resolve: Callable[[str], DataFrame] | None = None,
    base_table: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """Rows to fit on: base and features without ``exclude``, the label always kept."""
    dropped = [c for c in exclude if c != label]
    return with_features(base, lookups, resolve, dropped, base_table, salts)


def coefficients(model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """Coefficients of a fitted regression as rows ``(term, coefficient)``."""
    fitted = model.stages[-1]
    rows = [(n, float(c)) for n, c in zip(names, fitted.coefficients)] + [("intercept", float(fitted.intercept))]
    return SparkSession.active().createDataFrame(rows, "term string, coefficient double")
