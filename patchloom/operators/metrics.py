"""Model metrics as aggregates over scored tables.

Class metrics come from a confusion table counted in one pass over the rows;
everything after it works on at most (classes x classes) rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASS_METRICS = ("f1_score", "precision", "recall", "accuracy")

# Probabilities are raised to this before the logarithm.
LOG_FLOOR = 1e-15


def row_count(df: DataFrame) -> DataFrame:
    """One row with the number of rows, as a lazy result."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def confusion(
    df: DataFrame, label: str, predictions: Mapping[str, str] | str, by: Sequence[str] = ()
) -> DataFrame:
    """Row counts per label and predicted class; a missing label or prediction is the class null.

    ``predictions`` maps role names to prediction columns, so that several
    models are counted in the same pass; the role is in the column ``role``.
    """
    roles = {"candidate": predictions} if isinstance(predictions, str) else dict(predictions)
    pairs = F.array(
        *[
            F.struct(F.lit(role).alias("role"), F.col(column).cast("double").alias("predicted"))
            for role, column in roles.items()
        ]
    )
    rows = df.select(*by, F.col(label).cast("double").alias("label"), F.inline(pairs))
    return rows.groupBy(*by, "role", "label", "predicted").agg(F.count(F.lit(1)).alias("n"))


def weighted_metrics(
    df: DataFrame, label: str = "label", predictions: Mapping[str, str] | str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Support-weighted F1, precision and recall, and accuracy, one row per role.

    A ratio with a zero denominator counts as zero. A row without a prediction
    is a miss of its label's class, so a model that answers seldom scores low. Rows without a
    label can't be judged; ``n_unlabelled`` counts them, ``n_unpredicted`` the labelled rows without prediction.
    """
    groups = [*by, "role"]
    zero = F.lit(0).cast("bigint")
    judged = F.when(F.col("label").isNotNull(), F.col("n")).otherwise(zero)
    hit = F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(zero)
    silent = F.when(F.col("predicted").isNull(), judged).otherwise(zero)
    # The null class has no support, so it only carries the rows that can't be judged.
    sums = ("support", "called", "hits", "unlabelled", "unpredicted")

    def side(name: str, *values: Column) -> Column:
        return F.struct(F.col(name).alias("class"), *[v.alias(c) for v, c in zip(values, sums, strict=True)])

    sides = F.array(
        side("label", judged, zero, hit, F.col("n") - judged, silent),
        side("predicted", zero, judged, zero, zero, zero),
    )
    per_class = (
        confusion(df, label, predictions, by)
        .select(*groups, F.inline(sides))
        .groupBy(*groups, "class")
        .agg(*[F.sum(c).cast("double").alias(c) for c in sums])
        .withColumns({"p": _ratio("hits", "called"), "r": _ratio("hits", "support")})
        .withColumn("f", F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0))
    )
    support = F.col("support")
    total = F.nullif(F.sum(support), F.lit(0.0))
    return per_class.groupBy(*groups).agg(
        (F.sum(F.col("f") * support) / total).alias("f1_score"),
        (F.sum(F.col("p") * support) / total).alias("precision"),
        (F.sum(F.col("r") * support) / total).alias("recall"),
        (F.sum("hits") / total).alias("accuracy"),
        *[F.sum(c).cast("bigint").alias(n) for c, n in (("support", "n_rows"), ("unlabelled", "n_unlabelled"), ("unpredicted", "n_unpredicted"))],
    )


def _ratio(top: str, bottom: str) -> Column:
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(0.0)


def metrics_long(metrics: DataFrame, names: Sequence[str] = CLASS_METRICS, by: Sequence[str] = ("role",)) -> DataFrame:
    """One row per metric: ``(*by, metric_name, value)``."""
    pairs = F.array(*[F.struct(F.lit(n).alias("metric_name"), F.col(n).cast("double").alias("value")) for n in names])
    return metrics.select(*by, F.inline(pairs))


def baseline_comparison(
    df: DataFrame, label: str = "label", candidate: str = "prediction", baseline: str = "baseline_prediction"
) -> DataFrame:
    """``(metric_name, candidate, baseline, absolute_change, relative_change)``.

    Both models are counted in one pass. The relative change is null when the
    baseline is zero.
    """
    long = metrics_long(weighted_metrics(df, label, {"candidate": candidate, "baseline": baseline}))
    wide = long.groupBy("metric_name").agg(
        F.max(F.when(F.col("role") == "candidate", F.col("value"))).alias("candidate"),
        F.max(F.when(F.col("role") == "baseline", F.col("value"))).alias("baseline"),
    )
    change = F.col("candidate") - F.col("baseline")
    return wide.withColumns(
        {"absolute_change": change, "relative_change": change / F.nullif(F.col("baseline"), F.lit(0.0))}
    )


def weighted_squared_error(target: Column, prediction: Column) -> Column:
    """Mean squared error weighted by 1 / prediction; NaN when a prediction is 0."""
    p, y = prediction.cast("double"), target.cast("double")
    weight = 1.0 / F.nullif(p, F.lit(0.0))
    used = y.isNotNull()
    mean = F.sum(F.when(used, weight * (p - y) * (p - y))) / F.nullif(F.sum(F.when(used, weight)), F.lit(0.0))
    return F.when(F.count_if((p == 0.0) & used) > 0, F.lit(float("nan"))).otherwise(mean)


def squared_diff_plus_one(target: Column, prediction: Column) -> Column:
    """Sum of ``|prediction - target + 1| ** 2``."""
    shifted = prediction.cast("double") - target.cast("double") + 1
    return F.sum(shifted * shifted)


# Metric name -> function of (target, prediction) giving an aggregate.
CUSTOM_METRICS: dict[str, Callable[[Column, Column], Column]] = {
    "weighted_mean_squared_error": weighted_squared_error,
    "squared_diff_plus_one": squared_diff_plus_one,
}


def custom_metrics(
    df: DataFrame,
    target: str = "label",
    prediction: str = "prediction",
    metrics: Mapping[str, Callable[[Column, Column], Column]] = CUSTOM_METRICS,
    by: Sequence[str] = (),
) -> DataFrame:
    """All given metric functions in one aggregate, one column each."""
    parts = [fn(F.col(target), F.col(prediction)).alias(name) for name, fn in metrics.items()]
    return df.groupBy(*by).agg(*parts)


def log_loss(label: Column, probability: Column) -> Column:
    """Cross entropy of one row: -ln of the probability given to its label; null where there is none."""
    given = F.get(probability, label.cast("int"))
    return F.when(given.isNotNull(), -F.log(F.greatest(given, F.lit(LOG_FLOOR))))


def loss_and_accuracy(
    df: DataFrame,
    label: str = "label",
    probability: str = "probability",
    prediction: str | None = None,
    by: Sequence[str] = (),
    batch: str | None = None,
) -> DataFrame:
    """Mean log loss and accuracy per ``by`` group, for example per epoch.

    The loss is the mean over rows. With ``batch`` it is the mean of the batch
    means, so a short last batch weighs as much as a full one; accuracy always
    is correct rows over judged rows. The predicted class is the ``prediction`` column
    or, without one, the class of the greatest probability. Rows without a label,
    or whose label has no probability, can't be judged: they are in ``n_left_out`` and in
    nothing else. A judged row without a predicted class is wrong.
    """
    scores = F.col(probability)
    predicted = F.col(prediction) if prediction else F.array_position(scores, F.array_max(scores)) - 1
    loss = log_loss(F.col(label), scores)
    judged = loss.isNotNull()
    correct = F.when(judged, F.coalesce((predicted == F.col(label)).cast("double"), F.lit(0.0)))
    scored = df.select(
        *by, *([F.col(batch).alias("_batch")] if batch else []), loss.alias("_loss"), correct.alias("_correct")
    )
    if not batch:
        return scored.groupBy(*by).agg(
            F.avg("_loss").alias("loss"),
            F.avg("_correct").alias("accuracy"),
            F.count("_loss").alias("n_rows"),
            F.count_if(F.col("_loss").isNull()).alias("n_left_out"),
        )
    per_batch = scored.groupBy(*by, "_batch").agg(
        F.avg("_loss").alias("_loss"),
        F.sum("_correct").alias("_correct"),
        F.count("_loss").alias("_n"),
        F.count_if(F.col("_loss").isNull()).alias("_out"),
    )
    return per_batch.groupBy(*by).agg(
        F.avg("_loss").alias("loss"),
        (F.sum("_correct") / F.sum("_n")).alias("accuracy"),
        F.sum("_n").alias("n_rows"),
        F.sum("_out").alias("n_left_out"),
    )


def latest_version(
    versions: DataFrame, name: str = "name", version: str = "version", names: DataFrame | None = None, floor: int = 1
) -> DataFrame:
    """Greatest version per model name, compared as numbers and at least ``floor``.

    ``names`` lists models that are reported even when they have no version.
    """
    latest = versions.groupBy(name).agg(F.max(F.col(version).cast("int")).alias("latest_version"))
    if names is not None:
        latest = names.select(name).distinct().join(latest, name, "left")
    return latest.withColumn(
        "latest_version", F.greatest(F.coalesce("latest_version", F.lit(floor)), F.lit(floor))
    )
