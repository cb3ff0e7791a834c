"""The jobs: write features, train, validate, score."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from patchloom.functions.keys import build_key, row_id
from patchloom.operators.descent import LastLayer
from patchloom.operators.gate import DEFAULT_THRESHOLDS, Threshold, enforce, gate_report
from patchloom.operators.featurize import image_struct
from patchloom.operators.joins import annotate
from patchloom.operators.lookup import FeatureLookup
from patchloom.operators.metrics import custom_metrics, metrics_long, weighted_metrics
from patchloom.operators.models import ModelPackage, apply_model, classifier, score_batch, training_set
from patchloom.operators.splits import SPLIT_SEED, TRAIN_VALIDATION, split_frames
from patchloom.session import discard, scratch_path
from patchloom.sinks.feature_table import FeatureTable, create_feature_table, read_feature_table, upsert
from patchloom.sources.batches import materialise
from patchloom.sources.images import attach_content, decode_content, decoder, scan_images
from patchloom.sources.manifest import attach_files, list_files


def image_feature_rows(
    spark: SparkSession,
    annotations: DataFrame,
    root: str,
    featurize: Callable[[Column], Column],
    pattern: str = "*/*/*.jpg",
    with_content: bool = True,
    partitions: int | None = None,
    rejects: str = "raise",
    decode: Callable[[bytes], np.ndarray] | None = None,
) -> DataFrame:
    """``(id, slide_id, x_center, y_center, label[, content], features)``.

    ``featurize`` is a column function of :func:`image_struct`. Names are joined
    with the annotations first; only annotated files are opened, once, and read, decoded and featurized in
    one task. ``decode`` gets a file's bytes; without it Pillow is used
    where it is installed. Where it isn't, Spark's own decoder has to go through the
    whole folder, and only annotated images reach the model. ``partitions`` spreads
    the images over more tasks for a slow model. An annotated file that is no image ends the job;
    with ``rejects="drop"`` it is left out. :func:`image_rejects` lists such files, annotated or not.
    """
    if rejects not in ("raise", "drop"):
        raise ValueError(f"rejects must be 'raise' or 'drop', not {rejects!r}")
    keyed = annotations.withColumn("imid", build_key("sid", "x_center", "y_center", strict=True))
    usable = F.col("height") > 0
    if rejects == "raise":
        usable = F.when(usable, True).otherwise(F.raise_error(F.concat(F.lit("not an image: "), "path")).cast("boolean"))
    decode = decode or decoder()
    plain = ["id", "slide_id", "x_center", "y_center", "label"]
    if decode:
        named = list_files(spark, root, pattern).filter("imid IS NOT NULL").select("imid", "path", "length")
        matched = annotate(keyed, named, "imid").select(
            row_id("imid").alias("id"), F.col("sid").alias("slide_id"), "x_center", "y_center", "label", "path", "length"
        )
        images = decode_content(attach_files(matched), decode).filter(usable)
        if partitions:
            images = images.repartition(partitions)
        return images.select(*plain, *(["content"] if with_content else []), featurize(image_struct()).alias("features"))
    images = scan_images(spark, root, pattern, drop_invalid=False).filter("imid IS NOT NULL")
    wanted = keyed.groupBy("imid").agg(F.count("*").alias("_wanted"))
    # A check that names columns of both sides isn't moved before the join.
    images = images.join(wanted, "imid").filter(F.when(F.col("_wanted") > 0, usable))
    if partitions:
        images = images.repartition(partitions)
    features = images.select("imid", "path", featurize(image_struct()).alias("features"))
    rows = annotate(keyed, features, "imid").withColumnRenamed("sid", "slide_id").withColumn("id", row_id("imid"))
    if not with_content:
        return rows.select(*plain, "features")
    return attach_content(rows.select(*plain, "features", "path")).select(*plain, "content", "features")


def image_rejects(spark: SparkSession, root: str, pattern: str = "*/*/*.jpg") -> DataFrame:
    """``(path, reason)`` of files that the image job can't use: ``invalid`` or ``unnamed``."""
    images = scan_images(spark, root, pattern, drop_invalid=False)
    reason = F.when(F.col("height") <= 0, "invalid").when(F.col("imid").isNull(), "unnamed")
    return images.select("path", reason.alias("reason")).filter("reason is not null")


def write_features(df: DataFrame, table: FeatureTable, location: str | None = None) -> DataFrame:
    """Create the feature table when it is new, upsert the rows, return the table."""
    create_feature_table(df, table, location)
    upsert(df, table.name)
    return read_feature_table(df.sparkSession, table.name)


@dataclass(frozen=True)
class Trained:
    """A packaged model and the rows held out from its training, without features.

    ``splits`` has every split but the training part, by name; ``held_out`` is all of them together.
    """

    package: ModelPackage
    splits: Mapping[str, DataFrame]

    @property
    def held_out(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.splits.values())


def train(
    base: DataFrame,
    keys: Sequence[str],
    lookups: Iterable[FeatureLookup],
    pipeline: Pipeline | None = None,
    label: str = "label",
    exclude: Sequence[str] = (),
    weights: Mapping[str, float] = TRAIN_VALIDATION,
    seed: int = SPLIT_SEED,
    resolve: Callable[[str], DataFrame] | None = None,
    base_table: str | None = None,
    salts: int = 1,
) -> Trained:
    """Split the base rows by key, look up features for the training part, fit.

    The training rows are written out once, because the fit reads them several
    times, and deleted after it, so read no training summary from the model. The
    first split name is the training part.
    """
    lookups = tuple(lookups)
    splits = split_frames(base, keys, weights, seed)
    names = list(splits)
    rows = training_set(splits[names[0]], lookups, label, exclude, resolve, base_table, salts)
    stored = scratch_path(base.sparkSession, "training")
    model = (pipeline or classifier(label=label)).fit(materialise(rows, stored))
    discard(base.sparkSession, stored)
    return Trained(ModelPackage(model, lookups, tuple(exclude)), {name: splits[name] for name in names[1:]})


@dataclass(frozen=True)
class Validated:
    report: DataFrame
    failed: list[Row]


def validate(
    scored: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    baseline: str | None = None,
    rules: Iterable[Threshold] = DEFAULT_THRESHOLDS,
    run_mode: str = "enabled",
    custom: Mapping[str, Callable[[Column, Column], Column]] | None = None,
) -> Validated:
    """Metrics of one or two prediction columns, the report, and the gate.

    In mode ``enabled`` a missed threshold raises. Custom metrics join the
    report under their own names. With them, labels and predictions are stored first,
    so that lookups and models behind ``scored`` run once, whatever is computed of their results.
    """
    roles = {"candidate": prediction} | ({"baseline": baseline} if baseline else {})
    stored = scratch_path(scored.sparkSession, "scored") if custom else None
    if stored:
        scored = materialise(scored.select(*dict.fromkeys([label, *roles.values()])), stored)
    long = metrics_long(weighted_metrics(scored, label, roles))
    if custom:
        for role, column in roles.items():
            own = custom_metrics(scored, label, column, custom).withColumn("role", F.lit(role))
            long = long.unionByName(metrics_long(own, list(custom)))
    wide = long.groupBy("metric_name").agg(
        *[F.max(F.when(F.col("role") == role, F.col("value"))).alias(role) for role in roles]
    )
    report = gate_report(wide, rules)
    if run_mode != "disabled":
        # One row per metric: evaluated once, for the gate and for the caller.
        report = report.sparkSession.createDataFrame(report.collect(), report.schema)
        if stored:
            discard(report.sparkSession, stored)
    return Validated(report, enforce(report, run_mode))


def train_and_validate(
    base: DataFrame,
    keys: Sequence[str],
    lookups: Iterable[FeatureLookup],
    package_path: str,
    rules: Iterable[Threshold] = DEFAULT_THRESHOLDS,
    run_mode: str = "enabled",
    pipeline: Pipeline | None = None,
    label: str = "label",
    resolve: Callable[[str], DataFrame] | None = None,
) -> Validated:
    """Train, package, load the package again, score the held-out rows, gate."""
    spark = base.sparkSession
    trained = train(base, keys, lookups, pipeline, label, resolve=resolve)
    trained.package.save(package_path)
    package = ModelPackage.load(spark, package_path)
    scored = score_batch(package, trained.held_out, resolve)
    return validate(scored, label, rules=rules, run_mode=run_mode)


def embed_and_train(
    df: DataFrame,
    featurize: Callable[[Column], Column],
    content: str,
    keys: Sequence[str],
    label: str = "label",
    weights: Mapping[str, float] = TRAIN_VALIDATION,
    seed: int = SPLIT_SEED,
    pipeline: Pipeline | None = None,
) -> DataFrame:
    """Frozen featurizer with a trained layer on top; held-out rows with predictions.

    The embedding is computed and written once; every pass of the fit reads it,
    and it is deleted when the held-out rows are scored. The layer is
    trained by mini-batch descent, unless ``pipeline`` says otherwise.
    """
    spark = df.sparkSession
    stored = scratch_path(spark, "embedding")
    embedded = materialise(df.select(*keys, label, featurize(F.col(content)).alias("features")), stored)
    splits = split_frames(embedded, keys, weights, seed)
    names = list(splits)
    layer = pipeline or Pipeline(stages=[LastLayer(labelCol=label, keys=list(keys))])
    model = layer.fit(splits[names[0]])
    rest = reduce(DataFrame.unionByName, [splits[name] for name in names[1:]])
    scored = apply_model(model, rest, keep_stages=True).select(*keys, label, "probability", "prediction")
    found = materialise(scored)
    discard(spark, stored)
    return found
