"""Batch featurizers: a model built once per task and fed with Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from patchloom.functions import pixels as px
from patchloom.sources.images import to_rgb


def featurizer(build_model: Callable[[], Any], featurize: Callable[[Any, pd.Series], np.ndarray]):
    """A column function ``array<float>`` of one column.

    ``build_model`` runs once per task, ``featurize(model, batch)`` once per
    Arrow batch; it returns one row of numbers, of any shape, for each value.
    Nulls are not passed on; their feature is null.

    The function is declared non-deterministic, because Spark otherwise runs it
    again for every filter or explode on its result. Filters placed after it
    are not moved before it, so filter first.
    """

    @F.pandas_udf("array<float>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = build_model()
        for batch in batches:
            known = batch.notna().to_numpy()
            out = np.full(len(batch), None, dtype=object)
            if known.any():
                rows = np.asarray(featurize(model, batch[known]), np.float32).reshape(int(known.sum()), -1)
                for place, row in zip(np.flatnonzero(known), rows):
                    out[place] = row
            yield pd.Series(out)

    return features.asNondeterministic()


def predictor(build_model: Callable[[], Any], predict: Callable[[Any, np.ndarray], np.ndarray]):
    """A column function ``double`` that applies a foreign model to an array column.

    Built and evaluated like :func:`featurizer`; a null gets a null prediction.
    """

    @F.pandas_udf("double")
    def predictions(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = build_model()
        for batch in batches:
            known = batch.notna().to_numpy()
            out = pd.Series([None] * len(batch), dtype="Float64")
            if known.any():
                out[known] = np.asarray(predict(model, np.stack(batch[known].to_numpy())), np.float64)
            yield out

    return predictions.asNondeterministic()


def share_weights(spark: SparkSession, weights: Any) -> Broadcast:
    """Model weights sent to every executor once; ``build_model`` reads ``.value``.

    The size is that of the model and does not grow with the data.
    """
    return spark.sparkContext.broadcast(weights)


def character_pair_counts(texts: pd.Series, buckets: int) -> np.ndarray:
    """Counts of neighbouring characters, hashed into ``buckets``; whole texts.

    A pair of code points ``a, b`` goes to bucket ``(31 a + b) mod buckets``.
    """
    counts = np.zeros((len(texts), buckets))
    for row, text in enumerate(texts):
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        if len(codes) > 1:
            counts[row] = np.bincount((codes[:-1] * 31 + codes[1:]) % buckets, minlength=buckets)
    return counts


def text_featurizer(weights: Broadcast):
    """Frozen text embedding: hashed character pairs times a (buckets x width) matrix."""
    return featurizer(
        lambda: weights.value,
        lambda matrix, texts: character_pair_counts(texts, matrix.shape[0]) @ matrix,
    )


def _preprocess(image: np.ndarray, seed: int, train: bool, size: int, short_side: int) -> np.ndarray:
    if train:
        rng = np.random.default_rng(seed & 0xFFFFFFFFFFFFFFFF)
        image = px.random_flip(px.random_resized_crop(image, size, rng), rng)
    else:
        image = px.center_crop(px.resize_short_side(image, short_side), size)
    return px.normalize_planes(px.to_planes(image)).astype(np.float32).ravel()


def preprocess_images(
    images: DataFrame,
    keep: list[str],
    train: bool = False,
    size: int = 224,
    short_side: int = 256,
    id_column: str = "imid",
    epoch: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Decoded images to ``keep`` plus ``features``, a flat 3 x size x size array.

    Scoring resizes the short side and takes the middle. Training takes a random
    box and flips at random; the random numbers follow from ``id_column`` and
    ``epoch``, so a task that runs again gives the same pixels.
    """
    schema = StructType([images.schema[c] for c in keep] + [StructField("features", ArrayType(FloatType()))])
    seeded = images.select(
        *dict.fromkeys([*keep, "pixels", "height", "width", "channels"]),
        F.xxhash64(id_column, F.lit(epoch)).alias("_seed"),
    )
    # Decoding and resizing cost far more than moving the rows they spread.
    spread = seeded.repartition(partitions) if partitions else seeded

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            features = [
                _preprocess(to_rgb(p, h, w, c), int(s), train, size, short_side)
                for p, h, w, c, s in zip(
                    frame["pixels"], frame["height"], frame["width"], frame["channels"], frame["_seed"]
                )
            ]
            yield frame[keep].assign(features=features)

    return spread.mapInPandas(batches, schema)


def image_struct() -> Column:
    """What an image featurizer takes: the decoded pixels with their shape, as :func:`scan_images` names them."""
    return F.struct("pixels", "height", "width", "channels")


def image_featurizer(weights: Broadcast, height: int, width: int):
    """Frozen embedding of decoded images, a column function of :func:`image_struct`.

    Grey, colour and alpha images become red-green-blue first; images of another
    shape are resized. The batch is stacked and multiplied with a
    (height * width * 3 x n) matrix; pixels stay in 0..255. An image without pixels has no features.
    """

    @F.pandas_udf("array<float>")
    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        matrix = weights.value
        for batch in batches:
            out = np.full(len(batch), None, dtype=object)
            known = np.flatnonzero(batch["pixels"].notna().to_numpy())
            if len(known):
                shapes = zip(*[batch[c].iloc[known] for c in ("pixels", "height", "width", "channels")], strict=True)
                images = [to_rgb(*shape) for shape in shapes]
                images = [i if i.shape[:2] == (height, width) else px.resize(i, height, width) for i in images]
                rows = (np.stack(images).reshape(len(images), -1).astype(np.float64) @ matrix).astype(np.float32)
                for place, row in zip(known, rows, strict=True):
                    out[place] = row
            yield pd.Series(out)

    return features.asNondeterministic()
