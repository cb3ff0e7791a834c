"""A softmax layer on stored embeddings, trained by mini-batch gradient descent.

The rows are written once, partitioned by batch. A step is one job over its
batch: every task sums the gradient of its rows, the sums are added in a tree,
and the driver holds weights and velocity only, whose size is that of the
layer. After each epoch both are written next to the run's history, so that a
run that stops goes on from its last epoch.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from patchloom.functions.vectors import argmax
from patchloom.operators.featurize import share_weights
from patchloom.operators.splits import SPLIT_SEED, split_frames
from patchloom.session import discard, path_exists, scratch_path

# Numbers of a gradient that one row of a partial sum holds, and partial sums that one task adds.
CHUNK, FAN_IN = 8192, 64
# The driver is the root of the tree: it adds as many partial sums as fit in this.
ROOT_BYTES = 16 << 20
_PARTIAL = "part bigint, chunk int, total binary"
_LINE = "split string, learning_rate double, loss double, accuracy double, n_rows bigint, n_left_out bigint"
_EPOCH = f"class int, weights array<double>, velocity array<double>, lines array<struct<{_LINE.replace(', ', ',').replace(' ', ':')}>>"


@dataclass(frozen=True)
class Descent:
    """Settings of a run; epochs count from 1.

    The rate of an epoch is ``learning_rate`` times ``decay_by`` for every
    ``decay_every`` epochs before it. ``batches`` is the number of steps in an epoch.
    ``classes`` is measured where it is not given.
    """

    epochs: int = 5
    batches: int = 8
    learning_rate: float = 0.001
    momentum: float = 0.9
    decay_every: int = 7
    decay_by: float = 0.1
    seed: int = SPLIT_SEED
    classes: int | None = None

    def rate(self, epoch: int) -> float:
        return self.learning_rate * self.decay_by ** ((epoch - 1) // self.decay_every)

    def order(self, epoch: int) -> list[int]:
        """The batches in the order in which an epoch takes them; it follows from seed and epoch."""
        return sorted(range(self.batches), key=lambda b: hashlib.md5(f"{self.seed}|{epoch}|{b}".encode()).hexdigest())


def batch_of(keys: Sequence[str], batches: int, seed: int = SPLIT_SEED) -> Column:
    """The batch that a row belongs to: from 0, by a hash of its key and the seed."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("batch"), *[F.col(k).cast("string") for k in keys]))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % batches).cast("int")


def _softmax_parts(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities, loss and hits of rows; the last column of ``weights`` is the intercept."""
    z = x @ weights[:, :-1].T + weights[:, -1]
    top = z.max(axis=1, keepdims=True)
    e = np.exp(z - top)
    total = e.sum(axis=1, keepdims=True)
    loss = (top + np.log(total))[:, 0] - z[np.arange(len(y)), y]
    return e / total, loss, z.argmax(axis=1) == y


def _judged(batch: pa.RecordBatch, dims: int, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and labels of the rows that can be judged, and which rows those are."""
    label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(invalid="ignore"):
        known = (label >= 0) & (label < classes) & (label == np.floor(label))
    column = batch.column("features")
    known &= pc.fill_null(pc.list_value_length(column), -1).to_numpy() == dims
    x = column.filter(pa.array(known)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    finite = np.isfinite(x).all(axis=1)
    known[np.flatnonzero(known)[~finite]] = False
    return x[finite], label[known].astype(np.int64), known


def _partial_gradient(weights, classes: int, dims: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        gradient = np.zeros((classes, dims + 1))
        loss = hits = n = out = 0.0
        for batch in batches:
            x, y, known = _judged(batch, dims, classes)
            out += len(known) - len(y)
            if not len(y):
                continue
            p, losses, hit = _softmax_parts(x, y, w)
            p[np.arange(len(y)), y] -= 1
            gradient[:, :-1] += p.T @ x
            gradient[:, -1] += p.sum(axis=0)
            loss, hits, n = loss + losses.sum(), hits + hit.sum(), n + len(y)
        numbers = np.concatenate([gradient.ravel(), [loss, hits, n, out]])
        chunks = [numbers[k : k + CHUNK].tobytes() for k in range(0, len(numbers), CHUNK)]
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part] * len(chunks), pa.int64()),
                "chunk": pa.array(range(len(chunks)), pa.int32()),
                "total": pa.array(chunks, pa.binary()),
            }
        )

    return work


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of neighbouring rows of one (chunk, part); one sum is held."""
    key, total = None, None

    def row():
        return pa.RecordBatch.from_pydict(
            {"part": pa.array([key[1]], pa.int64()), "chunk": pa.array([key[0]], pa.int32()), "total": pa.array([total.tobytes()], pa.binary())}
        )

    for batch in batches:
        for part, chunk, numbers in zip(*(batch.column(c).to_pylist() for c in ("part", "chunk", "total")), strict=True):
            if (chunk, part) != key:
                if key is not None:
                    yield row()
                key, total = (chunk, part), np.frombuffer(numbers).copy()
            else:
                total += np.frombuffer(numbers)
    if key is not None:
        yield row()


def tree_sum(partials: DataFrame, parts: int, width: int, fan_in: int = FAN_IN, root_bytes: int = ROOT_BYTES) -> np.ndarray:
    """The sum of ``parts`` partial sums (part, chunk, total) of ``width`` numbers.

    A task adds ``fan_in`` of them, round by round, until what is left fits the
    driver, which adds the rest. Sums are added in the order of their parts, so equal parts give equal sums.
    """
    while parts > 1 and parts * width * 8 > root_bytes:
        ordered = partials.withColumn("_from", F.col("part")).withColumn("part", F.expr(f"part div {fan_in}"))
        partials = ordered.repartition("chunk", "part").sortWithinPartitions("chunk", "part", "_from").drop("_from").mapInArrow(_add, _PARTIAL)
        parts = -(-parts // fan_in)
    total = np.zeros(width)
    for row in sorted(partials.collect(), key=lambda r: r["part"]):
        numbers = np.frombuffer(row["total"])
        total[row["chunk"] * CHUNK :][: len(numbers)] += numbers
    return total


def _evaluate(rows: DataFrame, weights: np.ndarray) -> Row:
    """Loss as the mean of the batches' means, and accuracy over all judged rows."""
    classes, dims = weights.shape[0], weights.shape[1] - 1
    shared = share_weights(rows.sparkSession, weights)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x, y, known = _judged(batch, dims, classes)
            number = batch.column("batch").to_numpy()
            _, losses, hit = _softmax_parts(x, y, shared.value)
            for b in np.unique(number):
                mine, of = number[known] == b, number == b
                sums[b] = sums.get(b, 0) + np.array([losses[mine].sum(), hit[mine].sum(), mine.sum(), (of & ~known).sum()])
        if sums:
            columns = np.array(list(sums.values())).T
            names = dict(zip(("loss", "hits", "n", "out"), (pa.array(c) for c in columns), strict=True))
            yield pa.RecordBatch.from_pydict({"batch": pa.array([int(b) for b in sums], pa.int32())} | names)

    tasks = rows.mapInArrow(work, "batch int, loss double, hits double, n double, out double")
    by_batch = tasks.groupBy("batch").agg(*[F.sum(c).alias(c) for c in ("loss", "hits", "n", "out")])
    found = by_batch.agg(
        F.avg(F.when(F.col("n") > 0, F.col("loss") / F.col("n"))).alias("loss"),
        (F.sum("hits") / F.nullif(F.sum("n"), F.lit(0.0))).alias("accuracy"),
        F.coalesce(F.sum("n"), F.lit(0.0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum("out"), F.lit(0.0)).cast("bigint").alias("n_left_out"),
    ).first()
    shared.destroy()
    return found


class Run:
    """A training run below a folder: stored rows, settings, weights by epoch, history.

    The folder must be one that all executors share; its files are the caller's.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def history(self) -> DataFrame:
        """(epoch, split, learning_rate, loss, accuracy, n_rows, n_left_out): a row per epoch and split.

        Training rows are judged as they are met, before the step that uses them;
        validation rows after the epoch. Rows without a usable label or features are counted in ``n_left_out`` only.
        """
        lines = self._epochs().filter("lines IS NOT NULL").select("epoch", F.inline("lines"))
        return lines.select("epoch", *[c for c in lines.columns if c != "epoch"])

    def weights(self, epoch: int) -> np.ndarray:
        """Classes x (features and intercept) after an epoch."""
        return self._state(epoch)[0]

    def last_epoch(self) -> int:
        """The last epoch that was finished, 0 before the first."""
        if not path_exists(self.spark, f"{self.path}/epochs"):
            return 0
        return self._epochs().agg(F.max("epoch")).first()[0] or 0

    def best_epoch(self) -> int:
        """The epoch with the smallest validation loss, the first of equal ones; without validation rows, the last one."""
        losses = self.history().filter("split = 'validation' AND loss IS NOT NULL").orderBy("loss", "epoch").limit(1).collect()
        return losses[0]["epoch"] if losses else self.last_epoch()

    def _epochs(self) -> DataFrame:
        return self.spark.read.schema(f"{_EPOCH}, epoch int").parquet(f"{self.path}/epochs")

    def _state(self, epoch: int) -> tuple[np.ndarray, np.ndarray]:
        rows = self._epochs().filter(F.col("epoch") == epoch).select("class", "weights", "velocity").collect()
        rows = sorted(rows, key=lambda r: r["class"])
        if not rows:
            raise ValueError(f"no weights of epoch {epoch} below {self.path}")
        return np.array([r["weights"] for r in rows]), np.array([r["velocity"] for r in rows])

    def _save(self, epoch: int, weights: np.ndarray, velocity: np.ndarray, lines: list[tuple]) -> None:
        """Weights and history of an epoch in one write, so that it is there wholly or not at all."""
        rows = [(k, w.tolist(), v.tolist(), None if k else lines) for k, (w, v) in enumerate(zip(weights, velocity, strict=True))]
        self.spark.createDataFrame(rows, _EPOCH).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/epochs/epoch={epoch}")

    def prepare(self, train: DataFrame, validation: DataFrame | None, keys: Sequence[str], settings: Descent, features: str, label: str) -> tuple[Descent, int]:
        """Store the rows by batch and the settings, unless an earlier run has; settings with classes, and the features' length."""
        noted = f"{self.path}/settings"
        if path_exists(self.spark, noted):
            known = json.loads(self.spark.read.text(noted).first()["value"])
            dims, before = known.pop("dims"), Descent(**known)
            asked = replace(settings, epochs=before.epochs, classes=settings.classes or before.classes)
            if asked != before:
                raise ValueError(f"{self.path} holds a run with other settings: {before}")
            return replace(before, epochs=settings.epochs), dims
        for name, rows in (("train", train), ("validation", validation)):
            if rows is not None:
                slim = rows.select(batch_of(keys, settings.batches, settings.seed).alias("batch"), F.col(label).cast("double").alias("label"), F.col(features).cast("array<double>").alias("features"))
                # Dealt out by batch and size: small batches share a task, large ones take several.
                slim.hint("rebalance", "batch").write.mode("overwrite").partitionBy("batch").parquet(f"{self.path}/rows/{name}")
        shape = self._rows("train").agg(F.max(F.size("features")).alias("dims"), F.max("label").alias("label")).first()
        if not shape["dims"] or shape["dims"] < 0 or (settings.classes is None and shape["label"] is None):
            raise ValueError("there are no training rows with label and features")
        settings = replace(settings, classes=settings.classes or int(shape["label"]) + 1)
        text = json.dumps(asdict(settings) | {"dims": shape["dims"]})
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(noted)
        return settings, shape["dims"]

    def _rows(self, name: str) -> DataFrame:
        return self.spark.read.schema("label double, features array<double>, batch int").parquet(f"{self.path}/rows/{name}")

    def drop_rows(self) -> None:
        """Delete the stored rows, which are the run's bulk; history and weights stay."""
        if path_exists(self.spark, f"{self.path}/rows"):
            discard(self.spark, f"{self.path}/rows")

    def advance(self, settings: Descent, dims: int, validated: bool) -> np.ndarray:
        """Run the epochs that are missing; the weights after the last one."""
        rows = self._rows("train")
        held_out = self._rows("validation") if validated else None
        start = self.last_epoch()
        shape = (settings.classes, dims + 1)
        weights, velocity = self._state(start) if start else (np.zeros(shape), np.zeros(shape))
        for epoch in range(start + 1, settings.epochs + 1):
            rate, sums = settings.rate(epoch), np.zeros(4)
            for batch in settings.order(epoch):
                gradient, told = self._step(rows.filter(F.col("batch") == batch), weights)
                sums += told
                if told[2]:
                    velocity = settings.momentum * velocity + gradient / told[2]
                    weights = weights - rate * velocity
            loss, hits, n, out = sums.tolist()
            lines = [("train", rate, loss / n if n else None, hits / n if n else None, int(n), int(out))]
            if held_out is not None:
                found = _evaluate(held_out, weights)
                lines.append(("validation", rate, found["loss"], found["accuracy"], found["n_rows"], found["n_left_out"]))
            if not np.isfinite(weights).all():
                raise ArithmeticError(f"the weights grew beyond all bounds in epoch {epoch}: lower the learning rate")
            self._save(epoch, weights, velocity, lines)
        return weights

    def _step(self, rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Summed gradient, and (loss, hits, judged rows, rows left out)."""
        shared = share_weights(self.spark, weights)
        partials = rows.select("label", "features").mapInArrow(_partial_gradient(shared, weights.shape[0], weights.shape[1] - 1), _PARTIAL)
        parts = rows._jdf.queryExecution().toRdd().getNumPartitions()
        total = tree_sum(partials, parts, weights.size + 4)
        shared.destroy()
        return total[:-4].reshape(weights.shape), total[-4:]


class LastLayer(Estimator, HasFeaturesCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Softmax layer on an array column by mini-batch descent with momentum and step decay.

    Rows are dealt to batches, and ``validationShare`` of them to validation, by a hash of ``keys``. The layer is
    that of the best epoch, or with ``keep="last"`` of the last one. With ``path``
    an earlier run there is continued; without it the run lies in the scratch folder. Stored rows are deleted after the fit.
    """

    keys = Param(Params._dummy(), "keys", "columns that name a row", TypeConverters.toListString)
    epochs = Param(Params._dummy(), "epochs", "passes over the rows", TypeConverters.toInt)
    batches = Param(Params._dummy(), "batches", "steps in an epoch", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "rate of the first epochs", TypeConverters.toFloat)
    momentum = Param(Params._dummy(), "momentum", "share of the velocity that stays", TypeConverters.toFloat)
    validationShare = Param(Params._dummy(), "validationShare", "share of rows for validation", TypeConverters.toFloat)
    keep = Param(Params._dummy(), "keep", "best or last", TypeConverters.toString)
    path = Param(Params._dummy(), "path", "folder of the run", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", labelCol: str = "label", keys: Sequence[str] = ("id",), epochs: int = 5, batches: int = 8,
        learningRate: float = 0.001, momentum: float = 0.9, validationShare: float = 0.1, keep: str = "best", path: str | None = None,
    ):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", keys=["id"], epochs=5, batches=8, learningRate=0.001, momentum=0.9, validationShare=0.1, keep="best")
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**(given | {"keys": list(given.get("keys", ["id"]))}))

    def _fit(self, dataset: DataFrame) -> LastLayerModel:
        get = self.getOrDefault
        if get(self.keep) not in ("best", "last"):
            raise ValueError(f"keep must be 'best' or 'last', not {get(self.keep)!r}")
        spark = dataset.sparkSession
        settings = Descent(get(self.epochs), get(self.batches), get(self.learningRate), get(self.momentum))
        run = Run(spark, get(self.path) if self.isSet(self.path) else scratch_path(spark, "descent"))
        share, names = get(self.validationShare), get(self.keys)
        parts = split_frames(dataset, names, {"train": 1 - share, "validation": share}, settings.seed) if share else {"train": dataset}
        settings, dims = run.prepare(parts["train"], parts.get("validation"), names, settings, self.getFeaturesCol(), self.getLabelCol())
        weights = run.advance(settings, dims, bool(share))
        if get(self.keep) == "best":
            weights = run.weights(run.best_epoch())
        if not self.isSet(self.path):
            run.drop_rows()
        return LastLayerModel(featuresCol=self.getFeaturesCol(), weights=weights.tolist(), runPath=run.path)


class LastLayerModel(Model, HasFeaturesCol, HasProbabilityCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds probabilities, as an array, and the most probable class; both are null without finite features of the right length."""

    weights = Param(Params._dummy(), "weights", "classes x (features and intercept)", TypeConverters.toListListFloat)
    runPath = Param(Params._dummy(), "runPath", "folder of the run", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", weights: list[list[float]] | None = None, runPath: str | None = None):
        super().__init__()
        self._setDefault(featuresCol="features", probabilityCol="probability", predictionCol="prediction")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def numFeatures(self) -> int:
        return len(self.getOrDefault(self.weights)[0]) - 1

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = share_weights(dataset.sparkSession, np.array(self.getOrDefault(self.weights)))
        dims = self.numFeatures

        @F.pandas_udf("array<double>")
        def probabilities(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                out = np.full(len(batch), None, dtype=object)
                fits = np.array([v is not None and len(v) == dims for v in batch], bool)
                if fits.any():
                    x = np.stack(batch[fits].to_numpy()).astype(np.float64)
                    with np.errstate(invalid="ignore"):
                        z = x @ weights.value[:, :-1].T + weights.value[:, -1]
                        e = np.exp(z - z.max(axis=1, keepdims=True))
                    for place, row, usable in zip(np.flatnonzero(fits), e / e.sum(axis=1, keepdims=True), np.isfinite(x).all(axis=1), strict=True):
                        out[place] = row if usable else None
                yield pd.Series(out)

        scored = dataset.withColumn(self.getProbabilityCol(), probabilities.asNondeterministic()(F.col(self.getFeaturesCol()).cast("array<double>")))
        return scored.withColumn(self.getPredictionCol(), argmax(self.getProbabilityCol()).cast("double"))
