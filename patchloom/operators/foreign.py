"""Packages of models that Spark ML doesn't know: weight files, checked by hash, and the name of a loader.

The files lie on storage that all executors share. A Python worker reads and checks them
once, however many tasks it runs, and keeps the loaded model.
"""

from __future__ import annotations

import hashlib
import importlib
import json
from collections.abc import Callable, Iterator, Mapping
from io import BytesIO

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.session import scratch_path
from patchloom.sources.files import Opener

# A function of a batch, rows x features, that gives a number for each row.
Predict = Callable[[np.ndarray], np.ndarray]

_LOADED: dict[tuple[str, str], Predict] = {}
# Models that a worker keeps; the oldest goes first.
MOST_LOADED = 4


class BrokenPackage(ValueError):
    """A weight file is missing or has another content than when it was packaged."""


def numpy_layers(files: Mapping[str, bytes]) -> Predict:
    """Loader for dense layers in ``layers.npz`` (w0, b0, w1, b1, ...), with negative values cut off between them; the last has one output."""
    with np.load(BytesIO(files["layers.npz"]), allow_pickle=False) as held:
        layers = [(held[f"w{k}"], held[f"b{k}"]) for k in range(len(held.files) // 2)]

    def predict(x: np.ndarray) -> np.ndarray:
        for k, (w, b) in enumerate(layers):
            x = x @ w + b
            if k + 1 < len(layers):
                x = np.maximum(x, 0)
        return x[:, 0]

    return predict


def _named(loader: str) -> Callable[[Mapping[str, bytes]], Predict]:
    module, _, function = loader.partition(":")
    return getattr(importlib.import_module(module), function)


def load_checked(path: str, digests: str, loader: str) -> Predict:
    """The model of a package, from this process's memory if it was loaded before; ``digests`` is JSON from file names to SHA-256."""
    known = (digests, loader)
    if known not in _LOADED:
        files, opener = {}, Opener()
        for name, digest in json.loads(digests).items():
            filesystem, location = opener(f"{path}/{name}")
            try:
                with filesystem.open_input_stream(location) as stream:
                    files[name] = stream.read()
            except FileNotFoundError:
                raise BrokenPackage(f"the file {name} is missing in {path}") from None
            if hashlib.sha256(files[name]).hexdigest() != digest:
                raise BrokenPackage(f"the file {name} in {path} is not the one that was packaged")
        model = _named(loader)(files)
        while len(_LOADED) >= MOST_LOADED:
            del _LOADED[next(iter(_LOADED))]
        _LOADED[known] = model
    return _LOADED[known]


class ForeignModel(Model, HasFeaturesCol, HasPredictionCol, MLReadable, MLWritable):
    """A pipeline stage around a packaged model: an array column to a prediction, null for null.

    ``loader`` is ``module:function``, importable on the executors; it gets the files' bytes by name and returns
    a function of a batch. Saving the stage, alone or in a ``PipelineModel`` or ``ModelPackage``, copies the files.
    """

    # What the model makes of zeros in place of absent features is nobody's business.
    needs_whole_rows = True

    path = Param(Params._dummy(), "path", "folder of the weight files", TypeConverters.toString)
    digests = Param(Params._dummy(), "digests", "SHA-256 of each file, as JSON", TypeConverters.toString)
    loader = Param(Params._dummy(), "loader", "module:function that makes a model of the files", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", path: str | None = None, digests: str | None = None, loader: str | None = None):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def package(cls, spark: SparkSession, files: Mapping[str, bytes], loader: str, features: str = "features") -> ForeignModel:
        """Write the files to the scratch folder, from where saving copies them; the model is loaded once here, to see that it can be."""
        if not files or any(not name or "/" in name or name.startswith(".") for name in files):
            raise ValueError("a package needs files, named without folders")
        _named(loader)(files)
        path = scratch_path(spark, "weights")
        for name, data in files.items():
            target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
            stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
            stream.write(bytearray(data))
            stream.close()
        digests = json.dumps({name: hashlib.sha256(data).hexdigest() for name, data in sorted(files.items())})
        return cls(featuresCol=features, path=path, digests=digests, loader=loader)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        path, digests, loader = (self.getOrDefault(p) for p in (self.path, self.digests, self.loader))

        @F.pandas_udf("double")
        def predictions(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            # The worker's own module, whose memory outlives the task; what is sent with the function doesn't.
            from patchloom.operators.foreign import load_checked

            model = load_checked(path, digests, loader)
            for batch in batches:
                known = batch.notna().to_numpy()
                out = pd.Series([None] * len(batch), dtype="Float64")
                if known.any():
                    out[known] = np.asarray(model(np.stack(batch[known].to_numpy()).astype(np.float64)), np.float64)
                yield out

        features = F.col(self.getFeaturesCol()).cast("array<double>")
        return dataset.withColumn(self.getPredictionCol(), predictions.asNondeterministic()(features))

    def write(self) -> MLWriter:
        return _ForeignWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForeignReader(cls)


class _ForeignWriter(MLWriter):
    def __init__(self, instance: ForeignModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark, held = self.sparkSession, self.instance
        DefaultParamsWriter.saveMetadata(held, path, spark)
        fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        for name in json.loads(held.getOrDefault(held.digests)):
            source, target = fs.Path(f"{held.getOrDefault(held.path)}/{name}"), fs.Path(f"{path}/weights/{name}")
            fs.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, conf)


class _ForeignReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ForeignModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        found = self.cls()
        found._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(found, metadata)
        return found._set(path=f"{path.rstrip('/')}/weights")
