"""Packages of foreign models: hashes, one load per worker, saving and moving."""

from io import BytesIO
from pathlib import Path

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel

from patchloom.operators import foreign
from patchloom.operators.foreign import BrokenPackage, ForeignModel, load_checked, numpy_layers
from patchloom.operators.lookup import FeatureLookup
from patchloom.operators.models import ModelPackage, score_batch

LOADER = "patchloom.operators.foreign:numpy_layers"


def layers(seed=0, width=3):
    rng = np.random.default_rng(seed)
    held = {"w0": rng.normal(size=(width, 4)), "b0": rng.normal(size=4), "w1": rng.normal(size=(4, 1)), "b1": rng.normal(size=1)}
    out = BytesIO()
    np.savez(out, **held)
    return out.getvalue(), lambda x: (np.maximum(x @ held["w0"] + held["b0"], 0) @ held["w1"] + held["b1"])[:, 0]


@pytest.fixture(scope="module")
def points(spark):
    rows = [(i, np.random.default_rng(i).normal(size=3).tolist() if i % 10 else None) for i in range(200)]
    return rows, spark.createDataFrame(rows, "id int, features array<float>")


def test_predictions(spark, points):
    rows, frame = points
    data, plain = layers()
    found = {r["id"]: r["prediction"] for r in ForeignModel.package(spark, {"layers.npz": data}, LOADER).transform(frame).collect()}
    assert all(found[i] is None for i, x in rows if x is None)
    assert all(found[i] == pytest.approx(plain(np.array([x], np.float32).astype(float))[0], abs=1e-9) for i, x in rows if x is not None)


def test_in_a_package_that_is_moved(spark, points, tmp_path, rows):
    _, frame = points
    data, _ = layers(1)
    model = ForeignModel.package(spark, {"layers.npz": data, "notes.txt": b"kept too"}, LOADER)
    package = ModelPackage(PipelineModel(stages=[model]), (FeatureLookup("f", ("features",), ("id",)),))
    resolve = {"f": frame}.__getitem__
    scored = rows(score_batch(package, frame.select("id"), resolve))
    package.save(str(tmp_path / "p"))
    package.save(str(tmp_path / "p"))
    (tmp_path / "p").rename(tmp_path / "moved")
    loaded = ModelPackage.load(spark, str(tmp_path / "moved"))
    assert loaded.model.stages[0].getOrDefault(model.digests) == model.getOrDefault(model.digests)
    assert rows(score_batch(loaded, frame.select("id"), resolve)) == scored and len(scored) == 200
    assert sum(r[1] is None for r in scored) == 20


def test_changed_and_missing_files(spark, points, tmp_path):
    _, frame = points
    model = ForeignModel.package(spark, {"layers.npz": layers(2)[0]}, LOADER)
    PipelineModel(stages=[model]).save(str(tmp_path / "m"))
    (weights,) = Path(tmp_path / "m").rglob("layers.npz")
    weights.with_name(".layers.npz.crc").unlink(missing_ok=True)
    weights.write_bytes(layers(3)[0])
    with pytest.raises(PySparkException, match="not the one that was packaged"):
        PipelineModel.load(str(tmp_path / "m")).transform(frame).collect()
    weights.unlink()
    with pytest.raises(PySparkException, match="missing"):
        PipelineModel.load(str(tmp_path / "m")).transform(frame).collect()


@pytest.mark.parametrize("files", [{}, {"a/b": b""}, {".a": b""}, {"": b""}])
def test_names_of_files(spark, files):
    with pytest.raises(ValueError, match="named without folders"):
        ForeignModel.package(spark, files, LOADER)


def test_a_model_that_cant_be_loaded_is_not_packaged(spark):
    for files, loader in (({"other": b""}, LOADER), ({"layers.npz": b"x"}, LOADER), ({"layers.npz": layers()[0]}, "patchloom.operators.foreign:none")):
        with pytest.raises((KeyError, ValueError, AttributeError)):
            ForeignModel.package(spark, files, loader)


def test_loaded_once_in_a_process(spark, monkeypatch, tmp_path):
    data, _ = layers(4)
    model = ForeignModel.package(spark, {"layers.npz": data}, LOADER)
    given = [model.getOrDefault(p) for p in (model.path, model.digests, model.loader)]
    made = []
    monkeypatch.setattr(foreign, "numpy_layers", lambda files: made.append(1) or numpy_layers(files))
    monkeypatch.setattr(foreign, "_LOADED", {})
    assert load_checked(*given) is load_checked(*given) and made == [1]
    for seed in range(10, 10 + foreign.MOST_LOADED):
        other = ForeignModel.package(spark, {"layers.npz": layers(seed)[0]}, LOADER)
        load_checked(*[other.getOrDefault(p) for p in (other.path, other.digests, other.loader)])
    assert len(foreign._LOADED) == foreign.MOST_LOADED and (given[1], given[2]) not in foreign._LOADED
    with pytest.raises(BrokenPackage, match="missing"):
        load_checked(str(tmp_path), given[1], given[2])


def test_loaded_once_per_worker(spark, points, tmp_path):
    """Every process that loads writes a line; many more tasks run than there are workers."""
    _, frame = points
    model = ForeignModel.package(spark, {"log": str(tmp_path / "log").encode()}, "tests.test_foreign:logged")
    (tmp_path / "log").write_text("")
    assert model.transform(frame.repartition(60)).filter("prediction = 7").count() == 180
    lines = (tmp_path / "log").read_text().split()
    assert lines and len(lines) == len(set(lines)) <= 16


def logged(files):
    import os

    with open(files["log"].decode(), "a") as log:
        log.write(f"{os.getpid()}\n")
    return lambda x: np.full(len(x), 7.0)
