"""The descent against a plain numpy loop."""

import hashlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from patchloom.operators.descent import CHUNK, Descent, LastLayer, LastLayerModel, Run, batch_of, tree_sum
from patchloom.operators.lookup import FeatureLookup
from patchloom.operators.models import ModelPackage, score_batch
from patchloom.plans.jobs import embed_and_train, train

SETTINGS = Descent(epochs=4, batches=3, learning_rate=0.3, momentum=0.8, decay_every=2)


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(11)
    label = rng.integers(0, 3, 400)
    x = np.eye(3)[label] * 1.5 + rng.normal(0, 0.8, (400, 3))
    rows = [(i, int(y), p.tolist()) for i, (y, p) in enumerate(zip(label, x, strict=True))]
    rows += [(900, None, [1.0, 1.0, 1.0]), (901, 1, None), (902, 1, [1.0]), (903, 1, [1.0, float("nan"), 0.0]), (904, 7, [1.0, 1.0, 1.0])]
    return rows, spark.createDataFrame(rows, "id int, label int, features array<double>")


def plain(rows, settings, held_out=()):
    """Weights after every epoch, and (loss, accuracy) of both parts."""
    def usable(part):
        return [(i, y, x) for i, y, x in part if y is not None and 0 <= y < 3 and x is not None and len(x) == 3 and np.isfinite(x).all()]

    def batch(i):
        return int(hashlib.md5(f"{settings.seed}|batch|{i}".encode()).hexdigest()[:8], 16) % settings.batches

    def judge(part, w):
        x = np.array([[*p, 1.0] for _, _, p in part])
        y = np.array([k for _, k, _ in part])
        z = x @ w.T
        p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        return x, y, p, -np.log(p[np.arange(len(y)), y]), z.argmax(axis=1) == y

    w, v, weights, lines = np.zeros((3, 4)), np.zeros((3, 4)), [], []
    for epoch in range(1, settings.epochs + 1):
        rate = settings.learning_rate * settings.decay_by ** ((epoch - 1) // settings.decay_every)
        losses, hits = [], []
        for b in settings.order(epoch):
            part = [r for r in usable(rows) if batch(r[0]) == b]
            if not part:
                continue
            x, y, p, loss, hit = judge(part, w)
            losses, hits = [*losses, *loss], [*hits, *hit]
            v = settings.momentum * v + (p - np.eye(3)[y]).T @ x / len(y)
            w = w - rate * v
        weights.append(w)
        lines.append((epoch, "train", np.mean(losses), np.mean(hits)))
        if held_out:
            by = [[r for r in usable(held_out) if batch(r[0]) == b] for b in range(settings.batches)]
            told = [judge(part, w) for part in by if part]
            lines.append((epoch, "validation", np.mean([t[3].mean() for t in told]), np.concatenate([t[4] for t in told]).mean()))
    return weights, lines


def run_of(spark, folder, frame, held_out, settings):
    run = Run(spark, str(folder))
    found, dims = run.prepare(frame, held_out, ["id"], settings, "features", "label")
    run.advance(found, dims, held_out is not None)
    return run


def test_weights_and_history_are_those_of_a_plain_loop(spark, points, tmp_path):
    rows, frame = points
    settings = replace(SETTINGS, classes=3)
    run = run_of(spark, tmp_path / "run", frame.filter("id % 4 > 0").repartition(5), frame.filter("id % 4 = 0"), settings)
    weights, lines = plain([r for r in rows if r[0] % 4], settings, [r for r in rows if r[0] % 4 == 0])
    for epoch, w in enumerate(weights, 1):
        np.testing.assert_allclose(run.weights(epoch), w, rtol=0, atol=1e-10)
    found = run.history().orderBy("epoch", "split").collect()
    assert [(r["epoch"], r["split"]) for r in found] == [line[:2] for line in lines]
    for r, line in zip(found, lines, strict=True):
        assert (r["loss"], r["accuracy"]) == pytest.approx(line[2:], abs=1e-10)
    assert {r["n_left_out"] for r in found if r["split"] == "train"} == {3}
    assert [r["learning_rate"] for r in found if r["split"] == "train"] == pytest.approx([0.3, 0.3, 0.03, 0.03])
    best = min((line for line in lines if line[1] == "validation"), key=lambda line: line[2])[0]
    assert run.best_epoch() == best and run.last_epoch() == 4


def test_a_run_that_stopped_goes_on(spark, points, tmp_path):
    _, frame = points
    whole = run_of(spark, tmp_path / "whole", frame, None, replace(SETTINGS, classes=3))
    parts = run_of(spark, tmp_path / "parts", frame, None, replace(SETTINGS, epochs=1, classes=3))
    assert parts.last_epoch() == 1
    parts = run_of(spark, tmp_path / "parts", frame, None, replace(SETTINGS, epochs=4))
    np.testing.assert_allclose(parts.weights(4), whole.weights(4), rtol=0, atol=1e-12)
    assert sorted(r["epoch"] for r in parts.history().collect()) == [1, 2, 3, 4]
    before = parts.history().collect()
    run_of(spark, tmp_path / "parts", frame, None, SETTINGS)  # nothing is left to do
    assert parts.history().collect() == before
    with pytest.raises(ValueError, match="other settings"):
        run_of(spark, tmp_path / "parts", frame, None, replace(SETTINGS, momentum=0.1))
    with pytest.raises(ValueError, match="no weights of epoch 9"):
        parts.weights(9)


def test_more_batches_than_rows(spark, points, tmp_path):
    rows, frame = points
    settings = replace(SETTINGS, epochs=1, batches=40, classes=3)
    run = run_of(spark, tmp_path / "run", frame.filter("id < 12"), None, settings)
    np.testing.assert_allclose(run.weights(1), plain(rows[:12], settings)[0][0], rtol=0, atol=1e-10)


@pytest.mark.parametrize("rows", [[], [(1, None, [1.0])], [(1, 0, None)]])
def test_nothing_to_learn_from(spark, tmp_path, rows):
    frame = spark.createDataFrame(rows, "id int, label int, features array<double>")
    with pytest.raises(ValueError, match="no training rows"):
        run_of(spark, tmp_path / "run", frame, None, SETTINGS)


def test_weights_without_bounds_are_an_error(spark, tmp_path):
    frame = spark.createDataFrame([(i, i % 2, [1e200 * (-1) ** i]) for i in range(20)], "id int, label int, features array<double>")
    with pytest.raises(ArithmeticError, match="lower the learning rate"):
        run_of(spark, tmp_path / "run", frame, None, replace(SETTINGS, learning_rate=1e200))


@pytest.mark.parametrize("parts, width, root", [(1, 5, 0), (3, 7, 1 << 20), (50, CHUNK + 3, 0), (50, 2 * CHUNK, 10 * 16 * CHUNK)])
def test_sums_in_a_tree(spark, parts, width, root):
    rng = np.random.default_rng(1)
    numbers = rng.normal(size=(parts, width))
    rows = [(p, k, bytearray(line[k * CHUNK : (k + 1) * CHUNK].tobytes())) for p, line in enumerate(numbers) for k in range(-(-width // CHUNK))]
    frame = spark.createDataFrame(rows, "part bigint, chunk int, total binary").repartition(4)
    np.testing.assert_allclose(tree_sum(frame, parts, width, fan_in=4, root_bytes=root), numbers.sum(axis=0), atol=1e-12)
    assert not tree_sum(frame.limit(0), 1, width).any()


def test_batches_follow_from_the_key(spark):
    found = spark.range(100).select("id", batch_of(["id"], 7).alias("b")).collect()
    assert all(r["b"] == int(hashlib.md5(f"12345|batch|{r['id']}".encode()).hexdigest()[:8], 16) % 7 for r in found)
    assert sorted(Descent(batches=9).order(3)) == list(range(9)) and Descent(batches=9).order(3) != Descent(batches=9).order(4)


def test_layer_in_a_package(spark, points, tmp_path, rows):
    _, frame = points
    base, lookup = frame.filter("id < 400").select("id", "label"), [FeatureLookup("f", ("features",), ("id",))]
    resolve = {"f": frame.select("id", "features")}.__getitem__
    layer = LastLayer(keys=["id"], epochs=6, batches=2, learningRate=0.5, path=str(tmp_path / "run"))
    result = train(base, ["id"], lookup, Pipeline(stages=[layer]), resolve=resolve)
    scored = score_batch(result.package, result.held_out, resolve)
    assert scored.filter("label = prediction").count() > 0.75 * scored.count()
    result.package.save(str(tmp_path / "p"))
    loaded = ModelPackage.load(spark, str(tmp_path / "p"))
    assert rows(score_batch(loaded, result.held_out, resolve)) == rows(scored)
    unknown = score_batch(loaded, frame.select("id").filter("id >= 901"), resolve).collect()
    assert {r["id"]: r["prediction"] is None for r in unknown} == {901: True, 902: True, 903: True, 904: False}
    run = Run(spark, str(tmp_path / "run"))
    layer = loaded.model.stages[-1]
    assert isinstance(layer, LastLayerModel) and layer.numFeatures == 3
    np.testing.assert_allclose(np.array(layer.getOrDefault(layer.weights)), run.weights(run.best_epoch()))


def test_probabilities(spark):
    weights = [[1.0, 0.0, 0.5], [0.0, -2.0, 0.0]]
    frame = spark.createDataFrame([(1, [0.5, 0.25]), (2, None), (3, [1.0])], "id int, features array<float>")
    found = {r["id"]: r for r in LastLayerModel(weights=weights).transform(frame).collect()}
    z = np.array([1.0, -0.5])
    assert found[1]["probability"] == pytest.approx(np.exp(z) / np.exp(z).sum()) and found[1]["prediction"] == 0.0
    assert all(found[i]["probability"] is None and found[i]["prediction"] is None for i in (2, 3))


def test_embedding_is_deleted(spark, tmp_path):
    from patchloom.operators.featurize import share_weights, text_featurizer
    from patchloom.session import path_exists, scratch_root

    fs = spark._jvm.org.apache.hadoop.fs
    df = spark.createDataFrame([(i, i % 2, ("aaaa" if i % 2 else "bbbb") * (1 + i % 3)) for i in range(200)], "id int, label int, text string")
    layer = LastLayer(keys=["id"], epochs=3, batches=2, learningRate=0.05)
    scored = embed_and_train(df, text_featurizer(share_weights(spark, np.eye(64))), "text", ["id"], pipeline=Pipeline(stages=[layer]))
    assert scored.filter(F.col("label") == F.col("prediction")).count() == scored.count() > 30
    root = fs.Path(scratch_root(spark))
    left = [s.getPath().getName() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    assert not [n for n in left if n.startswith("embedding-")]
    assert not [n for n in left if n.startswith("descent-") and path_exists(spark, f"{root}/{n}/rows")]


def test_unfitted_layer_is_saved(spark, tmp_path):
    Pipeline(stages=[LastLayer(keys=["a", "b"], epochs=2)]).write().overwrite().save(str(tmp_path / "p"))
    stage = Pipeline.load(str(tmp_path / "p")).getStages()[0]
    assert stage.getOrDefault(stage.keys) == ["a", "b"] and stage.getOrDefault(stage.epochs) == 2
    PipelineModel(stages=[LastLayerModel(weights=[[1.0, 2.0]])]).write().overwrite().save(str(tmp_path / "m"))
    assert PipelineModel.load(str(tmp_path / "m")).stages[0].numFeatures == 1
    with pytest.raises(ValueError, match="keep must be"):
        LastLayer(keep="first").fit(spark.createDataFrame([(1, 0, [1.0])], "id int, label int, features array<double>"))
