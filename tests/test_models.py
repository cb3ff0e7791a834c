import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from patchloom.operators.featurize import character_pair_counts, featurizer, predictor, share_weights, text_featurizer
from patchloom.operators.lookup import FeatureLookup
from patchloom.operators.metrics import weighted_metrics
from patchloom.operators.models import (
    ModelPackage,
    classifier,
    coefficients,
    predict_table,
    regression,
    score_batch,
    training_set,
)
from patchloom.plans.jobs import embed_and_train, train
from patchloom.sinks.tables import overwrite_table


@pytest.fixture(scope="module")
def features(spark):
    rng = np.random.default_rng(5)
    label = rng.integers(0, 3, 300)
    points = np.eye(3)[label] * 3 + rng.normal(0, 0.5, (300, 3))
    rows = [(i, int(y), [float(v) for v in p]) for i, (y, p) in enumerate(zip(label, points))]
    return spark.createDataFrame(rows, "id int, label int, features array<float>")


LOOKUP = [FeatureLookup("f", ("features",), ("id",), missing="error")]


@pytest.fixture(scope="module")
def trained(features):
    resolve = {"f": features.select("id", "features")}.__getitem__
    return train(features.select("id", "label"), ["id"], LOOKUP, exclude=["content", "id"], resolve=resolve), resolve


def test_training_set_columns(features):
    resolve = {"f": features.select("id", "features")}.__getitem__
    rows = training_set(features.select("id", "label"), LOOKUP, exclude=["id", "label", "content"], resolve=resolve)
    assert rows.columns == ["label", "features"]


def test_fit_uses_the_given_settings(trained):
    fitted = trained[0].package.model.stages[-1]
    assert (fitted.getMaxIter(), fitted.getRegParam(), fitted.getElasticNetParam()) == (1, 0.03, 0.5)


def test_saved_package_scores_the_same(spark, trained, tmp_path, rows):
    result, resolve = trained
    scored = score_batch(result.package, result.held_out, resolve)
    assert scored.columns == ["id", "label", "prediction"]
    result.package.save(str(tmp_path / "p"))
    result.package.save(str(tmp_path / "p"))
    loaded = ModelPackage.load(spark, str(tmp_path / "p"))
    assert loaded.lookups == tuple(LOOKUP) and loaded.exclude == ("content", "id")
    assert rows(score_batch(loaded, result.held_out.repartition(7), resolve)) == rows(scored)
    metrics = weighted_metrics(scored).first()
    evaluator = MulticlassClassificationEvaluator()
    assert metrics["f1_score"] == pytest.approx(evaluator.evaluate(scored), abs=1e-12)
    assert metrics["accuracy"] > 0.9


def test_predict_table(spark, trained):
    result, resolve = trained
    overwrite_table(result.held_out, "model_input")
    found = predict_table(spark, result.package, "model_input", "model_output", "3", "2024-03-01 06:30:00", resolve)
    assert found.columns == ["id", "label", "prediction", "model_version", "inference_timestamp"]
    assert found.count() == result.held_out.count()
    row = found.first()
    assert row["model_version"] == "3" and str(row["inference_timestamp"]) == "2024-03-01 06:30:00"


@pytest.mark.parametrize("penalty", [1e-4, 5.0])
def test_ridge_minimises_the_stated_loss(spark, penalty):
    rng = np.random.default_rng(9)
    x = rng.normal(0, [1.0, 20.0], (200, 2)) + [3, -40]
    y = 100 * x[:, 0] - 2 * x[:, 1] + rng.normal(0, 5, 200)
    df = spark.createDataFrame([([float(a), float(b)], float(t)) for (a, b), t in zip(x, y)], "features array<double>, label double")
    found = {r["term"]: r["coefficient"] for r in coefficients(regression(penalty=penalty).fit(df), ["a", "b"]).collect()}
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc / 200 + penalty * np.eye(2), xc.T @ yc / 200)
    assert [found["a"], found["b"]] == pytest.approx(w.tolist(), rel=1e-6)
    assert found["intercept"] == pytest.approx(y.mean() - w @ x.mean(0), rel=1e-6)


def test_featurizer_builds_once_per_task_and_keeps_nulls(spark):
    def build():
        import uuid

        return uuid.uuid4().int % 2**20

    embed = featurizer(build, lambda model, batch: np.stack([batch.str.len(), np.full(len(batch), model)], 1))
    texts = [("ab",), (None,), ("abcd",)] * 50
    df = spark.createDataFrame(texts, "t string").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    try:
        found = [r[0] for r in df.select(embed("t")).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [None if f is None else f[0] for f in found] == [2.0, None, 4.0] * 50
    assert len({f[1] for f in found if f is not None}) == 1


def test_text_featurizer_reads_whole_texts(spark):
    text = "é" * 100_000 + "ab"
    counts = character_pair_counts(pd.Series([text, "", "x", "😀a"]), 64)
    assert counts.sum(axis=1).tolist() == [100_001, 0, 0, 1]
    assert counts[3][(ord("😀") * 31 + ord("a")) % 64] == 1
    matrix = np.arange(64.0).reshape(64, 1)
    embed = text_featurizer(share_weights(spark, matrix))
    found = spark.createDataFrame([("ab",), ("",)], "t string").select(embed("t")).collect()
    assert [r[0] for r in found] == [[float((97 * 31 + 98) % 64)], [0.0]]


def test_predictor(spark):
    predict = predictor(lambda: 2.0, lambda m, batch: batch.sum(axis=1) * m)
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 4.0],)], "a array<double>").repartition(4)
    assert sorted(r[0] for r in df.select(predict("a")).collect()) == [6.0, 14.0]


def test_embed_and_train(spark):
    rows = [(i, i % 2, ("aaaa" if i % 2 else "bbbb") * (1 + i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, label int, text string")
    # With 16 buckets the pairs "aa" and "bb" would share one; with 64 they do not.
    embed = text_featurizer(share_weights(spark, np.eye(64)))
    scored = embed_and_train(df, embed, "text", ["id"], pipeline=classifier(maxIter=20))
    assert scored.columns == ["id", "label", "probability", "prediction"]
    assert scored.filter(F.col("label") == F.col("prediction")).count() == scored.count() > 30


def test_ridge_beyond_the_normal_equations(spark, tmp_path):
    """5,000 features, of which two matter."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        x = np.zeros(5000)
        x[[7, 4321]] = rng.normal(size=2)
        x[rng.integers(0, 5000, 3)] += 0.01
        rows.append((float(2 * x[7] - 3 * x[4321] + 1), x.tolist()))
    frame = spark.createDataFrame(rows, "label double, features array<double>")
    pipeline = regression(penalty=1e-6)
    pipeline.write().overwrite().save(str(tmp_path / "unfitted"))
    stage = Pipeline.load(str(tmp_path / "unfitted")).getStages()[-1]
    assert stage.getOrDefault(stage.penalty) == 1e-6
    fitted = pipeline.fit(frame).stages[-1]
    assert fitted.numFeatures == 5000
    assert (fitted.coefficients[7], fitted.coefficients[4321], fitted.intercept) == pytest.approx((2, -3, 1), abs=0.02)


def test_rows_without_features_stay_unscored(spark, trained, features, rows):
    package, base = trained[0].package, spark.createDataFrame([(0,), (999,), (None,)], "id int")
    kept = FeatureLookup("f", ("features",), ("id",))
    some = {"f": features.select("id", "features")}.__getitem__
    found = score_batch(ModelPackage(package.model, (kept,)), base, some)
    assert [(r["id"], r["prediction"] is None) for r in found.orderBy("id").collect()] == [(None, True), (0, False), (999, True)]
    with pytest.raises(Exception, match="no row in f"):
        score_batch(package, base, some).collect()


def test_predictor_keeps_nulls(spark):
    sums = predictor(lambda: 2.0, lambda model, batch: batch.sum(axis=1) * model)
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "k int, v array<double>")
    assert {r["k"]: r["p"] for r in frame.select("k", sums("v").alias("p")).collect()} == {1: 6.0, 2: None}
