import math
import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from patchloom.operators.gate import DEFAULT_THRESHOLDS, GateFailed, Threshold, enforce, gate_report, report_lines
from patchloom.operators.metrics import (
    CUSTOM_METRICS,
    baseline_comparison,
    confusion,
    custom_metrics,
    latest_version,
    loss_and_accuracy,
    metrics_long,
    row_count,
    weighted_metrics,
)
from patchloom.plans.jobs import validate


def _scored(spark, pairs):
    return spark.createDataFrame([(float(y), float(p)) for y, p in pairs], "label double, prediction double")


CASES = {
    "perfect": [(i % 3, i % 3) for i in range(9)],
    "all wrong": [(i % 3, (i + 1) % 3) for i in range(9)],
    "class never predicted": [(0, 0), (1, 0), (2, 0), (2, 2)],
    "class never present": [(0, 5), (0, 0), (1, 1), (1, 5)],
    "one class": [(1, 1)] * 4,
    "random": [(random.Random(i).randrange(5), random.Random(-i).randrange(6)) for i in range(300)],
}


@pytest.mark.parametrize("case", CASES)
def test_weighted_metrics_equal_the_evaluator(spark, case):
    df = _scored(spark, CASES[case]).repartition(4)
    found = weighted_metrics(df).first()
    evaluator = MulticlassClassificationEvaluator()
    names = {"f1_score": "f1", "precision": "weightedPrecision", "recall": "weightedRecall", "accuracy": "accuracy"}
    for ours, theirs in names.items():
        assert found[ours] == pytest.approx(evaluator.evaluate(df, {evaluator.metricName: theirs}), abs=1e-12), ours
    assert found["n_rows"] == len(CASES[case])


def test_metrics_by_group_and_role(spark):
    df = spark.createDataFrame(
        [("a", 0, 0, 1), ("a", 1, 1, 1), ("b", 0, 1, 0), ("b", None, 1, 0)], "g string, label int, c int, b int"
    )
    found = weighted_metrics(df, "label", {"candidate": "c", "baseline": "b"}, by=["g"])
    accuracy = {(r["g"], r["role"]): (r["accuracy"], r["n_rows"]) for r in found.collect()}
    assert accuracy == {
        ("a", "candidate"): (1.0, 2), ("a", "baseline"): (0.5, 2), ("b", "candidate"): (0.0, 1), ("b", "baseline"): (1.0, 1),
    }
    assert metrics_long(found, by=["g", "role"]).count() == 16
    counted = confusion(df, "label", "c")
    assert counted.agg(F.sum("n")).first()[0] == 4
    assert counted.filter("label is null").agg(F.sum("n")).first()[0] == 1
    unlabelled = {(r["g"], r["role"]): r["n_unlabelled"] for r in found.collect()}
    assert unlabelled == {("a", "candidate"): 0, ("a", "baseline"): 0, ("b", "candidate"): 1, ("b", "baseline"): 1}


def test_rows_without_prediction_are_misses(spark):
    df = spark.createDataFrame([(1, 1)] + [(1, None)] * 9 + [(None, 1)], "label int, prediction int")
    found = weighted_metrics(df).first()
    assert (found["accuracy"], found["recall"], found["n_rows"], found["n_unpredicted"], found["n_unlabelled"]) == (0.1, 0.1, 10, 9, 1)
    nothing = weighted_metrics(df.filter("label is null")).first()
    assert (nothing["accuracy"], nothing["n_rows"], nothing["n_unlabelled"]) == (None, 0, 1)


def test_rows_that_cannot_be_judged(spark):
    rows = [(0, [0.9, 0.1]), (None, [0.5, 0.5]), (7, [0.5, 0.5]), (1, None)]
    df = spark.createDataFrame(rows, "label int, probability array<double>").withColumn("batch", F.lit(1))
    for batch in (None, "batch"):
        found = loss_and_accuracy(df, batch=batch).first()
        assert (found["accuracy"], found["n_rows"], found["n_left_out"]) == (1.0, 1, 3)
        assert found["loss"] == pytest.approx(0.1053605)
    assert row_count(df).first()["n_rows"] == 4


def test_baseline_with_zero_score(spark):
    df = spark.createDataFrame([(0, 0, 1), (1, 1, 0)], "label int, prediction int, baseline_prediction int")
    found = {r["metric_name"]: r for r in baseline_comparison(df).collect()}
    assert found["accuracy"]["absolute_change"] == 1.0 and found["accuracy"]["relative_change"] is None


def test_custom_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0), (6.0, 4.0)], "label double, prediction double")
    row = custom_metrics(df).first()
    weights = [0.5, 0.25, 0.25]
    assert row["weighted_mean_squared_error"] == pytest.approx((0.5 * 1 + 0.25 * 1 + 0.25 * 4) / sum(weights))
    assert row["squared_diff_plus_one"] == 4 + 4 + 1
    zero = custom_metrics(df.unionByName(df.limit(1).withColumn("prediction", F.lit(0.0)))).first()
    assert math.isnan(zero["weighted_mean_squared_error"])
    mine = custom_metrics(df, metrics={"bias": lambda y, p: F.avg(p - y)}).first()
    assert mine["bias"] == 0.0


def test_loss_and_accuracy(spark):
    rows = [(0, [0.5, 0.5], 1), (1, [0.2, 0.8], 1), (0, [0.0, 1.0], 2)]
    df = spark.createDataFrame(rows, "label int, probability array<double>, step int")
    whole = loss_and_accuracy(df).first()
    losses = [-math.log(0.5), -math.log(0.8), -math.log(1e-15)]
    assert whole["loss"] == pytest.approx(sum(losses) / 3) and whole["accuracy"] == pytest.approx(2 / 3)
    batched = loss_and_accuracy(df, batch="step").first()
    assert batched["loss"] == pytest.approx((sum(losses[:2]) / 2 + losses[2]) / 2)
    assert (batched["accuracy"], batched["n_rows"]) == (pytest.approx(2 / 3), 3)
    vectors = df.select(F.col("label").cast("double"), array_to_vector("probability").alias("probability"))
    evaluator = MulticlassClassificationEvaluator(metricName="logLoss")
    assert evaluator.evaluate(vectors.withColumn("prediction", F.lit(0.0))) == pytest.approx(whole["loss"])


def test_latest_version(spark, rows):
    df = spark.createDataFrame([("m", "9"), ("m", "10"), ("z", "0")], "name string, version string")
    names = spark.createDataFrame([("m",), ("new",)], "name string")
    assert rows(latest_version(df)) == [("m", 10), ("z", 1)]
    assert rows(latest_version(df, names=names)) == [("m", 10), ("new", 1)]


def _metrics(spark, **values):
    return spark.createDataFrame(list(values.items()), "metric_name string, candidate double")


def _verdicts(report):
    return {r["metric_name"]: r["passed"] for r in report.collect()}


def test_gate_edges(spark):
    rules = [
        Threshold("equal", 0.5), Threshold("lower", 0.2, False), Threshold("lower_equal", 0.5, False),
        Threshold("nan", 0.1), Threshold("nan_low", 0.1, False), Threshold("null", 0.1), Threshold("missing", 0.0),
    ]
    nan = float("nan")
    metrics = _metrics(spark, equal=0.5, lower=0.3, lower_equal=0.5, nan=nan, nan_low=nan, null=None, free=0.1)
    assert _verdicts(gate_report(metrics, rules)) == {
        "equal": True, "lower": False, "lower_equal": True, "nan": False, "nan_low": False, "null": False,
        "missing": False, "free": None,
    }


def test_run_modes(spark):
    report = gate_report(_metrics(spark, accuracy=0.79, f1_score=0.9), DEFAULT_THRESHOLDS)
    assert enforce(report, "disabled") == []
    assert [r["metric_name"] for r in enforce(report, "dry_run")] == ["accuracy"]
    with pytest.raises(GateFailed, match="accuracy is 0.79, threshold 0.8"):
        enforce(report)
    assert enforce(gate_report(_metrics(spark, accuracy=0.8, f1_score=0.5))) == []
    with pytest.raises(ValueError, match="run mode"):
        enforce(report, "off")


def test_report_text(spark):
    metrics = _metrics(spark, accuracy=0.75)
    lines = [r["line"] for r in report_lines(gate_report(metrics)).collect()]
    assert f"{'accuracy':30}  {'0.75':30}  N/A" in lines
    both = metrics.withColumn("baseline", F.lit(0.5))
    assert f"{'accuracy':30}  {'0.75':30}  0.5" in [r["line"] for r in report_lines(gate_report(both)).collect()]


def test_validate(spark):
    df = _scored(spark, CASES["perfect"])
    good = validate(df, custom=CUSTOM_METRICS, rules=[Threshold("accuracy", 1.0)])
    assert good.failed == [] and good.report.count() == 6
    with pytest.raises(GateFailed):
        validate(_scored(spark, CASES["all wrong"]))
    assert validate(_scored(spark, CASES["all wrong"]), run_mode="disabled").failed == []
    # Nothing scored: every rule fails.
    assert len(validate(df.limit(0), run_mode="dry_run").failed) == 2
