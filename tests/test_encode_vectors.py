from datetime import date, datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from patchloom.functions.encode import category_places, with_places, ColumnEncoder, fit_categories, fit_moments, one_hot, standard_scale
from patchloom.functions.pixels import array_to_bytes, bytes_to_array, normalize_channels, scale_to_unit
from patchloom.functions.vectors import DenseVectorizer, argmax


def test_categories_sort_by_value_not_text(spark):
    df = spark.createDataFrame([(2, "b"), (10, "a"), (2, None)], "n int, s string")
    assert fit_categories(df, ["n", "s"]) == {"n": (2, 10), "s": ("a", "b", None)}


def test_too_many_categories_are_refused(spark):
    with pytest.raises(ValueError, match="categories"):
        fit_categories(spark.range(100), ["id"], max_categories=99)
    assert len(fit_categories(spark.range(100), ["id"], max_categories=100)["id"]) == 100


def test_one_hot(spark):
    df = spark.createDataFrame([("a",), ("c",), (None,)], "s string")
    hot = df.select(one_hot(F.col("s"), ("a", "b", "c", None))).collect()
    assert [r[0] for r in hot] == [[1, 0, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1]]
    assert [r[0] for r in df.select(one_hot(F.col("s"), ("a",), unseen="ignore")).collect()] == [[1], [0], [0]]
    assert [r[0] for r in df.filter("s = 'a'").select(one_hot(F.col("s"), ("a",))).collect()] == [[1]]


@pytest.mark.parametrize("categories", [("a", "b"), ("a", "b", None)])
def test_one_hot_unseen_raises(spark, categories):
    df = spark.createDataFrame([("z",), ("a",)], "s string")
    with pytest.raises(PySparkException, match="unseen category: z"):
        df.select(one_hot(F.col("s"), categories)).collect()


def test_one_hot_null_without_null_category_raises(spark):
    df = spark.createDataFrame([(None,), ("a",)], "s string")
    with pytest.raises(PySparkException, match="unseen category: null"):
        df.select(one_hot(F.col("s"), ("a",))).collect()


def test_moments_match_numpy(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(1e6, 3.0, 2000)
    rows = [(float(v), 5.0, i % 7) for i, v in enumerate(values)] + [(float("nan"), None, 3), (None, 5.0, None)]
    df = spark.createDataFrame(rows, "x double, constant double, k int").repartition(5)
    plain = fit_moments(df, ["x", "constant"])
    pooled = ColumnEncoder.fit(df, ["k"], ["x", "constant"]).moments
    for found in (plain, pooled):
        assert found["x"].mean == pytest.approx(values.mean(), rel=1e-12)
        assert found["x"].std == pytest.approx(values.std(), rel=1e-9)
        assert (found["constant"].mean, found["constant"].std) == (5.0, 0.0)
    centred = spark.range(1).select(standard_scale(F.lit(7.0), plain["constant"])).first()[0]
    assert centred == 2.0


def test_moments_of_nothing(spark):
    with pytest.raises(ValueError, match="no values"):
        fit_moments(spark.createDataFrame([(None,)], "x double"), ["x"])


def test_column_encoder_round_trip(spark):
    df = spark.createDataFrame([(1, "u", 1.0, 9), (2, "v", 3.0, 9), (1, "v", 5.0, 9)], "h int, d string, x double, other int")
    encoder = ColumnEncoder.fit(df, ["h", "d"], ["x"])
    again = ColumnEncoder.from_json(encoder.to_json())
    assert again == encoder and encoder.width == 5
    out = encoder.transform(df, keep=["h"])
    assert out.columns == ["h", "features"]
    scale = np.std([1, 3, 5])
    assert [r["features"] for r in out.collect()] == [
        [1, 0, 1, 0, pytest.approx(-2 / scale)],
        [0, 1, 0, 1, 0],
        [1, 0, 0, 1, pytest.approx(2 / scale)],
    ]


def test_dense_vectorizer(spark, tmp_path):
    df = spark.createDataFrame([(1, [1.5, 2.0]), (2, None)], "id int, a array<float>")
    stage = DenseVectorizer(inputCol="a", outputCol="v")
    found = stage.transform(df).orderBy("id").collect()
    assert found[0]["v"].toArray().tolist() == [1.5, 2.0] and found[1]["v"] is None
    Pipeline(stages=[stage]).fit(df).write().overwrite().save(str(tmp_path / "p"))
    loaded = PipelineModel.load(str(tmp_path / "p"))
    assert loaded.stages[0].getInputCol() == "a"
    assert loaded.transform(df).orderBy("id").first()["v"] == found[0]["v"]


def test_argmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), (None,)], "a array<double>")
    assert [r[0] for r in df.select(argmax("a")).collect()] == [1, None]


def test_bytes_and_channels(spark):
    data = bytes([0, 1, 127, 128, 255, 16])
    df = spark.createDataFrame([(bytearray(data),), (bytearray(b""),)], "b binary")
    values = df.select(bytes_to_array("b").alias("a"))
    assert [r["a"] for r in values.collect()] == [list(data), []]
    assert [bytes(r[0]) for r in values.select(array_to_bytes("a")).collect()] == [data, b""]
    mean, std = (0.1, 0.2, 0.3), (0.5, 0.25, 0.125)
    inter, plane = (
        values.limit(1)
        .select(normalize_channels(scale_to_unit("a"), mean, std), normalize_channels(scale_to_unit("a"), mean, std, plane=2))
        .first()
    )
    unit = np.array(list(data)) / 255
    assert inter == pytest.approx(((unit.reshape(2, 3) - mean) / std).ravel().tolist())
    planes = unit.reshape(3, 2)
    assert plane == pytest.approx(((planes - np.reshape(mean, (3, 1))) / np.reshape(std, (3, 1))).ravel().tolist())


def test_encoder_keeps_dates_and_decimals(spark):
    rows = [(date(2024, 1, 2), Decimal("1.50"), datetime(2024, 1, 2, 3, 4, 5), True), (None, Decimal("2.00"), None, False)]
    frame = spark.createDataFrame(rows, "d date, n decimal(5,2), t timestamp, b boolean")
    encoder = ColumnEncoder.fit(frame, ["d", "n", "t", "b"], [])
    again = ColumnEncoder.from_json(encoder.to_json())
    assert again == encoder
    assert again.transform(frame).collect() == encoder.transform(frame).collect()


def test_places_are_those_of_the_sorted_values(spark):
    values = [None if i % 50 == 0 else f"v{i * 7919 % 3000:05d}" for i in range(5000)]
    frame = spark.createDataFrame([(v,) for v in values], "v string").repartition(7)
    places = category_places(frame, "v")
    order = sorted({v for v in values if v is not None}) + [None]
    assert {r["v"]: r["place"] for r in places.collect()} == {v: i for i, v in enumerate(order)}
    extra = frame.unionByName(spark.createDataFrame([("unseen",)], "v string"))
    found = with_places(extra, "v", places)
    assert found.count() == 5001 and [r["v"] for r in found.filter("place is null").collect()] == ["unseen"]
    assert category_places(frame.limit(0), "v").collect() == []
