import os

import pytest
from pyspark.sql import functions as F

import patchloom.sinks.feature_table as ft
from patchloom.plans.jobs import write_features
from patchloom.sinks.feature_table import (
    FeatureTable,
    KeyViolation,
    create_feature_table,
    describe,
    merge_rows,
    parse_keys,
    publish,
    read_feature_table,
    upsert,
)
from patchloom.session import discard, scratch_path, scratch_root
from patchloom.sinks.tables import ensure_schema, overwrite_table


def test_parse_keys():
    assert parse_keys(" id , ts,") == ("id", "ts")


def test_merge_rows(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([("B", 2), ("C", 3)], "v string, k int")
    assert rows(merge_rows(target, updates, ["k"]), "k", "v") == [(1, "a"), (2, "B"), (3, "C")]


@pytest.fixture
def table(spark, request):
    name = f"ft_tests.{request.node.name.replace('[', '_').replace(']', '')}"
    return FeatureTable(name, ("k",), buckets=4)


def _frame(spark, pairs):
    return spark.createDataFrame(pairs, "k int, v string, f array<float>")


@pytest.mark.parametrize("limit", [0, ft.BROADCAST_BYTES])
def test_upsert_leaves_other_buckets_alone(spark, rows, table, monkeypatch, limit):
    monkeypatch.setattr(ft, "BROADCAST_BYTES", limit)
    first = _frame(spark, [(i, "old", [1.0]) for i in range(100)])
    write_features(first, table)
    batch = _frame(spark, [(5, "new", [2.0]), (500, "new", None)])
    # Only the buckets of the batch are rewritten.
    files = set(spark.table(table.name).inputFiles())
    merged = upsert(batch, table.name, keep_staged=True)
    kept = files & set(spark.table(table.name).inputFiles())
    assert kept
    expected = sorted([(i, "new" if i == 5 else "old") for i in range(100)] + [(500, "new")], key=repr)
    assert rows(read_feature_table(spark, table.name), "k", "v") == expected
    # Once more changes nothing; neither does publishing the same result again.
    upsert(batch, table.name)
    publish(spark, table.name, merged)
    assert rows(read_feature_table(spark, table.name), "k", "v") == expected
    assert spark.conf.get(ft.OVERWRITE_MODE).lower() == "static"


def test_bad_batches_change_nothing(spark, rows, table):
    write_features(_frame(spark, [(1, "a", None)]), table)
    for bad in ([(2, "x", None), (2, "y", None)], [(None, "x", None)]):
        with pytest.raises(KeyViolation):
            upsert(_frame(spark, bad), table.name)
    with pytest.raises(ValueError, match="columns"):
        upsert(spark.createDataFrame([(1, "a")], "k int, v string"), table.name)
    assert upsert(_frame(spark, []), table.name) is None
    assert rows(read_feature_table(spark, table.name)) == [(1, "a", None)]


def test_create_is_a_no_op_or_an_error(spark, table):
    df = _frame(spark, [(1, "a", None)])
    create_feature_table(df, table)
    assert create_feature_table(df.select("f", "v", "k"), table) == table == describe(spark, table.name)
    with pytest.raises(ValueError, match="another key"):
        create_feature_table(df.drop("f"), table)
    with pytest.raises(ValueError, match="another key"):
        create_feature_table(df, FeatureTable(table.name, ("v",), buckets=4))
    with pytest.raises(KeyViolation):
        create_feature_table(df, FeatureTable(table.name + "2", ("absent",)))


def test_time_key_and_existing_location(spark, rows):
    location = scratch_path(spark, "timed")
    spec = FeatureTable("ft_tests.timed", ("k",), time_key="t", buckets=3)
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, t int, v string")
    write_features(df, spec, location)
    write_features(df.filter("t = 2").withColumn("v", F.lit("c")), spec)
    assert rows(read_feature_table(spark, spec.name)) == [(1, 1, "a"), (1, 2, "c")]
    # A new session without the catalog entry finds the buckets at their place.
    spark.sql("DROP TABLE ft_tests.timed")
    again = create_feature_table(df, spec, location)
    assert again.time_key == "t"
    assert rows(read_feature_table(spark, spec.name)) == [(1, 1, "a"), (1, 2, "c")]


def test_describe_other_table(spark):
    ensure_schema(spark, "ft_tests")
    overwrite_table(spark.range(3), "ft_tests.plain")
    overwrite_table(spark.range(5), "ft_tests.plain")
    assert spark.table("ft_tests.plain").count() == 5
    with pytest.raises(ValueError, match="not a feature table"):
        describe(spark, "ft_tests.plain")


def test_staged_data_are_removed(spark, table):
    root = scratch_root(spark)
    before = set(os.listdir(root))
    write_features(_frame(spark, [(1, "a", None)]), table)
    upsert(_frame(spark, [(1, "b", None), (2, "c", None)]), table.name)
    assert set(os.listdir(root)) == before
    with pytest.raises(ValueError, match="not below"):
        discard(spark, "/elsewhere/x")


def test_failed_publish_can_be_repeated(spark, rows, table, monkeypatch):
    write_features(_frame(spark, [(1, "a", None)]), table)
    lost = []

    def fail(session, name, path, gather=False):
        lost.append(path)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(ft, "publish", fail)
        with pytest.raises(RuntimeError):
            upsert(_frame(spark, [(1, "b", None)]), table.name)
    assert rows(read_feature_table(spark, table.name), "k", "v") == [(1, "a")]
    publish(spark, table.name, lost[0])
    assert rows(read_feature_table(spark, table.name), "k", "v") == [(1, "b")]


def test_scratch_follows_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_busy_key_is_spread_over_buckets_tasks_and_files(spark, tmp_path, monkeypatch):
    import patchloom.sinks.feature_table as module

    monkeypatch.setattr(module, "FILE_BYTES", 4000)
    frame = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"), F.rand(1).alias("v"))
    spec = FeatureTable("ft_tests.busy", ("k",), time_key="t", buckets=4)
    location = str(tmp_path / "busy")
    write_features(frame, spec, location)
    files = spark.read.parquet(location).filter("k = 1").groupBy(F.input_file_name().alias("f")).count().collect()
    assert len(files) > 8 and max(r["count"] for r in files) < 18_000 / 4
    for limit in (0, 1 << 30):
        monkeypatch.setattr(module, "BROADCAST_BYTES", limit)
        changed = frame.filter("t % 3 = 0").withColumn("v", F.lit(limit).cast("double"))
        found = write_features(changed, spec, location)
        assert found.count() == 20_000 and found.filter(F.col("v") == limit).count() == changed.count()
    many = len(list((tmp_path / "busy").glob("*/part-*.parquet")))
    monkeypatch.setattr(module, "FILE_BYTES", 1 << 30)
    module.compact(spark, spec.name)
    assert len(list((tmp_path / "busy").glob("*/part-*.parquet"))) == 4 < many
    assert read_feature_table(spark, spec.name).count() == 20_000 and module.pending(spark, spec.name) is None
    spark.sql("DROP TABLE ft_tests.busy")
