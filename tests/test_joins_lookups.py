import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from patchloom.operators.cleaning import clean_ranges, compute_features, limit_rows, time_range
from patchloom.operators.joins import annotate, unmatched_report
from patchloom.operators.lookup import (
    FeatureLookup,
    _in_ranges,
    _time_ranges,
    lookups_from_json,
    lookups_to_json,
    merge_lookups,
    point_in_time_lookup,
    with_features,
)
from patchloom.operators.skew import hot_keys, lookup_join
from patchloom.operators.splits import hash_split, process_splits, random_split, split_frames
from patchloom.plans.jobs import write_features
from patchloom.sinks.feature_table import FeatureTable


@pytest.fixture(scope="module")
def skewed(spark):
    """1,000 rows: a third with key 7, a tenth with a null key, the rest spread; some rows are copies."""
    keys = [7] * 340 + [None] * 100 + [i % 97 for i in range(560)]
    return spark.createDataFrame([(k, i // 3) for i, k in enumerate(keys)], "k int, v int").repartition(6)


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.createDataFrame([(i, f"n{i}") for i in range(0, 97, 2)] + [(7, "seven")], "k int, name string")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, skewed, dimension, rows, how):
    plain = rows(lookup_join(skewed, dimension, ["k"], how))
    salted = lookup_join(skewed, dimension, ["k"], how, salts=8, fraction=10)
    assert salted.columns == ["k", "v", "name"]
    assert rows(salted) == plain
    assert len(plain) == (1000 if how == "left" else sum(r[0] is not None and (r[0] % 2 == 0 or r[0] == 7) for r in rows(skewed)))


def test_salt_spreads_the_hot_key_and_copies(spark):
    copies = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit(0).alias("v"))
    right = spark.createDataFrame([(1, "a")], "k int, name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_join(copies, right, ["k"], "left", salts=8)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
    assert sum(sizes) == 4000 and max(sizes) <= 2000


def test_hot_keys(spark, skewed):
    assert {r["k"] for r in hot_keys(skewed, ["k"], 20).collect()} == {7, None}
    assert hot_keys(skewed.limit(0), ["k"]).collect() == []


def test_annotate_drops_null_and_unmatched_keys(spark, rows):
    left = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("", 4)], "imid string, label int")
    right = spark.createDataFrame([("a", "x"), (None, "y"), ("b", "z")], "imid string, content string")
    assert rows(annotate(left, right, "imid")) == [("a", 1, "x"), ("a", 2, "x")]


def test_unmatched_report(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("c",), ("c",), (None,), (None,)], "k string")
    assert unmatched_report(left, right, "k").first().asDict() == {
        "left_matched": 2, "left_unmatched": 1, "left_without_key": 1,
        "right_matched": 1, "right_unmatched": 2, "right_without_key": 2,
    }
    empty = left.limit(0)
    assert set(unmatched_report(empty, empty, "k").first()) == {0}


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([(1, 10), (2, 20), (3, 30), (None, 40)], "id int, label int")


@pytest.fixture(scope="module")
def features(spark):
    return spark.createDataFrame([(1, 0.5, "x"), (2, None, "y")], "id int, f double, g string")


def _look(base, features, missing, **more):
    return with_features(base, [FeatureLookup("t", ("f",), ("id",), missing)], {"t": features}.__getitem__, **more)


def test_missing_policies(spark, base, features, rows):
    assert rows(_look(base, features, "keep")) == sorted([(1, 10, 0.5), (2, 20, None), (3, 30, None), (None, 40, None)], key=repr)
    assert rows(_look(base, features, "drop")) == [(1, 10, 0.5), (2, 20, None)]
    with pytest.raises(PySparkException, match="no row in t for key"):
        # The failing check must not be pruned, whatever is selected.
        _look(base, features, "error").select(F.count(F.lit(1))).collect()
    assert rows(_look(base.filter("id < 3"), features, "error")) == [(1, 10, 0.5), (2, 20, None)]
    with pytest.raises(ValueError, match="missing"):
        FeatureLookup("t", ("f",), ("id",), "ignore")


def test_exclude_and_clash(spark, base, features):
    assert _look(base, features, "keep", exclude=["id", "not_there"]).columns == ["label", "f"]
    with pytest.raises(ValueError, match="are in the base rows"):
        _look(base.withColumn("f", F.lit(1.0)), features, "keep")


def test_lookups_of_one_table_are_one_join(spark, base, features):
    specs = [FeatureLookup("t", ("f",), ("id",)), FeatureLookup("t", ("g", "f"), ("id",))]
    assert merge_lookups(specs) == [FeatureLookup("t", ("f", "g"), ("id",))]
    joined = with_features(base, specs, {"t": features}.__getitem__)
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert lookups_from_json(lookups_to_json(specs, exclude=["id"])) == (specs, {"exclude": ["id"]})


def test_self_lookup_needs_no_join(spark, features):
    spec = FeatureLookup("t", ("f", "g"), ("id",))
    joined = with_features(features, [spec], {"t": features}.__getitem__, base_table="t")
    assert "Join" not in joined._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("block_rows, salts, key_types", [(10**6, 1, "int int"), (100, 1, "int int"), (20, 1, "bigint int"), (7, 4, "int bigint")])
def test_point_in_time_against_brute_force(spark, rows, block_rows, salts, key_types):
    rng = random.Random(block_rows)
    # Half of the rows have key 0; many rows share a time or are full copies.
    def key():
        return 0 if rng.random() < 0.5 else rng.choice([1, 2, 3, None])

    base = [(key(), rng.choice([None] + list(range(60)) + [30] * 20), rng.randrange(3)) for _ in range(400)]
    facts = {(key(), rng.randrange(60)): rng.randrange(1000) for _ in range(80)}
    facts = [(k, t, v if v % 5 else None) for (k, t), v in facts.items()]

    def best(k, t):
        past = [f for f in facts if f[0] == k and t is not None and f[1] <= t]
        return max(past, key=lambda f: f[1])[2] if past and k is not None else None

    stamp = "timestamp_seconds(%s)"
    ours, theirs = key_types.split()
    left = spark.createDataFrame(base, f"k {ours}, t int, n int").withColumn("ts", F.expr(stamp % "t"))
    right = spark.createDataFrame(facts, f"k {theirs}, ft int, v int").withColumn("fts", F.expr(stamp % "ft"))
    found = point_in_time_lookup(left, right, ["k"], "ts", "fts", ["v"], None, block_rows, salts)
    expected = sorted([(k, t, n, best(k, t)) for k, t, n in base], key=repr)
    assert rows(found, "k", "t", "n", "v") == expected


def test_every_hot_key_has_its_own_even_ranges(spark):
    """Keys whose times don't overlap, each with nine tenths of its rows in a hundredth of its span."""
    key, i = F.col("id") % 4, F.floor(F.col("id") / 4)
    seconds = key * 10_000_000 + F.when(i % 10 == 0, i * 99).otherwise(F.lit(990_000) + i)
    times = spark.range(40_000).select(key.alias("k"), F.timestamp_seconds(seconds).alias("_ts"))
    ranged = _in_ranges(times, ["k"], _time_ranges(times, ["k"], 500))
    sizes = ranged.groupBy("k", "_block").count().collect()
    assert len(sizes) == 80 and max(r["count"] for r in sizes) < 500 * 1.2
    assert _time_ranges(times, ["k"], 10_000) is None


@pytest.mark.parametrize("n", [1, 127, 128, 129, 16_383])
def test_ranges_are_looked_up_in_short_arrays(spark, n):
    """A row beside, on and between cuts; no array of all cuts is carried by it."""
    ranges = spark.range(1).select(F.xxhash64(F.lit(1)).alias("_hash"), F.sequence(F.lit(10), F.lit(10 * n), F.lit(10)).alias("_cuts"))
    times = spark.range(-5, 10 * n + 25, 3).select(F.when(F.col("id") % 2 == 0, 2).otherwise(1).alias("k"), F.col("id").cast("int").alias("_ts"))
    found = _in_ranges(times, ["k"], ranges)
    passed = F.least(F.greatest(F.floor(F.col("_ts") / 10), F.lit(0)), F.lit(n))
    assert found.columns == ["k", "_ts", "_block", "_last"] and found.count() == times.count()
    assert found.filter("k = 2 AND (_block <> 0 OR _last <> 0)").isEmpty()
    assert found.filter("k = 1").filter((F.col("_block") != passed) | (F.col("_last") != n)).isEmpty()
    assert "filter(" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_timed_lookup_through_with_features(spark, rows):
    base = spark.createDataFrame([(1, 5), (1, 10), (2, 5), (3, 5)], "k int, t int")
    kept = spark.createDataFrame([(1, 1, 10), (1, 9, 20), (2, 6, 30), (3, 5, None)], "k int, t int, f int")
    resolve = {"x": kept}.__getitem__
    spec = FeatureLookup("x", ("f",), ("k",), time="t")
    assert rows(with_features(base, [spec], resolve), "k", "t", "f") == [(1, 10, 20), (1, 5, 10), (2, 5, None), (3, 5, None)]
    drop = FeatureLookup("x", ("f",), ("k",), missing="drop", time="t")
    assert rows(with_features(base, [drop], resolve), "k", "t", "f") == [(1, 10, 20), (1, 5, 10), (3, 5, None)]
    error = FeatureLookup("x", ("f",), ("k",), missing="error", time="t")
    with pytest.raises(Exception, match="no row in x"):
        with_features(base, [error], resolve).collect()
    assert lookups_from_json(lookups_to_json([drop]))[0] == [drop]


def test_timed_table_needs_a_time(spark, tmp_path):
    frame = spark.createDataFrame([(1, 1, 10)], "k int, t int, f int")
    name = "patchloom_tests.timed"
    write_features(frame, FeatureTable(name, ("k",), "t", buckets=2), str(tmp_path / "timed"))
    with pytest.raises(ValueError, match="kept by time"):
        with_features(frame.select("k", "t"), [FeatureLookup(name, ("f",), ("k",))])
    found = with_features(frame.select("k", "t"), [FeatureLookup(name, ("f",), ("k",), time="t")])
    assert found.count() == 1
    spark.sql(f"DROP TABLE {name}")


def test_point_in_time_tie_breaker(spark, rows):
    left = spark.createDataFrame([(1, 5)], "k int, ts int")
    right = spark.createDataFrame([(1, 5, 1, "old"), (1, 5, 2, "new"), (1, 6, 3, "later")], "k int, fts int, seq int, v string")
    found = point_in_time_lookup(left, right, ["k"], "ts", "fts", ["v"], tie_breaker="seq")
    assert rows(found) == [(1, 5, "new")]


def test_clean_ranges(spark, rows):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1.0, 2.0, "a"), (0.0, 2.0, "a"), (1000.0, 2.0, "a"), (1.0, 400.0, "a"), (nan, 2.0, "a"), (1.0, 2.0, None)],
        "fare_amount double, trip_distance double, note string",
    )
    ranges = {"fare_amount": (0, 1000), "trip_distance": (0, 400)}
    assert rows(clean_ranges(df, ranges)) == [(1.0, 2.0, "a")]
    assert len(rows(clean_ranges(df, ranges, subset=["fare_amount"]))) == 2


def test_time_range_bounds(spark):
    df = spark.sql("select explode(sequence(timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-10', interval 1 day)) as ts")
    assert time_range(df, "ts", "2024-01-03", "2024-01-05").count() == 2
    assert time_range(df, "ts", "", None).count() == 10
    assert time_range(df, "ts", "2024-01-03").count() == 8
    assert time_range(df, "ts", None, "2024-01-03").count() == 2
    assert compute_features(df, lambda d: d.agg(F.count(F.lit(1)).alias("n")), "ts", "2024-01-09").first()["n"] == 2


def test_limit(spark):
    df = spark.range(100).repartition(5)
    assert [r["id"] for r in limit_rows(df, 3, [F.desc("id")]).collect()] == [99, 98, 97]
    assert limit_rows(df, 7).count() == 7


WEIGHTS = {"train": 0.7, "validation": 0.2, "test": 0.1}


def test_hash_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    parts = split_frames(df, ["k"], WEIGHTS)
    members = {name: {r["k"] for r in part.collect()} for name, part in parts.items()}
    assert sum(map(len, members.values())) == 5000 and len(set.union(*members.values())) == 5000
    for name, weight in WEIGHTS.items():
        assert abs(len(members[name]) / 5000 - weight) < 0.03
    again = hash_split(df.repartition(13).orderBy(F.desc("k")), ["k"], WEIGHTS).filter("split = 'train'")
    assert {r["k"] for r in again.collect()} == members["train"]
    other = split_frames(df, ["k"], WEIGHTS, seed=1)["train"]
    assert {r["k"] for r in other.collect()} != members["train"]


def test_other_splits(spark):
    df = spark.range(1000)
    parts = random_split(df, {"a": 3, "b": 1})
    assert parts["a"].count() + parts["b"].count() == 1000
    assert parts["a"].intersect(parts["b"]).count() == 0
    small = process_splits(parts, lambda d: d.filter("id < 10"))
    assert small["a"].count() + small["b"].count() == 10
    with pytest.raises(ValueError):
        split_frames(df, ["id"], {"a": 0.0})


def test_hot_keys_of_several_columns(spark):
    df = spark.createDataFrame([(1, "a")] * 40 + [(1, None)] * 30 + [(i, "b") for i in range(30)], "k int, s string")
    assert {tuple(r) for r in hot_keys(df, ["k", "s"], 5).collect()} == {(1, "a"), (1, None)}
    alone = spark.createDataFrame([(3, "x")] * 4, "k int, s string")
    assert [tuple(r) for r in hot_keys(alone, ["s"], 1000).collect()] == [("x",)]


def test_salted_join_of_different_key_types(spark, rows):
    left = spark.createDataFrame([(1, i) for i in range(60)] + [(2, 99)], "k int, v int")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (2**40, "c")], "k bigint, name string")
    assert rows(lookup_join(left, right, ["k"], salts=4, fraction=2)) == rows(left.join(right, ["k"], "left"))
