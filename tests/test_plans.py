"""The physical plans that the operators are meant to get, with nothing small enough to broadcast."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from patchloom.operators.cleaning import clean_ranges, time_range
from patchloom.operators.featurize import share_weights, text_featurizer
from patchloom.operators.metrics import weighted_metrics
from patchloom.operators.skew import lookup_join
from patchloom.sources.tables import explode_array, scan_path

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(what, text):
    return len(re.findall(what, text))


LAZY = [
    "path_scan", "key_build", "key_parse", "annotated_content", "unmatched_keys", "clean_rows", "hash_split_rows",
    "ceil_minutes_15", "calendar_features", "duration_in_minutes", "scoring_input", "upsert_by_key",
    "feature_lookup_rows", "several_lookups", "self_lookup", "complete_lookup", "weighted_class_metrics",
    "baseline_compare", "gate_verdicts", "log_loss_accuracy", "latest_versions", "raster_patches", "text_featurize",
    "pixel_normalize", "argmax_class", "point_in_time_rows", "point_in_time_hot_key", "hot_key_lookup",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_join_and_no_single_task_window(spark, name):
    text = plan(contract.queries()[name](spark, FOLDER))
    assert not re.search("NestedLoop|Cartesian", text)
    assert not re.search("BatchEvalPython", text), "row-at-a-time Python"
    if re.search(r"Exchange SinglePartition", text):
        # Only final aggregates of already aggregated rows may meet in one task.
        assert re.search("HashAggregate", text) and not re.search("Window", text)


def test_filters_and_columns_reach_the_scan(spark):
    lines = scan_path(spark, f"{FOLDER}/lineitem.parquet")
    text = plan(clean_ranges(lines, {"l_quantity": (5, 40)}, subset=["l_quantity"]).select("l_orderkey"))
    assert "GreaterThan(l_quantity,5.0), LessThan(l_quantity,40.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text
    events = scan_path(spark, f"{FOLDER}/events.parquet")
    text = plan(time_range(events, "ts", "2024-01-03", "2024-01-05").select("event_id"))
    assert "GreaterThanOrEqual(ts,2024-01-03T00:00), LessThan(ts,2024-01-05T00:00)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_lookup_shuffles_each_side_once(spark):
    orders = scan_path(spark, f"{FOLDER}/orders.parquet", ["o_orderkey", "o_custkey"])
    customers = scan_path(spark, f"{FOLDER}/customer.parquet").withColumnRenamed("c_custkey", "o_custkey")
    text = plan(lookup_join(orders, customers.select("o_custkey", "c_acctbal"), ["o_custkey"]))
    assert count("Exchange", text) == 2 and count("SortMergeJoin", text) == 1
    assert "struct<c_custkey:bigint,c_acctbal:double>" in text


def test_metrics_are_counted_in_one_pass(spark):
    text = plan(weighted_metrics(scan_path(spark, f"{FOLDER}/labels.parquet"), "quality", "toxic"))
    assert count("FileScan", text) == 1


def test_featurizer_runs_once_per_row(spark):
    embed = text_featurizer(share_weights(spark, [[1.0]] * 4))
    documents = scan_path(spark, f"{FOLDER}/documents.parquet", ["doc_id", "text"])
    embedded = documents.select("doc_id", embed("text").alias("features"))
    text = plan(explode_array(embedded.filter(F.size("features") > 0), ["doc_id"], "features"))
    assert count("ArrowEvalPython", text) == 1
    # An unused embedding is not computed at all.
    assert count("ArrowEvalPython", plan(embedded.select("doc_id"))) == 0
