"""Shards against what the law asks: near-equal bytes, gapless slots, whole rows, equal texts together."""

import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from patchloom.llm import sharding
from patchloom.llm.sharding import read_shards, splitters, write_shards
from patchloom.session import scratch_path
from tests.llm.conftest import prose


def sharded(spark, frame, shards, **settings):
    path = scratch_path(spark, "shards")
    write_shards(frame, path, shards, **settings)
    return [(r["shard"], r["slot"], r["row"]) for r in read_shards(spark, path, frame.schema).collect()]


def weight(row):
    return len((row["text"] or "").encode()) + 16


def by_shard(rows, shards):
    slots, sizes = defaultdict(list), Counter({s: 0 for s in range(shards)})
    for shard, slot, row in rows:
        assert 0 <= shard < shards
        slots[shard].append(slot)
        sizes[shard] += weight(row)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return sizes


def near_equal(sizes, rows, slack):
    mean = sum(sizes.values()) / len(sizes)
    largest = max(weight(row) for _, _, row in rows)
    assert max(abs(v - mean) for v in sizes.values()) <= slack * mean + largest


def test_hard_rows_come_back_whole(spark, documents, hard_rows):
    frame = documents(hard_rows)
    rows = sharded(spark, frame, 7)
    assert Counter(tuple(row) for _, _, row in rows) == Counter(map(tuple, frame.collect()))
    by_shard(rows, 7)
    assert all(row.__fields__ == frame.columns for _, _, row in rows)


def test_an_empty_table_and_fewer_rows_than_shards(spark, documents):
    assert sharded(spark, documents([]), 5) == []
    rows = sharded(spark, documents([(1, "a"), (2, None)]), 5)
    assert len(rows) == 2
    by_shard(rows, 5)


def test_sizes_are_near_equal_and_equal_texts_stay_together(spark, documents):
    given = [(i, prose(i, 5 + i * 7 % 60)) for i in range(3000)]
    given += [(10_000 + 10 * i + k, f"copied {i} " + prose(50_000 + i, 20)) for i in range(60) for k in range(3)]
    rows = sharded(spark, documents(given).repartition(6), 8)
    near_equal(by_shard(rows, 8), rows, 0.02)
    homes = defaultdict(set)
    for shard, _, row in rows:
        homes[row["text"]].add(shard)
    assert all(len(h) == 1 for h in homes.values())
    again = sharded(spark, documents(given).repartition(3), 8)
    assert {(row["doc_id"], s) for s, _, row in rows} == {(row["doc_id"], s) for s, _, row in again}


@pytest.mark.parametrize("ids", ["own", "equal", "null"])
def test_a_text_that_a_third_of_all_rows_have_is_divided(spark, documents, ids):
    own = {"own": lambda i: i, "equal": lambda i: 7, "null": lambda i: None}[ids]
    given = [(own(i), "the same text everywhere") for i in range(2000)] + [(10_000 + i, prose(i, 8)) for i in range(2000)]
    rows = sharded(spark, documents(given), 10, piece_bytes=4000)
    assert len(rows) == 4000
    # What no key tells apart is dealt out by salt, which is even on average only.
    near_equal(by_shard(rows, 10), rows, 0.02 if ids == "own" else 0.2)


def test_pieces_hold_a_bounded_part_of_a_hot_text(spark, documents):
    given = [(i, "the same text everywhere") for i in range(4000)] + [(10_000 + i, prose(i, 8)) for i in range(400)]
    path = scratch_path(spark, "shards")
    write_shards(documents(given), path, 4, piece_bytes=8000)
    index = spark.read.parquet(f"{path}/index").collect()
    assert sum(r["n_rows"] for r in index) == 4400 and max(r["n_rows"] for r in index) <= 1000


def test_one_very_long_text(spark, documents):
    given = [(0, "x" * 3_000_000)] + [(i, prose(i, 30)) for i in range(1, 500)]
    rows = sharded(spark, documents(given), 6)
    near_equal(by_shard(rows, 6), rows, 0.02)


def test_ranges_are_counted_and_none_is_overfull(spark):
    keys = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(11)).otherwise(F.xxhash64("id")).alias("h"), F.xxhash64("id", F.lit(1)).alias("r"), (F.col("id") % 90 + 16).alias("size")
    )
    cuts = splitters(keys, 4)
    placed = sharding.placed(keys, cuts)
    assert placed.count() == 20_000
    assert len(cuts.levels) >= 2  # the hot text was divided once more
    sizes = [r["n"] for r in placed.groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 4 and max(sizes) <= 1.02 * sum(sizes) / 4


def test_positions_by_bisection(spark):
    cuts = [-50, -3, 0, 7, 7_000_000_000]
    frame = spark.createDataFrame([(k, cuts) for k in (-60, -50, -4, 0, 6, 7, 8_000_000_000)], "k bigint, cuts array<bigint>")
    found = [r[0] for r in frame.select(sharding._position(F.col("k"), F.col("cuts"), 3)).collect()]
    assert found == [sum(c <= k for c in cuts) for k in (-60, -50, -4, 0, 6, 7, 8_000_000_000)]


def test_a_single_shard_is_read_alone(spark, documents):
    frame = documents([(i, prose(i, 20)) for i in range(200)])
    path = scratch_path(spark, "shards")
    write_shards(frame, path, 4)
    one = read_shards(spark, path, frame.schema, shard=2)
    whole = read_shards(spark, path, frame.schema).filter("shard = 2")
    assert sorted(one.collect()) == sorted(whole.collect()) and one.count()
    assert "PartitionFilters: [isnotnull(shard" in re.sub(r"#\d+", "", one._jdf.queryExecution().executedPlan().toString())


def test_no_python_and_no_loop_over_pairs(spark, documents):
    keys = documents([(1, "a"), (2, "b"), (3, "c")]).select(F.xxhash64("text").alias("h"), F.xxhash64("doc_id").alias("r"), F.lit(17).cast("bigint").alias("size"))
    cuts = splitters(keys, 2)
    plan = sharding.placed(keys, cuts)._jdf.queryExecution().executedPlan().toString()
    assert cuts.levels and not re.search("Python|Arrow|Cartesian|NestedLoop", plan)
    assert not re.search(r"\.rdd\b|pandas|mapInArrow|udf\(", Path(sharding.__file__).read_text())


def test_query_digests(spark):
    from patchloom.llm.registered import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op11_sharding"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        body = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(body) + 16, zlib.crc32(body), "bytes", None)
