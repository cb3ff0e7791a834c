"""Versions of feature tables: pinned readers, writers at once, expiry."""

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from patchloom.operators.lookup import FeatureLookup, with_features
from patchloom.sinks import versions as vs
from patchloom.sinks.feature_table import FeatureTable, KeyViolation
from patchloom.sinks.versions import VersionConflict, VersionedTable, VersionExists, resolver

SCHEMA = "k int, v string, f array<float>"


def frame(spark, pairs):
    return spark.createDataFrame([(k, v, [float(k or 0)]) for k, v in pairs], SCHEMA)


def plain(df):
    return {r["k"]: r["v"] for r in df.collect()}


@pytest.fixture
def held(spark, tmp_path):
    table = VersionedTable.create(frame(spark, []), FeatureTable("t", ("k",), buckets=4), str(tmp_path / "t"))
    assert table.upsert(frame(spark, [(i, "old") for i in range(100)])) == 1
    return table


def bucket_keys(table, n=1000):
    """Keys beyond those in the table, by bucket."""
    spark, out = table.spark, {}
    for r in spark.range(n, 2 * n).select(F.col("id").cast("int").alias("k")).withColumn("b", table.manifest().table.bucket()).collect():
        out.setdefault(r["b"], []).append(r["k"])
    return out


@pytest.mark.parametrize("limit", [0, vs.BROADCAST_BYTES])
def test_readers_stay_on_their_version(spark, held, monkeypatch, limit):
    monkeypatch.setattr(vs, "BROADCAST_BYTES", limit)
    pinned, first = held.read(1), {i: "old" for i in range(100)}
    assert held.upsert(frame(spark, [(5, "new"), (500, "new")])) == 2
    second = first | {5: "new", 500: "new"}
    assert plain(pinned) == plain(held.read(1)) == first and plain(held.read()) == second
    staged = held.prepare(frame(spark, [(5, "newer")]))  # written, but not yet a version
    assert plain(held.read()) == second and held.versions() == [0, 1, 2]
    assert held.commit(staged) == 3
    assert plain(held.read(3)) == second | {5: "newer"} and plain(held.read(2)) == second and plain(held.read(0)) == {}
    assert plain(held.changes(1)) == {5: "newer", 500: "new"} and plain(held.changes(2, 3)) == {5: "newer"} and plain(held.changes(3)) == {}
    with pytest.raises(ValueError, match="never written"):
        held.read(9)


def test_only_touched_buckets_are_written(spark, held):
    keys = bucket_keys(held)
    held.upsert(frame(spark, [(keys[2][0], "new")]))
    old, new = held.manifest(1), held.manifest(2)
    assert new.touched == (2,) and {b for b in new.folders if new.folders[b] != old.folders[b]} == {2}
    found = held.read(columns=["v", "k"])
    assert found.columns == ["v", "k"] and found.count() == 101


def test_of_two_writers_one_is_refused(spark, held):
    one, two = held.prepare(frame(spark, [(5, "one")])), held.prepare(frame(spark, [(5, "two"), (6, "two")]))
    assert held.commit(one) == 2
    with pytest.raises(VersionConflict, match="version 2 has changed buckets"):
        held.commit(two)
    assert plain(held.read()) == {i: "old" for i in range(100)} | {5: "one"} and held.versions() == [0, 1, 2]
    assert not Path(f"{held.path}/data/{two.folder}").exists()
    assert held.upsert(frame(spark, [(5, "two"), (6, "two")])) == 3


def test_writers_in_different_buckets_both_go_on(spark, held):
    keys = bucket_keys(held)
    staged = [held.prepare(frame(spark, [(keys[b][0], f"writer {b}")])) for b in (0, 1, 3)]
    assert [held.commit(s) for s in staged] == [2, 3, 4]
    assert plain(held.read()) == {i: "old" for i in range(100)} | {keys[b][0]: f"writer {b}" for b in (0, 1, 3)}
    assert keys[1][0] not in plain(held.read(2))
    late = held.prepare(frame(spark, [(keys[0][1], "late")]), base=1)
    with pytest.raises(VersionConflict):
        held.commit(late)


@pytest.mark.parametrize("way", ["link", "rename"])
def test_a_file_is_created_once(spark, tmp_path, way):
    files, path = vs._Files(spark, str(tmp_path)), str(tmp_path / "versions" / "0000000001.json")
    (tmp_path / "versions").mkdir()
    getattr(files, way)(path, "first")
    with pytest.raises(VersionExists):
        getattr(files, way)(path, "second")
    assert files.read(path) == "first"
    assert [n for n in files.names(str(tmp_path / "versions")) if not n.endswith(".crc")] == ["0000000001.json"]


def test_of_many_threads_one_creates_a_version(spark, tmp_path):
    files, path, made = vs._Files(spark, str(tmp_path)), str(tmp_path / "v" / "1.json"), []
    start = threading.Barrier(8)

    def work(k):
        start.wait()
        try:
            files.create(path, f"writer {k}")
            made.append(k)
        except VersionExists:
            pass

    threads = [threading.Thread(target=work, args=(k,)) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(made) == 1 and files.read(path) == f"writer {made[0]}"


def test_expired_versions_and_their_folders_go(spark, held):
    pinned = [held.upsert(frame(spark, [(k, "new")])) for k in (1, 2, 3)]
    before = plain(held.read())
    at_work = held.prepare(frame(spark, [(7, "late")]))
    assert held.expire(keep=2) == [0, 1, 2] and held.versions() == pinned[1:]
    assert plain(held.read()) == before and plain(held.read(3)) == before | {3: "old"}
    with pytest.raises(ValueError, match="expired"):
        held.read(2)
    named = {f for n in held.versions() for f in held.manifest(n).folders.values()}
    assert {p.name for p in Path(f"{held.path}/data").iterdir()} == named | {at_work.folder}
    assert held.commit(at_work) == 5 and plain(held.read()) == before | {7: "late"}
    lost = held.prepare(frame(spark, [(8, "lost")]))
    held.expire(keep=9, unfinished_after=-1)
    assert not Path(f"{held.path}/data/{lost.folder}").exists() and plain(held.read()) == before | {7: "late"}
    with pytest.raises(ValueError, match="at least one"):
        held.expire(keep=0)


def test_a_number_is_never_given_again(spark, held):
    early = held.prepare(frame(spark, [(k, "early") for k in range(100)]))
    for k in range(3):
        held.upsert(frame(spark, [(k, "new")]))
    held.expire(keep=1)
    with pytest.raises(VersionConflict):
        held.commit(early)
    assert held.versions() == [4]


def test_bad_batches_leave_everything_as_it_was(spark, held):
    for pairs in ([(1, "a"), (1, "b")], [(None, "a")]):
        with pytest.raises(KeyViolation):
            held.upsert(frame(spark, pairs))
    with pytest.raises(ValueError, match="differ"):
        held.upsert(frame(spark, [(1, "a")]).drop("f"))
    broken = frame(spark, [(1, "a")]).withColumn("v", F.raise_error(F.lit("broken batch")).cast("string"))
    with pytest.raises(Exception, match="broken batch"):
        held.upsert(broken)
    assert held.upsert(frame(spark, [])) == 1 and held.versions() == [0, 1]
    assert len(list(Path(f"{held.path}/data").iterdir())) == 1


def test_creating_again(spark, held):
    again = VersionedTable.create(frame(spark, []), FeatureTable("t", ("k",), buckets=99), held.path)
    assert again.manifest().table.buckets == 4 and again.latest() == 1
    with pytest.raises(ValueError, match="another key"):
        VersionedTable.create(frame(spark, []), FeatureTable("t", ("v",)), held.path)
    with pytest.raises(ValueError, match="other columns"):
        VersionedTable.create(frame(spark, []).drop("f"), FeatureTable("t", ("k",)), held.path)
    with pytest.raises(KeyViolation):
        VersionedTable.create(frame(spark, []), FeatureTable("t", ("z",)), f"{held.path}-other")
    with pytest.raises(ValueError, match="no versioned table"):
        VersionedTable(spark, f"{held.path}-none").read()


def test_time_key_and_other_types(spark, tmp_path):
    schema = "v decimal(9,2), k string, t timestamp, m map<string,int>"
    rows = [(None, "a'b", None, {"x": 1})]
    with pytest.raises(KeyViolation):
        table = VersionedTable.create(spark.createDataFrame(rows, schema), FeatureTable("t", ("k",), "t"), str(tmp_path / "t"))
        table.upsert(spark.createDataFrame(rows, schema))
    stamped = spark.createDataFrame(rows, schema).withColumn("t", F.explode(F.expr("sequence(timestamp'2024-01-01', timestamp'2024-01-09', interval 1 day)")))
    table.upsert(stamped)
    table.upsert(stamped.filter("t < '2024-01-03'").withColumn("v", F.lit(1.5).cast("decimal(9,2)")))
    found = table.read().collect()
    assert len(found) == 9 and sum(r["v"] is not None for r in found) == 2 and table.read().schema.simpleString() == stamped.schema.simpleString()


def test_lookups_on_a_pinned_version(spark, held):
    resolve = resolver(spark, {"t": (held.path, None)})
    held.upsert(frame(spark, [(1, "new")]))
    base, spec = spark.createDataFrame([(1,), (2,)], "k int"), [FeatureLookup("t", ("v",), ("k",))]
    assert plain(with_features(base, spec, resolve)) == {1: "old", 2: "old"}
    assert plain(with_features(base, spec, resolver(spark, {"t": (held.path, 2)}))) == {1: "new", 2: "old"}
