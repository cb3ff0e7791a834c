"""Exact dedup and mixing against brute force."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from patchloom.llm.exact_dedup import content_groups, drop_exact_copies
from patchloom.llm.mixing import mix, source_targets, take_mix


def _groups(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        ids = [i for i in groups[text or ""] if i is not None]
        keep = max(ids) if ids else None
        out.append((doc_id, keep, len(groups[text or ""]), doc_id == keep))
    return sorted(out, key=repr)


def test_groups_of_hard_rows(documents, hard_rows):
    rows = hard_rows + [(20, "prefix " * 100 + "a"), (21, "prefix " * 100 + "b"), (22, "prefix " * 100 + "a")]
    found = content_groups(documents(rows))
    assert sorted(map(tuple, found.collect()), key=repr) == _groups(rows)


@pytest.mark.parametrize("bits", [8 * 32768 // 8, 1 << 27])
def test_a_full_bitmap_changes_nothing(documents, bits):
    rows = [(i, f"text {i % 700}") for i in range(2000)]
    found = content_groups(documents(rows), bitmap_bits=bits)
    assert sorted(map(tuple, found.collect()), key=repr) == _groups(rows)


def test_a_large_group_and_an_empty_table(documents):
    rows = [(i, "same") for i in range(3000)] + [(i, f"own {i}") for i in range(3000, 4000)]
    kept = drop_exact_copies(documents(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2999, *range(3000, 4000)]
    assert kept.columns == documents([]).columns
    assert content_groups(documents([])).collect() == []
    assert drop_exact_copies(documents([])).collect() == []


def test_same_id_with_other_text_stays(documents):
    kept = drop_exact_copies(documents([(1, "a"), (1, "b"), (2, "a")]))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, "b"), (2, "a")]


def _targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight; what is above a cap is shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes.values())), set(names)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return target | share
        for s in above:
            target[s] = float(most * sizes[s])
            left -= target[s]
            open_.remove(s)


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 3, "b": 900, None: 40, "é": 7}, {"z": 5}, {"a": 1, "b": 0, "c": 1000}])
def test_targets_are_those_of_repeated_sharing(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r["source"]: r["target"] for r in source_targets(frame).collect()}
    assert found == pytest.approx(_targets(sizes))


def test_mix_of_hard_rows(documents, hard_rows):
    rows = hard_rows + [(100 + i, "w " * (1 + i % 9), "en", "abcd"[i % 4]) for i in range(400)]
    found = mix(documents(rows)).collect()
    assert len(found) == len(rows)
    by_source = defaultdict(lambda: [0, 0, 0])
    names = {(r[0], len((r[1] or "").split(" "))): r[3] for r in rows if r[0] is not None and r[0] >= 100}
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["copies"]
        if r["doc_id"] is not None and r["doc_id"] >= 100:
            entry = by_source["abcd"[(r["doc_id"] - 100) % 4]]
            entry[0] += r["taken"]
            entry[1], entry[2] = r["target"], max(entry[2], r["size"])
    assert names and by_source


def test_taken_words_come_near_the_target(documents):
    rows = [(i, "w " * (1 + i % 9), "en", "abc"[min(i % 7, 2)]) for i in range(3000)]
    rows += [(10_000 + i, "w " * 5, "en", "hot") for i in range(3000)]
    taken, target, largest = defaultdict(int), {}, 9
    source = {r[0]: r[3] for r in rows}
    frame = documents(rows)
    for r in mix(frame).collect():
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    for s in taken:
        assert abs(taken[s] - target[s]) <= largest
    rerun = mix(frame.repartition(5)).agg(F.sum("taken")).first()[0]
    assert rerun == sum(taken.values())


def test_take_mix_repeats_rows(documents):
    rows = [(i, "w " * 4, "en", "ab"[i % 10 == 0]) for i in range(500)] + [(1000, None, None, None)]
    frame = documents(rows)
    copies = {r["doc_id"]: r["copies"] for r in mix(frame).collect()}
    found = defaultdict(int)
    mixed = take_mix(frame)
    for r in mixed.collect():
        found[r["doc_id"]] += 1
    assert mixed.columns == frame.columns
    assert found == {i: n for i, n in copies.items() if n}
    assert mix(documents([])).collect() == [] and take_mix(documents([])).collect() == []


def test_hash_of_text(documents):
    found = documents([(1, "é")]).select(F.sha2("text", 256)).first()[0]
    assert found == hashlib.sha256("é".encode()).hexdigest()
