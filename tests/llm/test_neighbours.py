"""Nearest neighbours against brute force."""

from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F

from patchloom.llm.neighbours import Graph, build_graph, nearest

SCHEMA = "vec_id bigint, embedding array<float>, score string, rank string"


def exact(rows, asks, most):
    seen = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        seen.setdefault((i, tuple(np.float32(x).item() for x in v)), None)
    out = {}
    for q, own in seen:
        if not asks(q):
            continue
        scored = sorted(
            ((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in seen if i != q and len(v) == len(own)), key=lambda x: (x[0], x[1])
        )
        out[q] = [(i, -s) for s, i in scored[:most]]
    return out


def found_by(frame, asks, most, settings=Graph()):
    out = {}
    for r in nearest(frame, asks, most, settings).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_over_several_shards(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    rows = [(i, (centres[i % 20] + 0.4 * rng.normal(size=16)).astype("float32").tolist()) for i in range(3000)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = found_by(frame, F.col("vec_id") % 20 == 0, 10, Graph(shard_vectors=600, query_block=40))
    want = exact(rows, lambda i: i % 20 == 0, 10)
    assert found.keys() == want.keys()
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 10 * len(want)
    score = {(q, i): sum(a * b for a, b in zip(rows[q][1], rows[i][1], strict=True)) for q in want for i, _ in found[q]}
    assert all(s == pytest.approx(score[q, i], abs=1e-12) for q in want for i, s in found[q])


def test_hard_vectors_ties_and_copies(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 400)]  # one large group of equal vectors
    rows += [(1000, [0.5, 0.5]), (1000, [0.5, 0.5]), (1001, [0.0, 0.0]), (1002, None), (1003, []), (1004, [1.0, None]), (1005, [float("nan"), 1.0]),
             (1006, [float("inf"), 1.0]), (None, [1.0, 1.0]), (1020, [3.0, 3.0]), (2000, [1.0, 2.0, 3.0]), (2020, [1.0, 0.0, 0.0])]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = found_by(frame, F.col("vec_id") % 20 == 0, 5)
    assert found == exact(rows, lambda i: i % 20 == 0, 5)
    assert found[0][0] == (1020, 3.0) and [i for i, _ in found[0][1:]] == [1, 2, 3, 4]


def test_few_or_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest(empty, F.col("vec_id") % 20 == 0).collect() == []
    alone = spark.createDataFrame([(0, [1.0], "x", "y")], SCHEMA)
    assert nearest(alone, F.col("vec_id") % 20 == 0).collect() == []
    assert nearest(alone, F.lit(None).cast("boolean")).collect() == []


def test_graph_has_bounded_degree_and_no_loops():
    vectors = np.random.default_rng(1).normal(size=(500, 8)).astype("float32")
    edges, start = build_graph(vectors, Graph(degree=12, build_beam=24))
    assert edges.shape == (500, 12) and 0 <= start < 500
    for v, own in enumerate(edges):
        own = own[own >= 0]
        assert len(own) and v not in own and len(set(own.tolist())) == len(own)


def test_recall_beside_very_long_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).astype("float32").tolist()) for i in range(1500)]
    rows += [(2001, [-5e3, *[0.0] * 7]), (2002, [0.0, -4e5, *[0.0] * 6]), (2003, [*[0.0] * 7, -1e20])]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = found_by(frame, F.col("vec_id") % 20 == 0, 10)
    want = exact(rows, lambda i: i % 20 == 0, 10)
    assert found.keys() == want.keys()
    assert sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want) >= 0.95 * 10 * len(want)


def test_doubles_keep_their_precision_and_range(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=6) * 10.0 ** rng.choice([-30, 0, 30])).tolist()) for i in range(1200)]
    rows += [(3000, [0.1, 0, 0, 0, 0, 0]), (3001, [1.7, 0, 0, 0, 0, 0]), (3002, [1e39, 1e-39, 0, 0, 0, 0]), (3020, [0, 0, 0, 0, 0, 1e200]), (3021, [0, 0, 0, 0, 1e-200, 0])]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA.replace("float", "double"))
    found = found_by(frame, F.col("vec_id") % 20 == 0, 10, Graph(shard_vectors=300))
    vectors = dict(rows)
    product = lambda a, b: reduce(lambda total, x: total + x, (x * y for x, y in zip(a, b, strict=True)), 0.0)  # noqa: E731 - sum() compensates
    want = {}
    for q in (i for i in vectors if i % 20 == 0):
        scored = [(-product(vectors[q], v), i) for i, v in rows if i != q]
        want[q] = sorted(scored)[:10]
    assert found.keys() == want.keys()
    assert all(s == product(vectors[q], vectors[i]) for q in found for i, s in found[q])
    hits = sum(len({i for i, _ in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.95 * 10 * len(want)


def test_one_id_with_several_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 2.0]), (1, [3.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    assert found_by(frame, F.col("vec_id") == 0, 5) == {0: [(1, 3.0), (1, 2.0), (2, 2.0)]}
