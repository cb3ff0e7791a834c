"""Whitening against exact fractions and plain numpy."""

from fractions import Fraction
from math import floor

import numpy as np
import pytest

from patchloom.llm.whitening import plane_products, whitened

SCHEMA = "vec_id bigint, embedding array<{}>, x string, id string, n string, component string"


def frame_of(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA.format(kind))


def brute(rows, kind="float"):
    """(n, S, V) of the distinct integer vectors, and each usable row's integers, all exact."""
    usable = []
    for i, v in rows:
        if not v or any(c is None or not np.isfinite(c) for c in v):
            continue
        v = [float(np.float32(c)) if kind == "float" else c for c in v]
        usable.append((i, tuple(floor(64 * Fraction(c)) + 1_000_000 for c in v)))
    fit = sorted({x for _, x in usable})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit, strict=True)]
    products = [[sum(x[i] * x[j] for x in fit) for j in range(len(sums))] for i in range(len(sums))]
    cov = [[float(Fraction(n * p - sums[i] * sums[j], n * n)) for j, p in enumerate(row)] for i, row in enumerate(products)]
    return usable, fit, n, sums, np.array(cov)


def compare(spark, rows, kind="float", components=16):
    usable, fit, n, sums, cov = brute(rows, kind)
    found = whitened(frame_of(spark, rows, kind), components).collect()
    values, axes = np.linalg.eigh(cov)
    order = [k for k in np.argsort(-values)[:components] if values[k] > np.trace(cov) * 1e-11]
    assert len(found) == len(usable) * len(order)
    by = {}
    for r in found:
        by.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    signs = {}
    for i, x in usable:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        own = by[i, deviation if deviation < 1 << 63 else None]
        for c, k in enumerate(order, 1):
            want = float(np.dot([float(Fraction(a) - Fraction(s, n)) for a, s in zip(x, sums, strict=True)], axes[:, k]) / np.sqrt(values[k]))
            got = [r["whitened"] for r in own[c]]
            if abs(want) > 1e-6 and c not in signs:
                signs[c] = np.sign(want) * np.sign(got[0])
            assert any(abs(g * signs.get(c, 1) - want) < 1e-6 for g in got)
            assert own[c][0]["n"] == n
            assert own[c][0]["explained"] == pytest.approx(values[k] / np.trace(cov), rel=1e-9)
            assert own[c][0]["identity_error"] <= 1e-6


def test_plain_rows(spark):
    rng = np.random.default_rng(3)
    scale = np.linspace(0.2, 3, 24)
    compare(spark, [(i, (rng.normal(size=24) * scale).astype("float32").tolist()) for i in range(400)])


def test_doubles_of_any_size(spark):
    rng = np.random.default_rng(4)
    compare(spark, [(i, (rng.normal(size=5) * [1, 40, 1e5, 1e-3, 7e8]).tolist()) for i in range(120)], "double")


def test_hard_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(50)]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (3, rows[4][1]), (60, None), (61, []), (62, [1.0, None, 2.0, 3.0]), (63, [1.0, float("nan"), 0.0, 0.0])]
    rows += [(64, [float("inf"), 0.0, 0.0, 0.0]), (65, [0.0, 0.0, 0.0, 0.0]), (66, [0.0, -0.0, 0.0, 0.0])]
    compare(spark, rows, "double")


def test_copies_count_once(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(20)]
    rows += [(100 + i, rows[0][1]) for i in range(3000)]
    found = whitened(frame_of(spark, rows, "double")).collect()
    assert {r["n"] for r in found} == {20} and len(found) == 3020 * 3


def test_few_dimensions_and_directions_without_variance(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [a, 2 * floor(64 * a) / 64, 5.0]) for i, a in enumerate(floor(64 * c) / 64 for c in rng.normal(size=40))]
    found = whitened(frame_of(spark, rows, "double")).collect()
    assert {r["component"] for r in found} == {1}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    found = whitened(frame_of(spark, rows, "double"))
    assert found.collect() == [] and "identity_error" in found.columns


def test_other_lengths_take_no_part(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(30)]
    alone = {(r["vec_id"], r["component"]): r["whitened"] for r in whitened(frame_of(spark, rows, "double")).collect()}
    mixed = whitened(frame_of(spark, [*rows, (99, [1.0, 2.0])], "double")).collect()
    assert {(r["vec_id"], r["component"]): r["whitened"] for r in mixed} == pytest.approx(alone)


def test_entries_beyond_the_largest(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=2).tolist()) for i in range(10)] + [(20, [1e300, -1e300])]
    found = whitened(frame_of(spark, rows, "double")).collect()
    assert len(found) in (11, 22) and {r["deviation"] for r in found if r["vec_id"] == 20} == {None}


@pytest.mark.parametrize("widths", [[1, 3, 0, 9], [14] * 6, [52, 2, 0, 47]])
@pytest.mark.parametrize("rows", [1, 63, 64, 65, 1000])
def test_plane_products_are_exact(widths, rows):
    rng = np.random.default_rng(rows)
    block = np.stack([rng.integers(0, 1 << w, rows) for w in widths], axis=1).astype(np.int64)
    bits = np.array([int(block[:, j].max()).bit_length() for j in range(len(widths))])
    found = plane_products(block, bits)
    for i in range(len(widths)):
        for j in range(i, len(widths)):
            assert found[i, j] == sum(int(a) * int(b) for a, b in zip(block[:, i], block[:, j], strict=True))
