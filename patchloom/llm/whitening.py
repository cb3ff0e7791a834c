"""Whitening of embeddings from exact integer cross-products.

Vectors become integers. Each dimension is shifted by its smallest value, and its
bit planes are packed across rows into 64-bit words; the AND of two planes,
counted and weighted by the planes' places, sums to the exact cross-product of
two dimensions. Spark adds the blocks' counts, the matrix is centred in integers
and only then handed to ``eigh``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import in_small_batches, store

# Steps per unit, and what is added so that ordinary entries are positive.
STEPS, OFFSET = 64, 1_000_000
# Larger entries count as this one, so that integers of 53 bits hold all.
LARGEST = 1 << 52
COMPONENTS = 16
# Rows whose planes are counted at once; their words stay in the processor's cache.
BLOCK_ROWS = 4096
# Share of the whole variance below which double precision can't tell a direction.
LEAST_SHARE = 1e-11
_LIMB = 1 << 60
_LONG = 1 << 63


def usable(vector: Column) -> Column:
    """Not null, not empty, no null or non-finite entry."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def integers(vector: Column) -> Column:
    """floor(64 c) + 1,000,000 of every entry, at most LARGEST from zero."""
    top = float(LARGEST)

    def step(c: Column) -> Column:
        scaled = F.greatest(F.least(c.cast("double") * STEPS, F.lit(top)), F.lit(-top))
        return F.floor(scaled).cast("bigint") + OFFSET

    return F.transform(vector, step)


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    """A column of equally long arrays as rows x dimensions."""
    column = batch.column(name)
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch], rows: int = BLOCK_ROWS) -> Iterator[np.ndarray]:
    """The rows of all batches, ``rows`` at a time."""
    held: list[np.ndarray] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(_matrix(batch))
        n += len(held[-1])
        while n >= rows:
            together = np.concatenate(held)
            yield together[:rows]
            held, n = [together[rows:]], n - rows
    if n:
        yield np.concatenate(held)


def _limbs(value: int) -> tuple[int, int]:
    """A whole number as high and low part, so that sums of any size fit the decimals they are added in."""
    return value // _LIMB, value % _LIMB


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, and per dimension smallest, largest and sum, of a task's vectors."""
    n, low, high, sums = 0, None, None, None
    for block in _blocks(batches, 1024):
        n += len(block)
        least, most = block.min(axis=0), block.max(axis=0)
        low = least if low is None else np.minimum(low, least)
        high = most if high is None else np.maximum(high, most)
        # Below 2^10 rows of at most 2^53 each.
        total = block.sum(axis=0).astype(object)
        sums = total if sums is None else sums + total
    if n:
        parts = [_limbs(int(s)) for s in sums]
        yield pa.RecordBatch.from_pydict(
            {
                "dim": pa.array(range(len(low)), pa.int32()),
                "n": pa.array([n] * len(low), pa.int64()),
                "low": pa.array(low.tolist(), pa.int64()),
                "high": pa.array(high.tolist(), pa.int64()),
                "upper": pa.array([h for h, _ in parts], pa.int64()),
                "lower": pa.array([l for _, l in parts], pa.int64()),
            }
        )


def plane_products(block: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Exact sums over rows of y_i y_j, for whole y >= 0 of ``bits`` bits per dimension; Python integers, upper triangle.

    A plane is one bit of one dimension for all rows, 64 rows to a word.
    """
    rows, dims = block.shape
    words = -(-rows // 64)
    owner = np.repeat(np.arange(dims), bits)
    place = np.concatenate([np.arange(b) for b in bits]) if len(owner) else np.zeros(0, int)
    planes = np.zeros((len(owner), words * 8), np.uint8)
    for k, (dim, bit) in enumerate(zip(owner, place, strict=True)):
        packed = np.packbits(((block[:, dim] >> bit) & 1).astype(np.uint8))
        planes[k, : len(packed)] = packed
    planes = planes.view(np.uint64)
    first = np.concatenate([[0], np.cumsum(bits)])
    products = np.zeros((dims, dims), object)
    for i in range(dims):
        for k in range(first[i], first[i + 1]):
            counts = np.bitwise_count(planes[k] & planes[first[i] :]).sum(axis=1, dtype=np.int64)
            # Counts of one other dimension's planes are added by their places; 2^13 rows and 54 places fit 128 bits, so wide planes go by Python integers.
            if bits.max(initial=0) <= 40:
                weighed = counts << place[first[i] :]
                sums = np.add.reduceat(weighed, (first[i:-1] - first[i])[bits[i:] > 0])
            else:
                weighed = counts.astype(object) * np.array([1 << int(p) for p in place[first[i] :]], object)
                sums = np.add.reduceat(weighed, (first[i:-1] - first[i])[bits[i:] > 0])
            weight = 1 << int(place[k])
            products[i, i:][bits[i:] > 0] += np.array([int(s) * weight for s in sums], object)
    return products


def _scatter(low: np.ndarray, bits: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(batches):
            products = plane_products(block - low, bits)
            total = products if total is None else total + products
        if total is not None:
            i, j = np.triu_indices(len(low))
            parts = [_limbs(int(v)) for v in total[i, j]]
            # Within 64 bits: the upper part is below rows x 2^106 / 2^60.
            yield pa.RecordBatch.from_pydict(
                {
                    "i": pa.array(i, pa.int32()),
                    "j": pa.array(j, pa.int32()),
                    "upper": pa.array([str(h) for h, _ in parts], pa.string()),
                    "lower": pa.array([str(l) for _, l in parts], pa.string()),
                }
            )

    return work


def _whole(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(38,0)")).alias(column)


@dataclass(frozen=True)
class Whitening:
    """What the fit found: rows, sums and smallest entries per dimension, eigenvectors as rows, their eigenvalues, the trace."""

    n: int
    sums: tuple[int, ...]
    low: tuple[int, ...]
    axes: np.ndarray
    values: np.ndarray
    trace: float


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Principal axes of distinct integer vectors (column ``x``), which should be stored; None without rows.

    Two numbers per pair of dimensions come to the driver. Axes with no more than
    LEAST_SHARE of the variance are left out; an axis is signed so that its largest entry is positive.
    """
    found = (
        vectors.mapInArrow(_ranges, "dim int, n bigint, low bigint, high bigint, upper bigint, lower bigint")
        .groupBy("dim")
        .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), _whole("upper"), _whole("lower"))
    )
    stats = sorted(found.collect(), key=lambda r: r["dim"])
    if not stats:
        return None
    n, low = stats[0]["n"], [r["low"] for r in stats]
    sums = [int(r["upper"]) * _LIMB + int(r["lower"]) for r in stats]
    bits = np.array([(r["high"] - r["low"]).bit_length() for r in stats])
    pairs = (
        vectors.mapInArrow(_scatter(np.array(low, np.int64), bits), "i int, j int, upper string, lower string")
        .groupBy("i", "j")
        .agg(_whole("upper"), _whole("lower"))
    )
    covariance = np.zeros((len(low), len(low)))
    shifted = [s - n * m for s, m in zip(sums, low, strict=True)]
    for r in pairs.collect():
        product = int(r["upper"]) * _LIMB + int(r["lower"])
        # Centred in integers; the one division rounds correctly.
        covariance[r["i"], r["j"]] = covariance[r["j"], r["i"]] = (n * product - shifted[r["i"]] * shifted[r["j"]]) / (n * n)
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    trace = float(np.trace(covariance))
    order = [k for k in order if values[k] > trace * LEAST_SHARE]
    axes = axes[:, order].T
    largest = np.abs(axes).argmax(axis=1) if len(order) else []
    signs = np.array([1.0 if axes[k, at] > 0 else -1.0 for k, at in enumerate(largest)])
    return Whitening(n, tuple(sums), tuple(low), axes * signs[:, None], values[order], trace)


def _project(model: Whitening):
    """Whitened values of rows of integers: entries are shifted exactly before anything is rounded."""
    low = np.array(model.low, np.int64)
    rest = np.array([s - model.n * m for s, m in zip(model.sums, model.low, strict=True)], object)
    centre = np.array([r / model.n for r in rest])
    scaled = model.axes / np.sqrt(model.values)[:, None]

    def whiten(block: np.ndarray) -> np.ndarray:
        return ((block - low).astype(np.float64) - centre) @ scaled.T

    def deviation(block: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2; None beyond a long."""
        shifted = block - low
        most = max((max(int(shifted[:, k].max()) * model.n, int(rest[k])) for k in range(len(low))), default=0) if len(block) else 0
        if most * most * len(low) < _LONG:
            off = shifted * model.n - rest.astype(np.int64)
            return (off * off).sum(axis=1).tolist()
        exact = [sum((int(v) * model.n - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in shifted]
        return [v if v < _LONG else None for v in exact]

    return whiten, deviation


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of (covariance of the whitened fit list - identity), the values centred before they are multiplied."""
    whiten, _ = _project(model)
    k = len(model.values)
    if not k:
        return None

    def means(batches):
        sums = sum((whiten(block).sum(axis=0) for block in _blocks(batches)), np.zeros(k))
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(k), pa.int32()), "total": pa.array(sums, pa.float64())})

    found = vectors.mapInArrow(means, "i int, total double").groupBy("i").agg(F.sum("total").alias("total")).collect()
    mean = np.zeros(k)
    for r in found:
        mean[r["i"]] = r["total"] / model.n

    def products(batches):
        total = np.zeros((k, k))
        for block in _blocks(batches):
            centred = whiten(block) - mean
            total += centred.T @ centred
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "total": pa.array(total[i, j], pa.float64())})

    sums = vectors.mapInArrow(products, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    return max(abs(r["total"] / model.n - (r["i"] == r["j"])) for r in sums.collect())


def whitened(
    vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for every usable row and component.

    Rows are made integers by :func:`integers`; the fit uses each distinct vector
    once, found by one grouping in which copies are combined before they are sent.
    The scatter of a task is two numbers per pair of dimensions whatever its rows.

    Rows whose vector is null, empty or holds null or non-finite entries are left
    out; so are vectors of another length than most distinct ones have (of equally frequent
    lengths the largest counts). Null and repeated ids stay, as rows of their own. Entries
    beyond 2^52 / 64 count as that. ``deviation`` is null where it exceeds a long.
    Directions with no more than LEAST_SHARE of the variance are no component, so equal vectors, one vector
    or an empty table give no rows. Other columns don't matter.
    """
    vector = F.col(vector_column)
    given = vectors.select(F.col(id_column).alias("id"), vector.alias("vector")).filter(usable(F.col("vector")))
    rows = in_small_batches(given.select("id", integers(F.col("vector")).alias("x")))
    distinct = store(rows.select("x").distinct(), "whitening-fit")
    lengths = distinct.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    dims = lengths[0]["dims"] if lengths else 0
    fitted = distinct.filter(F.size("x") == dims)
    model = fit(fitted, components) if lengths else None
    schema = "id {}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    schema = schema.format(given.schema["id"].dataType.simpleString())
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_column)
    error = identity_error(fitted, model)
    whiten, deviation = _project(model)
    explained = model.values / model.trace
    k = len(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            block = _matrix(batch)
            each = np.repeat(np.arange(len(block)), k)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id").take(pa.array(each)),
                    "component": pa.array(np.tile(np.arange(1, k + 1), len(block)), pa.int32()),
                    "n": pa.array(np.full(len(each), model.n), pa.int64()),
                    "deviation": pa.array(deviation(block), pa.int64()).take(pa.array(each)),
                    "whitened": pa.array(whiten(block).ravel(), pa.float64()),
                    "explained": pa.array(np.tile(explained, len(block)), pa.float64()),
                    "identity_error": pa.array(np.full(len(each), error), pa.float64()),
                }
            )

    return rows.filter(F.size("x") == dims).mapInArrow(project, schema).withColumnRenamed("id", id_column)
