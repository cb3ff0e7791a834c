"""Approximate nearest neighbours by inner product: a robust-pruned directed graph per shard."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from patchloom.llm.common import in_small_batches, store

_SEED = 31337
_CLASS_BYTES = 32


@dataclass(frozen=True)
class Graph:
    """Settings of the graphs and of the search.

    A shard is a graph over about ``shard_vectors`` distinct vectors. ``degree``
    edges stay at a vertex; of the candidates that a search with ``build_beam``
    proposes, one goes when a kept neighbour is ``relax`` times nearer to it than the vertex is. ``beam``
    is the width of a query's search.
    """

    shard_vectors: int = 4096
    degree: int = 32
    build_beam: int = 64
    relax: float = 1.2
    beam: int = 96
    query_block: int = 512


def usable(vector: Column) -> Column:
    """Not null, not empty, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _band(vector: Column) -> Column:
    """Of the vector's length: lengths within one band differ by a factor of 8 at most, so that no vector drowns others in rounding."""
    # Against the largest component, because the square of a large one leaves the range of doubles.
    largest = F.array_max(F.transform(vector, lambda x: F.abs(x).cast("double")))
    square = lambda top: F.aggregate(vector, F.lit(0.0), lambda total, x: total + (x / top) * (x / top))
    length = F.get(F.transform(F.array(largest), lambda top: F.log2(top) + F.log2(square(top)) / 2), F.lit(0))
    return F.round(length / 3).cast("int")


def _lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors over the longest one's length, with one more coordinate, so that the largest inner product is the smallest distance among them."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / (np.abs(vectors).max(initial=0) or 1.0)
    norms = (vectors * vectors).sum(axis=1)
    longest = np.sqrt(norms.max(initial=0)) or 1.0
    vectors, norms = vectors / longest, norms / longest**2
    return np.concatenate([vectors, np.sqrt(np.maximum(norms.max(initial=0) - norms, 0))[:, None]], axis=1).astype(np.float32)


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in double precision from the first component to the last."""
    total = np.zeros(len(queries))
    with np.errstate(over="ignore", invalid="ignore"):
        for a, b in zip(queries.T.astype(np.float64), vectors.T.astype(np.float64), strict=True):
            total += a * b
    return total


def _search(points: np.ndarray, squares: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of many queries at once: vertices and distances (less the query's own square), nearest first; -1 where none."""
    m = len(queries)
    rows = np.arange(m)
    best = np.full((m, beam), -1, np.int64)
    far = np.full((m, beam), np.inf, np.float32)
    done = np.ones((m, beam), bool)
    seen = np.zeros((m, len(points)), bool)
    best[:, 0], done[:, 0], seen[:, start] = start, False, True
    far[:, 0] = squares[start] - 2 * queries @ points[start]
    active = rows
    while len(active):
        open_far = np.where(done[active], np.inf, far[active])
        pick = open_far.argmin(axis=1)
        left = np.isfinite(open_far[np.arange(len(active)), pick])
        active, pick = active[left], pick[left]
        if not len(active):
            break
        done[active, pick] = True
        near = edges[best[active, pick]]
        ok = near >= 0
        near = np.where(ok, near, 0)
        ok &= ~seen[active[:, None], near]
        seen[active[:, None].repeat(near.shape[1], 1)[ok], near[ok]] = True
        distance = squares[near] - 2 * np.einsum("mrd,md->mr", points[near], queries[active])
        distance = np.where(ok, distance, np.inf).astype(np.float32)
        merged = np.concatenate([far[active], distance], axis=1)
        order = np.argpartition(merged, beam - 1, axis=1)[:, :beam]
        names = np.concatenate([best[active], near], axis=1)
        closed = np.concatenate([done[active], ~ok], axis=1)
        far[active] = np.take_along_axis(merged, order, axis=1)
        best[active] = np.take_along_axis(names, order, axis=1)
        done[active] = np.take_along_axis(closed, order, axis=1)
    order = np.argsort(far, axis=1, kind="stable")
    far, best = np.take_along_axis(far, order, axis=1), np.take_along_axis(best, order, axis=1)
    return np.where(np.isfinite(far), best, -1), far


def _prune(points: np.ndarray, vertex: int, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Nearest first; a kept neighbour removes the candidates that it is ``relax`` times nearer to than the vertex is."""
    candidates = candidates[candidates != vertex]
    gap = points[candidates] - points[vertex]
    distance = (gap * gap).sum(axis=1)
    order = np.lexsort((candidates, distance))
    candidates, distance = candidates[order], distance[order]
    own = points[candidates]
    squares = (own * own).sum(axis=1)
    between = squares[:, None] + squares[None, :] - 2 * own @ own.T
    alive, kept = np.ones(len(candidates), bool), []
    limit = distance / (relax * relax)  # distances are squared
    for i in range(len(candidates)):
        if alive[i]:
            kept.append(i)
            if len(kept) == degree:
                break
            alive &= between[i] > limit
    return candidates[kept]


def build_graph(vectors: np.ndarray, settings: Graph) -> tuple[np.ndarray, int]:
    """Edges (vertices x degree, -1 where none) and the vertex where searches start, its vectors' middle."""
    points = _lifted(vectors)
    n, degree = len(points), settings.degree
    squares = (points * points).sum(axis=1)
    start = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    edges = np.full((n, degree), -1, np.int64)
    if n == 1:
        return edges, start
    random = np.random.default_rng(_SEED)
    if n <= degree + 1:
        for v in range(n):
            others = np.delete(np.arange(n), v)
            edges[v, : len(others)] = others
        return edges, start
    edges[:] = random.integers(0, n - 1, (n, degree))
    edges += edges >= np.arange(n)[:, None]  # never itself
    for relax in (1.0, settings.relax):
        order = random.permutation(n)
        for at in range(0, n, 256):
            block = order[at : at + 256]
            found, _ = _search(points, squares, edges, start, points[block], settings.build_beam)
            back: dict[int, list[int]] = {}
            for v, near in zip(block, found, strict=True):
                pool = np.unique(np.concatenate([near, edges[v]]))
                kept = _prune(points, v, pool[pool >= 0], degree, relax)
                edges[v] = -1
                edges[v, : len(kept)] = kept
                for u in kept.tolist():
                    back.setdefault(u, []).append(int(v))
            for u, more in back.items():
                own = edges[u][edges[u] >= 0]
                pool = np.unique(np.concatenate([own, more]))
                if len(pool) > degree:
                    pool = _prune(points, u, pool, degree, relax)
                edges[u] = -1
                edges[u, : len(pool)] = pool
    return edges, start


def _build(settings: Graph, kind: str) -> Callable[[pa.Table], pa.Table]:
    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("member")
        vectors = np.stack(table.column("vector").to_numpy(zero_copy_only=False)).astype(kind)
        edges, start = build_graph(vectors, settings)
        return pa.table(
            {
                "shard": table.column("shard").slice(0, 1),
                "members": pa.array([table.column("member").to_numpy().astype("<i8").tobytes()], pa.binary()),
                "classes": pa.array([b"".join(table.column("class").to_pylist())], pa.binary()),
                "vectors": pa.array([vectors.tobytes()], pa.binary()),
                "edges": pa.array([edges.astype("<i4").tobytes()], pa.binary()),
                "start": pa.array([start], pa.int32()),
            }
        )

    return build


def _query(settings: Graph, most: int, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by (shard, block): a shard's graph (block -1), then the blocks of queries that go through it.

    Every vertex of a query's beam is scored on the stored vectors; the shard's best ``most + 1`` go on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] < 0:
                    members = np.frombuffer(row["members"], "<i8")
                    classes = np.frombuffer(row["classes"], f"V{_CLASS_BYTES}")
                    vectors = np.frombuffer(row["vectors"], kind).reshape(len(members), -1)
                    edges = np.frombuffer(row["edges"], "<i4").reshape(len(members), -1).astype(np.int64)
                    graph = (members, classes, vectors, _lifted(vectors), edges, row["start"])
                    continue
                members, classes, vectors, points, edges, start = graph
                asked = np.frombuffer(row["members"], "<i8")
                own = np.frombuffer(row["vectors"], kind).reshape(len(asked), -1)
                queries = own.astype(np.float64)
                queries /= np.abs(queries).max(axis=1, keepdims=True)
                queries /= np.sqrt((queries * queries).sum(axis=1, keepdims=True))
                lifted = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
                # A query ranks by the inner product alone: the lifted squares are all the same.
                found, _ = _search(points, np.zeros(len(points), np.float32), edges, start, lifted, max(settings.beam, most + 1))
                q, r = np.nonzero(found >= 0)
                vertex = found[q, r]
                score = _products(own[q], vectors[vertex])
                order = np.lexsort((members[vertex], -score, q))
                q, vertex, score = q[order], vertex[order], score[order]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                q, vertex, score = (x[place <= most] for x in (q, vertex, score))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked[q]), pa.array([c.tobytes() for c in classes[vertex]], pa.binary()), pa.array(score)],
                    names=["query_id", "class", "score"],
                )

    return run


def _blocks(kind: str) -> Callable[[pa.Table], pa.Table]:
    def block(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        vectors = np.stack(rows.column("vector").to_numpy(zero_copy_only=False)).astype(kind)
        return pa.table(
            {
                "dim": rows.column("dim").slice(0, 1),
                "block": rows.column("block").slice(0, 1),
                "members": pa.array([rows.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
                "vectors": pa.array([vectors.tobytes()], pa.binary()),
            }
        )

    return block


def nearest(
    vectors: DataFrame,
    queries: Column,
    most: int = 20,
    settings: Graph = Graph(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The ``most`` nearest other rows of every row that ``queries`` picks: (query_id, rank, id, score).

    Nearness is the largest inner product. Equal vectors are one vertex that
    stands for its smallest ``most + 1`` ids, which is all that a result can
    show of them. Vertices are dealt to shards by length and hash; each shard is one graph,
    built in one task, and every block of queries goes through every shard of
    its dimension. Found vertices are scored there, in double precision on the stored vectors;
    floats stay floats, any other number becomes a double.

    Null ids and vectors that are null, empty, zero or hold null or non-finite
    components take no part. Vectors of different length are never compared.
    Rows that share an id and vector count once; an id with several vectors can be found once
    for each, and if it asks, its one list ranks every found row by the better score. Ties go to the smaller id.
    A product beyond the range of doubles is infinite. An empty table gives an empty result.
    """
    narrow = isinstance(getattr(vectors.schema[vector_column].dataType, "elementType", None), FloatType)
    kind, name = ("<f4", "float") if narrow else ("<f8", "double")
    vector = F.col(vector_column).cast(f"array<{name}>")
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), vector.alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = store(
        rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
        .groupBy("id", "vector")
        .agg(F.max("asks").alias("asks"))
        .withColumn("class", F.unhex(F.sha2(F.array_join(F.col("vector").cast("array<string>"), ","), 4 * 2 * _CLASS_BYTES))),
        "vectors",
    )
    # The smallest ids of a class, first of each hashed share of it, then of all.
    share = Window.partitionBy("class", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
    whole = Window.partitionBy("class").orderBy("id")
    firsts = rows.select("class", "id", F.row_number().over(share).alias("n")).filter(F.col("n") <= most + 1)
    members = store(firsts.select("class", "id", F.row_number().over(whole).alias("n")).filter(F.col("n") <= most + 1), "vector-classes")
    vertices = store(
        in_small_batches(rows).join(members.filter("n = 1").select("class", "id"), ["class", "id"], "left_semi").select(
            F.col("id").alias("member"), "class", "vector", F.size("vector").alias("dim"), _band(F.col("vector")).alias("band")
        ),
        "vertices",
    )
    sizes = vertices.groupBy("dim", "band").agg(F.ceil(F.count("*") / settings.shard_vectors).cast("int").alias("shards"))
    sizes = store(sizes, "shards")
    placed = vertices.join(sizes, ["dim", "band"]).withColumn("shard", F.concat_ws("/", "dim", "band", F.pmod(F.xxhash64("member"), "shards")))
    n_shards = max(1, sizes.agg(F.sum("shards")).first()[0] or 0)
    # A task per shard: building a graph costs far more than its bytes tell.
    graphs = placed.select("shard", "member", "class", "vector").repartition(n_shards, "shard").groupBy("shard").applyInArrow(
        _build(settings, kind), "shard string, members binary, classes binary, vectors binary, edges binary, start int"
    )
    graphs = store(graphs, "graphs")

    asking = rows.filter("asks").select("id", "vector", F.size("vector").alias("dim"))
    counts = asking.groupBy("dim").agg(F.ceil(F.count("*") / settings.query_block).cast("int").alias("blocks"))
    dealt = asking.join(store(counts, "query-blocks"), "dim").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    blocks = dealt.select("dim", "block", "id", "vector").groupBy("dim", "block").applyInArrow(_blocks(kind), "dim int, block int, members binary, vectors binary")
    sent = (
        blocks.join(sizes, "dim")
        .withColumn("number", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        .select(F.concat_ws("/", "dim", "band", "number").alias("shard"), "block", "members", "vectors")
    )
    work = graphs.withColumn("block", F.lit(-1)).unionByName(sent, allowMissingColumns=True)
    found = work.repartition(n_shards, "shard").sortWithinPartitions("shard", "block").mapInArrow(
        _query(settings, most, kind), "query_id bigint, class binary, score double"
    )
    # From found vertices to rows: the class's smallest ids.
    scored = store(found.groupBy("query_id", "class").agg(F.max("score").alias("score")), "scored")
    top = scored.withColumn("place", F.rank().over(Window.partitionBy("query_id").orderBy(F.desc("score")))).filter(F.col("place") <= most + 1)
    named = top.join(members.select("class", F.col("id").alias("id")), "class").filter("id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (
        named.withColumn("rank", rank)
        .filter(F.col("rank") <= most)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_column), "score")
    )
