"""Near-duplicate documents by min-max hashing, with links confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import bitmap_of, flag_by_bitmap, free_name, in_small_batches, store
from patchloom.llm.components import connected_components
from patchloom.llm.shingles import WordHasher, mix, shingles

_SEED = 8675309


@dataclass(frozen=True)
class MinMax:
    """Settings of the signature and the test.

    Every permutation gives two values, its minimum and its maximum, so
    ``bands * rows / 2`` permutations are evaluated. At a similarity of 0.8, 32
    bands of 4 miss a pair once in 10^7.
    """

    words: int = 5
    numerator: int = 80  # linked at 100 * intersection >= numerator * union
    bands: int = 32
    rows: int = 4
    # Documents compared in one task: at most about so many shingles, a larger document alone.
    task_shingles: int = 500_000


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(_SEED)
    odd = random.integers(1 << 30, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd, random.integers(0, 1 << 32, n, dtype=np.uint32)


def sets_of(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each stretch, and their bounds."""
    if not len(hashes):
        return hashes, bounds
    hashes = hashes.copy()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        hashes[a:b].sort()
    new = np.empty(len(hashes), bool)
    new[0] = True
    np.not_equal(hashes[1:], hashes[:-1], out=new[1:])
    new[bounds[:-1][np.diff(bounds) > 0]] = True
    return hashes[new], np.concatenate([[0], np.cumsum(new)])[bounds]


def _signer(settings: MinMax) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        odd, plus = _permutations(settings.bands * settings.rows // 2)
        band_salt = mix(np.arange(1, settings.bands + 1, dtype=np.uint64))
        for batch in batches:
            for at, to, words, offsets, _ in hasher.texts(batch.column(1)):
                hashes, bounds = sets_of(*shingles(words, offsets, settings.words))
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                values = np.zeros((len(full), 2 * len(odd)), np.uint32)
                prints = np.zeros((2, len(full)), np.uint64)
                if len(full):
                    begin = bounds[:-1][full]
                    for i, salt in enumerate((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)):
                        prints[i] = np.add.reduceat(mix(hashes ^ np.uint64(salt)), begin)
                    short = (hashes >> np.uint64(32)).astype(np.uint32)
                    for p in range(len(odd)):
                        permuted = short * odd[p] + plus[p]
                        values[:, p] = np.minimum.reduceat(permuted, begin)
                        values[:, len(odd) + p] = np.maximum.reduceat(permuted, begin)
                keys = np.zeros((len(full), settings.bands), np.uint64)
                for r in range(settings.rows):
                    keys = mix(keys + values[:, r :: settings.rows].astype(np.uint64) + np.uint64(r + 1))
                keys = mix(keys + band_salt)
                ids = batch.column(0).slice(at, to - at).take(pa.array(full))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(full) + 1, dtype=np.int32) * settings.bands), pa.array(keys.reshape(-1).view(np.int64))
                )
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes[full]), *[pa.array(p.view(np.int64)) for p in prints], lists],
                    names=["id", "n_shingles", "print1", "print2", "bands"],
                )

    return sign


def signatures(docs: DataFrame, settings: MinMax = MinMax(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_shingles, print1, print2, bands) of every text that has words; equal prints mean equal sets."""
    rows = docs.select(F.col(id_column).cast("bigint"), F.col(text_column).cast("string"))
    schema = "id bigint, n_shingles bigint, print1 bigint, print2 bigint, bands array<bigint>"
    return in_small_batches(rows).mapInArrow(_signer(settings), schema)


def near_duplicates(
    docs: DataFrame, settings: MinMax = MinMax(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Components of documents whose shingle sets are similar: (id, n_shingles, component_id, kept), one row per document.

    Documents with equal sets are one class, and its smallest id stands for it.
    Classes that share a band with others point to the band's smallest class;
    what hangs together so is a field of candidates, and every link lies within
    a field. Fields are then resolved on whole sets (:func:`_resolve`).

    Null and wordless texts have an empty set and link with nothing, as do rows
    whose id is null (their component is null, and they are kept). Rows that
    share an id are one document to the links: each row has its own
    n_shingles and the common component. An empty table gives an empty result.
    """
    signed = store(signatures(docs, settings, id_column, text_column), "minmax")
    named = signed.filter("id IS NOT NULL")
    classes = store(named.groupBy("print1", "print2").agg(F.min("id").alias("rep"), F.min("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")
    places = classes.select("rep", F.explode("bands").alias("band"))
    # Stored, so that the join deals out its own sides and can split a hot band.
    shared = store(
        places.groupBy("band").agg(F.min("rep").alias("first"), F.count("*").alias("n")).filter("n > 1"), "bands"
    )
    edges = store(
        places.join(shared, "band").groupBy("rep", "first").agg(F.sum("n").alias("weight")), "star-edges"
    )
    fields = connected_components(edges.select(F.col("rep").alias("a"), F.col("first").alias("b")))
    weights = edges.groupBy("rep").agg(F.sum("weight").alias("weight"))
    members = store(
        fields.join(classes.select(F.col("rep").alias("node"), "n").groupBy("node").agg(F.sum("n").alias("n")), "node")
        .join(weights.withColumnRenamed("rep", "node"), "node", "left")
        .select(F.col("node").alias("id"), F.col("component").alias("field"), "n", F.coalesce("weight", F.lit(0)).alias("weight")),
        "field-members",
    )
    linked = _resolve(docs, members, settings, id_column, text_column)

    of_class = classes.select("print1", "print2", "rep").join(linked.withColumnRenamed("id", "rep"), "rep", "left")
    of_class = of_class.select("print1", "print2", F.coalesce("label", "rep").alias("of_class"))
    by_id = (
        named.select("id", "print1", "print2")
        .join(of_class, ["print1", "print2"])
        .groupBy("id")
        .agg(F.min("of_class").alias("component"), F.max("of_class").alias("other"), F.count("*").alias("rows"))
    )
    by_id = store(by_id, "components")
    # Rows that share an id tie their classes together.
    ties = by_id.filter("component <> other")
    if not ties.isEmpty():
        joined = (
            named.select("id", "print1", "print2")
            .join(of_class, ["print1", "print2"])
            .join(ties.select("id", "component"), "id")
            .select(F.col("of_class").alias("a"), F.col("component").alias("b"))
        )
        renamed = connected_components(joined).select(F.col("node").alias("component"), F.col("component").alias("better"))
        by_id = by_id.join(renamed, "component", "left").select("id", F.coalesce("better", "component").alias("component"))
    # Texts without words have no row among the signatures.
    sized = signed.select("id", "n_shingles")
    wordless = docs.filter(~F.coalesce(F.col(text_column).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))).select(
        F.col(id_column).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("n_shingles")
    )
    everyone = sized.unionAll(wordless).join(by_id.select("id", "component"), "id", "left")
    component = F.coalesce("component", "id")
    return everyone.select(
        F.col("id").alias(id_column), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def _chunk(parts: Column) -> Column:
    return F.pmod(F.xxhash64("id"), parts).cast("int")


def texts_of(docs: DataFrame, wanted: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The texts of the rows of ``wanted`` (by ``id``). A bitmap of fixed size keeps most other texts out of the shuffle."""
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    bitmap = bitmap_of(wanted.select(F.xxhash64("id").alias("key")), "key")
    near = flag_by_bitmap(rows.filter("id IS NOT NULL AND text IS NOT NULL"), F.xxhash64("id"), bitmap, "near").filter("near")
    return in_small_batches(near.select("id", "text").join(wanted, "id"))


def _resolve(docs: DataFrame, members: DataFrame, settings: MinMax, id_column: str, text_column: str) -> DataFrame:
    """(id, label): equal labels for members that chains of true links connect, found within each field.

    A field is dealt to as many tasks as its shingles ask for, and its most
    connected member goes to all of them. Each task finds the exact components
    of what it holds. Members that its centre's component leaves out are then
    compared with the field's other tasks as well, in blocks; links between
    documents that both hang on the centre add nothing. So every link that
    changes a component is tested, without pairs inside a large group.
    """
    fields = store(
        members.groupBy("field").agg(
            F.ceil(F.sum("n") / settings.task_shingles).cast("int").alias("parts"),
            F.max_by("id", F.struct("weight", -F.col("id"))).alias("centre"),
        ),
        "fields",
    )
    placed = members.join(fields, "field")
    is_centre = F.col("id") == F.col("centre")
    parts = F.when(is_centre, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(_chunk(F.col("parts"))))
    placed = store(placed.withColumn("is_centre", is_centre).withColumn("part", F.explode(parts)), "placed")

    found = store(
        texts_of(docs, placed.select("id", "field", "part", "parts", "centre", "is_centre", "n"), id_column, text_column)
        .groupBy("field", "part")
        .applyInArrow(
            _within(settings), "id bigint, field bigint, part int, parts int, centre bigint, n bigint, label bigint, central boolean"
        ),
        "within",
    )
    split = found.filter("parts > 1")
    labels = found.groupBy("id").agg(F.min("label").alias("label"))
    if split.isEmpty():
        return labels

    outside = split.filter("NOT central")
    blocks = outside.groupBy("field").agg(F.ceil(F.sum("n") / settings.task_shingles).cast("int").alias("blocks"))
    outside, inside = outside.join(blocks, "field"), split.join(blocks, "field")
    columns = ("id", "field", "part", "block", "label", "asks")
    asking = (
        outside.withColumn("block", _chunk(F.col("blocks")))
        .withColumn("own", F.col("part"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .filter("part <> own")
        .withColumn("asks", F.lit(True))
    )
    asked = inside.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(False))
    across = (
        texts_of(docs, asking.select(*columns).unionAll(asked.select(*columns)), id_column, text_column)
        .groupBy("field", "part", "block")
        .applyInArrow(_across(settings), "a bigint, b bigint")
    )
    # The centre stands in every part, so what hangs on it is one.
    on_centre = split.filter("central").select(F.col("label").alias("a"), F.col("centre").alias("b"))
    own = split.select(F.col("id").alias("a"), F.col("label").alias("b"))
    merged = connected_components(across.unionAll(on_centre).unionAll(own)).withColumnRenamed("node", "id")
    return labels.join(merged, "id", "left").select("id", F.coalesce("component", "label").alias("label"))


class _Group:
    """The shingle sets of one task's documents, with numbers for hashes that more than one of them has."""

    def __init__(self, texts: pa.Array, words: int) -> None:
        hasher, hashes, sizes = WordHasher(), [], []
        for _, _, found, offsets, _ in hasher.texts(texts):
            own, bounds = sets_of(*shingles(found, offsets, words))
            hashes.append(own)
            sizes.append(np.diff(bounds))
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        _, self.entries = np.unique(flat, return_inverse=True)
        self.mark = np.zeros(len(flat) + 1, np.uint8)

    def linked(self, one: int, others: np.ndarray, numerator: int) -> np.ndarray:
        """Those of ``others`` whose set passes the test with document ``one``."""
        n, sizes = self.sizes[one], self.sizes[others]
        # The smaller set must reach the share of the larger one.
        others = others[100 * np.minimum(n, sizes) >= numerator * np.maximum(n, sizes)]
        if not len(others):
            return others
        own = self.entries[self.bounds[one] : self.bounds[one + 1]]
        self.mark[own] = 1
        sizes = self.sizes[others]
        begin = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(self.bounds[others] - begin[:-1], sizes) + np.arange(begin[-1])
        common = np.add.reduceat(self.mark[self.entries[places]].astype(np.int64), begin[:-1])
        self.mark[own] = 0
        return others[100 * common >= numerator * (n + sizes - common)]


def _within(settings: MinMax) -> Callable[[pa.Table], pa.Table]:
    def resolve(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("id").to_numpy()
        group = _Group(table.column("text").combine_chunks(), settings.words)
        centre = np.flatnonzero(table.column("is_centre").to_numpy(zero_copy_only=False))
        rest = np.flatnonzero(group.sizes)
        label, central = ids.copy(), np.zeros(len(ids), bool)
        starts = [*centre[np.isin(centre, rest)], None]
        while len(rest):
            first = starts.pop(0) if starts else None
            first = first if first is not None and first in rest else rest[0]
            component, frontier = [first], [first]
            rest = rest[rest != first]
            while frontier and len(rest):
                new = group.linked(frontier.pop(), rest, settings.numerator)
                rest = np.setdiff1d(rest, new, assume_unique=True)
                component += new.tolist()
                frontier += new.tolist()
            label[component] = ids[component].min()
            central[component] = np.isin(component, centre).any()
        columns = [table.column(c) for c in ("id", "field", "part", "parts", "centre", "n")]
        return pa.table([*columns, pa.array(label), pa.array(central)], names=["id", "field", "part", "parts", "centre", "n", "label", "central"])

    return resolve


def _across(settings: MinMax) -> Callable[[pa.Table], pa.Table]:
    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        label = table.column("label").to_numpy()
        group = _Group(table.column("text").combine_chunks(), settings.words)
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        others = np.flatnonzero(~asks & (group.sizes > 0))
        edges = set()
        for one in np.flatnonzero(asks & (group.sizes > 0)):
            edges |= {(int(label[one]), int(x)) for x in np.unique(label[group.linked(one, others, settings.numerator)])}
        pairs = np.array(sorted(edges), np.int64).reshape(-1, 2)
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return compare


def drop_near_copies(
    docs: DataFrame, settings: MinMax = MinMax(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, with all their columns.

    A bitmap of the lost ids lets most rows pass where they are read; only those it names are shuffled to be matched.
    """
    found = near_duplicates(docs, settings, id_column, text_column)
    lost = store(found.filter(~F.col("kept")).select(F.col(id_column).alias("__lost")).distinct(), "near-lost")
    flag = free_name(docs.columns, "__near")
    key = F.col(id_column).cast("bigint")
    bitmap = store(bitmap_of(lost.select(F.xxhash64("__lost").alias("key")), "key"), "near-bitmap")
    rows = flag_by_bitmap(docs, F.xxhash64(key), bitmap, flag)
    matched = rows.filter(flag).join(lost, key == F.col("__lost"), "left_anti")
    return rows.filter(~F.col(flag)).unionAll(matched).select(*docs.columns)
