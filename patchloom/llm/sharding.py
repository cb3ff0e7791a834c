"""Shards of near-equal bytes, by sampled splitters (DataFrame functions only).

A row's key is (hash of its text, hash of its id), so equal texts are neighbours
in key order. Size-weighted key samples give quantile boundaries, the rows are
counted by range, and ranges that turn out overfull are sampled and divided
again: first between texts, then, where one text alone fills a range, between
its ids. Whole ranges then go to the shards in key order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from patchloom.llm.common import store, text_of

# What a row weighs besides its text.
ROW_BYTES = 16
# Ranges that a shard is made of at first, and the most there are of them in all.
RANGES_PER_SHARD, MOST_RANGES = 128, 8191
# Key samples drawn for each range, about.
SAMPLES_PER_RANGE = 8
# Parts that one overfull range is divided into at most, and how often that is tried.
MOST_PARTS, ROUNDS = 127, 6
_FIRST_BITS, _PART_BITS = 13, 8
# Bytes of rows that one task sorts and writes, about.
PIECE_BYTES = 256 << 20
_MAX_KEY = (1 << 63) - 1


@dataclass(frozen=True)
class Splitters:
    """Cuts by level, each (range, text_cuts, id_cuts), and where the final ranges go."""

    levels: Sequence[DataFrame]
    places: DataFrame


def row_size(text_column: str) -> Column:
    """UTF-8 bytes of the text (null: none) plus ROW_BYTES."""
    return F.octet_length(text_of(text_column)).cast("bigint") + ROW_BYTES


def _keys(id_column: str, text_column: str) -> dict[str, Column]:
    # The id is hashed with its position, so that null and text ids are told from each other too.
    return {"h": F.xxhash64(text_of(text_column)), "r": F.xxhash64(F.col(id_column), F.lit("id"))}


def _whole() -> Column:
    """The range that every row is in at first, 0; not a literal, which would turn the lookup of cuts into a loop over pairs."""
    return F.pmod("h", F.lit(1)).cast("bigint")


def _position(key: Column, cuts: Column, bits: int) -> Column:
    """How many of the sorted ``cuts`` are at or below ``key``, by bisection."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])

    def step(at: Column, width: Column) -> Column:
        # Beyond the last cut ``get`` is null, which is not at or below anything.
        return F.when(F.get(cuts, at + width - 1) <= key, at + width).otherwise(at)

    return F.when(cuts.isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), step))


def _descend(rows: DataFrame, cuts: DataFrame, bits: int) -> DataFrame:
    """Replace ``range`` by the range one level down.

    At most one row of cuts per overfull range is broadcast: the first level has
    one row of at most 2 x MOST_RANGES numbers, and as an overfull range holds
    more than twice the mean, a later one has at most MOST_RANGES / 2 rows of at most 2 x MOST_PARTS.
    """
    joined = rows.join(F.broadcast(cuts.withColumnRenamed("range", "__range")), F.col("range") == F.col("__range"), "left")
    below = F.greatest(_position(F.col("h"), F.col("text_cuts"), bits), _position(F.col("r"), F.col("id_cuts"), bits))
    deeper = F.shiftleft("range", bits) + below
    return joined.withColumn("range", deeper.cast("bigint")).drop("__range", "text_cuts", "id_cuts")


def _cuts(rows: DataFrame, overfull: DataFrame, level: int) -> DataFrame:
    """Boundaries inside the ``overfull`` ranges (range, bytes, by_text, parts), from a size-weighted sample of their rows.

    A row is drawn as often as its share of the sample says, the fraction being
    decided by its hash, so a rerun draws the same. A key that fills a whole part
    gets a boundary on either side and so a range of its own.
    """
    inside = rows.join(F.broadcast(overfull), "range")
    share = F.col("size") * F.col("parts") * SAMPLES_PER_RANGE / F.col("bytes")
    dice = F.pmod(F.xxhash64("h", "r", F.lit(level)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    key = F.when(F.col("by_text"), F.col("h")).otherwise(F.col("r"))
    drawn = inside.select("range", "by_text", "parts", key.alias("key"), F.floor(share + dice).alias("n")).filter("n > 0")
    per_key = drawn.groupBy("range", "by_text", "parts", "key").agg(F.sum("n").alias("n"))
    ordered = Window.partitionBy("range").orderBy("key")
    upto = F.sum("n").over(ordered)
    total = F.sum("n").over(Window.partitionBy("range"))
    passed = per_key.withColumn("__upto", upto).withColumn("__total", total)
    quantile = lambda at: F.floor(at * F.col("parts") / F.col("__total"))
    crossed = passed.withColumn("__crossed", quantile(F.col("__upto")) - quantile(F.col("__upto") - F.col("n")))
    both = F.when((F.col("__crossed") > 1) & (F.col("key") < _MAX_KEY), F.array(F.col("key"), F.col("key") + 1))
    edges = crossed.filter("__crossed > 0").withColumn("__edges", F.coalesce(both, F.array("key")))
    lists = edges.groupBy("range", "by_text").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("__edges")))).alias("cuts"))
    return lists.select(
        "range", F.when(F.col("by_text"), F.col("cuts")).alias("text_cuts"), F.when(~F.col("by_text"), F.col("cuts")).alias("id_cuts")
    )


def splitters(rows: DataFrame, shards: int, piece_bytes: int = PIECE_BYTES) -> Splitters:
    """Boundaries for rows (h, r, size), which should be stored: they are read a few times.

    Every range ends up with at most twice ``total / ranges`` bytes, unless it is
    one row, or rows of one id and text, which no key tells apart; such a range
    is dealt out by salt. Counts are combined before each shuffle.
    """
    first = min(shards * RANGES_PER_SHARD, MOST_RANGES // 2)
    total = rows.agg(F.sum("size")).first()[0] or 0
    limit = max(1, -(-2 * total // first))
    rows, levels = rows.withColumn("range", _whole()), []
    bits = _FIRST_BITS
    for level in range(ROUNDS):
        sums = _sums(rows, label=f"shard-ranges-{level}")
        divisible = (F.col("h0") < F.col("h1")) | (F.col("r0") < F.col("r1"))
        wanted = F.ceil(F.col("bytes") * 2 / F.lit(limit))
        overfull = sums.filter((F.col("bytes") > (limit if level else 0)) & divisible).select(
            "range",
            "bytes",
            (F.col("h0") < F.col("h1")).alias("by_text"),
            F.least(wanted, F.lit(MOST_PARTS if level else first)).cast("bigint").alias("parts"),
        )
        if overfull.isEmpty():
            break
        levels.append(store(_cuts(rows, overfull, level), f"shard-cuts-{level}"))
        rows = _descend(rows, levels[-1], bits)
        bits = _PART_BITS
    else:
        sums = _sums(rows, label="shard-ranges")
    return Splitters(levels, store(_places(sums, shards, total, limit, piece_bytes), "shard-places"))


def _sums(rows: DataFrame, label: str) -> DataFrame:
    return store(
        rows.groupBy("range").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("n_rows"),
            F.min("h").alias("h0"), F.max("h").alias("h1"), F.min("r").alias("r0"), F.max("r").alias("r1"),
        ),
        label,
    )


def _places(sums: DataFrame, shards: int, total: int, limit: int, piece_bytes: int) -> DataFrame:
    """(range, slices, shard[], piece[], parts[]): where the slices of each range go.

    A range goes to the shard in which its middle lies, counted in bytes, so a
    shard's size is off by half a range at either end. Rows that no key tells
    apart are cut into slices of about a range's size. A shard's rows are dealt
    to pieces, which is what one task writes; a slice larger than a piece is
    dealt to several. The window orders ranges, whose number is bounded.
    """
    alike = (F.col("h0") == F.col("h1")) & (F.col("r0") == F.col("r1")) & (F.col("bytes") > limit)
    slices = F.when(alike, F.least(F.ceil(F.col("bytes") * 2 / F.lit(limit)), "n_rows")).otherwise(F.lit(1)).cast("int")
    before = F.sum("bytes").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    placed = sums.select("range", "bytes", slices.alias("slices"), F.coalesce(before, F.lit(0)).alias("before"))
    piece = max(1, min(piece_bytes, -(-total // (shards * 4))))

    def each(of):
        return F.transform(F.sequence(F.lit(0), F.col("slices") - 1), of)

    def middle(k: Column) -> Column:
        return F.col("before") + F.expr("bytes div slices") * k + F.expr("bytes div slices div 2")

    return placed.select(
        "range",
        "slices",
        each(lambda k: F.least(F.floor(middle(k) * F.lit(shards) / F.lit(total)), F.lit(shards - 1)).cast("int")).alias("shards"),
        each(lambda k: F.floor(middle(k) / F.lit(piece))).alias("pieces"),
        F.ceil(F.expr("bytes div slices") / F.lit(piece)).cast("bigint").alias("parts"),
    )


def placed(rows: DataFrame, cuts: Splitters) -> DataFrame:
    """Rows with h, r to the same rows with ``shard`` and ``piece``.

    The places are broadcast: there are a few times MOST_RANGES of them at most, a few numbers each.
    """
    rows = rows.withColumn("range", _whole())
    bits = _FIRST_BITS
    for level in cuts.levels:
        rows, bits = _descend(rows, level, bits), _PART_BITS
    places = F.broadcast(cuts.places.withColumnRenamed("range", "__range"))
    joined = rows.join(places, F.col("range") == F.col("__range"))
    salt = F.xxhash64(F.monotonically_increasing_id(), F.spark_partition_id())
    piece = F.get("pieces", F.col("__slice")) + F.pmod(F.xxhash64("r", F.lit("piece")), F.col("parts"))
    return (
        joined.withColumn("__slice", F.when(F.col("slices") > 1, F.pmod(salt, F.col("slices"))).otherwise(0).cast("int"))
        .withColumn("shard", F.get("shards", F.col("__slice")))
        .withColumn("piece", piece)
        .drop("range", "__range", "slices", "shards", "pieces", "parts", "__slice")
    )


def _layout(columns: StructType) -> StructType:
    return StructType([
        StructField("piece", LongType()), StructField("place", LongType()), StructField("row", columns), StructField("shard", IntegerType()),
    ])


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = 40,
    id_column: str = "doc_id",
    text_column: str = "text",
    piece_bytes: int = PIECE_BYTES,
) -> None:
    """Write all rows of ``docs``, whole, as ``shards`` folders of near-equal bytes below ``path``.

    Keys are computed once and stored; the texts are read a second time and moved
    by one shuffle, straight to the task that writes their piece of a shard.
    ``path/rows/shard=N`` holds the rows as a struct ``row`` with their place in
    their piece, ``path/index`` the rows of each piece and the slot its first one
    has: pieces are counted as they were written, so slots have no gaps.

    Equal texts share a shard unless they outgrow a range (some 2 % of one of 40
    shards); then they are divided by id. Null text equals empty text and weighs ROW_BYTES. Null
    and repeated ids are allowed: rows equal in id and text are dealt out by salt where they are many. Sizes are as
    near as the largest row allows; with fewer rows than shards, or one very
    long text, some shards are empty. An empty table gives no rows. Other
    columns may have any names. ``docs`` must give the same rows each time it is read.
    """
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in _keys(id_column, text_column).items()])
    slim = docs.select(row_size(text_column).alias("size"), *[c.alias(n) for n, c in _keys(id_column, text_column).items()])
    cuts = splitters(store(slim, "shard-keys"), shards, piece_bytes)
    ordered = Window.partitionBy("shard", "piece").orderBy("h", "r")
    numbered = placed(keyed, cuts).withColumn("place", (F.row_number().over(ordered) - 1).cast("bigint"))
    rows = numbered.select("piece", "place", "row", "shard")
    rows.write.option("compression", "zstd").partitionBy("shard").parquet(f"{path}/rows")
    written = docs.sparkSession.read.schema(_layout(rows.schema["row"].dataType)).parquet(f"{path}/rows")
    counts = written.groupBy("shard", "piece").agg(F.count("*").alias("n_rows"))
    before = F.sum("n_rows").over(Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    counts.withColumn("first_slot", F.coalesce(before, F.lit(0))).write.parquet(f"{path}/index")


def read_shards(spark: SparkSession, path: str, columns: StructType, shard: int | None = None) -> DataFrame:
    """(shard, slot, row) of what :func:`write_shards` wrote; ``columns`` is the schema of ``docs``.

    With ``shard`` only that folder is read.
    """
    rows = spark.read.schema(_layout(columns)).parquet(f"{path}/rows")
    index = spark.read.parquet(f"{path}/index")
    if shard is not None:
        rows, index = rows.filter(F.col("shard") == shard), index.filter(F.col("shard") == shard)
    slot = (F.col("first_slot") + F.col("place")).cast("bigint")
    return rows.join(index.drop("n_rows"), ["shard", "piece"]).select("shard", slot.alias("slot"), "row")
