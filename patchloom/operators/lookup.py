"""Feature lookup for training and scoring, by key or by key and time."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from patchloom.operators.skew import lookup_join
from patchloom.sinks.feature_table import time_key_of

MISSING = ("keep", "drop", "error")


@dataclass(frozen=True)
class FeatureLookup:
    """Which features of which table to fetch, and by what key.

    ``missing`` says what happens to base rows whose key the table does not
    hold: ``keep`` them with null features, ``drop`` them, or raise an ``error``.

    ``time`` names the table's time column; the latest row at or before the base
    row's ``base_time`` (by default a column of the same name) is fetched, and a
    key without such a row counts as missing. ``tie_breaker`` decides between
    rows of one key and time.
    """

    table: str
    features: tuple[str, ...]
    key: tuple[str, ...]
    missing: str = "keep"
    time: str | None = None
    base_time: str | None = None
    tie_breaker: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "features", tuple(self.features))
        object.__setattr__(self, "key", tuple(self.key))
        if self.missing not in MISSING:
            raise ValueError(f"missing must be one of {MISSING}, not {self.missing!r}")


def lookups_to_json(lookups: Iterable[FeatureLookup], **extra) -> str:
    return json.dumps({"lookups": [asdict(spec) for spec in lookups], **extra})


def lookups_from_json(text: str) -> tuple[list[FeatureLookup], dict]:
    raw = json.loads(text)
    return [FeatureLookup(**spec) for spec in raw.pop("lookups")], raw


def feature_lookup(
    base: DataFrame, features: DataFrame, spec: FeatureLookup, salts: int = 1
) -> DataFrame:
    """Base rows with the named features of one table, joined by key, or by key and time."""
    if spec.time:
        marked = features.withColumn("_found", F.lit(True))
        joined = point_in_time_lookup(
            base, marked, spec.key, spec.base_time or spec.time, spec.time, [*spec.features, "_found"], spec.tie_breaker,
            salts=salts,
        )
        if spec.missing == "keep":
            return joined.drop("_found")
        if spec.missing == "drop":
            return joined.filter("_found").drop("_found")
    elif spec.missing == "error":
        # A marker tells a missing row from one that holds null features.
        found = features.select(*spec.key, *spec.features, F.lit(True).alias("_found"))
        joined = lookup_join(base, found, spec.key, "left", salts)
    if spec.missing == "error":
        key_text = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in spec.key])
        message = F.concat(F.lit(f"no row in {spec.table} for key "), key_text)
        # The check is part of the filter, so no later projection can prune it.
        checked = F.when(F.col("_found"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        return joined.filter(checked).drop("_found")
    how = "inner" if spec.missing == "drop" else "left"
    return lookup_join(base, features.select(*spec.key, *spec.features), spec.key, how, salts)


def merge_lookups(lookups: Iterable[FeatureLookup]) -> list[FeatureLookup]:
    """Lookups with the same table, key and policy as one, so each table is joined once."""
    merged: dict[FeatureLookup, tuple[str, ...]] = {}
    for spec in lookups:
        where = replace(spec, features=())
        merged[where] = tuple(dict.fromkeys(merged.get(where, ()) + spec.features))
    return [replace(where, features=features) for where, features in merged.items()]


def with_features(
    base: DataFrame,
    lookups: Iterable[FeatureLookup],
    resolve: Callable[[str], DataFrame] | None = None,
    exclude: Sequence[str] = (),
    base_table: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """Training or scoring rows: the base, all looked-up features, minus ``exclude``.

    ``resolve`` maps a table name to its rows, by default the catalog. When the
    base rows come from ``base_table`` and already hold the columns a lookup
    would fetch from that same table, the self-join is left out. Excluded names
    that are absent are ignored. A catalog table that says it has a time key is
    refused without ``time``: its keys aren't unique, and later values would leak.
    """
    table = resolve or base.sparkSession.table
    for spec in merge_lookups(lookups):
        if spec.table == base_table and set(spec.features) <= set(base.columns):
            continue
        clash = set(spec.features) & set(base.columns)
        if clash:
            raise ValueError(f"{sorted(clash)} are in the base rows and in {spec.table}")
        if resolve is None and not spec.time and (time_key := time_key_of(base.sparkSession, spec.table)):
            raise ValueError(f"{spec.table} is kept by time; look it up with time={time_key!r}")
        base = feature_lookup(base, table(spec.table), spec, salts)
    return base.drop(*exclude)


# A key with more questions and feature rows than this is cut into time ranges of about so many rows.
BLOCK_ROWS = 2_000_000
# Quantiles that a hot key's time ranges lie between: as many as the hottest key has ranges, within these
# bounds. At the upper one, reached at 3 x 10^10 rows of one key, a task's sketch of a key takes some 4 MB.
COARSEST, FINEST = 1024, 16_384
# Cuts of a key that are looked through at once: FINEST ranges are as many such pieces.
_PIECE = 128


def point_in_time_lookup(
    base: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    base_ts: str,
    feature_ts: str,
    columns: Sequence[str],
    tie_breaker: str | None = None,
    block_rows: int = BLOCK_ROWS,
    salts: int = 1,
) -> DataFrame:
    """Base rows with each key's latest features at or before the base time.

    ``features`` is unique by key and time, or by key, time and ``tie_breaker``
    (the greatest wins). No base row without a partner is lost. Key and time
    columns may have different types on either side; they are compared in the
    wider one.

    Questions, the distinct (key, time) pairs of the base, and feature rows are
    put in one time order per key; a window carries the last feature row
    forward, so no pairs of rows are formed. A key with more than ``block_rows``
    rows is cut at its own time quantiles into ranges that run as separate groups,
    and the last feature row of each range is handed to the following ones.
    Counting the keys is a job of its own, and so are the quantiles where a key is hot.
    ``salts`` spreads base rows that share both key and time when the answers are joined back.
    """
    keys = list(keys)
    null_tie = F.lit(0)
    questions = (
        base.select(*keys, F.col(base_ts).alias("_ts"))
        .dropna("any")
        .distinct()
        .withColumns({"_side": F.lit(1), "_tie": null_tie})
    )
    facts = features.dropna("any", subset=[*keys, feature_ts]).select(
        *keys,
        F.col(feature_ts).alias("_ts"),
        F.lit(0).alias("_side"),
        (F.col(tie_breaker) if tie_breaker else null_tie).alias("_tie"),
        F.struct(*columns).alias("_value"),
    )
    if tie_breaker:
        questions = questions.withColumn("_tie", F.lit(None).cast(features.schema[tie_breaker].dataType))
    stream = questions.unionByName(facts, allowMissingColumns=True)

    # Sizes and time ranges are measured on the plain rows: cheaper than on the
    # distinct ones, and never less than them. Both unions widen the keys alike.
    times = base.select(*keys, F.col(base_ts).alias("_ts")).unionByName(facts.select(*keys, "_ts")).dropna("any")
    ranges = _time_ranges(times, keys, block_rows)
    stream = _in_ranges(stream, keys, ranges)

    so_far = (
        Window.partitionBy(*keys, "_block")
        .orderBy("_ts", "_side", "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = (
        stream.withColumn("_value", F.last("_value", ignorenulls=True).over(so_far))
        .filter("_side = 1")
        .select(*keys, "_block", "_ts", "_value")
    )
    if ranges is not None:
        answers = answers.join(_carried(stream.filter("_side = 0 AND _last > 0"), keys), [*keys, "_block"], "left")
        answers = answers.withColumn("_value", F.coalesce("_value", "_carry"))
    answers = answers.select(*keys, F.col("_ts").alias(base_ts), *[F.col("_value")[c].alias(c) for c in columns])
    return lookup_join(base, answers, [*keys, base_ts], "left", salts)


def _time_ranges(times: DataFrame, keys: list[str], block_rows: int) -> DataFrame | None:
    """(_hash, _cuts) of every key with more than ``block_rows`` rows, or None without such keys.

    All cuts together are fewer than the rows divided by ``block_rows``, so the
    table stays small: 4 MB for 10^12 rows.
    """
    counted = times.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
    hot = counted.filter(F.col("_n") > block_rows).collect()
    if not hot:
        return None
    spark = times.sparkSession
    sizes = spark.createDataFrame([(r["_hash"], r["_n"]) for r in hot], "_hash bigint, _n bigint")
    finest = min(max(COARSEST, -(-max(r["_n"] for r in hot) // block_rows)), FINEST)
    # Only keys that need more than the coarsest quantiles get the finest, which are as many as the hottest has ranges.
    few = F.col("_n") <= COARSEST * block_rows
    each = F.when(few, COARSEST).otherwise(finest)

    def quantiles_of(ts: Column, n: int) -> Column:
        return F.percentile_approx(ts, [i / n for i in range(1, n)], 10 * n)

    found = quantiles_of(F.when(few, F.col("_ts")), COARSEST)
    if finest > COARSEST:
        found = F.coalesce(found, quantiles_of(F.when(~few, F.col("_ts")), finest))
    quantiles = times.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(sizes), "_hash").groupBy("_hash", "_n").agg(found.alias("_q"))
    blocks = F.least(F.ceil(F.col("_n") / block_rows), F.lit(finest)).cast("int")
    picked = F.transform(
        F.sequence(F.lit(1), blocks - 1), lambda i: F.get("_q", F.floor(i * each / blocks).cast("int") - 1)
    )
    found = quantiles.select("_hash", F.array_distinct(picked).alias("_cuts"))
    return spark.createDataFrame(found.collect(), found.schema)


def _passed(cuts: str) -> Column:
    """How many of at most ``_PIECE`` rising cuts a row's time has passed, by halving."""

    def step(passed: Column, more: Column) -> Column:
        return F.when(F.get(cuts, passed + more - 1) <= F.col("_ts"), passed + more).otherwise(passed)

    return F.aggregate(F.array(*[F.lit(_PIECE >> i) for i in range(_PIECE.bit_length())]), F.lit(0), step)


def _in_ranges(rows: DataFrame, keys: list[str], ranges: DataFrame | None) -> DataFrame:
    """Add ``_block``, the number of the key's time range a row lies in, and ``_last``, the number of its last one.

    A key's cuts are looked up in pieces: first the piece by its first cut, then the cut. So a row meets
    arrays of at most ``_PIECE`` cuts, however many ranges its key has.
    """
    if ranges is None:
        return rows.withColumns({"_block": F.lit(0), "_last": F.lit(0)})
    pieces = F.sequence(F.lit(0), F.ceil(F.size("_cuts") / _PIECE).cast("int") - 1)
    heads = ranges.select("_hash", F.size("_cuts").alias("_size"), F.transform(pieces, lambda i: F.get("_cuts", i * _PIECE)).alias("_heads"))
    parts = ranges.select("_hash", F.posexplode(F.transform(pieces, lambda i: F.slice("_cuts", i * _PIECE + 1, _PIECE))).alias("_piece", "_part"))
    marked = rows.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(heads), "_hash", "left")
    marked = marked.withColumn("_piece", _passed("_heads") - 1).drop("_heads")
    marked = marked.join(F.broadcast(parts), ["_hash", "_piece"], "left")
    block = F.when(F.col("_part").isNotNull(), F.col("_piece") * _PIECE + _passed("_part")).otherwise(0)
    return marked.withColumns({"_block": block, "_last": F.coalesce("_size", F.lit(0))}).drop("_hash", "_piece", "_part", "_size")


def _carried(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Last feature row of earlier ranges, for every range after the first.

    ``facts`` holds hot keys only, so there is at most a row for each range.
    """
    last = facts.groupBy(*keys, "_block", "_last").agg(F.max_by("_value", F.struct("_ts", "_tie")).alias("_carry"))
    in_order = Window.partitionBy(*keys).orderBy("_block")
    until = F.coalesce(F.lead("_block").over(in_order), F.col("_last"))
    return (
        last.withColumn("_until", until)
        .filter("_until > _block")
        .select(*keys, F.explode(F.sequence(F.col("_block") + 1, F.col("_until"))).alias("_block"), "_carry")
    )
