"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.session import scratch_path

# What separates words: space and the five ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"

# A bitmap is a set of hashes held in 4,096-byte pieces, so its size is fixed by this number alone.
BITMAP_BITS = 1 << 27
_PIECE_BITS = 32768


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared scratch folder and read it back, which ends its lineage.

    The files stay for as long as the returned frame is of use; they lie below
    the session's scratch folder, which belongs to the caller.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Bytes of rows handed to Python at once; a longer text goes alone.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, after lowering the session's Arrow batches to BATCH_BYTES where they are larger.

    Texts vary in length by orders of magnitude, so rows bound nothing; a task
    holds a few batches on either side of the pipe to Python.
    """
    conf = df.sparkSession.conf
    now = conf.get(_BATCH_SETTING).removesuffix("b")
    if not now.lstrip("-").isdigit() or not 0 < int(now) <= BATCH_BYTES:
        conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")
    return df


def text_of(column: str) -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(column: str) -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("bigint")


def _slot(key: Column, bits: int) -> Column:
    return F.pmod(key, F.lit(bits))


def bitmap_of(keys: DataFrame, key: str, bits: int = BITMAP_BITS) -> DataFrame:
    """The hashes in a bigint column as bitmap pieces (piece, bitmap): at most ``bits`` / 32,768 rows of 4 KiB."""
    slot = _slot(F.col(key), bits)
    return (
        keys.filter(F.col(key).isNotNull())
        .select(slot.alias("slot"))
        .groupBy(F.expr("slot div 32768").alias("piece"))
        .agg(F.bitmap_construct_agg(F.col("slot") % _PIECE_BITS).alias("bitmap"))
    )


def flag_by_bitmap(df: DataFrame, key: Column, bitmap: DataFrame, flag: str, bits: int = BITMAP_BITS) -> DataFrame:
    """Add a boolean column: false where ``key`` surely isn't in the bitmap, else true.

    The bitmap is broadcast: it has at most ``bits`` / 8 bytes whatever the data.
    Keys that share a slot with a member are flagged too, so a flag means "look closer".
    """
    marked = df.withColumn("__slot", _slot(key, bits)).withColumn("__piece", F.expr("__slot div 32768"))
    pieces = bitmap.select(F.col("piece").alias("__piece"), F.col("bitmap").alias("__bitmap"))
    joined = marked.join(F.broadcast(pieces), "__piece", "left")
    place = (F.col("__slot") % _PIECE_BITS).cast("int")
    byte = F.conv(F.hex(F.expr("substring(__bitmap, cast((__slot % 32768) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("1").cast("int")
    hit = F.call_function("shiftright", byte, place % 8).bitwiseAND(bit) == 1
    return joined.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("__slot", "__piece", "__bitmap")


def free_name(df_columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores put before it until no column has that name."""
    taken = {c.lower() for c in df_columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
