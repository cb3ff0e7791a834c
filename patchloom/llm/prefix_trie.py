"""Tries of conversation prefixes, aggregated by ROLLUP over positional turn columns.

A conversation is cut into blocks of BLOCK turns, one row each with a column per
turn. ``ROLLUP`` over these columns aggregates every prefix of the block at once,
and ``grouping_id`` tells how long it is. A block further down is grouped
under the node at which the block before it ends, named by a hash of the whole
way from the root, so that all blocks of all conversations are aggregated together.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom.llm.common import store

# Turns in a block: a row is expanded to one more than that.
BLOCK = 8
# Ids of neighbouring conversations that are listed in one piece.
LISTED = 4096
_TURNS = [f"t{k}" for k in range(1, BLOCK + 1)]
_EMPTY = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """What a turn says, as 16 bytes of SHA-256, with its length in code points; null counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(said, 256)), 1, 16)
    return F.struct(digest.alias("said"), F.length(text).alias("chars"))


def ordered_turns(
    conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """(conv_id, pos, turn) with places from 1, by turn number (null first), equal numbers by turn id.

    Only ids of turns are sorted, not texts. Rows without a conversation id are left out.
    """
    turns = conversations.select(
        F.col(id_column).cast("bigint").alias("conv_id"),
        F.col(turn_column).alias("number"),
        turn_id(F.col(role_column), F.col(text_column)).alias("turn"),
    ).filter("conv_id IS NOT NULL")
    by_number = Window.partitionBy("conv_id").orderBy(F.col("number").asc_nulls_first(), "turn")
    return turns.select("conv_id", F.row_number().over(by_number).alias("pos"), "turn")


def with_openings(turns: DataFrame, every: int = 100, choices: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the opening of the first of each ``every`` ids: (turns, conversations).

    Conversation c takes the first h turns of conversation c - c % every (all if
    fewer, none if absent), then its own after its first h, with h = crc32(c) % choices.
    A conversation that ends up without turns stays among the conversations.
    """
    base = F.col("conv_id") - F.col("conv_id") % every
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % choices).cast("int")
    rows = turns.withColumns({"h": h, "base": base})
    conversations = rows.select("conv_id", "base", "h").distinct()
    # Fewer than ``choices`` rows for each base, which at most ``every`` conversations share.
    heads = turns.filter((F.col("conv_id") % every == 0) & (F.col("pos") < choices)).select(
        F.col("conv_id").alias("base"), F.col("pos").alias("head_pos"), F.col("turn").alias("head_turn")
    )
    taken = conversations.join(heads, "base").filter("head_pos <= h").select("conv_id", F.col("head_pos").alias("pos"), F.col("head_turn").alias("turn"))
    lengths = heads.groupBy("base").agg(F.max("head_pos").alias("available"))
    own = rows.filter("pos > h").join(lengths, "base", "left")
    moved = F.col("pos") - F.col("h") + F.least(F.col("h"), F.coalesce("available", F.lit(0)))
    rebuilt = taken.unionByName(own.select("conv_id", moved.cast("int").alias("pos"), "turn"))
    return rebuilt, conversations.select("conv_id")


def _steps(pos: Column, turn: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a turn at its place; a node's name is the exclusive or of those on the way to it."""
    return F.xxhash64(pos.cast("int"), turn), F.xxhash64(turn, pos.cast("int"), F.lit("second"))


def _blocks(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, block, node_a, node_b, end_a, end_b, last, t1..t8): a row per block of every conversation, block 0 even without turns.

    A turn is its id, length and hashes at its place. ``node`` names where the block starts, ``end`` where it ends; ``last`` is true for the conversation's last block.
    """
    a, b = _steps(F.col("pos"), F.col("turn"))
    place = (F.col("pos") - 1) % BLOCK + 1
    cut = turns.withColumns({"block": F.expr(f"(pos - 1) div {BLOCK}").cast("int"), "a": a, "b": b, "place": place})
    step = F.struct("turn.said", "turn.chars", "a", "b")
    rows = cut.groupBy("conv_id", "block").agg(
        F.bit_xor("a").alias("a"),
        F.bit_xor("b").alias("b"),
        *[F.max(F.when(F.col("place") == k, step)).alias(t) for k, t in enumerate(_TURNS, 1)],
    )
    empty = conversations.select("conv_id").join(turns.select("conv_id"), "conv_id", "left_anti")
    rows = rows.unionByName(empty.select("conv_id", F.lit(0).alias("block"), F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b")), True)
    way = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max("block").over(Window.partitionBy("conv_id"))
    ends = rows.withColumns({"end_a": F.bit_xor("a").over(way), "end_b": F.bit_xor("b").over(way), "last": F.col("block") == last})
    starts = {"node_a": F.col("end_a").bitwiseXOR(F.col("a")), "node_b": F.col("end_b").bitwiseXOR(F.col("b"))}
    return ends.withColumns(starts).drop("a", "b")


def _rolled(blocks: DataFrame, **aggregates: str) -> DataFrame:
    """One row per node: (a, b, depth, up_a, up_b, chars) and the aggregates over the conversations through it.

    A turn column that is null though it is grouped by belongs to
    conversations that end earlier: no node. The node at a block's start is the
    end of the block before, so only the root is taken from there.
    """
    view = f"trie_blocks_{uuid.uuid4().hex}"  # a session may build several tries at once
    blocks.createOrReplaceTempView(view)
    listed = ", ".join(_TURNS)
    session = blocks.sparkSession
    counted = session.sql(
        f"SELECT block, node_a, node_b, {listed}, grouping_id() AS rolled, {', '.join(f'{sql} AS {name}' for name, sql in aggregates.items())} "
        f"FROM {view} GROUP BY block, node_a, node_b, ROLLUP({listed})"
    )
    session.catalog.dropTempView(view)
    length = F.lit(BLOCK) - F.bit_count("rolled")
    counted = counted.withColumn("length", length)
    ends = F.get(F.array(*_TURNS), F.col("length") - 1)
    nodes = counted.withColumn("end", ends).filter("CASE WHEN length = 0 THEN block = 0 ELSE end IS NOT NULL END")
    depth = F.col("block") * BLOCK + F.col("length")

    def name(half: str) -> Column:
        # Turns that are rolled up are null here.
        out = F.col(f"node_{half}")
        for t in _TURNS:
            out = out.bitwiseXOR(F.coalesce(F.col(f"{t}.{half}"), F.lit(0).cast("bigint")))
        return out

    def above(half: str) -> Column:
        return name(half).bitwiseXOR(F.coalesce(F.col(f"end.{half}"), F.lit(0).cast("bigint")))

    return nodes.select(
        name("a").alias("a"),
        name("b").alias("b"),
        depth.cast("bigint").alias("depth"),
        above("a").alias("up_a"),
        above("b").alias("up_b"),
        F.coalesce(F.col("end.chars"), F.lit(0)).cast("bigint").alias("chars"),
        *aggregates,
    )


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's list, whose pieces come in order; one hash state is held."""
    node, state = None, None
    for batch in batches:
        done = []
        for a, b, piece in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "listed")), strict=True):
            if (a, b) != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (a, b), hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if done:
            yield _digests(done)
    if node is not None:
        yield _digests([(*node, state.hexdigest())])


def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    a, b, digests = zip(*rows, strict=True)
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "ends_sha256": pa.array(digests, pa.string())})


def _end_lists(blocks: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of the nodes at which a conversation ends.

    Ids are first listed in pieces by range, which bounds a piece by LISTED ids;
    a node's pieces are then hashed in order as they stream by.
    """
    ends = blocks.filter("last").select(F.col("end_a").alias("a"), F.col("end_b").alias("b"), "conv_id")
    piece = F.floor(F.col("conv_id") / F.lit(LISTED))
    pieces = ends.groupBy("a", "b", piece.alias("piece")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    listed = pieces.select("a", "b", "piece", F.array_join(F.col("ids").cast("array<string>"), ",").alias("listed"))
    return listed.repartition("a", "b").sortWithinPartitions("a", "b", "piece").mapInArrow(_hash_lists, "a bigint, b bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, pos from 1 without gaps, turn) of all ``conversations`` (conv_id, each once).

    A node is a distinct sequence of first turns; the root is the empty one. Returns conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 as the query's contract has them.

    Sums over subtrees need no walk: a node belongs to its smallest member,
    whose nodes are the lower end of its way. A node's subtree
    therefore holds all nodes of its members, but for its own smallest member's
    nodes above it. So a second ROLLUP adds up what each member's nodes have, and a running sum
    up the smallest member's way gives the rest.

    Conversations without turns are members of the root alone. A conversation's
    own turns are numbered in one task, which spills; everything across
    conversations is combined before it is sent, so a first turn or a whole conversation
    that a third of all have is a partial row per task. Without conversations there is no node, not even the root.
    """
    blocks = store(_blocks(turns, conversations), "trie-blocks")
    nodes = store(_rolled(blocks, conv_id="min(conv_id)", n_convs="count(*)"), "trie-nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count("*").alias("n_children"))
    saved = (F.col("n_convs") - 1) * F.col("chars")
    own = nodes.join(children, ["a", "b"], "left").withColumns(
        {"n_children": F.coalesce("n_children", F.lit(0)).cast("bigint"), "leaf": F.col("n_children").isNull().cast("bigint"), "saved": saved}
    )
    upwards = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("conv_id")
    owned = store(
        own.withColumns(
            {
                "leaves_below": F.sum("leaf").over(upwards), "saved_below": F.sum("saved").over(upwards),
                "leaves_owned": F.sum("leaf").over(whole), "saved_owned": F.sum("saved").over(whole),
                "top": F.col("depth") == F.min("depth").over(whole),
            }
        ),
        "trie-owned",
    )
    shares = owned.filter("top").select("conv_id", "leaves_owned", "saved_owned")
    # Conversations that own no node add nothing.
    sums = _rolled(store(blocks.join(shares, "conv_id"), "trie-shares"), leaves_in="sum(leaves_owned)", saved_in="sum(saved_owned)")
    totals = owned.join(sums.select("a", "b", "leaves_in", "saved_in"), ["a", "b"]).join(_end_lists(blocks), ["a", "b"], "left")
    # Below a conversation's topmost node its parents are its own.
    tops = owned.filter("top AND depth > 0").select(F.col("a").alias("of_a"), F.col("b").alias("of_b"), "up_a", "up_b")
    parents = nodes.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("above"))
    above = tops.join(parents, ["up_a", "up_b"]).select("of_a", "of_b", "above")
    found = totals.join(above, (F.col("a") == F.col("of_a")) & (F.col("b") == F.col("of_b")), "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("above", "conv_id"))
    return found.select(
        "conv_id",
        "depth",
        parent.alias("parent_conv_id"),
        "n_convs",
        "n_children",
        (F.col("leaves_in") - F.col("leaves_owned") + F.col("leaves_below")).alias("n_leaves"),
        (F.col("saved_in") - F.col("saved_owned") + F.col("saved_below")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )
