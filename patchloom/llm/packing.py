"""Vector best-fit packing of token sequences."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import in_small_batches, store
from patchloom.llm.tokens import Encoder, tokenizer_path


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds: tokens, documents, and attention cost (the sum of squared piece lengths).

    The defaults leave documents and attention open: no 1,024 tokens exceed them.
    """

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024


# Documents packed by one task. A block's last sequences stay partly empty, which
# costs about one sequence in several thousand.
BLOCK_DOCUMENTS = 8192
END_ID = 2


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, and the number of bins.

    Longest first; of the open bins that can take the piece under every
    capacity, the one whose remaining capacities have the smallest weighted norm
    takes it. A capacity weighs as much as the pieces ask of it. Ties go to the
    bin opened first, equal lengths keep their order. A piece that no empty bin
    could take is an error.
    """
    need = np.stack([lengths, np.ones_like(lengths), lengths * lengths]).astype(float)
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    if (need > full[:, None]).any():
        raise ValueError("a piece exceeds the capacity of an empty sequence")
    need /= full[:, None]
    weight = need.sum(axis=1) / max(need.sum(), 1e-300)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rest = np.ones((3, max(1, len(lengths))))
    names = np.zeros(max(1, len(lengths)), np.int64)  # bins still open, in opening order
    filled = np.zeros(max(1, len(lengths)), np.int64)
    n_open = n_bins = 0
    slack = 1e-9
    for step, i in enumerate(np.argsort(-lengths, kind="stable")):
        ask = need[:, i]
        if step % 256 == 0 and n_open:  # bins that can't take the shortest piece any more are closed
            keep = rest[0, :n_open] + slack >= need[0].min()
            kept = int(keep.sum())
            rest[:, :kept], names[:kept] = rest[:, :n_open][:, keep], names[:n_open][keep]
            n_open = kept
        left = rest[:, :n_open] - ask[:, None]
        fits = np.flatnonzero((left >= -slack).all(axis=0))
        if len(fits):
            norm = weight @ (left[:, fits] ** 2)
            at = fits[np.argmin(norm)]
        else:
            at = n_open
            rest[:, at], names[at] = 1.0, n_bins
            n_open, n_bins = n_open + 1, n_bins + 1
        rest[:, at] -= ask
        bins[i], offsets[i] = names[at], filled[names[at]]
        filled[names[at]] += lengths[i]
    return bins, offsets, n_bins


def piece_lengths(n: int, most: int) -> list[int]:
    """Full pieces, the first one holding what is left over."""
    pieces = -(-n // most)
    return [n - most * (pieces - 1)] + [most] * (pieces - 1) if n else []


def _tokenise(path: str, end_id: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at, to, ids, bounds in encoder.encode(batch.column(1)):
                body, sizes, sums = memoryview(ids.astype("<u4", copy=False)).cast("B"), [], []
                for a, b in zip((4 * bounds[:-1]).tolist(), (4 * bounds[1:]).tolist(), strict=True):
                    own = bytes(body[a:b]) + end
                    sizes.append(len(own) // 4)
                    cuts = np.concatenate([[0], np.cumsum(piece_lengths(sizes[-1], most))]) * 4
                    sums.append([zlib.crc32(own[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), pa.array(sizes, pa.int64()), pa.array(sums, pa.list_(pa.int64()))],
                    names=["id", "n", "sums"],
                )

    return run


def _pack_block(capacity: Capacity) -> Callable[[pa.Table], pa.Table]:
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        block = table.column("block")[0].as_py()
        sizes = table.column("n").to_numpy()
        pieces = [np.array(piece_lengths(int(n), capacity.tokens), np.int64) for n in sizes]
        counts = np.array([len(p) for p in pieces], np.int64)
        lengths = np.concatenate(pieces)
        number = np.concatenate([np.arange(c) for c in counts])
        starts = np.concatenate([np.concatenate([[0], np.cumsum(p)[:-1]]) for p in pieces])
        whole = lengths == capacity.tokens
        bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        bins[~whole], offsets[~whole], n_bins = best_fit(lengths[~whole], capacity)
        bins[whole] = n_bins + np.arange(int(whole.sum()))
        ids = table.column("id").combine_chunks().take(pa.array(np.repeat(np.arange(len(counts)), counts)))
        columns = {
            "id": ids,
            "piece": pa.array(number.astype(np.int32)),
            "start": pa.array(starts),
            "length": pa.array(lengths),
            "ids_crc32": pa.array(np.concatenate([np.asarray(s, np.int64) for s in table.column("sums").to_pylist()])),
            "sequence_id": pa.array(bins + (block << 32)),
            "offset": pa.array(offsets),
        }
        return pa.table(columns)

    return pack


def pack_documents(
    docs: DataFrame,
    capacity: Capacity = Capacity(),
    tokenizer: str | None = None,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_documents: int = BLOCK_DOCUMENTS,
) -> DataFrame:
    """Sequences of whole documents: (id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    Every text becomes ids and ``end_id``; a document longer than a sequence is
    cut into full pieces, the first being what is left over. Full pieces are
    sequences of their own; the others are packed by :func:`best_fit` in
    blocks of about ``block_documents`` documents, dealt by a hash of the row,
    so each task has a bounded share and no key decides where a row goes. Only
    lengths and checksums are shuffled. ``tokenizer`` is the path of the
    vocabulary on every machine; the installed public one by default.

    Null text is empty and packs as its end id. Rows with the same or a null id
    are packed each for itself. An empty table gives an empty result.
    """
    if min(capacity.documents, capacity.attention // max(capacity.tokens**2, 1)) < 1:
        raise ValueError("a full piece must fit a sequence")
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    tokenise = _tokenise(tokenizer or tokenizer_path(), end_id, capacity.tokens)
    encoded = in_small_batches(rows).mapInArrow(tokenise, "id bigint, n bigint, sums array<bigint>")
    # The row number is written down here, so it stays the same whoever reads it again.
    stored = store(encoded.withColumn("row", F.monotonically_increasing_id()), "token-counts")
    blocks = max(1, round(stored.count() / block_documents))
    dealt = stored.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    packed = dealt.groupBy("block").applyInArrow(
        _pack_block(capacity),
        "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
    return packed.withColumnRenamed("id", id_column)
