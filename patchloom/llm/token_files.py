"""Token-id files: documents compressed one by one with a shared, trained zstandard dictionary.

A store is a folder with two Parquet tables. ``dictionary`` has one row: the
dictionary's SHA-256, its bytes and the width of an id. ``segments`` has one
row per run of documents in id order:

    segment, first_id, last_id, n_nulls, n_docs, n_tokens, dictionary_hash,
    index   int64 little-endian: n_docs ids, n_docs + 1 byte offsets, n_docs id counts,
    data    the documents' zstandard frames, one after the other

Each frame holds one document's ids as little-endian numbers of the given
width. A reader of one document opens the segment whose id range holds it, finds
the frame in the index, and decompresses nothing else. Ids that are null come
first in the first segment; ``n_nulls`` counts them and their index entry is 0.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patchloom.llm.common import in_small_batches
from patchloom.llm.tokens import Encoder, tokenizer_path

# The dictionary is trained on at most so many documents, chosen by hash among those of at most so many bytes.
SAMPLE_DOCUMENTS, SAMPLE_BYTES = 1024, 16384
DICTIONARY_BYTES = 65536
# Text bytes of a segment, about; the segments' first ids are the only thing that the driver holds of them.
SEGMENT_BYTES = 16 << 20
END_ID = 2
_LEVEL = 3
_TEXTS = 256


@dataclass(frozen=True)
class Format:
    dictionary: bytes
    width: int  # bytes of an id

    @property
    def hash(self) -> str:
        return hashlib.sha256(self.dictionary).hexdigest()

    def _trained(self) -> zstandard.ZstdCompressionDict | None:
        return zstandard.ZstdCompressionDict(self.dictionary) if self.dictionary else None

    def compressor(self) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=_LEVEL, dict_data=self._trained(), write_content_size=True)

    def decompressor(self) -> zstandard.ZstdDecompressor:
        return zstandard.ZstdDecompressor(dict_data=self._trained())

    def pack(self, ids: bytes) -> bytes:
        return ids if self.width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()

    def unpack(self, body: bytes) -> bytes:
        return body if self.width == 4 else np.frombuffer(body, "<u2").astype("<u4").tobytes()


def encoded(encoder: Encoder, texts: pa.Array) -> Iterator[bytes]:
    """Ids of each text as little-endian unsigned 32-bit bytes."""
    for _, _, ids, bounds in encoder.encode(texts):
        body = memoryview(ids.astype("<u4", copy=False)).cast("B")
        for a, b in zip((4 * bounds[:-1]).tolist(), (4 * bounds[1:]).tolist(), strict=True):
            yield bytes(body[a:b])


def train_format(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> Format:
    """The dictionary, trained on the id arrays of a bounded sample of (id, text); none where zstandard can't train one."""
    encoder = Encoder(tokenizer)
    width = 2 if max(encoder.whole.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    fitting = docs.filter(F.octet_length("text").between(1, SAMPLE_BYTES) & F.col("id").isNotNull())
    chosen = fitting.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCUMENTS)
    sample = fitting.join(F.broadcast(chosen), "id", "left_semi").orderBy(F.xxhash64("id"), "id", "text").limit(SAMPLE_DOCUMENTS)
    texts = [row["text"] for row in sample.select("text").collect()]
    plain = Format(b"", width)
    arrays = [plain.pack(ids) for ids in encoded(encoder, pa.array(texts, pa.string()))]
    try:
        trained = zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, arrays)) // 8)), arrays)
    except (zstandard.ZstdError, ValueError, MemoryError):  # too few or too uniform samples
        return plain
    return Format(trained.as_bytes(), width)


def _compress(tokenizer: str, end_id: int, form: Format, bounds: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(tokenizer), form.compressor()
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids = batch.column(0)
            segment = np.searchsorted(bounds, ids.fill_null(np.iinfo(np.int64).min).to_numpy(), "right").astype(np.int64)
            at, sizes, frames = 0, [], []
            for own in encoded(encoder, batch.column(1)):
                own += end
                sizes.append(len(own) // 4)
                frames.append(packer.compress(form.pack(own)))
                if len(frames) == _TEXTS or at + len(frames) == batch.num_rows:
                    part = slice(at, at + len(frames))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(segment[part]), ids.slice(at, len(frames)), pa.array(sizes, pa.int64()), pa.array(frames, pa.binary())],
                        names=["segment", "id", "n", "frame"],
                    )
                    at, sizes, frames = at + len(frames), [], []

    return run


def _segment(form_hash: str) -> Callable[[pa.Table], pa.Table]:
    def build(table: pa.Table) -> pa.Table:
        # Equal ids are told apart by what they hold, so a rerun writes the same file.
        order = sorted(
            range(table.num_rows),
            key=lambda i, ids=table.column("id").to_pylist(), frames=table.column("frame").to_pylist(): (ids[i] is not None, ids[i] or 0, frames[i]),
        )
        table = table.take(pa.array(order, pa.int64()))
        ids, counts = table.column("id"), table.column("n").to_numpy()
        frames = table.column("frame").to_pylist()
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])])
        index = np.concatenate([ids.combine_chunks().fill_null(0).to_numpy(), offsets, counts]).astype("<i8")
        known = [i for i in (ids[ids.null_count] if ids.null_count < len(ids) else None, ids[-1]) if i is not None and i.is_valid]
        return pa.table(
            {
                "segment": table.column("segment").slice(0, 1),
                "first_id": pa.array([known[0].as_py() if known else None], pa.int64()),
                "last_id": pa.array([known[-1].as_py() if known else None], pa.int64()),
                "n_nulls": pa.array([ids.null_count], pa.int64()),
                "n_docs": pa.array([len(ids)], pa.int64()),
                "n_tokens": pa.array([int(counts.sum())], pa.int64()),
                "dictionary_hash": pa.array([form_hash]),
                "index": pa.array([index.tobytes()], pa.binary()),
                "data": pa.array([b"".join(frames)], pa.binary()),
            }
        )

    return build


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    segment_bytes: int = SEGMENT_BYTES,
) -> None:
    """Encode every whole text and write the store described above, in ascending id order.

    Segment bounds are quantiles of the ids, so texts stay where they are read
    and only compressed ids are shuffled, once. Null text is empty and has just its end
    id. Rows with the same id all stay, side by side in one segment. An empty table gives a
    store without segments.
    """
    tokenizer = tokenizer or tokenizer_path()
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    form = train_format(rows, tokenizer, end_id)
    spark = docs.sparkSession
    dictionary = [(form.hash, bytearray(form.dictionary), form.width)]
    spark.createDataFrame(dictionary, "dictionary_hash string, dictionary binary, width int").coalesce(1).write.parquet(f"{path}/dictionary")

    volume = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    parts = max(1, -(-volume // segment_bytes))
    bounds = np.zeros(0, np.int64)
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        found = rows.agg(F.percentile_approx("id", shares, max(10_000, 20 * parts))).first()[0]
        bounds = np.unique(np.array(found or [], np.int64))
    framed = in_small_batches(rows).mapInArrow(_compress(tokenizer, end_id, form, bounds), "segment bigint, id bigint, n bigint, frame binary")
    segments = framed.groupBy("segment").applyInArrow(
        _segment(form.hash),
        "segment bigint, first_id bigint, last_id bigint, n_nulls bigint, n_docs bigint, n_tokens bigint, "
        "dictionary_hash string, index binary, data binary",
    )
    segments.write.parquet(f"{path}/segments")


def read_format(spark: SparkSession, path: str) -> Format:
    row = spark.read.parquet(f"{path}/dictionary").first()
    form = Format(bytes(row["dictionary"]), row["width"])
    if form.hash != row["dictionary_hash"]:
        raise ValueError(f"the dictionary of {path} is damaged")
    return form


def _documents(form: Format, wanted: frozenset[int] | None, summary: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = form.decompressor()
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_hash"] != form.hash:
                    raise ValueError(f"segment {row['segment']} was written with another dictionary")
                n = row["n_docs"]
                index = np.frombuffer(row["index"], "<i8")
                ids, offsets, counts = index[:n], index[n : 2 * n + 1], index[2 * n + 1 :]
                starts = row["start"] + np.concatenate([[0], np.cumsum(counts)])
                null = np.arange(n) < row["n_nulls"]
                picked = range(n) if wanted is None else [i for i in range(n) if not null[i] and int(ids[i]) in wanted]
                for at in range(0, len(picked), _TEXTS):
                    own = list(picked[at : at + _TEXTS])
                    bodies = [form.unpack(reader.decompress(row["data"][offsets[i] : offsets[i + 1]])) for i in own]
                    for i, body in zip(own, bodies, strict=True):
                        if len(body) != 4 * counts[i]:
                            raise ValueError(f"document {ids[i]} of segment {row['segment']} is damaged")
                    last = (
                        pa.array([zlib.crc32(b) for b in bodies], pa.int64())
                        if summary
                        else pa.array([np.frombuffer(b, "<u4").astype(np.int64) for b in bodies], pa.list_(pa.int64()))
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[own], mask=null[own]), pa.array(starts[own]), pa.array(counts[own]), last],
                        names=["id", "start", "n_tokens", "ids_crc32" if summary else "ids"],
                    )

    return run


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None, summary: bool = False) -> DataFrame:
    """Documents of a store: (id, start, n_tokens, ids), or with ``summary`` the CRC-32 of the ids in their place.

    ``start`` counts the ids of all documents before. With ``ids``, only the
    segments whose range holds one of them are read, and only those documents
    are decompressed.
    """
    form = read_format(spark, path)
    segments = spark.read.parquet(f"{path}/segments")
    # One row per segment, with no document data in it.
    before = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = segments.select("segment", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    chosen = segments
    if ids is not None:
        ranges = F.lit(False)
        for one in ids:
            ranges = ranges | ((F.col("first_id") <= one) & (F.col("last_id") >= one))
        chosen = segments.filter(ranges)
    last = "ids_crc32 bigint" if summary else "ids array<bigint>"
    wanted = None if ids is None else frozenset(ids)
    return chosen.join(starts, "segment").mapInArrow(
        _documents(form, wanted, summary), f"id bigint, start bigint, n_tokens bigint, {last}"
    )
