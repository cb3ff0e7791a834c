"""Quality classifier: random-indexing word vectors, pooled per document, and a small calibrated network."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import in_small_batches
from patchloom.llm.shingles import WordHasher

_SEED = 99991
# Words share so many vectors of so many dimensions; an index vector has NONZERO entries of +1 or -1.
SLOTS, WIDTH, NONZERO, WINDOW = 16384, 48, 6, 2
# Labelled documents the network is fitted on, chosen by hash.
TRAINING_ROWS = 12_000
# Words that are looked at together.
CHUNK_WORDS = 1 << 15
HIDDEN, EPOCHS, BATCH, RATE = 32, 40, 256, 0.003


@dataclass(frozen=True)
class QualityModel:
    vectors: np.ndarray  # SLOTS x WIDTH, of unit length
    centre: np.ndarray
    spread: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float

    def score(self, features: np.ndarray) -> np.ndarray:
        logits = _forward(self.layers, (features - self.centre) / self.spread)[1] / self.temperature
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))


def index_vectors() -> np.ndarray:
    random = np.random.default_rng(_SEED)
    vectors = np.zeros((SLOTS, WIDTH), np.int8)
    for row in vectors:
        row[random.choice(WIDTH, NONZERO, replace=False)] = random.choice(np.array([-1, 1], np.int8), NONZERO)
    return vectors


def word_slots(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(50)).astype(np.int64)


def _contexts(batches: Iterator[pa.RecordBatch], index: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Sums of the index vectors around every word, one row per slot that has any."""
    hasher = WordHasher()
    index = index_vectors() if index is None else index
    total = np.zeros((SLOTS, WIDTH), np.int64)
    for batch in batches:
        for _, _, words, offsets, _ in hasher.texts(batch.column(0)):
            slots = word_slots(words)
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            for at in range(0, len(slots), CHUNK_WORDS):
                # With the neighbours before and after the chunk, whose own sums belong to other chunks.
                first, to = max(0, at - WINDOW), min(len(slots), at + CHUNK_WORDS)
                near, text = slots[first : to + WINDOW], owner[first : to + WINDOW]
                around = np.zeros((len(near), WIDTH), np.int8)
                for step in range(1, WINDOW + 1):
                    same = (text[step:] == text[:-step])[:, None]
                    around[step:] += index[near[:-step]] * same
                    around[:-step] += index[near[step:]] * same
                own, around = near[at - first : to - first], around[at - first : to - first]
                order = np.argsort(own, kind="stable")
                begins = np.flatnonzero(np.diff(own[order], prepend=-1))
                total[own[order][begins]] += np.add.reduceat(around[order], begins, axis=0, dtype=np.int64)
    used = np.flatnonzero(total.any(axis=1))
    own = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * WIDTH), pa.array(total[used].reshape(-1)))
    yield pa.RecordBatch.from_arrays([pa.array(used), own], names=["slot", "v"])


def pooled(words: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Per text: mean word vector, its mean agreement with the word before, the mean's length, share of known words, and log length."""
    slots = word_slots(words)
    n, counts = len(offsets) - 1, np.diff(offsets)
    full = np.flatnonzero(counts)
    out = np.zeros((n, 2 * WIDTH + 4), np.float32)
    out[:, -1] = np.log1p(counts)
    if len(full):
        begin = offsets[:-1][full]
        own = vectors[slots]
        some = counts[full, None].astype(np.float32)
        mean = np.add.reduceat(own, begin, axis=0) / some
        out[full, :WIDTH] = mean
        out[full, WIDTH : 2 * WIDTH] = np.sqrt(np.maximum(np.add.reduceat(own * own, begin, axis=0) / some - mean * mean, 0))
        near = np.zeros(len(slots), np.float32)
        near[1:] = (slots[1:] == slots[:-1]).astype(np.float32)
        near[begin] = 0
        out[full, -4] = np.add.reduceat(near, begin) / some[:, 0]
        out[full, -3] = np.sqrt((mean * mean).sum(axis=1))
        out[full, -2] = np.add.reduceat((own * own).sum(axis=1), begin) / some[:, 0]
    return out


def _features(vectors: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for at, to, words, offsets, _ in hasher.texts(batch.column(0)):
                own = pooled(words, offsets, vectors)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(to - at + 1, dtype=np.int32) * own.shape[1]), pa.array(own.reshape(-1)))
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([lists, part.column(1), part.column(2)], names=["features", "label", "place"])

    return run


def _forward(layers: tuple[np.ndarray, ...], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.maximum(x @ w1 + b1, 0)
    return hidden, (hidden @ w2 + b2)[:, 0]


def _fit_network(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """Two layers, cross-entropy, Adam with a little weight decay; a fixed seed."""
    random = np.random.default_rng(_SEED)
    layers = [
        random.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
        random.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, 1)), np.zeros(1),
    ]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(x))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            hidden, logits = _forward(tuple(layers), x[rows])
            error = ((1 / (1 + np.exp(-np.clip(logits, -60, 60))) - y[rows]) / len(rows))[:, None]
            back = (error @ layers[2].T) * (hidden > 0)
            slopes = [x[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for i, slope in enumerate(slopes):
                slope = slope + 1e-4 * layers[i]
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope * slope
                layers[i] -= RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> QualityModel:
    """Fit on all texts, and of the labels on at most TRAINING_ROWS, those whose ids have the smallest hashes.

    Word vectors need no label: they are learnt from the words around each word of all whole
    texts, in one row per word slot and task. A fifth of the labelled documents is kept from
    the network and sets the temperature. Texts stay where they are; of a labelled one its
    features go on, however long it is. Null ids, labels and texts are not learnt from. With one label only, or none, every score is
    that label's share (one half without labels).
    """
    known = labels.filter(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
    chosen = (
        known.select(F.col(id_column).alias("__id"), F.col(label_column).cast("double").alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id", "__label")
        .limit(TRAINING_ROWS)
    )
    text = F.col(text_column).cast("string")
    texts = in_small_batches(docs.filter(text.isNotNull()).select(F.col(id_column).alias("__id"), text.alias("text")))
    parts = texts.select("text").mapInArrow(partial(_contexts, index=index_vectors()), "slot bigint, v array<bigint>")
    sums = parts.groupBy("slot").agg(F.array(*[F.sum(F.col("v")[i]) for i in range(WIDTH)]).alias("v"))
    rows = sums.toArrow()
    vectors = np.zeros((SLOTS, WIDTH), np.float32)
    if rows.num_rows:
        vectors[rows.column("slot").to_numpy()] = rows.column("v").combine_chunks().flatten().to_numpy().reshape(-1, WIDTH)
    vectors /= np.maximum(np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)), 1e-9)

    sample = texts.join(F.broadcast(chosen), "__id").select("text", F.col("__label").alias("label"), F.xxhash64("__id", "__label").alias("place"))
    fitted = sample.mapInArrow(_features(vectors), "features array<float>, label double, place bigint").toArrow().sort_by("place")
    width = 2 * WIDTH + 4
    if not fitted.num_rows:
        return QualityModel(vectors, np.zeros(width), np.ones(width), _constant(width, 0.5), 1.0)
    x = fitted.column("features").combine_chunks().flatten().to_numpy().reshape(-1, width).astype(float)
    y = (fitted.column("label").to_numpy() >= 0.5).astype(float)
    if len(set(y)) == 1:
        return QualityModel(vectors, np.zeros(width), np.ones(width), _constant(width, float(y[0])), 1.0)
    centre, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    x = (x - centre) / spread
    aside = np.arange(len(x)) % 5 == 0 if len(x) >= 50 else np.zeros(len(x), bool)
    layers = _fit_network(x[~aside], y[~aside])
    temperature = 1.0
    if aside.any():
        logits = _forward(layers, x[aside])[1]
        temperature = min(np.geomspace(0.25, 8, 61), key=lambda t: np.logaddexp(0, np.where(y[aside] > 0, -1, 1) * logits / t).mean())
    return QualityModel(vectors, centre, spread, layers, float(temperature))


def _constant(width: int, share: float) -> tuple[np.ndarray, ...]:
    level = np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1 - 1e-6))
    return np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros((HIDDEN, 1)), np.array([level])


def _scorer(model: QualityModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for at, to, words, offsets, _ in hasher.texts(batch.column(1)):
                scores[at:to] = model.score(pooled(words, offsets, model.vectors))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["id", "score"])

    return run


def score(docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score) of every whole text: the calibrated probability of label 1.

    Null and empty texts have no words and get the score of that. Rows are
    independent, so repeated rows agree but for rounding, and null ids stay null.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    return in_small_batches(rows).mapInArrow(_scorer(model), "id bigint, score double").withColumnRenamed("id", id_column)
