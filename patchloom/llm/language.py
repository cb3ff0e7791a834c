"""Language identification with error-correcting output codes over byte n-grams."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from patchloom.llm.common import in_small_batches
from patchloom.llm.shingles import grouped_bytes

# N-grams of 1 to 3 bytes of lower-cased text share so many counters.
BUCKETS = 8192
LONGEST = 3
# Texts whose counters are held at once: 16 MB of them.
GROUP_TEXTS = 256
_SEED = 424242
# Rows on which scale and bit weights are set, chosen by hash from the rows to learn from.
CALIBRATION_ROWS = 1000
CALIBRATION_BYTES = 65536
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    codes: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # buckets x bits, log-odds of an n-gram
    scale: float  # from mean log-odds to margins
    reliability: np.ndarray  # per bit
    sharpness: float  # from losses to the score


def few_texts(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Groups as of :func:`grouped_bytes`, of GROUP_TEXTS texts at most: a group's counters take as much for short texts as for long ones."""
    for at, to, data, bounds in grouped_bytes(texts):
        for first in range(at, to, GROUP_TEXTS):
            last = min(first + GROUP_TEXTS, to)
            start, end = bounds[first - at], bounds[last - at]
            yield first, last, data[start:end], bounds[first - at : last - at + 1] - start


def counts_of(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """N-gram counts, texts x BUCKETS, of texts that lie one after the other in ``data``."""
    n = len(bounds) - 1
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(bounds)) * BUCKETS
    end = np.repeat(bounds[1:], np.diff(bounds))
    gram = np.zeros(len(low), np.uint32)
    found = np.zeros(n * BUCKETS, np.int64)
    at = np.arange(len(low))
    for k in range(LONGEST):
        if len(low) <= k:
            break
        gram = gram[: len(low) - k] * np.uint32(257) + low[k:] + np.uint32(1)
        inside = at[: len(gram)] + k < end[: len(gram)]
        slot = ((gram * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int64)
        found += np.bincount(owner[: len(gram)][inside] + slot[inside], minlength=len(found))
    return found.reshape(n, BUCKETS)


def codewords(languages: int) -> np.ndarray:
    """One word of +1 and -1 per language; of many drawn books the one whose closest words lie farthest apart."""
    bits = max(15, math.ceil(10 * math.log2(max(2, languages))))
    random = np.random.default_rng(_SEED)
    best, distance = None, -1
    for _ in range(64 if languages <= 64 else 4):
        book = random.choice(np.array([-1, 1], np.int8), (languages, bits))
        for b in range(bits):  # a bit that is the same for all languages tells nothing
            if languages > 1 and abs(int(book[:, b].sum())) == languages:
                book[random.integers(languages), b] *= -1
        apart = (bits - book.astype(int) @ book.T.astype(int)) // 2
        least = apart[~np.eye(languages, dtype=bool)].min() if languages > 1 else bits
        if least > distance:
            best, distance = book, least
    return best


def _count_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        languages = batch.column(0).to_pylist()
        for at, to, data, bounds in few_texts(batch.column(1)):
            found = counts_of(data, bounds)
            for name, row in zip(languages[at:to], found, strict=True):
                totals[name] = totals[name] + row if name in totals else row.copy()
    for name, row in totals.items():
        used = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(row[used], pa.int64())], names=["lang", "bucket", "n"]
        )


def train(rows: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from all rows with a text and a language.

    N-grams are counted per language over every row, added up in the tasks and
    then per (language, bucket): what comes back is one row of BUCKETS counters
    per language. A bit's classifier holds the log-odds of an n-gram between the
    languages on either side of the bit. Scale and bit weights are set on a
    bounded sample. Without rows the model knows no language.
    """
    known = rows.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")
    )
    sums = in_small_batches(known).mapInArrow(_count_by_language, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    frame = sums.toPandas()
    languages = tuple(sorted(frame["lang"].unique()))
    counts = np.zeros((len(languages), BUCKETS))
    counts[frame["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int), frame["bucket"].to_numpy(int)] = frame["n"]
    if not languages:
        return LanguageModel((), np.zeros((0, 1), np.int8), np.zeros((BUCKETS, 1), np.float32), 1.0, np.ones(1), 1.0)
    codes = codewords(len(languages))
    shares = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
    weights = np.zeros((BUCKETS, codes.shape[1]), np.float32)
    for b in range(codes.shape[1]):
        yes, no = shares[codes[:, b] > 0], shares[codes[:, b] < 0]
        if len(yes) and len(no):
            weights[:, b] = np.log(yes.mean(axis=0)) - np.log(no.mean(axis=0))

    # Chosen by hash alone, so that no texts are gathered to be ranked; rows with equal text and language are one.
    fitting = known.filter(F.octet_length("text").between(1, CALIBRATION_BYTES)).withColumn("h", F.xxhash64("text", "lang"))
    chosen = fitting.select("h").distinct().orderBy("h").limit(CALIBRATION_ROWS)
    picked = fitting.join(F.broadcast(chosen), "h", "left_semi").groupBy("h").agg(F.first("lang").alias("lang"), F.first("text").alias("text"))
    sample = picked.toPandas().sort_values("h")
    scale, reliability, sharpness = 1.0, np.ones(codes.shape[1]), 1.0
    if len(sample) and len(languages) > 1:
        raw = np.concatenate([_mean_odds(d, b, weights) for _, _, d, b in few_texts(pa.array(sample["text"], pa.string()))])
        truth = sample["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int)
        signed = raw * codes[truth]
        scale = 4.0 / max(float(np.median(np.abs(raw))), 1e-6)
        wrong = np.clip((signed <= 0).mean(axis=0), 1e-3, 0.5 - 1e-3)
        reliability = np.log((1 - wrong) / wrong)
        reliability = reliability / reliability.sum()
        losses = _losses(raw * scale, codes, reliability)
        sharpness = min(
            np.geomspace(0.25, 64, 25),
            key=lambda s: -np.log(np.maximum(_softmax(-s * losses)[np.arange(len(truth)), truth], 1e-12)).mean(),
        )
    return LanguageModel(languages, codes, weights, scale, reliability, float(sharpness))


def _mean_odds(data: np.ndarray, bounds: np.ndarray, weights: np.ndarray) -> np.ndarray:
    found = counts_of(data, bounds).astype(np.float32)
    return (found @ weights) / np.maximum(found.sum(axis=1, keepdims=True), 1)


def _losses(margins: np.ndarray, codes: np.ndarray, reliability: np.ndarray) -> np.ndarray:
    """Texts x languages: logistic loss of the margins against each codeword, bits weighted by their reliability."""
    agree = margins[:, None, :] * codes[None, :, :]
    return (np.logaddexp(0, -agree) * reliability).sum(axis=2)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _predictor(model: LanguageModel, margin: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            names, scores, unsure = np.full(n, UNKNOWN, object), np.zeros(n), np.ones(n, bool)
            lettered = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            for at, to, data, bounds in few_texts(batch.column(batch.num_columns - 2)):
                if not model.languages:
                    break
                losses = _losses(_mean_odds(data, bounds, model.weights) * model.scale, model.codes, model.reliability)
                order = np.argsort(losses, axis=1, kind="stable")
                best = order[:, 0]
                use = lettered[at:to]
                names[at:to][use] = np.array(model.languages, object)[best][use]
                scores[at:to][use] = _softmax(-model.sharpness * losses)[np.arange(to - at), best][use]
                if len(model.languages) > 1:
                    two = np.take_along_axis(losses, order[:, :2], axis=1)
                    unsure[at:to][use] = (two[:, 1] - two[:, 0] < margin * two[:, 1])[use]
                else:
                    unsure[at:to][use] = False
            kept = [batch.column(i) for i in range(batch.num_columns - 2)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names, pa.string()), pa.array(scores), pa.array(unsure)],
                names=[*batch.schema.names[:-2], "lang_pred", "score", "ambiguous"],
            )

    return predict


# Two best losses closer than this share of the second are called ambiguous.
AMBIGUITY = 0.05


def identify(docs: DataFrame, model: LanguageModel, carry: tuple[str, ...] = ("doc_id",), text: str = "text", margin: float = AMBIGUITY) -> DataFrame:
    """``carry`` plus (lang_pred, score, ambiguous), one row per input row.

    A text that is null or has no letter is ``und`` with score 0, and so is
    everything under a model that knows no language; both count as ambiguous.
    Equal losses go to the language that sorts first. Rows are independent, so
    repeated rows agree; only the text is looked at, whole.
    """
    value = F.col(text).cast("string")
    rows = docs.select(*carry, value.alias("__text"), F.coalesce(value.rlike(r"\p{L}"), F.lit(False)).alias("__letter"))
    fields = [f for f in rows.schema.fields if f.name in carry]
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("ambiguous", BooleanType())]
    return in_small_batches(rows).mapInArrow(_predictor(model, margin), StructType(fields + added))


def learnable(docs: DataFrame, id_column: str = "doc_id", folds: int = 3, held: int = 1) -> DataFrame:
    """Rows to learn from: those whose crc32 of the id as text, mod ``folds``, isn't ``held``. Null ids are left out."""
    return docs.filter(fold_of(id_column, folds) != held)


def fold_of(id_column: str, folds: int):
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a language, with all their columns.

    What goes is ``und`` and what is ambiguous with a score below ``least``. A text
    that mixes languages still has its strongest one, so it stays.
    """
    # Only the text and its answer pass through Python; the other columns stay where they are.
    predict = _predictor(model, AMBIGUITY)

    def keeps(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, letters in columns:
            (found,) = predict(iter([pa.RecordBatch.from_arrays([texts, letters], names=["text", "letter"])]))
            doubt = pc.and_(found.column("ambiguous"), pc.less(found.column("score"), least))
            yield pc.and_not(pc.not_equal(found.column("lang_pred"), UNKNOWN), doubt)

    value = docs[text].cast("string")
    letter = F.coalesce(value.rlike(r"\p{L}"), F.lit(False))
    return in_small_batches(docs).filter(F.arrow_udf(keeps, "boolean")(value, letter))
