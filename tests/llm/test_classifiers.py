"""Language and quality classifiers: held-out accuracy, and defined results for hard rows."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from patchloom.llm import language, quality
from patchloom.llm.shingles import grouped_bytes
from tests.llm.conftest import prose

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_counts_against_brute_force():
    texts = ["abC", "", "é!", None, "a", "xyzxyz"]
    for at, _, data, bounds in grouped_bytes(pa.array(texts, pa.string())):
        found = language.counts_of(data, bounds)
        for i, text in enumerate(texts[at:]):
            raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
            want = np.zeros(language.BUCKETS, int)
            for k in (1, 2, 3):
                for x in range(len(raw) - k + 1):
                    gram = 0
                    for b in raw[x : x + k]:
                        gram = (gram * 257 + b + 1) % 2**32
                    want[(gram * 2654435761 % 2**32) >> 19] += 1
            assert (found[i] == want).all()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 70])
def test_codewords_differ(n):
    book = language.codewords(n)
    assert len({tuple(w) for w in book.tolist()}) == n
    if n > 1:
        assert not (abs(book.astype(int).sum(axis=0)) == n).any()


def test_held_out_languages(docs):
    found = language.identify(docs, language.train(language.learnable(docs)), carry=("doc_id", "lang"))
    held = found.filter(language.fold_of("doc_id", 3) == 1).collect()
    assert len(held) > 250 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in held)


def test_identify_hard_rows(documents, hard_rows):
    frame = documents(hard_rows + [(50 + i, prose(i, 30), "en") for i in range(9)] + [(70 + i, "der die und ß " * 9, "de") for i in range(9)])
    model = language.train(frame)
    found = {
        (r["doc_id"], r["text"]): r for r in language.identify(frame, model, carry=("doc_id", "text")).collect()
    }
    for doc_id, text, *_ in hard_rows:
        row = found[doc_id, text]
        lettered = text is not None and any(c.isalpha() for c in text)
        assert (row["lang_pred"] in model.languages) == lettered
        assert lettered or (row["lang_pred"], row["score"], row["ambiguous"]) == ("und", 0.0, True)
    kept = language.keep_identified(frame, model)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} >= set(range(50, 59)) | set(range(70, 79))
    assert not {1, 2, 3} & {r["doc_id"] for r in kept.collect()}


def test_languages_without_rows(documents):
    model = language.train(documents([]))
    assert model.languages == ()
    assert [(r["lang_pred"], r["score"]) for r in language.identify(documents([(1, "abc")]), model).collect()] == [("und", 0.0)]
    one = language.train(documents([(1, "abc", "xx"), (2, None, "yy"), (3, "abc", None)]))
    assert [(r["lang_pred"], r["score"]) for r in language.identify(documents([(1, "abc"), (2, "1")]), one).collect()] == [("xx", 1.0), ("und", 0.0)]
    assert language.identify(documents([]), one).collect() == []


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, language.learnable(labels, folds=5, held=0))
    rows = quality.score(docs, model).join(labels, "doc_id").filter(language.fold_of("doc_id", 5) == 0).select("score", "quality").collect()
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert (good[:, None] > bad[None, :]).mean() + 0.5 * (good[:, None] == bad[None, :]).mean() > 0.95
    assert (good >= 0.3).mean() > 0.97
    # Calibrated: the mean score is near the share of label 1.
    assert abs(np.concatenate([good, bad]).mean() - len(good) / len(rows)) < 0.05


def test_quality_of_hard_rows(spark, documents, hard_rows):
    labels = spark.createDataFrame([(8, 1), (8, 0), (6, 0), (None, 1), (4, None), (999, 1)], "doc_id bigint, quality int")
    frame = documents(hard_rows)
    scores = quality.score(frame, quality.train(frame, labels)).collect()
    assert len(scores) == len(hard_rows) and all(0 <= r["score"] <= 1 for r in scores)
    for same in ((8,), (1, 2, 3)):
        own = [r["score"] for r in scores if r["doc_id"] in same]
        assert own == pytest.approx([own[0]] * len(own))
    for few, share in (([], 0.5), ([(8, 1)], 1.0), ([(8, 0)], 0.0)):
        model = quality.train(frame, spark.createDataFrame(few, "doc_id bigint, quality int"))
        assert quality.score(frame, model).select(F.max(F.abs(F.col("score") - share))).first()[0] < 1e-3
    assert quality.score(documents([]), model).collect() == []


def test_word_vectors_are_sums_of_neighbours():
    index = quality.index_vectors()
    assert (np.count_nonzero(index, axis=1) == quality.NONZERO).all()
    batch = pa.RecordBatch.from_arrays([pa.array(["one two three", "two", None])], names=["text"])
    found = {s: np.array(v) for b in quality._contexts(iter([batch])) for s, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
    hasher = quality.WordHasher()
    one, two, three = (quality.word_slots(w)[0] for w in (next(hasher.texts(pa.array([x])))[2] for x in ("one", "two", "three")))
    assert (found[one] == index[two].astype(int) + index[three]).all()
    assert (found[two] == index[one].astype(int) + index[three]).all()


def test_word_vectors_of_long_texts_against_a_plain_count(monkeypatch):
    monkeypatch.setattr(quality, "CHUNK_WORDS", 7)
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 9, n)) for n in (200, 1, 0, 2, 3, 50)]
    index, hasher = quality.index_vectors().astype(int), quality.WordHasher()
    want = {}
    for text in texts:
        slots = quality.word_slots(next(hasher.texts(pa.array([text])))[2]) if text else []
        for i, own in enumerate(slots):
            near = [j for j in range(max(0, i - quality.WINDOW), min(len(slots), i + quality.WINDOW + 1)) if j != i]
            want[own] = want.get(own, 0) + sum((index[slots[j]] for j in near), np.zeros(quality.WIDTH, int))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    found = {s: np.array(v) for b in quality._contexts(iter([batch])) for s, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
    assert found.keys() == {s for s, v in want.items() if v.any()}
    assert all((found[s] == want[s]).all() for s in found)


def test_network_and_score_against_a_plain_version():
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(quality.SLOTS, quality.WIDTH)).astype(np.float32)
    layers = (rng.normal(size=(2 * quality.WIDTH + 4, 3)), rng.normal(size=3), rng.normal(size=(3, 1)), rng.normal(size=1))
    model = quality.QualityModel(vectors, rng.normal(size=2 * quality.WIDTH + 4), np.full(2 * quality.WIDTH + 4, 1.5), layers, 2.0)
    words, hasher = "one two two three".split(), quality.WordHasher()
    _, _, hashes, offsets, _ = next(hasher.texts(pa.array([" ".join(words)])))
    own = [vectors[s].astype(float) for s in quality.word_slots(hashes)]
    mean = sum(own) / 4
    deviation = np.sqrt(sum((v - mean) ** 2 for v in own) / 4)
    features = [*mean, *deviation, 1 / 4, math.sqrt(sum(mean**2)), sum(float(v @ v) for v in own) / 4, math.log(5)]
    scaled = [(x - c) / 1.5 for x, c in zip(features, model.centre, strict=True)]
    hidden = [max(0.0, sum(x * w for x, w in zip(scaled, layers[0][:, h], strict=True)) + layers[1][h]) for h in range(3)]
    logit = sum(h * w for h, w in zip(hidden, layers[2][:, 0], strict=True)) + layers[3][0]
    assert model.score(quality.pooled(hashes, offsets, vectors))[0] == pytest.approx(1 / (1 + math.exp(-logit / 2)), rel=1e-4)


def test_long_labelled_texts_are_learnt_from(spark, documents):
    rows = [(i, ("good fine " if i % 2 else "bad poor ") * 10_000) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id bigint, quality int")
    frame = documents(rows)
    scores = {r["doc_id"]: r["score"] for r in quality.score(frame, quality.train(frame, labels)).collect()}
    assert all((scores[i] > 0.5) == (i % 2 == 1) for i in range(40))


@pytest.mark.parametrize("text", [None, "a", "ab cd"])
def test_memory_of_many_short_texts(text):
    """10,000 texts of one batch stay below 200 MB, and no group is left out."""
    import tracemalloc

    rng = np.random.default_rng(1)
    book = language.codewords(4)
    model = language.LanguageModel(("de", "en", "es", "fr"), book, rng.normal(size=(language.BUCKETS, book.shape[1])).astype(np.float32), 1.0, np.full(book.shape[1], 1 / book.shape[1]), 1.0)
    texts = pa.array([text] * 9_999 + ["the last one"], pa.string())
    batch = pa.RecordBatch.from_arrays([pa.array(range(10_000)), texts, pa.array([True] * 10_000)], names=["doc_id", "__text", "__letter"])
    tracemalloc.start()
    (found,) = language._predictor(model, 0.05)(iter([batch]))
    counted = list(language._count_by_language(iter([pa.RecordBatch.from_arrays([pa.array(["en"] * 10_000), texts], names=["lang", "text"])])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6
    (alone,) = language._predictor(model, 0.05)(iter([batch.slice(9_999)]))
    (last,), (same,) = found.slice(9_999).to_pylist(), alone.to_pylist()
    assert last.pop("score") == pytest.approx(same.pop("score"), abs=1e-6) and last == same
    each = len(set(found.column("lang_pred").to_pylist()[:9_999]))
    assert each == 1 and sum(counted[0].column("n").to_pylist()) == 9_999 * sum(max(0, len(text or "") - k) for k in range(3)) + 12 + 11 + 10
