"""Token ids, token files and packing: the same ids as the library's, exact round trips, valid packings."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from patchloom.llm import tokens
from patchloom.llm.packing import Capacity, best_fit, pack_documents, piece_lengths
from patchloom.llm.token_files import read_format, read_tokens, write_tokens
from patchloom.session import scratch_path
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(tokens.tokenizer_path())


def library_ids(whole, text):
    return [*whole.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("cache", [1_000_000, 200])
def test_ids_are_those_of_the_whole_library(whole, monkeypatch, cache):
    monkeypatch.setattr(tokens, "CACHE_WORDS", cache)
    rng = random.Random(2)
    parts = ["a", "the", "é", "ß", " ", "  ", "\n", "\t", "\xa0", ".", "'s", "'", "!!", "1", "　", "😀", "́", "A", "***", "ª", "\x1c", "\x00",
             " of", "...", "<|endoftext|>", "中文", " ", "²", "“", "\x85", "ing"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)] + [None, "", prose(1, 5000)]
    encoder = tokens.Encoder(tokens.tokenizer_path())
    for at in range(0, len(texts), 500):
        own = texts[at : at + 500]
        for a, b, ids, bounds in encoder.encode(pa.array(own, pa.string())):
            for i in range(a, b):
                assert ids[bounds[i - a] : bounds[i - a + 1]].tolist() == library_ids(whole, own[i])[:-1], own[i]


def test_token_files_round_trip(spark, documents, hard_rows, whole):
    rows = hard_rows + [(100 + i, prose(i, 20 + i % 50)) for i in range(300)]
    path = scratch_path(spark, "store")
    write_tokens(documents(rows).repartition(5), path, segment_bytes=20_000)
    assert spark.read.parquet(f"{path}/segments").count() > 3
    found = read_tokens(spark, path).collect()
    assert sorted(((r["id"], r["ids"]) for r in found), key=repr) == sorted(((r[0], library_ids(whole, r[1])) for r in rows), key=repr)
    start = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == start and r["n_tokens"] == len(r["ids"])
        start += r["n_tokens"]
    order = [r["id"] for r in sorted(found, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    short = read_tokens(spark, path, ids=[150, 8]).collect()
    assert sorted(r["id"] for r in short) == [8, 8, 150]
    sums = {r["id"]: r["ids_crc32"] for r in read_tokens(spark, path, ids=[150], summary=True).collect()}
    assert sums == {150: zlib.crc32(np.array(library_ids(whole, prose(50, 20)), "<u4").tobytes())}
    form = read_format(spark, path)
    assert form.dictionary and form.width == 2


def test_token_files_without_rows_or_samples(spark, documents, whole):
    for rows in ([], [(1, "a")], [(None, None)]):
        path = scratch_path(spark, "store")
        write_tokens(documents(rows), path)
        assert [(r["id"], r["ids"]) for r in read_tokens(spark, path).collect()] == [(i, library_ids(whole, t)) for i, t in rows]


def test_best_fit_keeps_every_capacity():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 1024, 3000)
    for capacity in (Capacity(), Capacity(1024, 3, 1024 * 1024), Capacity(1024, 64, 1024 * 1024)):
        bins, offsets, n = best_fit(lengths, capacity)
        held = defaultdict(list)
        for length, b, offset in zip(lengths.tolist(), bins.tolist(), offsets.tolist(), strict=True):
            held[b].append((offset, length))
        assert len(held) == n
        for own in held.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= capacity.tokens and len(own) <= capacity.documents and sum(x * x for _, x in own) <= capacity.attention
        if capacity.documents > 3:
            assert n <= 1.02 * -(-int(lengths.sum()) // 1024)
    with pytest.raises(ValueError):
        best_fit(np.array([5]), Capacity(4, 1, 100))
    assert best_fit(np.zeros(0, np.int64), Capacity())[2] == 0


def test_attention_cost_opens_bins():
    bins, _, n = best_fit(np.array([6, 6, 2, 2]), Capacity(16, 16, 44))
    assert n == 2 and bins[0] != bins[1]


def test_piece_lengths():
    assert piece_lengths(1, 4) == [1] and piece_lengths(4, 4) == [4] and piece_lengths(9, 4) == [1, 4, 4] and piece_lengths(0, 4) == []


@pytest.mark.parametrize("block", [8192, 20])
def test_packing_of_hard_rows(documents, hard_rows, whole, block):
    rows = hard_rows + [(100 + i, prose(i, 5 + i * 7 % 300)) for i in range(120)]
    found = pack_documents(documents(rows), block_documents=block).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append(r)
        pieces[r["doc_id"]].append(r)
    total = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
        total += at
    want = defaultdict(list)
    for r in rows:
        ids = library_ids(whole, r[1])
        cuts = np.concatenate([[0], np.cumsum(piece_lengths(len(ids), 1024))])
        for p, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            want[r[0]].append((p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert {i: sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in own) for i, own in pieces.items()} == {i: sorted(w) for i, w in want.items()}
    assert len(sequences) <= -(-total // 1024) + 1 + (0 if block > 20 else 12)
    assert pack_documents(documents([])).collect() == []
