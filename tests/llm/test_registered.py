"""Registered queries of the subpackage: their SQL, and the pipeline against a brute-force version."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from patchloom.llm import language, registered
from patchloom.llm.packing import piece_lengths
from tests.llm.test_near_copies import components_of, shingle_set

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registered.ORACLES))
@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_sql(spark, name, folder):
    duck = duckdb.connect()
    for table in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = duck.execute(registered.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    found = registered.QUERIES[name](spark, folder)
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_every_operator_has_a_query():
    numbers = {int(re.match(r"op(\d+)_", n)[1]) for n in registered.QUERIES if n != "pipeline"}
    assert numbers == set(range(1, 14)) and "pipeline" in registered.QUERIES


@pytest.mark.parametrize("name, columns", [
    ("op1_substring_dedup", {"doc_id", "partner_id", "start_word", "end_word"}),
    ("op2_secrets", {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"}),
    ("op5_neighbours", {"query_id", "rank", "vec_id", "score"}),
    ("op6_token_files", {"doc_id", "start", "n_tokens", "ids_crc32"}),
    ("op7_quality", {"doc_id", "held_out", "score", "predicted"}),
    ("op8_minhash", {"doc_id", "n_shingles", "component_id", "kept"}),
    ("op9_language", {"doc_id", "held_out", "lang_pred", "score"}),
    ("op11_sharding", {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}),
    ("op12_whitening", {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}),
    ("op10_packing", {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}),
])
def test_contract_columns(spark, name, columns):
    found = registered.QUERIES[name](spark, FOLDER)
    assert columns <= set(found.columns)
    rows = found.collect()
    assert rows
    if "doc_id" in columns and name not in ("op1_substring_dedup", "op10_packing"):
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())


def test_pipeline_against_brute_force(spark):
    """Stage by stage on the documents that the stage before really kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        given = [r.asDict() for r in docs.collect()]
        out = stage(spark, docs, FOLDER)
        rows = [r.asDict() for r in out.collect()]
        kept[name] = rows
        if name != "packing":
            assert out.columns == docs.columns
        if name == "language":
            model = language.train(language.learnable(docs))
            und = {r["doc_id"] for r in language.identify(docs, model).filter(F.col("lang_pred") == "und").collect()}
            gone = {r["doc_id"] for r in given} - {r["doc_id"] for r in rows}
            assert und <= gone and len(gone - und) <= 0.01 * len(given)
        elif name == "exact_dedup":
            last = {r["text"]: r["doc_id"] for r in sorted(given, key=lambda r: r["doc_id"])}
            assert sorted(r["doc_id"] for r in rows) == sorted(last.values())
        elif name == "near_dedup":
            sets = {r["doc_id"]: shingle_set(r["text"], 5) for r in given}
            ids = sorted(sets)
            links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
            assert sorted(r["doc_id"] for r in rows) == sorted(set(components_of(ids, links).values()))
        elif name == "mixing":
            assert max(Counter(r["doc_id"] for r in rows).values()) <= 3
            total = sum(len((r["text"] or "").split()) for r in given)
            mixed = sum(len((r["text"] or "").split()) for r in rows)
            assert abs(total - mixed) <= 0.25 * total
        docs = spark.createDataFrame(out.collect(), out.schema)
    by_document = Counter((r["doc_id"], r["piece"]) for r in kept["packing"])
    copies = Counter(r["doc_id"] for r in kept["mixing"])
    assert {d for d, _ in by_document} == set(copies)
    assert all(n == copies[d] for (d, _), n in by_document.items())
    assert piece_lengths(1024, 1024) == [1024]


def test_pipeline_runs(spark):
    found = registered.QUERIES["pipeline"](spark, FOLDER)
    assert found.count() > 100 and found.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 1024
