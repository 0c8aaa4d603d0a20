"""The registered queries on the smallest tables."""

from __future__ import annotations

import hashlib
import os
import struct

import duckdb
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

import __spark_entry__ as entry_point
from lavra.llm import bpe
from lavra.llm.queries import ORACLE_SQL, QUERIES

FOLDER = os.environ.get("LAVRA_TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not found")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(os.listdir(FOLDER)):
        name, extension = os.path.splitext(file)
        if extension == ".parquet":
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


def test_all_are_registered():
    registered = entry_point.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(entry_point.oracle_sql()) & set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    found = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    assert found == sorted(cursor.fetchall(), key=str)


@pytest.mark.parametrize("name, table", [(n, "documents") for n in sorted(set(QUERIES) - set(ORACLE_SQL))])
def test_query_has_a_row_per_document(spark, name, table):
    ids = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select("doc_id").collect()}
    found = [r["doc_id"] for r in QUERIES[name](spark, FOLDER).select("doc_id").collect()]
    assert len(found) == len(ids) and set(found) == ids


def _documents(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def test_op5_like_the_library(spark):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = _documents(spark)
    for row in QUERIES["op5_bpe"](spark, FOLDER).collect():
        ids = library.encode_ordinary(texts[row["doc_id"]])
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_op13_like_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    texts = _documents(spark)
    for row in QUERIES["op13_token_counts"](spark, FOLDER).collect():
        n = len(library.encode(texts[row["doc_id"]]))
        size = len(texts[row["doc_id"]].encode())
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (size, n, n > 4096)


def test_pipeline(spark):
    """Every stage against what it says it keeps."""
    import corpus_pipeline
    from lavra.llm import secret_scan, simhash

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, docs, FOLDER).cache()
    assert known.columns == docs.columns
    lettered = {r["doc_id"] for r in docs.where(docs["text"].rlike(r"\p{L}")).collect()}
    assert {r["doc_id"] for r in known.collect()} == lettered
    alone = stages["simhash_near_duplicates"](spark, known, FOLDER).cache()
    groups = {r["component_id"] for r in simhash.near_duplicates(known).collect()}
    assert sorted(r["doc_id"] for r in alone.collect()) == sorted(groups)
    clean = stages["secret_scan"](spark, alone, FOLDER).cache()
    assert clean.columns == docs.columns and clean.count() == alone.count()
    weights = secret_scan.train(secret_scan.labelled_sample(alone))
    left = secret_scan.scan(clean, weights).where("size(secrets) > 0")
    assert left.count() == 0
    mixed = stages["mixing"](spark, clean, FOLDER).cache()
    assert mixed.columns == docs.columns
    assert {r["doc_id"] for r in mixed.collect()} <= groups
    done = stages["byte_level_bpe"](spark, mixed, FOLDER)
    assert done.count() == mixed.count()
