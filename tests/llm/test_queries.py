"""The registered queries against their SQL, and their contracts' columns."""

from __future__ import annotations

import duckdb
import pytest

from airscan.llm.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op3_ngram_jaccard": ["doc_id", "n_shingles", "component_id"],
    "op4_stream_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op5_bpe_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op9_compression_quality": ["doc_id", "held_out", "score", "predicted"],
    "op11_midstate_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op12_importance_resampling": ["doc_id", "n_features", "weight", "score", "rank"],
    "op10_hmm_score": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
}


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(COLUMNS))
def test_contract_columns(spark, name):
    rows = QUERIES[name](spark, SF_DIR)
    assert rows.columns[: len(COLUMNS[name])] == COLUMNS[name]
    assert rows.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cursor = db.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    rows = QUERIES[name](spark, SF_DIR)
    assert sorted(rows.columns) == sorted(columns)
    got = sorted(repr([row[c] for c in sorted(columns)]) for row in rows.collect())
    want = sorted(repr([row[columns.index(c)] for c in sorted(columns)]) for row in cursor.fetchall())
    assert got == want
