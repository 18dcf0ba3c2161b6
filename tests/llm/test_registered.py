"""The registered queries over whole tables: their SQL, their columns, one row per document."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, oracle_connection
from conftest import SF
from courierflow.llm import oracles, queries

COLUMNS = {
    "op1_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "has_pii"},
    "op2_suffix": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op4_quality": {"doc_id", "held_out", "score", "predicted"},
    "op6_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op8_wavelet": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op13_class_ngrams": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
}


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries()) and set(oracles.SQL) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", oracles.SQL)
def test_query_matches_sql(spark, name):
    _, rows, ok, why = compare(spark, oracle_connection(SF), name, queries.QUERIES[name], oracles.SQL[name], SF)
    assert ok and (rows == 200 or name == "op12_prefix_trie"), why


@pytest.mark.parametrize("name", COLUMNS)
def test_one_row_per_document(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert set(df.columns) == COLUMNS[name]
    assert sorted(r.doc_id for r in df.collect()) == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
