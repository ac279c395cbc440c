"""The registered queries: counterparts in DuckDB, contract columns, one row for each row."""

import pytest

import __spark_entry__ as registry
from checks.compare import difference
from shopperflow.llm import duckdb_sql, queries

COLUMNS = {
    "op1_ngram_join": ["doc_id", "n_shingles", "component_id"],
    "op2_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"],
    "op3_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op5_order_minhash": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op6_line_quality": ["doc_id", "held_out", "score", "predicted"],
    "op7_html_blocks": ["page_id", "url", "text", "n_chars"],
    "op11_backoff_automaton": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
}


@pytest.mark.parametrize("name", sorted(duckdb_sql.QUERIES))
def test_equals_duckdb(spark, sf_dir, name):
    assert difference(spark, sf_dir, name) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(duckdb_sql.QUERIES)))
def test_one_row_each(spark, sf_dir, name):
    table = "pages" if name.startswith("op7") else "documents"
    found = registry.queries()[name](spark, sf_dir)
    assert found.count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    assert found.columns == COLUMNS.get(name, found.columns)


def test_there_is_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
