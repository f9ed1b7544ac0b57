"""The registered queries: contract columns, SQL where there is one, native plans."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from barlake.llm.queries import FURTHER, ORACLE_SQL, QUERIES

SMOKE = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op2_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op3_url_filters": ["page_id", "host", "path", "rule", "verdict"],
    "op4_pii": ["doc_id", "n_entities", "text"],
    "op5_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op6_simhash": ["doc_id", "fingerprint", "component_id"],
    "op7_lm_scores": ["doc_id", "n_words", "n_matched", "n_unigrams", "log_score", "mean_score"],
    "op8_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op9_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op11_centroid_clustering": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
    "op12_hard_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
    "op13_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
}


def test_all_are_registered():
    assert set(COLUMNS) == set(QUERIES) and {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op12_hard_negatives"}))
def test_contract_columns_and_one_row_per_input_row(scratch, name):
    df = QUERIES[name](scratch, SMOKE)
    table = {"op3_url_filters": "pages", "op11_centroid_clustering": "embeddings"}.get(name, "documents")
    assert df.columns[:len(COLUMNS[name])] == COLUMNS[name]
    assert df.count() == scratch.read.parquet(f"{SMOKE}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(scratch, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    df = {**QUERIES, **FURTHER}[name](scratch, SMOKE)
    want = con.execute(ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(d[0] for d in want.description)
    at = {d[0]: i for i, d in enumerate(want.description)}
    assert (sorted(repr([r[c] for c in cols]) for r in df.collect())
            == sorted(repr([r[at[c]] for c in cols]) for r in want.fetchall()))


@pytest.mark.parametrize("name", ["op1_secrets", "op3_url_filters", "op4_pii"])
def test_native_queries_run_no_python(scratch, name):
    plan = QUERIES[name](scratch, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
