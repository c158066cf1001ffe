"""Queries of operators that SQL can express, against DuckDB."""

import pytest

import __spark_entry__
from check import compare, oracle_connection

NAMES = ["op1_quality_rules", "op6_benchmark_decontamination", "op7_url_filters", "op12_conversation_trie"]


@pytest.mark.parametrize("name", NAMES)
def test_query_is_its_oracle(spark, sf_dir, llm_queries, name):
    df = llm_queries[name](spark, sf_dir)
    found = oracle_connection(sf_dir).execute(__spark_entry__.oracle_sql()[name])
    assert compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in found.description], found.fetchall()) is None


def test_all_operators_and_the_pipeline_are_registered(llm_queries):
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in llm_queries) == 1
    assert "pipeline" in llm_queries
