import os

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.queries import QUERIES

# The quick ones; set ALL_QUERIES=1 to compare every query with its SQL.
QUICK = (
    "table_profile", "column_overlap", "overlap_types", "metric_direction", "gaps_numeric", "table_overwrite", "json_result", "top_categories", "clean_text", "dedup_exact", "split_exact", "replay_mix", "cap_pairs",
    "numbered_rows", "chat_prompt", "mask_spans", "json_values", "row_text", "attach_runs", "pairwise_models", "version_wins", "pareto_versions", "search_index", "recommendation_prompts", "qa_trade_off",
    "recommendation_prompt", "perplexity", "training_summary",
)
SMALL = contract.SMALL


# SQL has no subword tokenizer; test_new_operators.py compares these with the library.
WITHOUT_SQL = {"subword_masks", "subword_budget"}


def test_every_query_has_sql():
    assert set(QUERIES) - WITHOUT_SQL <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITHOUT_SQL) if os.environ.get("ALL_QUERIES") else QUICK)
def test_query_equals_sql(spark, name):
    problem, _ = difference(spark, connect(SMALL), SMALL, name, contract.oracle_sql()[name])
    assert not problem
