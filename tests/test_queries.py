"""The registered queries: agreement with SQL on the small tables, and plan checks."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()
SAMPLE = [
    "enrich_file_events", "filter_gt_median", "null_counts", "recode_map", "one_hot", "join_lookup_default", "join_index_outer",
    "wordcount_regex", "sales_multi_dim", "sales_kv_output", "describe_by_group", "pivot_wide", "top10_ips", "sorted_unique_lines",
    "scalar_date", "scalar_math", "api_pages_extract", "stream_tumbling_live", "stream_session_by_gap_live", "stream_stateful_session",
    "stream_dedup", "stream_checkpoint_restart", "sink_multi", "map_with_retry", "map_with_checkpoint", "dedup_subset_none", "dup_groups",
    "db_potential_duplicates", "bloom_probe", "minhash_signature", "shard_stats", "profile_report", "corr_matrix", "boxplot_stats",
    "user_cosine", "recommend_items", "ml_knn_scan", "text_trigrams", "text_sentiment_lexicon", "throttle_token_bucket",
    "circuit_breaker", "lambda_serving", "kappa_replay", "batch_ingest_daily", "batch_process",
]
# lazy queries whose plans are looked at
PLANNED = [
    "dedup_exact", "dedup_hash", "dedup_sharded", "sales_by_category", "user_euclidean", "join_inner", "filter_gt_median",
    "stream_session_by_gap", "throttle_fixed_window", "text_sentiment_lexicon", "describe", "dedup_report", "shard_by_count",
]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), duck(sf), SQL[name]) is None


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(QUERIES["filter_alerts"](spark, sf))
    assert "EqualTo(event_type,error)" in text
    text = plan(QUERIES["value_counts"](spark, sf))
    assert "ReadSchema: struct<o_orderpriority:string>" in text


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES) and len(QUERIES) > 250


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["window_start", "window_end", "event_type"]
