"""What the physical plans must look like to hold at scale."""

import re

import pytest

import __spark_entry__ as entry
from sluiceway.operators import joins

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    found = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    return {c.split(":")[0] for schema in found for c in schema.split(",") if c}


@pytest.mark.parametrize(
    "name, columns",
    [
        ("customer_orders_fact", {"c_custkey", "c_mktsegment", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"}),
        ("product_dimension", {"p_brand", "p_type"}),
        ("suppliers_used_together", {"l_orderkey", "l_suppkey", "_q", "_hits"}),
        ("orphaned_part_keys", {"l_partkey", "p_partkey", "p_size"}),
        ("row_count_in_bounds", set()),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    assert read_columns(plan(spark, name)) == columns


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("stage_events_stamped", "GreaterThan(value,10.0)"),
        ("new_events_by_cursor", "GreaterThan(ts,2024-01-"),
        ("parameterized_sql", "GreaterThan(o_totalprice,100000.0)"),
        ("customer_360", "EqualTo(o_orderstatus,F)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(spark, name)


@pytest.mark.parametrize(
    "name",
    [
        "latest_event_per_user_and_type",
        "newest_three_orders_per_customer",
        "customers_by_source_priority",
        "sync_incremental_deduped",
        "runtimes_per_user",
        "recent_syncs",
    ],
)
def test_newest_rows_are_cut_in_the_map_tasks(spark, name):
    text = plan(spark, name)
    assert re.search(r"WindowGroupLimit .*Partial", text)


@pytest.mark.parametrize(
    "name",
    ["sales_fact", "merge_customers", "order_history_by_check", "ranked_items", "best_matching_parts",
     "lineitem_statistics", "redacted_documents", "redacted_known_json", "unpacked_raw_events"],
)
def test_rows_stay_in_the_jvm(spark, name):
    assert "Python" not in plan(spark, name) and "Arrow" not in plan(spark, name)


def test_whole_table_checks_scan_once(spark):
    assert plan(spark, "row_count_in_bounds").count("FileScan") == 1
    # three nulls, two sources of rows in the union: one scan each
    assert plan(spark, "not_null_tests").count("FileScan") == 2


def test_statistics_shuffle_keys_not_texts(spark):
    text = plan(spark, "documents_profile")
    assert re.search(r"Exchange hashpartitioning\(_column#\d+, _key#\d+L, _key2#\d+L", text)


def test_small_batch_is_broadcast_and_target_not_shuffled(spark):
    text = plan(spark, "delete_insert_customers")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_large_key_sides_leave_an_exchange_for_skew_splitting(spark):
    """Both inputs of the join sort straight from an exchange of their own."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.read.parquet(f"{FOLDER}/orders.parquet").select("o_custkey")
        kept = joins.keep_matching(rows, rows.filter("o_custkey < 50"), ["o_custkey"])
        text = kept._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Sort \[o_custkey[^\n]*\n[^\n]*Exchange hashpartitioning\(o_custkey#\d+L, 8\)", text)) == 2
        assert kept.count() == rows.filter("o_custkey < 50").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_co_access_does_not_shuffle_the_log(spark):
    text = plan(spark, "suppliers_used_together")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "hashpartitioning(l_orderkey" not in text


def test_orders_are_folded_before_the_join(spark):
    text = plan(spark, "customer_orders_fact")
    assert re.search(r"partial_(count|sum)\(o_", text) or re.search(r"partial_sum\(o_totalprice", text)


@pytest.mark.parametrize(
    "name, scans",
    [("lineitem_statistics", 1), ("gappy_document_statistics", 1), ("customer_orders_fact", 2), ("merge_customers", 5)],
)
def test_each_input_is_scanned_once_per_use(spark, name, scans):
    """Statistics take one scan; a merge reads its target once, its batch (of two parts) for keys and rows."""
    assert plan(spark, name).count("FileScan") == scans
