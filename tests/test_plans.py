"""What Spark makes of the queries."""

from __future__ import annotations

import pytest
from conftest import plan_of

import __spark_entry__ as contract

LAZY = sorted(
    name for name in contract.oracle_sql()
    if not name.startswith(("stream_", "linreg_", "gym_", "trial_"))
)


def plan(spark, sf_dir, name):
    return plan_of(contract.queries()[name](spark, sf_dir))


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    for node in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize("name", ["filter_expr", "filter_column", "filter_sql"])
def test_filter_reaches_the_scan(spark, sf_dir, name):
    assert "EqualTo(o_orderpriority,2-HIGH)" in plan(spark, sf_dir, name)


@pytest.mark.parametrize("name, columns", [
    ("course_sizes", "struct<n_regionkey:int>"),
    ("log_month_df", "struct<o_orderstatus:string,o_orderdate:timestamp_ntz>"),
    ("tumbling_views", "struct<ts:timestamp_ntz,event_type:string>"),
    ("correlation_matrix", "struct<l_linenumber:int,l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double>"),
    ("word_counts", "struct<text:string>"),
])
def test_only_needed_columns_are_read(spark, sf_dir, name, columns):
    text = contract.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().treeString()
    full = contract.queries()[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert columns in text or columns in full or f"ReadSchema: {columns[:60]}" in text


@pytest.mark.parametrize("name", ["level_counts", "word_counts", "course_sizes", "log_month_df", "global_sum", "distinct_pairs"])
def test_counts_combine_before_the_shuffle(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    before, after = text.split("Exchange hashpartitioning" if "hashpartitioning" in text else "Exchange SinglePartition", 1)
    assert "HashAggregate" in before and "HashAggregate" in after


def test_top_words_needs_no_full_sort(spark, sf_dir):
    text = plan(spark, sf_dir, "top_words")
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_correlation_reads_its_table_once(spark, sf_dir, set_conf):
    assert plan(spark, sf_dir, "correlation_matrix").count("FileScan") == 1
    set_conf(spark__sql__codegen__maxFields="10")
    assert plan(spark, sf_dir, "correlation_matrix").count("FileScan") == 1


def test_course_names_are_broadcast(spark, sf_dir):
    assert "BroadcastHashJoin" in plan(spark, sf_dir, "enrich_events")


def test_sliding_windows_count_minutes_first(spark, sf_dir):
    text = plan(spark, sf_dir, "sliding_views")
    assert text.index("Expand") < text.rindex("Exchange hashpartitioning")


def test_ranking_is_cut_before_the_shuffle(spark, sf_dir):
    from pyspark.sql import functions as F

    from tablecraft.operators import top_rows_per

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_totalprice")
    assert plan_of(top_rows_per(orders, ["o_custkey"], [F.desc("o_totalprice")], 3)).count("WindowGroupLimit") == 2
