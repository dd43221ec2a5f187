"""Plan checks at the shuffle level: what must hold when the tables are large."""

from __future__ import annotations

import re

import pytest

from saltmill.catalog import QUERIES

SMALL_COUNTS = {"sort_cols", "wc_sort_key", "dq_assign_ids"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(conf):
    """Only explicit, size-checked broadcasts remain."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_joins_and_no_row_udf(spark, sf_dir, no_broadcast, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BatchEvalPython" not in plan and "RoundRobinPartitioning" not in plan
    # A window is cut per task before its shuffle, runs over partition counts, or within a range
    # of the sorted table.
    windows = re.findall(r"Window \[[^\n]*", plan)
    in_ranges = all("windowspecdefinition(_part#" in w for w in windows)
    assert in_ranges or "WindowGroupLimit" in plan or name in SMALL_COUNTS


@pytest.mark.parametrize(
    "name, column", [("filter_gt", "c_acctbal"), ("filter_eq", "p_type"), ("r_rewards", "o_orderdate")]
)
def test_filters_reach_the_scan(spark, sf_dir, name, column):
    plan = _plan(QUERIES[name](spark, sf_dir))
    assert re.search(rf"PushedFilters: \[[^\]]*\({column},", plan)


def test_scans_read_only_used_columns(spark, sf_dir):
    plan = _plan(QUERIES["r_sales_by_store"](spark, sf_dir))
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double>" in plan


def test_facts_are_combined_before_joins(spark, sf_dir, no_broadcast):
    for name in ("topk_category_revenue", "join_chain", "agg_two_level"):
        plan = _plan(QUERIES[name](spark, sf_dir))
        deepest = plan.splitlines()
        scan = next(i for i, line in enumerate(deepest) if re.search(r"FileScan parquet \[.*(l_partkey|o_custkey)", line))
        assert any("HashAggregate" in line and "partial" in line for line in deepest[scan - 4 : scan]), name


def test_fees_shuffle_the_fact_once(spark, sf_dir, no_broadcast):
    for name in ("r_balance", "overdue_days"):
        plan = _plan(QUERIES[name](spark, sf_dir))
        # Lines meet their order by shuffle, and their item by a checked broadcast.
        assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1, name
        assert len(re.findall(r"Exchange hashpartitioning\((rental_id|l_orderkey|o_orderkey)", plan)) <= 2, name


def test_chosen_parts_filter_lines_before_the_count(spark, sf_dir, no_broadcast):
    plan = _plan(QUERIES["cte_join"](spark, sf_dir))
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


def test_texts_are_keyed_by_hash(spark, sf_dir):
    for name in ("distinct_rows", "dedup_subset"):
        plan = _plan(QUERIES[name](spark, sf_dir))
        assert re.search(r"hashpartitioning\(_text", plan) and not re.search(r"hashpartitioning\(text", plan), name


def test_report_lists_need_few_shuffles(spark, sf_dir, no_broadcast):
    for name in ("r_actor_info", "r_film_list", "r_film_list_nice"):
        assert _plan(QUERIES[name](spark, sf_dir)).count("Exchange hashpartitioning") <= 6, name


def test_top_k_does_not_sort_the_table(spark, sf_dir):
    assert "TakeOrderedAndProject" in _plan(QUERIES["topk_actors"](spark, sf_dir))


def test_rank_filters_do_not_shuffle_rows(spark, sf_dir):
    for name in ("win_rank", "win_dense_rank"):
        assert "Exchange hashpartitioning" not in _plan(QUERIES[name](spark, sf_dir))


def test_outer_join_with_a_later_inner_join_becomes_inner(spark, sf_dir, no_broadcast):
    assert "LeftOuter" not in _plan(QUERIES["outer_elim"](spark, sf_dir))


def test_open_lines_are_filtered_in_the_scan(spark, sf_dir):
    plan = _plan(QUERIES["r_in_stock"](spark, sf_dir))
    assert "EqualTo(l_returnflag,N)" in plan and "GreaterThanOrEqual(l_sh" in plan
