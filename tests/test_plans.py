"""Plan assertions: pushdown, pruning, semi/anti joins, partial top-N limits,
and no single-partition window over row-level data."""

import re

import pytest

from lakecraft.plans import QUERIES
from tests.conftest import SF_SMALL


def plan(spark, name):
    return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_filter_pushed_to_scan(spark):
    p = plan(spark, "c25_recent_detail")
    assert re.search(r"o_orderdate#\d+ >= 2001-07-02", p), p


def test_projection_pruned(spark):
    p = plan(spark, "c01_customers")
    assert "ReadSchema: struct<c_name:string,c_mktsegment:string>" in p


@pytest.mark.parametrize("name,op", [("c05_customers_with_orders", "LeftSemi"), ("c24_in_form", "LeftSemi"),
                                     ("c10_orders_without_items", "LeftAnti"), ("b05_returning_gap", "LeftAnti")])
def test_semi_anti(spark, name, op):
    assert op in plan(spark, name)


@pytest.mark.parametrize("name", ["c15_top2_per_category", "b01_top3_customers"])
def test_partial_window_group_limit(spark, name):
    p = plan(spark, name)
    assert "WindowGroupLimit" in p and "Partial" in p


@pytest.mark.parametrize("name", ["c17_order_rownum", "c19_running_total", "c18_price_rank", "w_lead",
                                  "w_running_avg", "ev_session"])
def test_no_single_partition_window_over_rows(spark, name):
    """Every Window over row-level data is partitioned (by range segment); an
    unpartitioned Window may only run over the per-segment offset table."""
    p = plan(spark, name)
    for m in re.finditer(r"Window \[[^\n]*\], \[([^\]]*)\]", p):
        spec = m.group(1)
        assert spec.strip(), f"unpartitioned window in {name}: {m.group(0)[:200]}"


def test_dedup_is_an_aggregate(spark):
    p = plan(spark, "b06_dedup_latest")
    assert "Window" not in p and "Aggregate" in p


SEGMENTED = ["c17_order_rownum", "c18_price_rank", "c19_running_total", "w_dense_rank", "w_lead", "w_running_avg",
             "ev_session", "ev_session_window"]


@pytest.mark.parametrize("name", SEGMENTED)
def test_building_a_segmented_query_writes_nothing(spark, name):
    import os
    from urllib.parse import urlparse
    from lakecraft.session import checkpoint_dir
    base = urlparse(checkpoint_dir(spark)).path
    before = sorted(os.listdir(base))
    df = QUERIES[name](spark, SF_SMALL)
    df.count()
    assert sorted(os.listdir(base)) == before


def test_rows_of_a_segmented_query_are_shuffled_once(spark):
    p = plan(spark, "c17_order_rownum")
    rows = [m for m in re.finditer(r"Exchange hashpartitioning\(([^)]*)\)", p) if "_pid" in m.group(1) and "order" not in m.group(1)]
    assert "rangepartitioning" not in p and len(rows) >= 1
    assert len(re.findall(r"Exchange hashpartitioning\(_pid#\d+, ", p)) <= 2     # the rows, and the edge table's few


@pytest.mark.parametrize("name", SEGMENTED)
def test_segment_search_is_compiled(spark, name):
    """The search is comparisons with literals, not an interpreted function over an array, and stands
    once for the rows and once for each use of an edge table (sessions have two, one over the other)."""
    p = plan(spark, name)
    assert "aggregate(" not in p and "element_at(" not in p and "lambdafunction" not in p
    assert len(re.findall(r"CASE WHEN [^\n]* AS _pid#", p)) <= (4 if name == "ev_session" else 2)


def test_segment_search_orders_as_sorted(spark):
    """Nulls, NaN, quotes, descending columns and groups of two columns: segments follow the sort order."""
    from lakecraft.operators import windows as W
    rows = [(None if i % 7 == 0 else f"a'{i % 3}\\`", None if i % 5 == 0 else i % 4, float("nan") if i % 11 == 0 else
             None if i % 13 == 0 else i * 37 % 101 / 4, i) for i in range(400)]
    df = spark.createDataFrame(rows, "g1 string, g2 int, x double, id long")
    group, order = ["g1", "g2"], [W.Desc("x"), "id"]
    seg = W.range_segments(df, order, group, 9)
    got = seg.orderBy("g1", "g2", W._sort(W.Desc("x")), "id").collect()
    pids = [r._pid for r in got]
    assert pids == sorted(pids) and len(set(pids)) == 9
    parts = {}
    for r in got:
        parts.setdefault((r.g1, r.g2), set()).add(r._pid)
    assert all(r._spans for r in got if len(parts[r.g1, r.g2]) > 1)
    assert seg.where("_spans").select("g1", "g2", "_pid").distinct().count() <= 2 * 9
