"""Golden answers of the reference's seed data (FIXTURES.md F1), produced by the
registered queries themselves. The seed rows are written as Parquet in the
test-table layout; order dates keep their offsets from the as-of date
(-5, -2, -10, -1, 0 days), with AS_OF = 2001-08-01 standing in for 2025-01-31."""

import datetime as dt

import pytest

from lakecraft.plans import QUERIES
from lakecraft.plans.params import AS_OF
from tests.fixtures import CUSTOMERS, ITEMS, ORDERS, PRODUCTS

OFFSETS = {1: -5, 2: -2, 3: -10, 4: -1, 5: 0}
TOTALS = {1: 28500000.0, 2: 32000000.0, 3: 26000000.0, 4: 9000000.0, 5: 2500000.0}


@pytest.fixture(scope="module")
def seed_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("seed"))
    spark.createDataFrame([(c, n, 0, 0.0, e) for c, n, e in CUSTOMERS],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string") \
        .write.parquet(f"{d}/customer.parquet")
    spark.createDataFrame([(p, n, "Brand#1", c, 1, pr) for p, n, c, pr in PRODUCTS],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
                          "p_retailprice double").write.parquet(f"{d}/part.parquet")
    day = lambda o: dt.datetime.combine(AS_OF + dt.timedelta(days=OFFSETS[o]), dt.time())
    spark.createDataFrame([(o, c, s, TOTALS[o], day(o), "1-URGENT") for o, c, _, s in ORDERS],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(o, p, 0, i, float(q), sub, 0.0, 0.0, "N", "O", day(o)) for i, o, p, q, sub in ITEMS],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{d}/lineitem.parquet")
    return d


def run(spark, d, name):
    return QUERIES[name](spark, d).collect()


def test_order_totals(spark, seed_dir):
    assert {r.order_id: r.total_amount for r in run(spark, seed_dir, "order_totals")} == TOTALS


def test_counts_including_zero(spark, seed_dir):
    assert {r.customer_id: r.order_count for r in run(spark, seed_dir, "c09_order_count")} == \
        {1: 2, 2: 1, 3: 1, 4: 0, 5: 1}


def test_subqueries(spark, seed_dir):
    assert sorted(r.product_id for r in run(spark, seed_dir, "c11_above_avg")) == [1, 2, 3]
    assert [r.order_id for r in run(spark, seed_dir, "c13_max_order")] == [2]
    assert {r.customer_id: r.total_spent for r in run(spark, seed_dir, "c12_big_spenders")} == \
        {1: 37500000.0, 2: 32000000.0, 3: 26000000.0}


def test_top2_per_category(spark, seed_dir):
    got = {}
    for r in run(spark, seed_dir, "c15_top2_per_category"):
        got.setdefault(r.category, []).append((r.rn, r.product_id))
    assert {k: [p for _, p in sorted(v)] for k, v in got.items()} == \
        {"Accessory": [6], "Audio": [5, 4], "Electronics": [1, 2], "Laptop": [3]}


def test_multi_item_orders_and_running_total(spark, seed_dir):
    assert sorted((r.order_id, r.cnt) for r in run(spark, seed_dir, "c16_multi_item_orders")) == [(1, 2), (3, 2)]
    rt = sorted((r.running_total, r.order_id) for r in run(spark, seed_dir, "c19_running_total"))
    assert [(o, t) for t, o in rt] == [(3, 26.0e6), (1, 54.5e6), (2, 86.5e6), (4, 95.5e6), (5, 98.0e6)]


def test_category_share_and_summary(spark, seed_dir):
    share = {r.category: r.pct_of_total for r in run(spark, seed_dir, "b03_category_share")}
    assert share == {"Electronics": 44.90, "Laptop": 32.65, "Audio": 14.80, "Accessory": 7.65}
    summ = {r.category: (r.order_count, r.quantity_sold, r.revenue) for r in run(spark, seed_dir, "mv_revenue_by_category")}
    assert summ == {"Electronics": (2, 2, 44.0e6), "Laptop": (1, 1, 32.0e6), "Audio": (2, 2, 14.5e6),
                    "Accessory": (2, 3, 7.5e6)}


def test_returning_gap_and_incremental(spark, seed_dir):
    assert sorted(r.customer_id for r in run(spark, seed_dir, "b05_returning_gap")) == [1, 2, 5]
    items = sorted((r.order_id, r.line_number) for r in run(spark, seed_dir, "b07_incremental"))
    assert [i for o, i in items] == [1, 2, 3, 6, 7]


def test_top_customers_nulls_last(spark, seed_dir):
    rows = QUERIES["mv_top_customers"](spark, seed_dir).collect()
    assert [r.customer_id for r in rows][-1] == 4 and rows[-1].total_spent is None
    assert [r.customer_id for r in rows][:3] == [1, 2, 3]
