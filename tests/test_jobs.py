import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakecraft import jobs as J
from lakecraft.sources import tables as T
from tests.conftest import SF_SMALL
from tests.fixtures import PRODUCTS_CSV


@pytest.mark.parametrize("stamp", [None, dt.datetime(2025, 1, 1)])
def test_run_products_keeps_earlier_batches(spark, tmp, stamp):
    src = f"{tmp}/products.csv"
    with open(src, "w") as f:
        f.write(PRODUCTS_CSV)
    m = J.run_products(spark, src, f"{tmp}/bronze", f"{tmp}/silver", ingest_ts=stamp)
    assert m.ok() and m.steps == {"landed": 12, "cleaned": 9}
    assert spark.read.parquet(f"{tmp}/bronze").where("_source_file IS NOT NULL").count() == 12
    with open(src, "w") as f:
        f.write("product_name,category,price\nLamp,Home,10\n")
    m = J.run_products(spark, src, f"{tmp}/bronze", f"{tmp}/silver", ingest_ts=stamp and stamp + dt.timedelta(days=1))
    assert m.ok() and m.steps == {"landed": 1, "cleaned": 10}
    assert spark.read.parquet(f"{tmp}/silver").where("product_name = 'Lamp'").count() == 1


def test_run_orders_rerun_replaces_days(spark, tmp):
    orders = T.orders(spark, SF_SMALL)
    as_of = dt.date(2001, 8, 1)
    m1 = J.run_orders(spark, orders, f"{tmp}/orders", as_of)
    m2 = J.run_orders(spark, orders, f"{tmp}/orders", as_of)      # idempotent re-run
    assert m1.ok() and m2.ok() and m1.steps == m2.steps and m1.steps["loaded"] == m1.steps["extracted"] > 0
    assert spark.read.parquet(f"{tmp}/orders").count() == m1.steps["loaded"]
    # a run counts its own days: earlier ones in the folder don't make up for it
    empty = J.run_orders(spark, orders, f"{tmp}/orders", dt.date(2100, 1, 1))
    assert empty.ok() and empty.steps == {"extracted": 0, "rejected": 0, "loaded": 0}
    bad = orders.limit(5).selectExpr("CAST(NULL AS BIGINT) AS order_id", "customer_id", "order_date", "total_amount", "status", "created_at")
    part = J.run_orders(spark, orders.unionByName(bad).unionByName(orders.limit(3)), f"{tmp}/o2", dt.date(2001, 8, 1), days=4000)
    assert part.ok() and part.steps["rejected"] == 5 and part.steps["repeated"] == 3
    assert part.steps["loaded"] == orders.count()


def test_run_medallion(spark, tmp):
    csv = f"{tmp}/orders_csv"
    T.orders(spark, SF_SMALL).drop("created_at").write.option("header", True).csv(csv)
    m = J.run_medallion(spark, csv, f"{tmp}/silver", f"{tmp}/gold")
    days = T.orders(spark, SF_SMALL).select("order_date").distinct().count()
    assert m.steps["gold"] == days and m.steps["silver"] == T.orders(spark, SF_SMALL).count()


def test_incremental_summary_equals_full(spark, tmp):
    from lakecraft.plans.dashboards import gold_metrics
    orders = T.orders(spark, SF_SMALL)
    full = gold_metrics(orders).withColumn("y", F.year("order_date"))
    J.refresh_summary_incremental(full.where("y < 2000").withColumn("total_orders", F.lit(0)), f"{tmp}/g", ["y"])
    J.refresh_summary_incremental(full.where("y < 1999"), f"{tmp}/g", ["y"])
    J.refresh_summary_incremental(full.where("y >= 1999"), f"{tmp}/g", ["y"])
    assert sorted(map(tuple, spark.read.parquet(f"{tmp}/g").select(*full.columns).collect())) == sorted(map(tuple, full.collect()))


def test_publish_survives_a_failed_write(spark, tmp):
    path = f"{tmp}/t"
    assert J.latest(spark, path) == (0, None)
    J.publish(spark, spark.range(3).toDF("x"), path, "a")
    with pytest.raises(Exception, match="stop"):
        J.publish(spark, spark.range(5).select(F.expr("IF(id < 4, id, CAST(raise_error('stop') AS BIGINT)) AS x")), path, "b")
    n, df = J.latest(spark, path)
    assert n == 1 and df.count() == 3
    J.publish(spark, spark.range(5).toDF("x"), path, "c")
    assert J.latest(spark, path)[1].count() == 5


def test_format_bench(spark, tmp):
    r = J.format_bench(spark, 20000, tmp)
    assert r["rows"] == 20000 and r["parquet_mb"] < r["csv_mb"]


def _grown(spark, tmp):
    """A copy of the small tables with one more customer, a changed one, a new order and its item."""
    d = f"{tmp}/src"
    for t in ("customer", "part", "orders", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    key = c.agg(F.max("c_custkey")).first()[0]
    c2 = c.withColumn("c_mktsegment", F.when(F.col("c_custkey") == 1, "CHANGED").otherwise(F.col("c_mktsegment")))
    extra = c.where("c_custkey = 1").withColumn("c_custkey", F.lit(key + 1).cast(c.schema["c_custkey"].dataType))
    o, li = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("orders", "lineitem"))
    order = o.agg(F.max("o_orderkey")).first()[0] + 1
    o2 = o.limit(1).withColumn("o_orderkey", F.lit(order).cast(o.schema["o_orderkey"].dataType))
    li2 = li.limit(1).withColumn("l_orderkey", F.lit(order).cast(li.schema["l_orderkey"].dataType))
    return d, {"customer": c2.unionByName(extra), "orders": o.unionByName(o2), "lineitem": li.unionByName(li2)}


def test_run_mart_accumulates(spark, tmp):
    d, grown = _grown(spark, tmp)
    csv = f"{tmp}/p.csv"
    with open(csv, "w") as f:
        f.write(PRODUCTS_CSV)
    out = f"{tmp}/mart_out"
    m = J.run_mart(spark, d, out, dt.date(2001, 8, 1), products_csv=csv)
    assert m.ok(), m.failures
    customers = T.customers(spark, SF_SMALL).count()
    assert m.steps["dim_customer"] == customers and m.steps["products_cleaned"] == 9
    assert m.steps["fact"] == T.order_items(spark, SF_SMALL).distinct().count()
    again = J.run_mart(spark, d, out, dt.date(2001, 8, 1))
    assert again.ok() and again.steps["fact"] == 0 and again.steps["dim_customer"] == customers
    for t, df in grown.items():
        df.write.mode("overwrite").parquet(f"{d}/{t}.parquet")
    third = J.run_mart(spark, d, out, dt.date(2001, 9, 1))
    assert third.ok(), third.failures
    assert third.steps["fact"] == 1 and third.steps["dim_customer"] == customers + 2       # one new version, one new key
    dim = J.latest(spark, f"{out}/mart/dim_customer")[1]
    got = sorted((r.segment == "CHANGED", r.valid_from, r.valid_to, r.is_current) for r in dim.where("customer_id = 1").collect())
    assert got == [(False, dt.date(2001, 8, 1), dt.date(2001, 9, 1), False), (True, dt.date(2001, 9, 1), dt.date(9999, 12, 31), True)]
    assert J.latest(spark, f"{out}/summaries/mv_revenue_by_category")[1].count() == T.products(spark, SF_SMALL).select("category").distinct().count()


def test_step_policies(spark, tmp):
    missing = f"{tmp}/nothing"
    m = J.run_mart(spark, missing, f"{tmp}/o1", dt.date(2001, 8, 1))
    assert set(m.failures) == {"mart"}                          # required: the run ends
    m = J.run_mart(spark, missing, f"{tmp}/o2", dt.date(2001, 8, 1), steps={"mart": "optional"})
    assert set(m.failures) == {"mart", "summaries"}
    m = J.run_mart(spark, SF_SMALL, f"{tmp}/o3", dt.date(2001, 8, 1), products_csv=missing)
    assert set(m.failures) == {"products_csv"} and "fact" not in m.steps


def test_incremental_items_bookmark(spark, tmp):
    d, grown = _grown(spark, tmp)
    assert J.run_incremental_items(spark, d, f"{tmp}/i").steps["loaded"] == T.order_items(spark, d).count()
    assert J.run_incremental_items(spark, d, f"{tmp}/i").steps["loaded"] == 0
    late = grown["orders"].orderBy(F.desc("o_orderkey")).limit(1).withColumn("o_orderdate", F.expr("TIMESTAMP_NTZ '2001-12-24 18:30:00'"))
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").unionByName(late).write.mode("overwrite").parquet(f"{d}/orders.parquet")
    grown["lineitem"].write.mode("overwrite").parquet(f"{d}/lineitem.parquet")
    assert J.run_incremental_items(spark, d, f"{tmp}/i").steps["loaded"] == 1
