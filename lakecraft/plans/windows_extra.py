"""Further window functions of the lab guide: DENSE_RANK, LEAD, a running
AVG per partition and a year-over-year comparison."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakecraft.functions.scalars import money
from lakecraft.operators import windows as W
from lakecraft.plans.registry import register
from lakecraft.sources import tables as T
from lakecraft.sources.tables import with_retail


@register("w_dense_rank", with_retail(
    "SELECT product_id, category, price, DENSE_RANK() OVER (PARTITION BY category ORDER BY price DESC) "
    "AS price_dense_rank FROM app_products"))
def w_dense_rank(spark, d):
    p = T.products(spark, d).select("product_id", "category", "price")
    return W.rank_in_group(p, ["category"], ["price"], descending=True, out="price_dense_rank", dense=True)


@register("w_lead", with_retail(
    "SELECT order_id, customer_id, order_date, "
    "LEAD(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS next_order_date "
    "FROM app_orders"))
def w_lead(spark, d):
    o = T.orders(spark, d).select("order_id", "customer_id", "order_date")
    return W.lead_in_group(o, ["customer_id"], ["order_date", "order_id"],
                           {"next_order_date": "order_date"})


@register("w_running_avg", with_retail(
    "SELECT order_id, customer_id, order_date, total_amount, "
    "CAST(SUM(CAST(total_amount AS DECIMAL(12,2))) OVER w AS DOUBLE) / CAST(COUNT(*) OVER w AS DOUBLE) "
    "AS running_avg FROM app_orders "
    "WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id ROWS UNBOUNDED PRECEDING)"))
def w_running_avg(spark, d):
    """Running average = running exact sum / running count (one segmented pass)."""
    o = T.orders(spark, d).select("order_id", "customer_id", "order_date", "total_amount")
    r = W.prefix_sums(o, {"_s": money("total_amount"), "_n": F.lit(1).cast("long")},
                      ["order_date", "order_id"], ["customer_id"])
    return r.select("order_id", "customer_id", "order_date", "total_amount",
                    (F.col("_s").cast("double") / F.col("_n").cast("double")).alias("running_avg"))


@register("w_yoy", with_retail(
    "SELECT year, month, CAST(revenue AS DOUBLE) AS revenue, "
    "CAST(LAG(revenue, 12) OVER (ORDER BY year, month) AS DOUBLE) AS revenue_prev_year, "
    "CASE WHEN LAG(revenue, 12) OVER (ORDER BY year, month) IS NOT NULL "
    "THEN ROUND(100.0 * (CAST(revenue AS DOUBLE) - CAST(LAG(revenue, 12) OVER (ORDER BY year, month) AS DOUBLE)) "
    "/ CAST(LAG(revenue, 12) OVER (ORDER BY year, month) AS DOUBLE), 2) END AS yoy_pct FROM monthly",
    "monthly AS (SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month, "
    "SUM(CAST(total_amount AS DECIMAL(12,2))) AS revenue FROM app_orders GROUP BY ALL)"))
def w_yoy(spark, d):
    """Year-over-year by month: LAG 12 over the monthly aggregate (one row per
    month, so the ordered window is small whatever the order volume)."""
    monthly = (T.orders(spark, d).groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"))
               .agg(F.sum(money("total_amount")).alias("rev")))
    prev = F.lag("rev", 12).over(Window.orderBy("year", "month")).cast("double")
    cur = F.col("rev").cast("double")
    return monthly.select("year", "month", cur.alias("revenue"), prev.alias("revenue_prev_year"),
                          F.when(prev.isNotNull(), F.round(100.0 * (cur - prev) / prev, 2)).alias("yoy_pct"))
