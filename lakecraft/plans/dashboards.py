"""Dashboard summaries (the three materialized views and the dashboard
questions) and data-quality reports over the retail views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakecraft.functions.scalars import money, money_sum, ntz
from lakecraft.operators import quality as Q
from lakecraft.plans.params import AS_OF, AS_OF_SQL, CATEGORY
from lakecraft.plans.registry import register
from lakecraft.sources import tables as T
from lakecraft.sources.tables import with_retail

M = "CAST(SUM(CAST({} AS DECIMAL(12,2))) AS DOUBLE)".format


# ---------------------------------------------------------------- materialized views

@register("mv_daily_revenue", with_retail(
    "SELECT report_date, COUNT(*) AS num_orders, SUM(n)::BIGINT AS num_items, SUM(s)::DOUBLE AS revenue FROM ("
    "SELECT order_date AS report_date, order_id, COUNT(*) AS n, SUM(total_amount::DECIMAL(12,2)) AS s FROM app_orders "
    "WHERE isfinite(total_amount) GROUP BY ALL) GROUP BY ALL ORDER BY 1 DESC"))
def mv_daily_revenue(spark, d):
    # num_items counts order rows (the view reads orders only); value kept as defined
    return (T.orders(spark, d).where(F.col("total_amount").isNotNull())
            .groupBy(F.col("order_date").alias("report_date"))
            .agg(F.countDistinct("order_id").alias("num_orders"), F.count(F.lit(1)).alias("num_items"),
                 money_sum("total_amount").alias("revenue"))
            .orderBy(F.col("report_date").desc()))


@register("mv_top_customers", with_retail(
    "SELECT customer_id, full_name, segment, COALESCE(n, 0) AS order_count, s::DOUBLE AS total_spent FROM app_customers LEFT JOIN ("
    "SELECT customer_id, COUNT(order_id) AS n, SUM(total_amount::DECIMAL(12,2)) AS s FROM app_orders GROUP BY ALL) USING (customer_id) "
    "ORDER BY s DESC NULLS LAST"))
def mv_top_customers(spark, d):
    # right-side condition applied before the outer join keeps customers without orders
    per = (T.orders(spark, d).where(F.col("total_amount").isNotNull()).groupBy("customer_id")
           .agg(F.count("order_id").alias("order_count"), F.sum(money("total_amount")).alias("s")))
    return (T.customers(spark, d).join(per, "customer_id", "left")
            .select("customer_id", "full_name", "segment",
                    F.coalesce("order_count", F.lit(0)).cast("long").alias("order_count"),
                    F.col("s").cast("double").alias("total_spent"))
            .orderBy(F.col("total_spent").desc_nulls_last()))


@register("mv_revenue_by_category", with_retail(
    "SELECT category, COUNT(*) AS order_count, SUM(q)::BIGINT AS quantity_sold, SUM(s)::DOUBLE AS revenue FROM ("
    "SELECT category, order_id, SUM(quantity) AS q, SUM(subtotal::DECIMAL(12,2)) AS s FROM app_items JOIN app_products USING (product_id) "
    "WHERE subtotal IS NOT NULL GROUP BY ALL) GROUP BY ALL ORDER BY revenue DESC"))
def mv_revenue_by_category(spark, d):
    items = T.order_items(spark, d).where(F.col("subtotal").isNotNull())
    return (items.join(T.products(spark, d).select("product_id", "category"), "product_id")
            .groupBy("category")
            .agg(F.countDistinct("order_id").alias("order_count"),
                 F.sum("quantity").cast("long").alias("quantity_sold"),
                 money_sum("subtotal").alias("revenue"))
            .orderBy(F.col("revenue").desc()))


# ---------------------------------------------------------------- dashboard questions

@register("orders_last_30d", with_retail(
    f"SELECT * FROM app_orders WHERE order_date >= {AS_OF_SQL} - INTERVAL 30 DAY"))
def orders_last_30d(spark, d):
    return T.orders(spark, d, since=AS_OF - dt.timedelta(days=30))


@register("orders_recent", with_retail(
    f"SELECT * FROM app_orders WHERE created_at > CAST({AS_OF_SQL} AS TIMESTAMP) - INTERVAL 1 DAY"))
def orders_recent(spark, d):
    cutoff = ntz(dt.datetime.combine(AS_OF, dt.time())) - F.expr("INTERVAL 1 DAY")
    return T.orders(spark, d).where(F.col("created_at") > cutoff)


@register("revenue_by_date_status", with_retail(
    f"SELECT order_date, COUNT(*) AS n_orders, {M('total_amount')} AS revenue "
    "FROM app_orders WHERE status = 'F' GROUP BY order_date"))
def revenue_by_date_status(spark, d):
    return (T.orders(spark, d).where(F.col("status") == "F").groupBy("order_date")
            .agg(F.count(F.lit(1)).alias("n_orders"), money_sum("total_amount").alias("revenue")))


@register("orders_by_status", with_retail(
    "SELECT status, COUNT(*) AS n_orders FROM app_orders GROUP BY status"))
def orders_by_status(spark, d):
    return T.orders(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n_orders"))


DASH_FROM, DASH_TO, DASH_SEGMENT = dt.date(2000, 1, 1), dt.date(2000, 12, 31), "BUILDING"


def dashboard_revenue(spark, d, date_from=None, date_to=None, category=None, segment=None):
    """Saved dashboard query with optional filters; each given parameter adds a
    predicate that reaches the matching scan. Orders meet their filtered
    customers first, so the items join what is left of them."""
    o = T.orders(spark, d, since=date_from, until=date_to).select("order_id", "customer_id", "order_date")
    items = T.order_items(spark, d).select("order_id", "product_id", "quantity", "subtotal")
    p = T.products(spark, d).select("product_id", "category")
    if category is not None:
        p = p.where(F.col("category") == category)
    c = T.customers(spark, d).select("customer_id", "segment")
    if segment is not None:
        c = c.where(F.col("segment") == segment)
    of_customers = o.join(c.select("customer_id"), "customer_id").select("order_id", "order_date")
    return (items.join(of_customers, "order_id").join(p, "product_id")
            .groupBy("order_date", "category")
            .agg(F.countDistinct("order_id").alias("orders"), F.sum("quantity").cast("long").alias("quantity"),
                 money_sum("subtotal").alias("revenue")))


@register("dash_filtered", with_retail(
    "SELECT o.order_date, p.category, COUNT(DISTINCT o.order_id) AS orders, "
    f"CAST(SUM(oi.quantity) AS BIGINT) AS quantity, {M('oi.subtotal')} AS revenue "
    "FROM app_items oi JOIN app_products p ON p.product_id = oi.product_id "
    "JOIN app_orders o ON o.order_id = oi.order_id JOIN app_customers c ON c.customer_id = o.customer_id "
    f"WHERE o.order_date BETWEEN DATE '{DASH_FROM}' AND DATE '{DASH_TO}' AND p.category = '{CATEGORY}' "
    f"AND c.segment = '{DASH_SEGMENT}' GROUP BY o.order_date, p.category"))
def dash_filtered(spark, d):
    return dashboard_revenue(spark, d, DASH_FROM, DASH_TO, CATEGORY, DASH_SEGMENT)


@register("gold_daily_metrics", with_retail(
    f"SELECT order_date, {M('total_amount')} AS daily_revenue, COUNT(DISTINCT order_id) AS total_orders, "
    "COUNT(DISTINCT customer_id) AS unique_customers, "
    "CASE WHEN COUNT(total_amount) > 0 THEN CAST(SUM(CAST(total_amount AS DECIMAL(12,2))) AS DOUBLE) "
    "/ CAST(COUNT(total_amount) AS DOUBLE) END AS avg_order_value "
    "FROM app_orders GROUP BY order_date"))
def gold_daily_metrics(spark, d):
    return gold_metrics(T.orders(spark, d))


def gold_metrics(orders):
    """Gold daily metrics from silver orders: revenue, orders, customers, AOV.
    Orders collapse to (day, customer, order) and (day, customer) first, so the
    distinct counts are counts of rows and no row is expanded."""
    per_order = orders.groupBy("order_date", "customer_id", "order_id").agg(
        F.sum(money("total_amount")).alias("s"), F.count("total_amount").alias("n"))
    per_customer = per_order.groupBy("order_date", "customer_id").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.count("order_id").alias("o"))
    total, n = F.sum("s"), F.sum("n")
    return per_customer.groupBy("order_date").agg(
        total.cast("double").alias("daily_revenue"), F.sum("o").cast("long").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        F.when(n > 0, total.cast("double") / n.cast("double")).alias("avg_order_value"))


@register("medallion_gold", with_retail(
    f"SELECT order_date, {M('total_amount')} AS daily_revenue, COUNT(DISTINCT order_id) AS total_orders, "
    "COUNT(DISTINCT customer_id) AS unique_customers, "
    "CASE WHEN COUNT(total_amount) > 0 THEN CAST(SUM(CAST(total_amount AS DECIMAL(12,2))) AS DOUBLE) "
    "/ CAST(COUNT(total_amount) AS DOUBLE) END AS avg_order_value FROM silver GROUP BY order_date",
    "silver AS (SELECT DISTINCT order_id, customer_id, order_date, total_amount, trim(status) AS status, "
    "created_at FROM app_orders WHERE order_id IS NOT NULL)"))
def medallion_gold(spark, d):
    """Bronze -> silver -> gold on the orders table: the generic silver pass
    (trim, key present, numeric casts, exact duplicates removed), then the gold
    daily metrics."""
    from lakecraft.operators.cleaning import clean_silver
    return gold_metrics(clean_silver(T.orders(spark, d)))


@register("order_totals", with_retail(
    f"SELECT o.order_id, {M('oi.subtotal')} AS total_amount FROM app_orders o "
    "LEFT JOIN app_items oi ON oi.order_id = o.order_id GROUP BY o.order_id"))
def order_totals(spark, d):
    """Set-based form of the order-total trigger: each order's total is the sum
    of its items (null when it has none)."""
    sums = T.order_items(spark, d).groupBy("order_id").agg(F.sum(money("subtotal")).alias("s"))
    return (T.orders(spark, d).select("order_id").join(sums, "order_id", "left")
            .select("order_id", F.col("s").cast("double").alias("total_amount")))


@register("top10_customers", with_retail(
    f"SELECT c.customer_id, c.full_name, {M('o.total_amount')} AS total_spent "
    "FROM app_customers c JOIN app_orders o ON o.customer_id = c.customer_id "
    "GROUP BY c.customer_id, c.full_name "
    "ORDER BY SUM(CAST(o.total_amount AS DECIMAL(12,2))) DESC, c.customer_id LIMIT 10"))
def top10_customers(spark, d):
    per = T.orders(spark, d).groupBy("customer_id").agg(F.sum(money("total_amount")).alias("s"))
    return (T.customers(spark, d).join(per, "customer_id").orderBy(F.col("s").desc(), "customer_id")
            .limit(10).select("customer_id", "full_name", F.col("s").cast("double").alias("total_spent")))


# ---------------------------------------------------------------- data quality

ORDER_RULES = [
    Q.NotNull("order_id"),
    Q.NotNull("customer_id"),
    Q.InSet("status", ["F", "O", "P"]),
    Q.Between("total_amount", 0, 1e9),
    Q.RowCountBetween(1, 1_000_000),
]


def _dq_row_sql(rule, column, n, u, count_rule=False):
    pct = "CAST(NULL AS DOUBLE)" if count_rule else \
        f"CASE WHEN {n} > 0 THEN ROUND(CAST({u} AS DOUBLE) * 100.0 / CAST({n} AS DOUBLE), 4) END"
    ok = f"({u}) = 0" if count_rule else \
        f"CASE WHEN {n} = 0 THEN TRUE ELSE CAST({n} - {u} AS DOUBLE) / CAST({n} AS DOUBLE) >= 1.0 END"
    col = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (f"SELECT '{rule}' AS rule, {col} AS \"column\", CAST({n} AS BIGINT) AS element_count, "
            f"CAST({u} AS BIGINT) AS unexpected_count, {pct} AS unexpected_percent, {ok} AS success FROM a")


DQ_ORDERS_SQL = with_retail(
    " UNION ALL ".join([
        _dq_row_sql("expect_column_values_to_not_be_null", "order_id", "n", "z_oid"),
        _dq_row_sql("expect_column_values_to_not_be_null", "customer_id", "n", "z_cid"),
        _dq_row_sql("expect_column_values_to_be_in_set", "status", "n_status", "bad_status"),
        _dq_row_sql("expect_column_values_to_be_between", "total_amount", "n_total", "bad_total"),
        _dq_row_sql("expect_table_row_count_to_be_between", None, "n",
                    "CASE WHEN n < 1 OR n > 1000000 THEN 1 ELSE 0 END", count_rule=True),
    ]),
    "a AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE order_id IS NULL) AS z_oid, "
    "COUNT(*) FILTER (WHERE customer_id IS NULL) AS z_cid, COUNT(status) AS n_status, "
    "COUNT(*) FILTER (WHERE status IS NOT NULL AND status NOT IN ('F','O','P')) AS bad_status, "
    "COUNT(total_amount) AS n_total, "
    "COUNT(*) FILTER (WHERE total_amount IS NOT NULL AND NOT (total_amount >= 0 AND total_amount <= 1e9)) "
    "AS bad_total FROM app_orders)")


@register("dq_orders", DQ_ORDERS_SQL)
def dq_orders(spark, d):
    return Q.run_suite(T.orders(spark, d), ORDER_RULES)


@register("dq_unique", with_retail(
    "SELECT order_id, line_number, COUNT(*) AS n FROM app_items GROUP BY order_id, line_number "
    "HAVING COUNT(*) > 1"))
def dq_unique(spark, d):
    return Q.duplicate_keys(T.order_items(spark, d), ["order_id", "line_number"])


@register("dq_foreign_key", with_retail(
    "SELECT 'order_items.order_id' AS fk, COUNT(*) AS orphans FROM app_items i "
    "WHERE NOT EXISTS (SELECT 1 FROM app_orders o WHERE o.order_id = i.order_id) "
    "UNION ALL SELECT 'order_items.product_id', COUNT(*) FROM app_items i "
    "WHERE NOT EXISTS (SELECT 1 FROM app_products p WHERE p.product_id = i.product_id) "
    "UNION ALL SELECT 'orders.customer_id', COUNT(*) FROM app_orders o "
    "WHERE NOT EXISTS (SELECT 1 FROM app_customers c WHERE c.customer_id = o.customer_id)"))
def dq_foreign_key(spark, d):
    items, orders = T.order_items(spark, d), T.orders(spark, d)
    checks = [("order_items.order_id", items, orders, "order_id", "order_id"),
              ("order_items.product_id", items, T.products(spark, d), "product_id", "product_id"),
              ("orders.customer_id", orders, T.customers(spark, d), "customer_id", "customer_id")]
    parts = [Q.orphans(ch, pa, ck, pk).agg(F.count(F.lit(1)).alias("orphans"))
             .select(F.lit(name).alias("fk"), "orphans") for name, ch, pa, ck, pk in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("dq_check", with_retail(
    " UNION ALL ".join([
        _dq_row_sql("expect_column_values_to_not_be_null", "order_id", "n", "z_oid"),
        _dq_row_sql("expect_column_values_to_not_be_null", "product_id", "n", "z_pid"),
        _dq_row_sql("expect_rows_to_satisfy", "quantity > 0", "n", "bad_q"),
    ]),
    "a AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE order_id IS NULL) AS z_oid, "
    "COUNT(*) FILTER (WHERE product_id IS NULL) AS z_pid, "
    "COUNT(*) FILTER (WHERE NOT COALESCE(quantity > 0, FALSE)) AS bad_q FROM app_items)"))
def dq_check(spark, d):
    return Q.run_suite(T.order_items(spark, d),
                       [Q.NotNull("order_id"), Q.NotNull("product_id"), Q.Satisfies("quantity > 0", "quantity > 0")])


@register("dq_order_total", with_retail(
    "SELECT o.order_id, o.total_amount, CAST(s.items_total AS DOUBLE) AS items_total, "
    "CAST(CAST(o.total_amount AS DECIMAL(12,2)) - s.items_total AS DOUBLE) AS difference "
    "FROM app_orders o JOIN (SELECT order_id, SUM(CAST(subtotal AS DECIMAL(12,2))) AS items_total "
    "FROM app_items GROUP BY order_id) s ON s.order_id = o.order_id "
    "WHERE CAST(o.total_amount AS DECIMAL(12,2)) <> s.items_total"))
def dq_order_total(spark, d):
    """Reconcile each order's stored total with the sum of its items."""
    s = T.order_items(spark, d).groupBy("order_id").agg(F.sum(money("subtotal")).alias("it"))
    o = T.orders(spark, d).select("order_id", "total_amount")
    j = o.join(s, "order_id").where(money("total_amount") != F.col("it"))
    return j.select("order_id", "total_amount", F.col("it").cast("double").alias("items_total"),
                    (money("total_amount") - F.col("it")).cast("double").alias("difference"))


PROFILE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("dq_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    f"CASE WHEN COUNT(*) > 0 THEN ROUND(CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / "
    f"CAST(COUNT(*) AS DOUBLE), 6) END AS null_fraction, CAST(MIN({c}) AS VARCHAR) AS min_value, "
    f"CAST(MAX({c}) AS VARCHAR) AS max_value FROM orders" for c in PROFILE_COLS))
def dq_profile(spark, d):
    return Q.profile(T.table(spark, d, "orders"), PROFILE_COLS)
