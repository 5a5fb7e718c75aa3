"""Star-schema mart (dim_date, SCD2 dimensions, fact_sales) and the queries
over it: the seven business cases and the mart reports.

The mart is derived inside each query from the base tables, so every query's
work grows with the data. Surrogate keys are dense and deterministic (ordered
by the natural key), computed with the parallel global row number.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakecraft.functions.scalars import money, money_sum
from lakecraft.operators import warehouse as WH
from lakecraft.operators.windows import latest_per_key
from lakecraft.plans.params import AS_OF, AS_OF_SQL
from lakecraft.plans.registry import register
from lakecraft.session import checkpoint_dir, materialize, source_state
from lakecraft.sources import tables as T
from lakecraft.sources.tables import with_retail

CUSTOMER_ATTRS = ["full_name", "segment", "nation_id"]
PRODUCT_ATTRS = ["product_name", "category", "price"]


#: The columns of an order item; rows equal in all of them are items of their own, numbered by ``occurrence``.
ITEM_KEY = ["order_id", "line_number", "product_id", "created_at", "quantity", "subtotal"]


class Mart:
    """The star schema derived from the base tables, as of a date.

    The dimensions and the fact table are stored once (Parquet tables in the
    shared checkpoint folder) and then read by every mart query of the session,
    until a source file changes. Parts are built on first use only.
    """

    def __init__(self, spark, d, as_of):
        self.customers, self.products = T.customers(spark, d), T.products(spark, d)
        self.orders, self.items = T.orders(spark, d), T.order_items(spark, d)
        self.as_of = as_of

    def _dimension(self, rows, key, attrs, sk):
        return materialize(WH.with_surrogate_key(WH.scd2_initial(rows, key, attrs, self.as_of), [key, "valid_from"], sk), "dim")

    @cached_property
    def dim_customer(self):
        return self._dimension(self.customers, "customer_id", CUSTOMER_ATTRS, "customer_sk")

    @cached_property
    def dim_product(self):
        return self._dimension(self.products, "product_id", PRODUCT_ATTRS, "product_sk")

    @cached_property
    def dim_date(self):
        return WH.dim_date(self.orders, "order_date", self.as_of)

    @cached_property
    def fact(self):
        return materialize(WH.fact_sales(self.items, self.orders, self.dim_customer, self.dim_product), "fact_sales")

    @cached_property
    def fact_with_id(self):
        order = ["order_id", "line_number", "product_id", "created_at", "quantity", "amount"]
        return WH.with_surrogate_key(self.fact, order, "fact_sales_id")


_MARTS: dict = {}


def _mart_key(spark, d, as_of):
    return spark.sparkContext.applicationId, d.rstrip("/"), as_of, source_state(spark, d)


def build_mart(spark, d, as_of=AS_OF) -> Mart:
    """The session's mart over the tables in ``d`` (built on first use, again when a file of ``d`` changes)."""
    checkpoint_dir(spark)
    key = _mart_key(spark, d, as_of)
    if key not in _MARTS:
        _MARTS[key] = Mart(spark, d, as_of)
    return _MARTS[key]


# The mart in SQL. Each dimension has one open version per key, numbered by key.
MART_CTES = f"""
calendar(d) AS (
  SELECT unnest(range(
    (SELECT COALESCE(MIN(CAST(order_date AS DATE)), {AS_OF_SQL}) FROM app_orders) - INTERVAL 12 MONTH,
    (SELECT COALESCE(MAX(CAST(order_date AS DATE)), {AS_OF_SQL}) FROM app_orders) + INTERVAL 12 MONTH + INTERVAL 1 DAY,
    INTERVAL 1 DAY))),
days AS (
  SELECT year(d)::INTEGER * 10000 + month(d)::INTEGER * 100 + day(d)::INTEGER AS date_key, d::TIMESTAMP AS date_actual,
         year(d)::INTEGER AS year, month(d)::INTEGER AS month, isodow(d)::INTEGER AS day_of_week,
         day(d)::INTEGER AS day_of_month, quarter(d)::INTEGER AS quarter,
         year(d)::INTEGER * 100 + month(d)::INTEGER AS year_month
  FROM calendar),
buyers AS (
  SELECT rank() OVER (ORDER BY customer_id) AS customer_sk, customer_id, full_name, segment, nation_id
  FROM app_customers),
goods AS (
  SELECT rank() OVER (ORDER BY product_id) AS product_sk, product_id, product_name, category, price
  FROM app_products),
sales AS (
  SELECT item.order_id, item.line_number, year(ord.order_date)::INTEGER * 10000 + month(ord.order_date)::INTEGER * 100
           + day(ord.order_date)::INTEGER AS date_key, buyers.customer_sk, goods.product_sk, item.product_id, item.quantity,
         item.subtotal AS amount, item.created_at, ord.order_date
  FROM app_items item, app_orders ord, buyers, goods
  WHERE item.order_id = ord.order_id AND ord.customer_id = buyers.customer_id AND item.product_id = goods.product_id)
"""


def mart_sql(body: str, extra: str = "") -> str:
    ctes = MART_CTES.strip()
    if extra.strip():
        ctes += ",\n" + extra.strip()
    return with_retail(body, ctes)


def _money_sql(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(12,2))) AS DOUBLE)"


# ---------------------------------------------------------------- the mart itself

VERSION_SQL = f"{AS_OF_SQL} AS valid_from, DATE '9999-12-31' AS valid_to, TRUE AS is_current"
SALES_SUM = "SUM(amount::DECIMAL(12,2))"


@register("dim_date", mart_sql("FROM days"))
def q_dim_date(spark, d):
    return WH.dim_date(T.orders(spark, d), "order_date", AS_OF)


@register("dim_customer", mart_sql(f"SELECT *, {VERSION_SQL} FROM buyers"))
def q_dim_customer(spark, d):
    return build_mart(spark, d).dim_customer


@register("dim_product", mart_sql(f"SELECT *, {VERSION_SQL} FROM goods"))
def q_dim_product(spark, d):
    return build_mart(spark, d).dim_product


@register("fact_sales", mart_sql(
    "SELECT row_number() OVER (ORDER BY order_id, line_number, product_id, created_at, quantity, amount) AS fact_sales_id, * FROM sales"))
def q_fact_sales(spark, d):
    return build_mart(spark, d).fact_with_id


# ---------------------------------------------------------------- business cases

@register("b01_top3_customers", mart_sql(
    "SELECT buyers.full_name, spent.total::DOUBLE AS revenue, "
    "1 + (SELECT COUNT(*) FROM spent more WHERE more.total > spent.total) AS rn "
    "FROM spent JOIN buyers USING (customer_sk) WHERE (SELECT COUNT(*) FROM spent more WHERE more.total > spent.total) < 3",
    f"spent AS (SELECT customer_sk, {SALES_SUM} AS total FROM sales GROUP BY ALL)"))
def b01_top3_customers(spark, d):
    m = build_mart(spark, d)
    rev = m.fact.groupBy("customer_sk").agg(F.sum(money("amount")).alias("revenue"))
    ranked = (m.dim_customer.where("is_current").join(rev, "customer_sk")
              .withColumn("rn", F.rank().over(Window.orderBy(F.col("revenue").desc())).cast("long")))
    # rank <= 3 plans a partial WindowGroupLimit: each task forwards its top rows only
    return ranked.where(F.col("rn") <= 3).select(
        "full_name", F.col("revenue").cast("double").alias("revenue"), "rn")


@register("b02_daily_running", mart_sql(
    "SELECT x.order_date, x.r::DOUBLE AS daily_revenue, SUM(y.r)::DOUBLE AS running_total "
    "FROM per_day x JOIN per_day y ON y.order_date <= x.order_date GROUP BY x.order_date, x.r",
    f"per_day AS (SELECT order_date, {SALES_SUM} AS r FROM sales GROUP BY ALL)"))
def b02_daily_running(spark, d):
    daily = build_mart(spark, d).fact.groupBy("order_date").agg(F.sum(money("amount")).alias("rev"))
    # one row per calendar day: the ordered window runs on a table bounded by the date span
    w = Window.orderBy("order_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("order_date", F.col("rev").cast("double").alias("daily_revenue"),
                        F.sum("rev").over(w).cast("double").alias("running_total"))


@register("b03_category_share", mart_sql(
    "SELECT category, total::DOUBLE AS revenue, "
    f"ROUND(100.0 * total::DOUBLE / (SELECT {SALES_SUM} FROM sales)::DOUBLE, 2) AS pct_of_total FROM by_category",
    f"by_category AS (SELECT category, {SALES_SUM} AS total FROM sales JOIN goods USING (product_sk) GROUP BY ALL)"))
def b03_category_share(spark, d):
    m = build_mart(spark, d)
    cat = (m.fact.join(m.dim_product.where("is_current"), "product_sk")
           .groupBy("category").agg(F.sum(money("amount")).alias("rev")))
    # the category table is tiny; its total is an unpartitioned window over it
    total = F.sum("rev").over(Window.partitionBy())
    return cat.select("category", F.col("rev").cast("double").alias("revenue"),
                      F.round(100.0 * F.col("rev").cast("double") / total.cast("double"), 2)
                      .alias("pct_of_total"))


@register("b04_month_over_month", mart_sql(
    "SELECT y AS year, m AS month, now.r::DOUBLE AS revenue, prior.r::DOUBLE AS prev_month_revenue, "
    "(now.r - prior.r)::DOUBLE AS diff_vs_prev FROM numbered now LEFT JOIN (SELECT n + 1 AS n, r FROM numbered) prior USING (n)",
    "by_month AS (SELECT year(order_date)::INTEGER AS y, month(order_date)::INTEGER AS m, "
    f"{SALES_SUM} AS r FROM sales GROUP BY ALL), numbered AS (SELECT *, rank() OVER (ORDER BY y, m) AS n FROM by_month)"))
def b04_month_over_month(spark, d):
    m = build_mart(spark, d)
    monthly = (m.fact.join(m.dim_date, "date_key").groupBy("year", "month")
               .agg(F.sum(money("amount")).alias("rev")))
    w = Window.orderBy("year", "month")          # one row per month
    prev = F.lag("rev").over(w)
    return monthly.select("year", "month", F.col("rev").cast("double").alias("revenue"),
                          prev.cast("double").alias("prev_month_revenue"),
                          (F.col("rev") - prev).cast("double").alias("diff_vs_prev"))


@register("b05_returning_gap", with_retail(
    "SELECT customer_id, full_name FROM app_customers WHERE customer_id IN (SELECT customer_id FROM age WHERE days BETWEEN 0 AND 9) "
    "AND customer_id NOT IN (SELECT customer_id FROM age WHERE days BETWEEN 10 AND 19)",
    f"age AS (SELECT customer_id, date_diff('day', CAST(order_date AS DATE), {AS_OF_SQL}) AS days FROM app_orders)"))
def b05_returning_gap(spark, d):
    day = dt.timedelta(days=1)
    recent = T.orders(spark, d, since=AS_OF - 9 * day, until=AS_OF)
    gap = T.orders(spark, d, since=AS_OF - 19 * day, until=AS_OF - 10 * day)
    return (T.customers(spark, d).select("customer_id", "full_name")
            .join(recent.select("customer_id").distinct(), "customer_id", "left_semi")
            .join(gap.select("customer_id").distinct(), "customer_id", "left_anti"))


@register("b06_dedup_latest", with_retail(
    "SELECT order_id, line_number, best.product_id, best.quantity, best.subtotal, best.created_at FROM ("
    "SELECT order_id, line_number, max({'created_at': created_at, 'product_id': product_id, 'quantity': quantity, "
    "'subtotal': subtotal}) AS best FROM app_items GROUP BY ALL)"))
def b06_dedup_latest(spark, d):
    items = T.order_items(spark, d)
    return latest_per_key(items, ["order_id", "line_number"], ["created_at", "product_id", "quantity", "subtotal"])


def items_after(spark, d, last_day):
    """Items of the orders placed after ``last_day`` (the highest day a caller has loaded)."""
    o = T.orders(spark, d, since=None if last_day is None else last_day + dt.timedelta(days=1))
    return (T.order_items(spark, d).join(o.select("order_id", "order_date"), "order_id")
            .select("order_id", "line_number", "order_date", "product_id", "quantity", "subtotal"))


@register("b07_incremental", with_retail(
    "SELECT order_id, line_number, order_date, product_id, quantity, subtotal FROM app_items "
    f"NATURAL JOIN (SELECT order_id, order_date FROM app_orders WHERE date_diff('day', CAST(order_date AS DATE), {AS_OF_SQL}) < 7) "
    "ORDER BY order_date, order_id, line_number"))
def b07_incremental(spark, d):
    return items_after(spark, d, AS_OF - dt.timedelta(days=7)).orderBy("order_date", "order_id", "line_number")


# ---------------------------------------------------------------- mart reports

@register("monthly_revenue", mart_sql(
    f"SELECT days.year, days.month, {SALES_SUM}::DOUBLE AS revenue FROM sales JOIN days USING (date_key) GROUP BY ALL"))
def monthly_revenue(spark, d):
    m = build_mart(spark, d)
    return m.fact.join(m.dim_date, "date_key").groupBy("year", "month").agg(money_sum("amount").alias("revenue"))


@register("revenue_by_quarter", mart_sql(
    f"SELECT days.year, days.quarter, {SALES_SUM}::DOUBLE AS revenue FROM sales JOIN days USING (date_key) GROUP BY ALL"))
def revenue_by_quarter(spark, d):
    m = build_mart(spark, d)
    return m.fact.join(m.dim_date, "date_key").groupBy("year", "quarter").agg(money_sum("amount").alias("revenue"))


@register("mart_customer_revenue", mart_sql(
    f"SELECT customer_id, full_name, {SALES_SUM}::DOUBLE AS revenue FROM buyers JOIN sales USING (customer_sk) GROUP BY ALL"))
def mart_customer_revenue(spark, d):
    m = build_mart(spark, d)
    rev = m.fact.groupBy("customer_sk").agg(F.sum(money("amount")).alias("r"))
    return (m.dim_customer.join(rev, "customer_sk").groupBy("customer_id", "full_name")
            .agg(F.sum("r").cast("double").alias("revenue")))


@register("mart_product_revenue", mart_sql(
    f"SELECT goods.product_id, product_name, {SALES_SUM}::DOUBLE AS revenue, SUM(quantity)::BIGINT AS quantity "
    "FROM goods JOIN sales USING (product_sk) GROUP BY ALL"))
def mart_product_revenue(spark, d):
    m = build_mart(spark, d)
    rev = m.fact.groupBy("product_sk").agg(F.sum(money("amount")).alias("r"), F.sum("quantity").alias("q"))
    return (m.dim_product.join(rev, "product_sk").groupBy("product_id", "product_name")
            .agg(F.sum("r").cast("double").alias("revenue"), F.sum("q").cast("long").alias("quantity")))


@register("top5_products", mart_sql(
    "SELECT product_sk, product_name, total::DOUBLE AS revenue FROM (SELECT product_sk, product_name, "
    f"{SALES_SUM} AS total FROM goods JOIN sales USING (product_sk) GROUP BY ALL) ORDER BY total DESC, product_sk LIMIT 5"))
def top5_products(spark, d):
    m = build_mart(spark, d)
    rev = m.fact.groupBy("product_sk").agg(F.sum(money("amount")).alias("r"))
    return (m.dim_product.join(rev, "product_sk")
            .orderBy(F.col("r").desc(), "product_sk").limit(5)
            .select("product_sk", "product_name", F.col("r").cast("double").alias("revenue")))


@register("mart_row_counts", mart_sql(" UNION ALL ".join(
    f"SELECT '{name}' AS tbl, COUNT(*) AS n FROM {cte}"
    for name, cte in (("fact_sales", "sales"), ("dim_date", "days"), ("dim_customer", "buyers"), ("dim_product", "goods")))))
def mart_row_counts(spark, d):
    m = build_mart(spark, d)
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")
             for name, df in (("dim_date", m.dim_date), ("dim_customer", m.dim_customer),
                              ("dim_product", m.dim_product), ("fact_sales", m.fact))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("mart_integrity", mart_sql(
    "SELECT (SELECT COUNT(*) FROM sales) AS fact_rows, (SELECT COUNT(*) FROM sales SEMI JOIN days USING (date_key)) AS with_date, "
    "(SELECT COUNT(*) FROM sales SEMI JOIN buyers USING (customer_sk)) AS with_customer, "
    "(SELECT COUNT(*) FROM sales SEMI JOIN goods USING (product_sk)) AS with_product"))
def mart_integrity(spark, d):
    m = build_mart(spark, d)
    f = (m.fact.join(m.dim_date.select("date_key", F.lit(1).alias("_d")), "date_key", "left")
         .join(m.dim_customer.select("customer_sk", F.lit(1).alias("_c")), "customer_sk", "left")
         .join(m.dim_product.select("product_sk", F.lit(1).alias("_p")), "product_sk", "left"))
    return f.agg(F.count(F.lit(1)).alias("fact_rows"), F.count("_d").alias("with_date"),
                 F.count("_c").alias("with_customer"), F.count("_p").alias("with_product"))


@register("mart_reconciles", with_retail(
    "SELECT COUNT(*) AS items, COUNT(*) AS fact_rows, SUM(subtotal::DECIMAL(12,2))::DOUBLE AS item_revenue, "
    "SUM(subtotal::DECIMAL(12,2))::DOUBLE AS fact_revenue, TRUE AS equal "
    "FROM (SELECT DISTINCT * FROM app_items) WHERE order_id IN (SELECT order_id FROM app_orders)"))
def mart_reconciles(spark, d):
    """The mart holds every item: its rows and revenue against those of the items with an order."""
    items = T.order_items(spark, d).join(T.orders(spark, d).select("order_id"), "order_id", "left_semi").distinct()
    left = items.agg(F.count(F.lit(1)).alias("items"), money_sum("subtotal").alias("item_revenue"))
    right = build_mart(spark, d).fact.agg(F.count(F.lit(1)).alias("fact_rows"), money_sum("amount").alias("fact_revenue"))
    cols = ["items", "fact_rows", "item_revenue", "fact_revenue"]
    both = left.unionByName(right, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in cols])     # of two rows
    same = (F.col("items") == F.col("fact_rows")) & F.col("item_revenue").eqNullSafe(F.col("fact_revenue"))
    return both.select(*cols, same.alias("equal"))
