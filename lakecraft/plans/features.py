"""Customer feature table and point-in-time retrieval queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakecraft.functions.scalars import money
from lakecraft.operators import features as FS
from lakecraft.operators.windows import prefix_sums
from lakecraft.plans.registry import register
from lakecraft.sources import tables as T
from lakecraft.sources.tables import with_retail
from lakecraft.session import shared_table

TRAINING_TTL = dt.timedelta(days=30)        # look-back of the training-set join
SERVING_TTL = dt.timedelta(days=30)
LATEST_FROM, LATEST_TO = dt.datetime(2001, 1, 1), dt.datetime(2001, 8, 2)
NOW = dt.datetime(2001, 8, 2)

CUSTOMER_FEATURES = FS.FeatureView(
    name="customer_features", entity="customer_id", timestamp_field="event_timestamp",
    ttl=TRAINING_TTL, features={"total_amount": "double", "order_count": "bigint"})


def customer_features(spark, d):
    """The offline feature table (a stored Parquet source of the feature view):
    built once per session and folder."""
    return shared_table(spark, ("customer_features", d.rstrip("/")), lambda: build_customer_features(spark, d))


def build_customer_features(spark, d):
    """Per customer, cumulative spend and order count, stamped at the end of
    each day with orders (the value becomes known when the day closes).
    Orders are first aggregated per (customer, day), then a segmented running
    sum per customer - a very active customer does not end up in one task."""
    daily = (T.orders(spark, d).groupBy("customer_id", "order_date")
             .agg(F.sum(money("total_amount")).alias("amt"), F.count(F.lit(1)).alias("cnt")))
    run = prefix_sums(daily, {"total": F.col("amt"), "count": F.col("cnt")}, ["order_date"],
                      ["customer_id"])
    return run.select("customer_id",
                      F.date_add("order_date", 1).cast("timestamp_ntz").alias("event_timestamp"),
                      F.col("total").cast("double").alias("total_amount"),
                      F.col("count").cast("long").alias("order_count"))


CF_CTES = """
daily AS (SELECT customer_id, order_date, SUM(CAST(total_amount AS DECIMAL(12,2))) AS amt, COUNT(*) AS cnt
          FROM app_orders GROUP BY customer_id, order_date),
cf AS (SELECT customer_id, CAST(order_date + INTERVAL 1 DAY AS TIMESTAMP) AS event_timestamp,
              CAST(SUM(amt) OVER w AS DOUBLE) AS total_amount, CAST(SUM(cnt) OVER w AS BIGINT) AS order_count
       FROM daily WINDOW w AS (PARTITION BY customer_id ORDER BY order_date ROWS UNBOUNDED PRECEDING))
"""


@register("customer_features", with_retail("SELECT * FROM cf", CF_CTES))
def q_customer_features(spark, d):
    return build_customer_features(spark, d)


@register("feature_asof", with_retail(
    "SELECT r.order_id, r.customer_id, r.request_ts, "
    f"CASE WHEN f.event_timestamp >= r.request_ts - INTERVAL {TRAINING_TTL.days} DAY THEN f.total_amount END AS total_amount, "
    f"CASE WHEN f.event_timestamp >= r.request_ts - INTERVAL {TRAINING_TTL.days} DAY THEN f.order_count END AS order_count, "
    f"CASE WHEN f.event_timestamp >= r.request_ts - INTERVAL {TRAINING_TTL.days} DAY THEN f.event_timestamp END "
    "AS event_timestamp FROM (SELECT order_id, customer_id, created_at AS request_ts FROM app_orders) r "
    "ASOF LEFT JOIN cf f ON r.customer_id = f.customer_id AND r.request_ts >= f.event_timestamp", CF_CTES))
def feature_asof(spark, d):
    requests = T.orders(spark, d).select("order_id", "customer_id", F.col("created_at").alias("request_ts"))
    return FS.as_of_join(requests, customer_features(spark, d), "customer_id", "request_ts", "event_timestamp",
                         list(CUSTOMER_FEATURES.features), CUSTOMER_FEATURES.ttl)


@register("feature_latest", with_retail(
    "SELECT customer_id, event_timestamp, total_amount, order_count FROM ("
    "SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp DESC) AS rn FROM cf "
    f"WHERE event_timestamp > TIMESTAMP '{LATEST_FROM}' AND event_timestamp <= TIMESTAMP '{LATEST_TO}') "
    "WHERE rn = 1", CF_CTES))
def feature_latest(spark, d):
    return FS.materialize_latest(customer_features(spark, d), "customer_id", "event_timestamp",
                                 LATEST_FROM, LATEST_TO)


@register("feature_lookup", with_retail(
    "SELECT c.customer_id, "
    f"CASE WHEN s.event_timestamp >= TIMESTAMP '{NOW}' - INTERVAL {SERVING_TTL.days} DAY THEN s.total_amount END AS total_amount, "
    f"CASE WHEN s.event_timestamp >= TIMESTAMP '{NOW}' - INTERVAL {SERVING_TTL.days} DAY THEN s.order_count END AS order_count, "
    f"CASE WHEN s.event_timestamp >= TIMESTAMP '{NOW}' - INTERVAL {SERVING_TTL.days} DAY THEN s.event_timestamp END AS event_timestamp "
    "FROM app_customers c LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id "
    f"ORDER BY event_timestamp DESC) AS rn FROM cf WHERE event_timestamp <= TIMESTAMP '{NOW}') WHERE rn = 1) s "
    "ON s.customer_id = c.customer_id", CF_CTES))
def feature_lookup(spark, d):
    serving = FS.materialize_latest(customer_features(spark, d), "customer_id", "event_timestamp", None, NOW)
    return FS.lookup(T.customers(spark, d).select("customer_id"), serving, "customer_id", "event_timestamp",
                     ["total_amount", "order_count"], NOW, SERVING_TTL)
