"""Base-table readers and the retail views over them.

The analytical queries are written against the retail data model (customers,
products, orders, order items). Order dates are days, kept as zone-less
midnight timestamps, so every engine and client renders them identically. On
the shipped test data those are views over the TPC-H-like tables; each view is a pure projection, so Catalyst prunes the
scan to the columns a query touches and pushes filters into the Parquet reader.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecraft.functions.scalars import ntz

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one base table (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_id"),
        F.col("c_acctbal").alias("acctbal"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
    )


def orders(spark: SparkSession, sf_dir: str, since=None, until=None) -> DataFrame:
    """Orders by day: ``order_date`` is midnight of the source's date or timestamp.
    ``since`` and ``until`` (dates, both included) bound the source column itself,
    so they reach the scan."""
    raw = table(spark, sf_dir, "orders")
    if since is not None:
        raw = raw.where(F.col("o_orderdate") >= ntz(since))
    if until is not None:
        raw = raw.where(F.col("o_orderdate") < ntz(until + dt.timedelta(days=1)))
    return raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").cast("timestamp_ntz").alias("order_date"),      # a day, zone-less
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("subtotal"),
        F.col("l_shipdate").alias("created_at"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event log; ``ts`` stays a zone-less timestamp so batch windows do not
    depend on the session time zone (streams cast it for watermarks)."""
    return table(spark, sf_dir, "events")


# The same views in SQL, prepended to oracle queries (DuckDB has the base
# tables registered as views of the same names).
RETAIL_CTES = """
app_customers AS (
  SELECT c_custkey AS customer_id, c_name AS full_name, c_mktsegment AS segment,
         c_nationkey AS nation_id, c_acctbal AS acctbal
  FROM customer),
app_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         p_brand AS brand, p_retailprice AS price
  FROM part),
app_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS order_date,
         o_totalprice AS total_amount, o_orderstatus AS status, o_orderdate AS created_at
  FROM orders),
app_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS subtotal, l_shipdate AS created_at
  FROM lineitem)
"""


def with_retail(sql_body: str, extra_ctes: str = "") -> str:
    """Prefix ``sql_body`` with the retail CTEs (plus optional more CTEs)."""
    ctes = RETAIL_CTES.strip()
    if extra_ctes.strip():
        ctes = ctes + ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{sql_body.strip()}"
