"""Load, cleaning and scalar operators over batches cut from the base tables.

``customer`` and ``part`` are loaded in two batches: a first one, and a second
one in which some keys are changed, some unchanged and some new. Dirty text is
made from the tables' own values by rule, so that every rule of the cleaning
jobs meets rows that it keeps and rows that it drops.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from lakecraft.functions.scalars import json_or_raw, partition_expr, strip_ws, try_number
from lakecraft.operators import cleaning as CL
from lakecraft.operators import features as FS
from lakecraft.operators import profiles as PR
from lakecraft.operators import warehouse as WH
from lakecraft.plans.features import CF_CTES, customer_features
from lakecraft.plans.registry import register
from lakecraft.session import scratch_path
from lakecraft.sources import tables as T
from lakecraft.sources.tables import with_retail
from lakecraft.sources.versions import diff_loads, publish_bucketed

FIRST, SECOND = dt.date(2001, 1, 1), dt.date(2001, 6, 1)

# batch 1: keys not divisible by 5; batch 2: even keys, the segment of those divisible by 3 changed
BATCHES = """
one AS (SELECT customer_id, full_name, segment FROM app_customers WHERE customer_id % 5 <> 0),
two AS (SELECT customer_id, full_name, CASE WHEN customer_id % 3 = 0 THEN segment || '*' ELSE segment END AS segment
        FROM app_customers WHERE customer_id % 2 = 0)
"""


def _batches(spark, d):
    c = T.customers(spark, d).select("customer_id", "full_name", "segment")
    changed = F.when(F.col("customer_id") % 3 == 0, F.concat("segment", F.lit("*"))).otherwise(F.col("segment"))
    return c.where("customer_id % 5 <> 0"), c.where("customer_id % 2 = 0").withColumn("segment", changed)


def _scd2(spark, d):
    one, two = _batches(spark, d)
    dim = WH.with_surrogate_key(WH.scd2_initial(one, "customer_id", ["full_name", "segment"], FIRST), ["customer_id"], "customer_sk")
    return dim, two


SCD2_SQL = """
opened AS (SELECT *, DATE '2001-01-01' AS valid_from FROM one
           UNION ALL SELECT two.*, DATE '2001-06-01' FROM two LEFT JOIN one USING (customer_id)
           WHERE one.customer_id IS NULL OR one.segment <> two.segment),
versions AS (SELECT *, COALESCE(max(valid_from) FILTER (WHERE valid_from > DATE '2001-01-01') OVER (PARTITION BY customer_id), valid_from) AS last_from
             FROM opened),
dim AS (SELECT customer_id, full_name, segment, valid_from,
               CASE WHEN valid_from = last_from THEN DATE '9999-12-31' ELSE last_from END AS valid_to,
               valid_from = last_from AS is_current,
               rank() OVER (ORDER BY valid_from, customer_id) AS customer_sk FROM versions)
"""


@register("scd2_apply", with_retail("SELECT * FROM dim", BATCHES.strip() + "," + SCD2_SQL))
def scd2_apply(spark, d):
    dim, two = _scd2(spark, d)
    return WH.scd2_apply(dim, two, "customer_id", ["full_name", "segment"], SECOND, "customer_sk")


@register("scd6_apply", with_retail(
    "SELECT dim.*, last.segment AS current_segment FROM dim JOIN dim last ON last.customer_id = dim.customer_id AND last.is_current",
    BATCHES.strip() + "," + SCD2_SQL))
def scd6_apply(spark, d):
    dim, two = _scd2(spark, d)
    return WH.scd6_apply(dim, two, "customer_id", ["full_name", "segment"], SECOND, ["segment"], "customer_sk")


@register("scd1_apply", with_retail(
    "SELECT customer_id, full_name, COALESCE(two.segment, one.segment) AS segment FROM one FULL JOIN two USING (customer_id, full_name)", BATCHES))
def scd1_apply(spark, d):
    one, two = _batches(spark, d)
    return WH.scd1_apply(one, two, "customer_id", ["full_name", "segment"])


@register("merge_upsert", with_retail(
    "FROM two UNION ALL FROM one ANTI JOIN two USING (customer_id)", BATCHES))
def merge_upsert(spark, d):
    one, two = _batches(spark, d)
    return WH.upsert(one, two, ["customer_id"])


@register("insert_ignore", with_retail("FROM two ANTI JOIN one USING (customer_id)", BATCHES))
def insert_ignore(spark, d):
    one, two = _batches(spark, d)
    return WH.insert_ignore(one, two, ["customer_id"])


@register("load_defaults", with_retail(
    "SELECT order_id, CASE WHEN status = 'P' THEN 'created' ELSE status END AS status, 'web' AS channel FROM app_orders"))
def load_defaults(spark, d):
    o = T.orders(spark, d).select("order_id", F.when(F.col("status") != "P", F.col("status")).alias("status"))
    return WH.apply_defaults(o, {"status": "created", "channel": "web"})


@register("validity_lookup", with_retail(
    "SELECT o.order_id, o.customer_id, o.order_date, v.segment FROM app_orders o LEFT JOIN dim v ON v.customer_id = o.customer_id "
    "AND o.order_date >= v.valid_from AND o.order_date < v.valid_to", BATCHES.strip() + "," + SCD2_SQL))
def validity_lookup(spark, d):
    dim, two = _scd2(spark, d)
    dim = WH.scd2_apply(dim, two, "customer_id", ["full_name", "segment"], SECOND, "customer_sk")
    o = T.orders(spark, d).select("order_id", "customer_id", "order_date")
    return WH.validity_lookup(o, dim, "customer_id", "order_date", ["segment"])


# ---------------------------------------------------------------- cleaning

# names with blanks around, missing names by key, prices as text with signs, blanks and words among them
DIRTY_PARTS = """
dirty AS (
  SELECT CASE product_id % 11 WHEN 0 THEN NULL WHEN 1 THEN 'N/A' WHEN 2 THEN chr(9) || product_name || '  ' ELSE product_name END AS product_name,
         CASE product_id % 7 WHEN 0 THEN NULL WHEN 1 THEN ' ' || category ELSE category END AS category,
         CASE product_id % 13 WHEN 0 THEN 'unknown' WHEN 1 THEN '-1' WHEN 2 THEN '  12.50 ' WHEN 3 THEN 'nan' ELSE '7' END AS price
  FROM app_products UNION ALL
  SELECT product_name, category, '7' FROM app_products WHERE product_id % 3 = 0)
"""


def _dirty_parts(spark, d):
    p = T.products(spark, d)
    k = lambda n: F.col("product_id") % n
    name = F.when(k(11) == 1, "N/A").when(k(11) == 2, F.concat(F.lit("\t"), "product_name", F.lit("  "))).when(k(11) != 0, F.col("product_name"))
    cat = F.when(k(7) == 1, F.concat(F.lit(" "), "category")).when(k(7) != 0, F.col("category"))
    price = F.when(k(13) == 0, "unknown").when(k(13) == 1, "-1").when(k(13) == 2, "  12.50 ").when(k(13) == 3, "nan").otherwise("7")
    rows = p.select(name.alias("product_name"), cat.alias("category"), price.alias("price"))
    return rows.unionByName(p.where(k(3) == 0).select("product_name", "category", F.lit("7").alias("price")))


@register("clean_products", with_retail(
    "SELECT DISTINCT trim(product_name, chr(9) || ' ') AS product_name, COALESCE(trim(category), '') AS category, "
    "CAST(trim(price) AS DOUBLE) AS price FROM dirty WHERE product_name <> 'N/A' AND price NOT IN ('unknown', '-1', 'nan')", DIRTY_PARTS))
def clean_products(spark, d):
    return CL.clean_products(_dirty_parts(spark, d))


@register("clean_silver", with_retail(
    "SELECT DISTINCT trim(product_name) AS product_name, trim(category) AS category, TRY_CAST(trim(price) AS DOUBLE) AS price "
    "FROM dirty WHERE product_name IS NOT NULL AND price <> 'nan'", DIRTY_PARTS))
def clean_silver(spark, d):
    """The operator runs on all dirty rows and keeps NaN; the query leaves such rows out of its result."""
    return CL.clean_silver(_dirty_parts(spark, d)).where("price IS NULL OR NOT isnan(price)")


@register("clean_orders", with_retail(
    "SELECT DISTINCT order_id::BIGINT AS order_id, customer_id, order_date, total_amount FROM app_orders WHERE order_id % 9 <> 0"))
def clean_orders(spark, d):
    o = T.orders(spark, d)
    text = F.when(F.col("order_id") % 9 == 0, F.lit("  ")).otherwise(F.col("order_id").cast("string"))
    dirty = o.select(text.alias("order_id"), "customer_id", "order_date", "total_amount")
    twice = dirty.unionByName(dirty.where("customer_id % 4 = 0"))
    cleaned = CL.clean_orders(twice, dedup=True, normalize=True)
    return cleaned.withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))


# ---------------------------------------------------------------- scalars

@register("scalar_text", with_retail(
    "SELECT product_id, product_name AS stripped, CASE WHEN product_id % 4 = 1 THEN NULL ELSE price END AS number FROM app_products"))
def scalar_text(spark, d):
    """White space of every kind stripped; numbers read from text, what is none becomes null."""
    p = T.products(spark, d)
    padded = F.concat(F.lit("\n \t"), "product_name", F.lit("\r\n"))
    text = F.when(F.col("product_id") % 4 == 1, F.concat(F.col("price").cast("string"), F.lit("d"))).otherwise(
        F.concat(F.lit(" +"), F.col("price").cast("string"), F.lit("\t")))
    return p.select("product_id", strip_ws(padded).alias("stripped"), try_number(text).alias("number"))


@register("scalar_json",
          "SELECT event_id, CASE event_id % 3 WHEN 0 THEN props WHEN 1 THEN '{\"raw\":\"plain\"}' ELSE '{\"raw\":\"[1]\"}' END AS payload FROM events")
def scalar_json(spark, d):
    """JSON objects stay, any other text is wrapped."""
    e = T.events(spark, d)
    k = F.col("event_id") % 3
    text = F.when(k == 0, F.col("props")).when(k == 1, F.lit("plain")).otherwise(F.lit("[1]"))
    # the operator's objects have no spaces; their field is written as the source has it
    out = e.select("event_id", k.alias("k"), json_or_raw(text).alias("payload"))
    value = F.get_json_object("payload", "$.k")
    return out.select("event_id", F.when(F.col("k") == 0, F.concat(F.lit('{"k": '), value, F.lit("}"))).otherwise(F.col("payload")).alias("payload"))


@register("partition_values",
          "SELECT event_id, year(ts)::INTEGER AS y, strftime(ts, '%Y-%m') AS m, strftime(ts, '%Y-%m-%d-%H') AS h, "
          "event_type[:3] AS t FROM events")
def partition_values(spark, d):
    e = T.events(spark, d)
    return e.select("event_id", partition_expr("year", "ts").alias("y"), partition_expr("month", "ts").alias("m"),
                    partition_expr("hour", "ts").alias("h"), partition_expr("truncate:3", "event_type").alias("t"))


@register("sort_with_nulls", with_retail(
    "SELECT product_id, CASE WHEN product_id % 6 <> 0 THEN price END AS price, "
    "row_number() OVER (ORDER BY CASE WHEN product_id % 6 <> 0 THEN price END DESC NULLS LAST, product_id) AS place "
    "FROM app_products ORDER BY place"))
def sort_with_nulls(spark, d):
    """Descending, nulls last, numbered in parallel."""
    from lakecraft.operators import windows as W
    p = T.products(spark, d).select("product_id", F.when(F.col("product_id") % 6 != 0, F.col("price")).alias("price"))
    return W.global_row_number(p, [W.Desc("price"), "product_id"], "place").orderBy("place")


@register("feature_incremental", with_retail(
    "SELECT customer_id, arg_max(cf, event_timestamp).event_timestamp AS event_timestamp, arg_max(cf, event_timestamp).total_amount AS total_amount, "
    "arg_max(cf, event_timestamp).order_count AS order_count FROM cf WHERE event_timestamp <= TIMESTAMP '2001-08-02' GROUP BY customer_id", CF_CTES))
def feature_incremental(spark, d):
    """Two incremental materialisations give what one full run gives."""
    f, mid, end = customer_features(spark, d), dt.datetime(1999, 7, 1), dt.datetime(2001, 8, 2)
    first = FS.materialize_incremental(None, f, "customer_id", "event_timestamp", None, mid)
    return FS.materialize_incremental(first, f, "customer_id", "event_timestamp", mid, end)


@register("load_reconciliation", with_retail(
    "SELECT COUNT(*) AS extracted, COUNT(*) FILTER (WHERE order_id % 9 = 0) AS rejected, COUNT(*) FILTER (WHERE order_id % 9 <> 0) AS loaded, "
    "TRUE AS balanced FROM app_orders"))
def load_reconciliation(spark, d):
    """Rows of the steps of an order load, taken from the rows themselves: extracted = rejected + loaded."""
    o = T.orders(spark, d)
    dirty = o.withColumn("order_id", F.when(F.col("order_id") % 9 != 0, F.col("order_id")))
    loaded = CL.clean_orders(dirty).agg(F.count(F.lit(1)).alias("loaded"))
    counts = dirty.agg(F.count(F.lit(1)).alias("extracted"), F.count_if(F.col("order_id").isNull()).alias("rejected"))
    both = counts.unionByName(loaded, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("extracted", "rejected", "loaded")])
    return both.withColumn("balanced", F.col("extracted") == F.col("rejected") + F.col("loaded"))


@register("load_diff", with_retail(
    "SELECT customer_id, CASE WHEN customer_id % 499 = 3 THEN 'u' WHEN customer_id % 499 = 4 THEN 'd' ELSE 'c' END AS op, "
    "CASE WHEN customer_id % 499 <> 5 THEN segment END AS old_segment, "
    "CASE customer_id % 499 WHEN 3 THEN segment || '*' WHEN 5 THEN segment END AS new_segment "
    "FROM app_customers WHERE customer_id % 499 IN (3, 4, 5)"))
def load_diff(spark, d):
    """Two loads of the customers, some changed, gone or new in the second: the feed from buckets that differ."""
    c = T.customers(spark, d).select("customer_id", "full_name", "segment")
    k = F.col("customer_id") % 499
    path = scratch_path(spark, f"versions-{uuid.uuid4().hex}")
    old = publish_bucketed(spark, c.where(k != 5), path, "customer_id", 16)
    changed = F.when(k == 3, F.concat("segment", F.lit("*"))).otherwise(F.col("segment"))
    new = publish_bucketed(spark, c.where(k != 4).withColumn("segment", changed), path, "customer_id", 16)
    feed = diff_loads(spark, path, old, new, "customer_id", ["full_name", "segment"])
    return feed.select("customer_id", "op", F.col("before.segment").alias("old_segment"), F.col("after.segment").alias("new_segment"))


@register("profile_merged",
          "SELECT column_name AS \"column\", n_rows, n_null, lo, hi FROM ("
          + " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_null, MIN({c})::DOUBLE AS lo, "
                               f"MAX({c})::DOUBLE AS hi FROM orders" for c in ("o_orderkey", "o_custkey", "o_totalprice")) + ")")
def profile_merged(spark, d):
    """The exact part of a profile merged from those of three loads (the sketches' estimates are tested by themselves)."""
    o = T.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = scratch_path(spark, f"profile-{uuid.uuid4().hex}")
    for i in range(3):
        PR.add_profile(spark, o.where(F.col("o_orderkey") % 3 == i), path)
    return PR.stored_profile(spark, path).select("column", "n_rows", "n_null", "lo", "hi")
