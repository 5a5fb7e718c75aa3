"""Change-data queries over an order change feed derived from the tables.

The feed is what log-based capture of the orders table would emit: a create
(``c``) when the order is placed (status ``O``), an update (``u``) when its
last item ships (status becomes the order's final status) and a delete
(``d``) 30 days after placement for orders that never got items. It is built
with joins and aggregates over ``orders``/``lineitem``, so it grows with them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from lakecraft.functions.scalars import epoch_millis, ntz
from lakecraft.operators import cdc as C
from lakecraft.plans.registry import register
from lakecraft.sources import tables as T
from lakecraft.sources.tables import with_retail
from lakecraft.session import scratch_path, shared_table
from lakecraft.sources.summaries import Summary, apply_changes, read_summary

ROW_COLS = ["order_id", "customer_id", "status", "total_amount"]
DIFF_AT = dt.datetime(2000, 1, 1)            # the "old" snapshot time of cdc_diff
DIFF_AT_MS = int(DIFF_AT.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def order_change_feed(spark, d):
    """The change topic as landed in bronze: built once per session and folder."""
    return shared_table(spark, ("order_changes", d.rstrip("/")), lambda: build_order_change_feed(spark, d))


def build_order_change_feed(spark, d):
    o = T.orders(spark, d)
    shipped = T.order_items(spark, d).groupBy("order_id").agg(F.max("created_at").alias("shipped_at"))
    j = o.join(shipped, "order_id", "left")

    def image(status):
        return F.struct(F.col("order_id"), F.col("customer_id"), status.alias("status"), F.col("total_amount"))

    row_type = o.select(image(F.col("status")).alias("r")).schema["r"].dataType
    ms = epoch_millis
    creates = o.select(F.lit("c").alias("op"), ms(F.col("created_at")).alias("ts_ms"), F.lit(0).alias("seq"),
                       F.lit(None).cast(row_type).alias("before"), image(F.lit("O")).alias("after"))
    updates = j.where(F.col("shipped_at").isNotNull()).select(
        F.lit("u").alias("op"), ms(F.col("shipped_at")).alias("ts_ms"), F.lit(1).alias("seq"),
        image(F.lit("O")).alias("before"), image(F.col("status")).alias("after"))
    deletes = j.where(F.col("shipped_at").isNull()).select(
        F.lit("d").alias("op"), ms(F.col("created_at") + F.expr("INTERVAL 30 DAYS")).alias("ts_ms"),
        F.lit(1).alias("seq"), image(F.lit("O")).alias("before"), F.lit(None).cast(row_type).alias("after"))
    return creates.unionByName(updates).unionByName(deletes)


FEED_CTES = """
shipped AS (SELECT order_id, MAX(created_at) AS shipped_at FROM app_items GROUP BY order_id),
feed AS (
  SELECT 'c' AS op, epoch_ms(o.created_at) AS ts_ms, 0 AS seq, o.order_id, o.customer_id,
         'O' AS status, o.total_amount FROM app_orders o
  UNION ALL
  SELECT 'u', epoch_ms(s.shipped_at), 1, o.order_id, o.customer_id, o.status, o.total_amount
  FROM app_orders o JOIN shipped s ON s.order_id = o.order_id
  UNION ALL
  SELECT 'd', epoch_ms(o.created_at + INTERVAL 30 DAY), 1, o.order_id, NULL, NULL, NULL
  FROM app_orders o WHERE NOT EXISTS (SELECT 1 FROM shipped s WHERE s.order_id = o.order_id)),
hist AS (
  SELECT order_id, customer_id, status, total_amount, make_timestamp(ts_ms * 1000) AS valid_from,
         make_timestamp(next_ts * 1000) AS valid_to FROM (
    SELECT *, lead(ts_ms) OVER (PARTITION BY order_id ORDER BY ts_ms, seq) AS next_ts FROM feed)
  WHERE op <> 'd')
"""


def _state_sql(where: str = "") -> str:
    return ("SELECT order_id, customer_id, status, total_amount, ts_ms FROM ("
            "SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts_ms DESC, seq DESC) AS rn "
            f"FROM feed {where}) WHERE rn = 1 AND op <> 'd'")


@register("cdc_current_state", with_retail(_state_sql(), FEED_CTES))
def cdc_current_state(spark, d):
    return C.current_state(order_change_feed(spark, d), "order_id")


@register("cdc_history", with_retail("SELECT * FROM hist", FEED_CTES))
def cdc_history(spark, d):
    return C.history(order_change_feed(spark, d), "order_id", ["customer_id", "status", "total_amount"])


@register("cdc_diff", with_retail(
    "SELECT COALESCE(o.order_id, n.order_id) AS order_id, "
    "CASE WHEN o.order_id IS NULL THEN 'c' WHEN n.order_id IS NULL THEN 'd' ELSE 'u' END AS op, "
    "o.status AS old_status, n.status AS new_status, o.total_amount AS old_total, n.total_amount AS new_total "
    "FROM old_state o FULL OUTER JOIN new_state n ON o.order_id = n.order_id "
    "WHERE o.order_id IS NULL OR n.order_id IS NULL OR o.customer_id IS DISTINCT FROM n.customer_id "
    "OR o.status IS DISTINCT FROM n.status OR o.total_amount IS DISTINCT FROM n.total_amount",
    FEED_CTES.strip() + f",\nold_state AS ({_state_sql(f'WHERE ts_ms <= {DIFF_AT_MS}')}),\n"
    f"new_state AS ({_state_sql()})"))
def cdc_diff(spark, d):
    feed = order_change_feed(spark, d)
    old = C.current_state(feed.where(F.col("ts_ms") <= DIFF_AT_MS), "order_id").drop("ts_ms")
    new = C.current_state(feed, "order_id").drop("ts_ms")
    diff = C.diff_snapshots(old, new, "order_id", ["customer_id", "status", "total_amount"])
    return diff.select("order_id", "op", F.col("before.status").alias("old_status"),
                       F.col("after.status").alias("new_status"),
                       F.col("before.total_amount").alias("old_total"),
                       F.col("after.total_amount").alias("new_total"))


@register("fact_asof_dim", with_retail(
    "SELECT i.order_id, i.line_number, i.created_at, h.status AS status_at_ship FROM app_items i "
    "LEFT JOIN hist h ON h.order_id = i.order_id AND h.valid_from <= i.created_at "
    "AND (h.valid_to IS NULL OR i.created_at < h.valid_to)", FEED_CTES))
def fact_asof_dim(spark, d):
    """Each item joined to the order version valid when it shipped (equi key
    plus a half-open validity range; open versions end at +infinity)."""
    hist = C.history(order_change_feed(spark, d), "order_id", ["status"])
    h = hist.select(F.col("order_id").alias("_k"), "status", "valid_from",
                    F.coalesce("valid_to", ntz(dt.datetime(9999, 12, 31))).alias("_to"))
    i = T.order_items(spark, d).select("order_id", "line_number", "created_at")
    j = i.join(h, (i["order_id"] == h["_k"]) & (h["valid_from"] <= i["created_at"]) & (i["created_at"] < h["_to"]),
               "left")
    return j.select("order_id", "line_number", "created_at", F.col("status").alias("status_at_ship"))


@register("cdc_feed", with_retail("SELECT op, ts_ms, seq, order_id, customer_id, status, total_amount FROM feed",
                                  FEED_CTES))
def cdc_feed(spark, d):
    """The derived change feed, flattened (key from the after or before image)."""
    f = order_change_feed(spark, d)
    return f.select("op", "ts_ms", "seq", C.row_key("order_id").alias("order_id"),
                    F.col("after.customer_id").alias("customer_id"), F.col("after.status").alias("status"),
                    F.col("after.total_amount").alias("total_amount"))


@register("cdc_apply", with_retail(_state_sql(), FEED_CTES))
def cdc_apply(spark, d):
    """The state after two batches that arrive in the wrong order: updates and
    deletes first, then the creates that precede them."""
    feed = order_change_feed(spark, d)
    first = C.merge_changes(None, feed.where("op <> 'c'"), "order_id")
    return C.live_rows(C.merge_changes(first, feed.where("op = 'c'"), "order_id"))


@register("cdc_decode", with_retail(
    "SELECT op, ts_ms, order_id, customer_id, status, total_amount FROM feed", FEED_CTES))
def cdc_decode(spark, d):
    """Envelopes as a topic carries them: the feed serialised to JSON text, every other
    message wrapped in ``payload``, decoded again."""
    f = order_change_feed(spark, d)
    text = F.to_json(F.struct("before", "after", "op", "ts_ms"))
    wrapped = F.concat(F.lit('{"payload":'), text, F.lit("}"))
    odd = F.pmod(F.xxhash64("ts_ms", C.row_key("order_id")), F.lit(2)) == 1
    messages = f.select(F.when(odd, wrapped).otherwise(text).alias("value"))
    decoded = C.decode_envelope(messages, f.schema["after"].dataType)
    return decoded.select("op", "ts_ms", C.row_key("order_id").alias("order_id"), F.col("after.customer_id").alias("customer_id"),
                          F.col("after.status").alias("status"), F.col("after.total_amount").alias("total_amount"))


SPEC = Summary(("region", "status"), "region", {"revenue": "total_amount"}, {"customers": "customer_id"})


@register("mv_incremental", with_retail(
    "SELECT customer_id % 16 AS region, status, COUNT(*) AS n_rows, SUM(total_amount::DECIMAL(12,2))::DOUBLE AS revenue, "
    "COUNT(DISTINCT customer_id) AS customers FROM app_orders WHERE order_id IN (SELECT order_id FROM app_items) GROUP BY ALL"))
def mv_incremental(spark, d):
    """A summary kept by signed deltas over two batches of the change feed: every order is created, then
    gets its status with the last item or is deleted for want of items (some updates come before the create)."""
    def image(side):
        cols = [F.col(f"{side}.{c}").alias(c) for c in ROW_COLS]
        return F.when(F.col(side).isNotNull(), F.struct((F.col(f"{side}.customer_id") % 16).alias("region"), *cols)).alias(side)

    feed = order_change_feed(spark, d).select("op", "ts_ms", image("before"), image("after"))
    path = scratch_path(spark, f"summary-{uuid.uuid4().hex}")
    cuts = [F.col("ts_ms") <= DIFF_AT_MS, F.col("ts_ms") > DIFF_AT_MS]
    for batch, cut in enumerate(cuts):
        apply_changes(spark, path, SPEC, feed.where(cut), batch)
    return read_summary(spark, path, SPEC, feed.select("after.*"))
