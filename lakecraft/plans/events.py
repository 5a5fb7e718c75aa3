"""Event-table queries: the partition rollup of the sales-events table and the
batch twins of the streaming window jobs."""

from __future__ import annotations

from lakecraft.operators import events as E
from lakecraft.plans.registry import register
from lakecraft.sources import tables as T

VSUM = "CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS value_sum"


@register("partition_rollup",
          f"SELECT strftime(ts, '%Y-%m') AS month, event_type, COUNT(*) AS n_events, {VSUM} "
          "FROM events GROUP BY ALL")
def partition_rollup(spark, d):
    return E.month_rollup(T.events(spark, d), "ts", "event_type", "value")


@register("ev_tumbling",
          "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, "
          "time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type, "
          f"COUNT(*) AS n_events, {VSUM} FROM events GROUP BY ALL")
def ev_tumbling(spark, d):
    return E.windowed_counts(T.events(spark, d), "1 hour")


@register("ev_sliding",
          "SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, event_type, "
          f"COUNT(*) AS n_events, {VSUM} FROM (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, ts), "
          "time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS s FROM events) GROUP BY ALL")
def ev_sliding(spark, d):
    return E.windowed_counts(T.events(spark, d), "1 hour", "30 minutes")


SESSION_SQL = """
WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
f AS (SELECT *, CASE WHEN prev IS NULL OR ts > prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS st FROM e),
g AS (SELECT *, SUM(st) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sn FROM f)
SELECT user_id, MIN(ts) AS window_start, MAX(ts) + INTERVAL 30 MINUTE AS window_end, COUNT(*) AS n_events
FROM g GROUP BY user_id, sn
"""


@register("ev_session", SESSION_SQL)
def ev_session(spark, d):
    return E.sessionize(T.events(spark, d), 30 * 60)


@register("ev_session_window", SESSION_SQL)
def ev_session_window(spark, d):
    return E.session_counts_native(T.events(spark, d), "30 minutes")


@register("event_props",
          "SELECT event_id, user_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS prop_k "
          "FROM events")
def event_props(spark, d):
    return T.events(spark, d).select("event_id", "user_id", "event_type", E.json_field("props", "$.k").alias("prop_k"))
