"""Event-time operators shared by batch queries and streaming jobs.

The same functions run on a static DataFrame (batch twin, checked against
SQL) and on a streaming DataFrame (after ``withWatermark``), so the streaming
result can be compared with the batch result on the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecraft.functions.scalars import money
from lakecraft.operators.windows import (earlier_segments, inside_segment, range_segments, segment_edges,
                                         with_segment_edges)


def _window_cols(w: str = "window") -> list[Column]:
    # window bounds as zone-less timestamps: the same wall-clock values in every client
    return [F.col(f"{w}.start").cast("timestamp_ntz").alias("window_start"),
            F.col(f"{w}.end").cast("timestamp_ntz").alias("window_end")]


def windowed_counts(events: DataFrame, size: str, slide: str | None = None,
                    key: str = "event_type", ts: str = "ts", value: str = "value") -> DataFrame:
    """Tumbling (``slide=None``) or sliding event-time windows per key: event
    count and exact value sum. Works unchanged on a watermarked stream."""
    win = F.window(ts, size, slide) if slide else F.window(ts, size)
    agg = events.groupBy(win.alias("window"), key).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(money(value)).cast("double").alias("value_sum"))
    return agg.select(*_window_cols(), key, "n_events", "value_sum")


def session_counts_native(events: DataFrame, gap: str, key: str = "user_id", ts: str = "ts",
                          tiebreak: str = "event_id") -> DataFrame:
    """Spark's own ``session_window``, run within range segments of (key, ts,
    tiebreak), so a key with a large share of all events is not one task's work.

    Only the first and the last session of a key in a segment can go on in a
    neighbouring segment, and only for keys that span segments: at most four
    rows a segment, merged by a window over that small table.
    """
    seg = range_segments(events.select(key, ts, tiebreak), [ts, tiebreak], [key])
    local = (seg.groupBy(key, "_pid", F.session_window(ts, gap).alias("w"))
             .agg(F.count(F.lit(1)).alias("n_events"), F.max("_spans").alias("_spans"))
             .select(key, "_pid", "_spans", F.col("w.start").alias("_lo"), F.col("w.end").alias("_hi"), "n_events"))
    part = Window.partitionBy(key, "_pid")
    edge = F.col("_spans") & ((F.col("_lo") == F.min("_lo").over(part)) | (F.col("_lo") == F.max("_lo").over(part)))
    local = local.withColumn("_edge", edge)
    inner = local.where(~F.col("_edge")).select(key, "_lo", "_hi", "n_events")
    of_key = Window.partitionBy(key).orderBy("_lo", "_hi", "_pid")
    reach = F.max("_hi").over(of_key.rowsBetween(Window.unboundedPreceding, -1))
    ends = local.where("_edge").withColumn("_new", F.when(reach.isNull() | (F.col("_lo") > reach), 1).otherwise(0))
    ends = ends.withColumn("_no", F.sum("_new").over(of_key.rowsBetween(Window.unboundedPreceding, 0)))
    merged = ends.groupBy(key, "_no").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.sum("n_events").alias("n_events"))
    return inner.unionByName(merged.drop("_no")).select(
        key, F.col("_lo").cast("timestamp_ntz").alias("window_start"), F.col("_hi").cast("timestamp_ntz").alias("window_end"), "n_events")


def session_counts_by_key(events: DataFrame, gap: str, key: str = "user_id", ts: str = "ts") -> DataFrame:
    """``session_window`` grouped by key only (the streaming form, where state
    is kept per key)."""
    agg = events.groupBy(F.session_window(ts, gap).alias("window"), key).agg(
        F.count(F.lit(1)).alias("n_events"))
    return agg.select(key, *_window_cols(), "n_events")


def sessionize(events: DataFrame, gap_seconds: int, key: str = "user_id", ts: str = "ts",
               tiebreak: str = "event_id") -> DataFrame:
    """Gap-based sessions per key for batch data, parallel even for a key that
    holds a large share of all events.

    A session starts where the gap to the previous event exceeds
    ``gap_seconds`` (an event exactly one gap later stays in the session, as
    with ``session_window``); its number is a running count of starts. Both are
    computed within range segments of (key, ts, tiebreak); a key that spans
    segments carries its last timestamp and its count from the earlier ones in
    a table of at most two rows a segment. Sessions are then a partially
    aggregated group-by. Output matches ``session_window``: [first event, last
    event + gap).
    """
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap_seconds))
    seg = range_segments(events.select(key, ts, tiebreak), [ts, tiebreak], [key])
    inside = inside_segment([key], [ts, tiebreak])
    last = segment_edges(seg, [key], {"_last": F.max(ts)})
    last = last.select("_pid", key, F.max("_last").over(earlier_segments([key])).alias("_prior"))
    rows = with_segment_edges(seg, last, [key], ["_prior"])
    previous = F.coalesce(F.lag(ts).over(inside), F.col("_prior"))
    rows = rows.withColumn("_start", F.when(previous.isNull() | (F.col(ts) > previous + gap), 1).otherwise(0)).drop("_prior")
    starts = segment_edges(rows, [key], {"_n": F.sum("_start")})
    starts = starts.select("_pid", key, F.sum("_n").over(earlier_segments([key])).alias("_before"))
    numbered = with_segment_edges(rows, starts, [key], ["_before"]).withColumn(
        "session_no", F.coalesce("_before", F.lit(0)) + F.sum("_start").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    sessions = numbered.groupBy(key, "session_no").agg(
        F.min(ts).alias("_lo"), F.max(ts).alias("_hi"), F.count(F.lit(1)).alias("n_events"))
    return sessions.select(key, F.col("_lo").cast("timestamp_ntz").alias("window_start"),
                           (F.col("_hi") + gap).cast("timestamp_ntz").alias("window_end"), "n_events")


def month_rollup(df: DataFrame, ts: str, key: str, value: str) -> DataFrame:
    """Roll up by ``month(ts)`` and a key (the partition spec of the sales
    events table): rows and exact value totals."""
    return (df.groupBy(F.date_format(ts, "yyyy-MM").alias("month"), key)
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum(money(value)).cast("double").alias("value_sum")))


def json_field(text: str, path: str, type_: str = "bigint") -> Column:
    """Extract a field from JSON text (``$.k``) with a typed, non-failing cast."""
    return F.get_json_object(F.col(text), path).try_cast(type_)
