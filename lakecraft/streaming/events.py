"""Structured Streaming jobs for event topics.

Sources are anything that yields ``value`` (text or bytes) with ``partition``
and ``offset`` columns: the Kafka source (``readStream.format("kafka")``,
``startingOffsets=earliest``) or, offline, a file stream with the same
columns. Every job is checkpointed; file sinks commit through the sink log, so
a restarted query neither loses nor repeats records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecraft.functions.scalars import json_or_raw
from lakecraft.operators.events import windowed_counts

# Envelope columns of a topic record (as the Kafka source delivers them).
RAW_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

# Typed click events; ``ts`` is optional in the producer's messages.
EVENT_SCHEMA = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("page", T.StringType()),
    T.StructField("user_id", T.IntegerType()),
    T.StructField("ts", T.TimestampType()),
])


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Topic source (needs the Kafka connector on the classpath)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).load()
            .select(F.col("value").cast("string").alias("value"), "partition", "offset"))


def file_source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Offline stand-in for a topic: JSON-lines files with value/partition/offset."""
    r = spark.readStream.schema(RAW_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


def decode(raw: DataFrame) -> DataFrame:
    """Null messages are skipped; a JSON object is kept as is, anything else
    becomes ``{"raw": text}``; each record gains ``processed_at``,
    ``_partition``, ``_offset`` and the ``ingest_date`` directory key."""
    v = F.col("value").cast("string")
    return (raw.where(v.isNotNull())
            .select(json_or_raw(v).alias("payload"),
                    F.current_timestamp().alias("processed_at"),
                    F.col("partition").alias("_partition"), F.col("offset").alias("_offset"))
            .withColumn("ingest_date", F.date_format("processed_at", "yyyy-MM-dd")))


def bronze_query(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Decode and land records as JSON under ``<path>/ingest_date=<day>/``
    (many records per file). Returns the started query."""
    w = (decode(raw).writeStream.format("json").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint).partitionBy("ingest_date"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def typed(decoded: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Parse payloads into typed columns (unknown fields ignored)."""
    return decoded.select(F.from_json("payload", schema).alias("e"), "processed_at", "_partition", "_offset") \
        .select("e.*", "processed_at", "_partition", "_offset")


def split_rejects(events: DataFrame, required: Sequence[str] = ("ts",)) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): rows missing a required field go to a reject path
    instead of being dropped silently."""
    bad = F.lit(False)
    for c in required:
        bad = bad | F.col(c).isNull()
    return events.where(~bad), events.where(bad)


def windowed(events: DataFrame, size: str, slide: str | None = None, watermark: str = "5 seconds",
             key: str = "event_type", ts: str = "ts", value: str = "value") -> DataFrame:
    """Event-time window counts with a watermark: append mode emits a window
    once the watermark passes its end; older rows are dropped (and counted in
    ``numRowsDroppedByWatermark``)."""
    return windowed_counts(events.withWatermark(ts, watermark), size, slide, key, ts, value)


def session_counts(events: DataFrame, gap: str, watermark: str, key: str = "user_id", ts: str = "ts") -> DataFrame:
    """Session windows on a stream (state per key, closed by the watermark)."""
    agg = events.withWatermark(ts, watermark).groupBy(F.session_window(ts, gap).alias("w"), key) \
        .agg(F.count(F.lit(1)).alias("n_events"))
    return agg.select(key, F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n_events")


def dedup(events: DataFrame, key: Sequence[str], watermark: str, ts: str = "ts") -> DataFrame:
    """Drop redelivered events (same key) within the watermark delay; state is
    purged once the watermark passes."""
    return events.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(key))


def enrich(events: DataFrame, static: DataFrame, key: str) -> DataFrame:
    """Stream-static join: each micro-batch joins the current static table."""
    return events.join(static, key, "left")


def join_streams(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                 left_wm: str, right_wm: str, within: str) -> DataFrame:
    """Stream-stream inner join with watermarks and a time bound
    (``right_ts`` in ``[left_ts, left_ts + within]``) so state can be purged."""
    l, r = left.withWatermark(left_ts, left_wm).alias("l"), right.withWatermark(right_ts, right_wm).alias("r")
    cond = (F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col(f"r.{right_ts}") >= F.col(f"l.{left_ts}")) \
        & (F.col(f"r.{right_ts}") <= F.col(f"l.{left_ts}") + F.expr(f"INTERVAL {within}"))
    return l.join(r, cond)


def console(df: DataFrame, checkpoint: str | None = None):
    """Debug helper: print each micro-batch."""
    w = df.writeStream.format("console").option("truncate", False)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()


def parsed(raw: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Messages with their typed form ``r``."""
    return raw.withColumn("r", F.from_json(F.col("value").cast("string"), schema))


def malformed(schema: T.StructType = EVENT_SCHEMA):
    """Of :func:`parsed` messages: nothing of the schema could be read."""
    bad = F.lit(True)
    for f in schema.fields:
        bad = bad & F.col(f"r.{f.name}").isNull()
    return F.col("r").isNull() | bad


def rejects_query(raw: DataFrame, path: str, checkpoint: str, schema: T.StructType = EVENT_SCHEMA,
                  trigger: dict | None = None):
    """The messages that :func:`copy_query` leaves out, as they came, with partition and offset."""
    bad = parsed(raw, schema).where(F.col("value").isNotNull() & malformed(schema)).select("value", "partition", "offset")
    return (bad.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def copy_query(raw: DataFrame, path: str, checkpoint: str, schema: T.StructType = EVENT_SCHEMA,
               where: str | None = None, trigger: dict | None = None):
    """Typed JSON sink table fed by ``INSERT INTO sink SELECT * FROM source``:
    parse messages with a declared schema, optional stateless filter, write
    typed JSON files (exactly once through the file-sink log). Messages that
    are no JSON object of the schema are left to :func:`rejects_query`."""
    rows = parsed(raw, schema).where(~malformed(schema)).select("r.*")
    if where:
        rows = rows.where(where)
    return (rows.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str | None = None, key: str | None = None):
    """Publish rows as JSON messages (needs the Kafka connector on the
    classpath): batch frames are written once, streaming frames start a
    checkpointed query."""
    from lakecraft.sources.sinks import to_json_messages
    msgs = to_json_messages(df, key)
    if df.isStreaming:
        return (msgs.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("topic", topic).option("checkpointLocation", checkpoint).start())
    msgs.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    return None
