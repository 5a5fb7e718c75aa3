"""Late events beside on-time ones, and the balance of a stream.

Spark drops a row that comes after the watermark without a trace. Here every
micro-batch is divided before any window sees it: rows that can't be used, rows
later than the watermark *of the batch that meets them* (the highest event time of
the batches before, less the allowed delay), and rows on time. Spark's own operators
compare with the watermark of one batch earlier, or of a batch without data run in
between: what they drop is late here too, while some late rows would still pass there,
depending on timing. The division here depends on nothing but the batches. One write puts them under ``batch=<id>/kind=<kind>``; then an
entry with the batch's counts and highest event time makes it count. A replayed
batch reads the entries before its own, so it is divided as it was the first time
and rewrites its own folder: nothing is lost or repeated over restarts.

Late rows are a table of their own and may be merged into finished windows
later (:func:`window_corrections`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from lakecraft.operators.events import windowed_counts

ENTRY = "batch long, n_in long, n_on_time long, n_late long, n_rejected long, max_us long, watermark_us long"
KINDS = ("on_time", "late", "rejected")


def batches(spark: SparkSession, path: str) -> DataFrame:
    """The counted batches: rows in, on time, late, rejected; highest event time and watermark in microseconds."""
    try:
        return spark.read.schema(ENTRY).parquet(f"{path}/_batches")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRY)


def watermark_before(spark: SparkSession, path: str, batch: int, delay: dt.timedelta) -> int | None:
    """Microseconds; None while no batch before had a usable event time."""
    top = batches(spark, path).where(F.col("batch") < batch).agg(F.max("max_us")).first()[0]
    return None if top is None else top - int(delay / dt.timedelta(microseconds=1))


def divide(batch: DataFrame, batch_id: int, path: str, delay: dt.timedelta, ts: str = "ts", size: dt.timedelta | None = None,
           usable: Column | None = None) -> None:
    """Store one micro-batch. A row is rejected if ``ts`` is null or ``usable`` doesn't hold; late if its event time - with
    ``size``, the end of its tumbling window - is not after the watermark of the batch (with ``size`` as Spark closes windows;
    without, a row at the watermark itself is on time)."""
    spark = batch.sparkSession
    wm = watermark_before(spark, path, batch_id, delay)
    bad = F.col(ts).isNull() if usable is None else F.col(ts).isNull() | ~F.coalesce(usable, F.lit(False))
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    if wm is None:
        past = F.lit(False)
    elif size is None:
        past = us < wm
    else:
        step = int(size / dt.timedelta(microseconds=1))
        past = us - F.pmod(us, F.lit(step)) + step <= wm
    kind = F.when(bad, "rejected").when(past, "late").otherwise("on_time")
    obs = Observation(f"batch {batch_id}")
    rows = batch.withColumn("kind", kind).observe(
        obs, F.count(F.lit(1)).alias("n_in"), *[F.count_if(F.col("kind") == k).alias(k) for k in KINDS],
        F.max(F.when(F.col("kind") != "rejected", us)).alias("max_us"))
    rows.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/batch={batch_id}")
    got = obs.get
    entry = [(batch_id, got["n_in"], got["on_time"], got["late"], got["rejected"], got["max_us"], wm)]
    spark.createDataFrame(entry, ENTRY).coalesce(1).write.mode("overwrite").parquet(f"{path}/_batches/n={batch_id}")


def divide_query(events: DataFrame, path: str, checkpoint: str, delay: dt.timedelta, ts: str = "ts", size: dt.timedelta | None = None,
                 usable: Column | None = None, trigger: dict | None = None):
    """Stream ``events`` through :func:`divide`. The rows that reach the query are counted where they enter (metric
    ``entered``), for :class:`Flow` to compare with what was stored."""
    counted = events.observe("entered", F.count(F.lit(1)).alias("rows"))
    return (counted.writeStream.foreachBatch(lambda batch, n: divide(batch, n, path, delay, ts, size, usable))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def read_kind(spark: SparkSession, path: str, kind: str, schema) -> DataFrame:
    """The rows of one kind from all counted batches, with their ``batch``; others are not read."""
    if kind not in KINDS:
        raise ValueError(f"no kind {kind}")
    shape = type(schema)(list(schema.fields)).add("batch", "long").add("kind", "string")
    done = [r.batch for r in batches(spark, path).select("batch").collect()]
    if not done:
        return spark.createDataFrame([], shape).drop("kind")
    return spark.read.schema(shape).parquet(path).where((F.col("kind") == kind) & F.col("batch").isin(done)).drop("kind")


def window_corrections(spark: SparkSession, path: str, schema, size: str, key: str = "event_type", ts: str = "ts", value: str = "value") -> DataFrame:
    """What the late rows would add to finished windows: window counts and sums over them alone."""
    return windowed_counts(read_kind(spark, path, "late", schema), size, None, key, ts, value)


class Flow(StreamingQueryListener):
    """Rows that entered each micro-batch of a query, as its progress reports them; :meth:`reconcile` holds them
    against the stored batches: in = on time + late + rejected."""

    def __init__(self, metric: str = "entered"):
        self.metric, self.entered = metric, {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.note(event.progress)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def note(self, progress) -> None:
        row = progress.observedMetrics.get(self.metric)
        if row is not None and progress.numInputRows:
            self.entered[progress.batchId] = row["rows"]

    def reconcile(self, spark: SparkSession, path: str) -> dict:
        """batch -> what disagrees; empty when every batch balances. Batches of runs before this listener
        are checked by their own numbers only."""
        wrong = {}
        stored = {r.batch: r for r in batches(spark, path).collect()}
        for n, r in stored.items():
            out = r.n_on_time + r.n_late + r.n_rejected
            if out != r.n_in or self.entered.get(n, r.n_in) != r.n_in:
                wrong[n] = f"entered {self.entered.get(n, r.n_in)}, read {r.n_in}, stored {out}"
        for n in self.entered.keys() - stored.keys():
            wrong[n] = f"entered {self.entered[n]}, stored nothing"
        return wrong
