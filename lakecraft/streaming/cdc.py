"""Change-data streaming: raw change messages to bronze, and applying change
batches to a silver table.

The silver table is plain Parquet, one folder per micro-batch
(``batch=<id>``), holding the newest change of each key in that batch with its
order columns - deletes included. Readers take the newest change of each key
over all batches and leave deletes out, so batches may arrive late, out of
order or more than once: a replayed micro-batch rewrites its own folder, an
older change never wins over a newer one, and a create that arrives after the
delete it precedes stays deleted. :func:`compact` rewrites the state as one
base batch of a new table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecraft.operators.cdc import decode_envelope, row_key
from lakecraft.operators.windows import latest_per_key
from lakecraft.session import file_system


def raw_to_bronze(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Land non-empty change messages unchanged (text + topic metadata) as
    JSON under ``ingest_date`` directories."""
    v = F.col("value").cast("string")
    out = (raw.where(v.isNotNull() & (v != ""))
           .select(v.alias("value"), F.col("partition").alias("_partition"), F.col("offset").alias("_offset"),
                   F.current_timestamp().alias("received_at"))
           .withColumn("ingest_date", F.date_format("received_at", "yyyy-MM-dd")))
    return (out.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
            .partitionBy("ingest_date").trigger(**(trigger or {"availableNow": True})).start())


def _silver_schema(row: T.StructType, order: Sequence[str]) -> T.StructType:
    key = [T.StructField("_key", T.StringType()), T.StructField("op", T.StringType()), T.StructField("after", row)]
    return T.StructType(key + [T.StructField(c, T.LongType()) for c in order] + [T.StructField("batch", T.LongType())])


def _newest(changes: DataFrame, order: Sequence[str]) -> DataFrame:
    return latest_per_key(changes.select("_key", *order, "op", "after"), ["_key"], list(order))


def read_changes(spark: SparkSession, path: str, row: T.StructType, order: Sequence[str] = ("ts_ms", "_offset")) -> DataFrame:
    """The stored changes of all micro-batches (no rows before the first)."""
    schema = _silver_schema(row, order)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":         # anything else is not an empty table
            raise
        return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, row: T.StructType, order: Sequence[str] = ("ts_ms", "_offset")) -> DataFrame:
    """Current silver rows: per key the newest change (combined map-side), deletes left out."""
    return _newest(read_changes(spark, path, row, order), order).where(F.col("op") != "d").select("after.*")


def apply_batch(changes: DataFrame, batch_id: int, path: str, key: str, row: T.StructType,
                order: Sequence[str] = ("ts_ms", "_offset")) -> None:
    """Store one micro-batch of decoded changes (``op, before, after`` and the
    ``order`` columns): its newest change per key. The batch is reduced before
    the write, and nothing stored earlier is read. Undecodable messages (null
    ``op``) are not changes; see :func:`rejects`."""
    keyed = changes.where(F.col("op").isNotNull()).withColumn("_key", row_key(key).cast("string"))
    _newest(keyed, order).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def fold(spark: SparkSession, path: str, row: T.StructType, upto: int, order: Sequence[str] = ("ts_ms", "_offset")) -> int:
    """Replace the batches up to ``upto`` by one that holds the newest change of each of their keys (deletes included: an
    older change that comes late must still lose); returns how many it replaced. Reads then cost the table's size and
    the batches since, whatever the table's age. The new folder comes before the old ones go, and merging changes twice
    gives the same rows, so an interrupted fold leaves the table right and the next one ends its work."""
    fs, place = file_system(spark, path)
    old = [s.getPath() for s in fs.listStatus(place) if s.getPath().getName().startswith("batch=")]
    numbers = {int(p.getName()[6:]): p for p in old}
    folded = {n: p for n, p in numbers.items() if n <= upto}
    if len(folded) < 2:
        return 0
    state = _newest(read_changes(spark, path, row, order).where(F.col("batch") <= upto), order)
    staging = f"{path}/_fold"
    state.write.mode("overwrite").parquet(staging)
    if not fs.rename(file_system(spark, staging)[1], file_system(spark, f"{path}/batch={min(min(numbers), 0) - 1}")[1]):
        raise OSError(f"cannot move {staging}")
    for p in folded.values():
        fs.delete(p, True)
    return len(folded)


def rejects(decoded: DataFrame) -> DataFrame:
    """Messages that are no change envelopes."""
    return decoded.where(F.col("op").isNull())


def apply_query(raw: DataFrame, path: str, key: str, row: T.StructType, checkpoint: str,
                reject_path: str | None = None, trigger: dict | None = None, fold_every: int | None = None):
    """Stream: decode change messages and apply each micro-batch to ``path``;
    undecodable ones go to ``reject_path`` (per batch, so a replay repeats none).
    Before each ``fold_every``-th batch the ones before it are folded (:func:`fold`)."""
    decoded = decode_envelope(raw, row).withColumnRenamed("offset", "_offset")

    def each(batch: DataFrame, batch_id: int):
        if fold_every and batch_id and batch_id % fold_every == 0:
            fold(batch.sparkSession, path, row, batch_id - 1)
        apply_batch(batch, batch_id, path, key, row)
        if reject_path:
            rejects(batch).select("value", "_offset").write.mode("overwrite").json(f"{reject_path}/batch={batch_id}")

    return (decoded.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def compact(spark: SparkSession, path: str, out: str, row: T.StructType, order: Sequence[str] = ("ts_ms", "_offset")) -> None:
    """Write the newest change of every key (deletes included: a late older change must still lose)
    as the base batch of a new table. Later batches go on in ``out``."""
    _newest(read_changes(spark, path, row, order), order).write.mode("overwrite").parquet(f"{out}/batch=-1")
