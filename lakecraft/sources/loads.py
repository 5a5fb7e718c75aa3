"""Tables kept as whole loads: ``<path>/load=<n>/`` holds the content of the n-th
load as plain Parquet, and readers take the newest. A load is written as a
folder of its own, so readers of earlier ones are not disturbed. Its entry in
``<path>/_loads`` (number, rows, bytes, schema, time), written last, makes it
count: a failed write leaves the load before it the newest one, and a load
without rows is a load like any other. Earlier loads stay readable by number
or by time, can be published again, and are removed by :func:`expire`.

A table may also be made of *parts* (:func:`append_part`): then all loads
together are its content (:func:`read_parts`).

One writer a table; any number of readers.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecraft.session import file_system

ENTRY = "load int, n_rows long, n_bytes long, kind string, schema string, written_ms long"


def write_observed(df: DataFrame, name: str, write) -> int:
    """Run ``write`` on ``df``; the rows are counted inside the write job."""
    obs = Observation(name)
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get["rows"])


def _entries(spark: SparkSession, path: str) -> list[Row]:
    """Entries of a table's loads, oldest first (bounded by the number of loads)."""
    try:
        return spark.read.schema(ENTRY).parquet(f"{path}/_loads").orderBy("load").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _read(spark: SparkSession, path: str, entry: Row) -> DataFrame:
    return spark.read.schema(T.StructType.fromJson(json.loads(entry.schema))).parquet(f"{path}/load={entry.load}")


def latest(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """Number and content of the newest load; 0 and None before the first."""
    entries = _entries(spark, path)
    return (entries[-1].load, _read(spark, path, entries[-1])) if entries else (0, None)


def _write(spark: SparkSession, df: DataFrame, path: str, name: str, kind: str, partition_by: Sequence[str] = ()) -> int:
    entries = _entries(spark, path)
    if any(e.kind != kind for e in entries):
        raise ValueError(f"{path} is kept as {entries[0].kind}s")
    n = entries[-1].load + 1 if entries else 1
    folder = f"{path}/load={n}"
    rows = write_observed(df, name, lambda d: d.write.mode("overwrite").partitionBy(*partition_by).parquet(folder))
    if kind == "part" and not rows and entries:
        return 0
    fs, place = file_system(spark, folder)
    size = int(fs.getContentSummary(place).getLength())
    entry = spark.createDataFrame([(n, rows, size, kind, df.schema.json(), int(time.time() * 1000))], ENTRY)
    entry.coalesce(1).write.mode("overwrite").parquet(f"{path}/_loads/n={n}")
    return rows


def publish(spark: SparkSession, df: DataFrame, path: str, name: str = "load", partition_by: Sequence[str] = ()) -> int:
    """Write the next load, the table's whole content; returns its number of rows."""
    return _write(spark, df, path, name, "whole", partition_by)


def append_part(spark: SparkSession, df: DataFrame, path: str, name: str = "part") -> int:
    """Write the next load of a table whose content is all its loads; returns the rows added
    (a later load without rows doesn't count, and its number is used again)."""
    return _write(spark, df, path, name, "part")


def read_parts(spark: SparkSession, path: str) -> DataFrame | None:
    """All counted loads of a table of parts together, with their number as ``load``; None before the first.
    Columns are those of the newest load (older loads have nulls for new ones)."""
    entries = _entries(spark, path)
    if not entries:
        return None
    shape = T.StructType.fromJson(json.loads(entries[-1].schema)).add("load", T.IntegerType())
    return spark.read.schema(shape).option("basePath", path).parquet(*[f"{path}/load={e.load}" for e in entries])


def history(spark: SparkSession, path: str) -> DataFrame:
    """Loads, newest first: load, n_rows, n_bytes, written_at."""
    rows = [(e.load, e.n_rows, e.n_bytes, e.written_ms) for e in reversed(_entries(spark, path))]
    return spark.createDataFrame(rows, "load int, n_rows long, n_bytes long, ms long").select(
        "load", "n_rows", "n_bytes", F.timestamp_millis("ms").alias("written_at"))


def read_load(spark: SparkSession, path: str, load: int | None = None, as_of: dt.datetime | None = None) -> DataFrame:
    """Content of one load: by number, or the newest one written at or before ``as_of``
    (without a zone: the local time of this process)."""
    if (load is None) == (as_of is None):
        raise ValueError("give either a load or a time")
    entries = _entries(spark, path)
    if as_of is not None:
        found = [e for e in entries if e.written_ms <= as_of.timestamp() * 1000][-1:]
    else:
        found = [e for e in entries if e.load == load]
    if not found:
        raise ValueError(f"no such load of {path}")
    return _read(spark, path, found[0])


def rollback(spark: SparkSession, path: str, load: int) -> int:
    """Publish an earlier load's content as the newest load (the ones between stay in the history)."""
    return publish(spark, read_load(spark, path, load), path, "rollback")


def expire(spark: SparkSession, path: str, older_than: dt.datetime, keep: int = 1) -> list[int]:
    """Remove the loads written before ``older_than``, never the newest ``keep`` (at least
    one); returns their numbers. A load's entry goes before its files, so a reader that comes
    later doesn't find it; choose ``older_than`` so that readers of these loads are done.
    Folders of loads that never counted (a failed write) or lost their entry (an
    interrupted run of this function) go too when they are older; a second run ends the work of
    an interrupted one. Tables of parts are refused: every load is content."""
    entries = _entries(spark, path)
    if any(e.kind == "part" for e in entries):
        raise ValueError(f"{path}: every part is content")
    if not entries:
        return []
    kept = {e.load for e in entries[-max(1, keep):]}
    limit = older_than.timestamp() * 1000
    gone = [e.load for e in entries if e.written_ms < limit and e.load not in kept]
    fs, _ = file_system(spark, path)
    place = lambda name: file_system(spark, f"{path}/{name}")[1]
    for n in gone:
        fs.delete(place(f"_loads/n={n}"), True)
        fs.delete(place(f"load={n}"), True)
    counted = {e.load for e in entries}
    for status in fs.listStatus(place("")):
        name = status.getPath().getName()
        if name.startswith("load=") and int(name[5:]) not in counted and status.getModificationTime() < limit:
            fs.delete(status.getPath(), True)
    return gone
