"""Compaction in place: the small files of chosen partitions become few large ones; large files are not read.

The merged files are written to a hidden folder of the table (``_compact-<id>``); a list
of the files they replace, written after them, makes the step final. Only then do
merged files move to their partitions and replaced ones go. :func:`recover` ends an
interrupted run: with a list the moves are carried through, without one the
hidden folder goes and the table is as it was. Moving files is not atomic: run it
when no reader lists the table, or use :func:`lakecraft.sources.sinks.compact`, which writes
another folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecraft.session import file_system
from lakecraft.sources.files import list_files

_NONE = "__HIVE_DEFAULT_PARTITION__"


def small_files(spark: SparkSession, path: str, partition_by: Sequence[str] = (), small_bytes: int = 128 << 20,
                where: str | None = None) -> DataFrame:
    """Files below ``small_bytes`` (path, size, partition values as text), from the listing alone. ``where`` is a condition on
    the partition columns, with the types that reading the table gives them."""
    files = list_files(spark, path).where(F.col("size") < small_bytes)
    for c in partition_by:
        raw = F.regexp_extract("path", f"/{c}=([^/]*)/", 1)
        text = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
        files = files.withColumn(c, F.when(raw != _NONE, text))
    if where:
        kinds = spark.read.parquet(path).schema
        typed = files.select("path", "size", *[F.col(c).cast(kinds[c].dataType).alias(c) for c in partition_by])
        files = files.join(typed.where(where).select("path"), "path", "left_semi")
    return files.select("path", "size", *partition_by)


def compact_small(spark: SparkSession, path: str, partition_by: Sequence[str] = (), small_bytes: int = 128 << 20,
                  target_bytes: int = 512 << 20, where: str | None = None) -> dict:
    """Merge the small files of every partition that has at least two of them into ``ceil(bytes / target_bytes)``. Returns
    files_before, files_after and bytes_read. What is collected are file names, as Spark's own listing does."""
    recover(spark, path)
    parts = list(partition_by)
    small = small_files(spark, path, parts, small_bytes, where)
    per = small.groupBy(*parts).agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")).where("files > 1")
    same = lambda a, b: [a[c].eqNullSafe(b[c]) for c in parts]
    chosen = small.join(per, same(small, per), "left_semi") if parts else small.join(per, how="left_semi", on=F.lit(True))
    files = chosen.select("path", "size").collect()
    if not files:
        return {"files_before": 0, "files_after": 0, "bytes_read": 0}
    schema = spark.read.parquet(path).schema
    shape = T.StructType([T.StructField(f.name, T.StringType()) if f.name in parts else f for f in schema.fields])
    rows = spark.read.schema(shape).option("basePath", path).parquet(*[f.path for f in files])
    # one number per output file: a partition's files follow those of the ones before it (one row per partition)
    need = sorted(((*[r[c] for c in parts], -(-r["bytes"] // target_bytes)) for r in per.collect()), key=str)
    first, bins = 0, []
    for *values, n in need:
        bins.append((*values, first, int(n)))
        first += int(n)
    table = spark.createDataFrame(bins, T.StructType([T.StructField(f"_p{i}", T.StringType()) for i in range(len(parts))]
                                                     + [T.StructField("_first", T.LongType()), T.StructField("_n", T.LongType())]))
    match = F.lit(True)
    for i, c in enumerate(parts):
        match = match & rows[c].eqNullSafe(table[f"_p{i}"])
    place = F.col("_first") + F.pmod(F.xxhash64(*[F.col(f"`{f.name}`") for f in schema.fields if not isinstance(f.dataType, T.MapType)]), F.col("_n"))
    placed = rows.join(table, match).withColumn("_file", place.cast("int")).repartitionById(first, "_file").select(*[F.col(f"`{c}`") for c in rows.columns])
    staging = f"{path.rstrip('/')}/_compact-{uuid.uuid4().hex}"
    w = placed.write.mode("overwrite")
    (w.partitionBy(*parts) if parts else w).parquet(f"{staging}/data")
    spark.createDataFrame([(f.path,) for f in files], "path string").write.parquet(f"{staging}/replaced")
    after = _swap(spark, path, staging)
    return {"files_before": len(files), "files_after": after, "bytes_read": sum(f.size for f in files)}


def _swap(spark: SparkSession, path: str, staging: str) -> int:
    """Move merged files to their partitions, remove the replaced ones; can be run again."""
    fs, data = file_system(spark, f"{staging}/data")
    to = lambda p: file_system(spark, p)[1]
    moved, mark = 0, staging.rsplit("-", 1)[1][:8]
    walk = fs.listFiles(data, True)
    while walk.hasNext():
        status = walk.next()
        name, parent = status.getPath().getName(), status.getPath().getParent().toString()
        if not name.endswith(".parquet"):
            continue
        inside = parent.split(f"{staging.rsplit('/', 1)[1]}/data", 1)[1]
        fs.mkdirs(to(f"{path}{inside}"))
        if not fs.rename(status.getPath(), to(f"{path}{inside}/merged-{mark}-{name}")):
            raise OSError(f"cannot move {status.getPath()}")
        moved += 1
    for r in spark.read.parquet(f"{staging}/replaced").collect():
        fs.delete(to(r.path), False)
    fs.delete(to(staging), True)
    return moved


def recover(spark: SparkSession, path: str) -> list[str]:
    """End interrupted compactions of a table; returns their folders' names."""
    fs, place = file_system(spark, path)
    found = []
    for status in fs.listStatus(place):
        name = status.getPath().getName()
        if name.startswith("_compact-"):
            staging = f"{path.rstrip('/')}/{name}"
            if fs.exists(file_system(spark, f"{staging}/replaced/_SUCCESS")[1]):
                _swap(spark, path, staging)
            else:
                fs.delete(status.getPath(), True)
            found.append(name)
    return found
