"""Change feeds between loads that know which key buckets differ.

A load is stored by buckets of its key's hash, with a checksum of each bucket's rows
beside it. Two loads are compared by their checksums first: only buckets that differ
are read and joined, so a feed costs what changed, not what is stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecraft.operators.cdc import diff_snapshots
from lakecraft.sources.loads import history, latest, publish, read_load

SUMS = "bucket int, buckets int, n long, mix long, total decimal(38,0)"


def publish_bucketed(spark: SparkSession, df: DataFrame, path: str, key: str, buckets: int = 256, name: str = "load") -> int:
    """Publish ``df`` as the next load, by buckets of ``key``, with their checksums; returns the load's number. The rows of
    a bucket stand in a folder of their own, in few files (small buckets share a task, large ones are split)."""
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int"))
    publish(spark, rows.hint("rebalance", "_bucket"), path, name, partition_by=["_bucket"])
    n, stored = latest(spark, path)
    cols = [F.col(f"`{c}`") for c in df.columns]
    # the xor alone would not see a row that stands twice, the sum alone is weaker against chosen values
    sums = stored.groupBy(F.col("_bucket").alias("bucket"), F.lit(buckets).alias("buckets")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*cols)).alias("mix"),
        F.sum(F.xxhash64(F.lit(1), *cols).cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"))
    sums.coalesce(1).write.mode("overwrite").parquet(f"{path}/_sums/n={n}")
    return n


def _sums(spark: SparkSession, path: str, load: int) -> DataFrame | None:
    try:
        return spark.read.schema(SUMS).parquet(f"{path}/_sums/n={load}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def changed_buckets(spark: SparkSession, path: str, old: int, new: int) -> list[int] | None:
    """Numbers of the buckets whose rows differ; None if checksums are missing or were made over other buckets."""
    a, b = _sums(spark, path, old), _sums(spark, path, new)
    if a is None or b is None or a.unionByName(b).select("buckets").distinct().count() > 1:
        return None
    differ = a.exceptAll(b).unionByName(b.exceptAll(a)).select("bucket").distinct()      # at most one row per bucket
    return sorted(r.bucket for r in differ.collect())


def diff_loads(spark: SparkSession, path: str, old: int, new: int, key: str, attrs: Sequence[str]) -> DataFrame:
    """The change feed (key, op, before, after) from load ``old`` to load ``new``."""
    a, b = read_load(spark, path, old), read_load(spark, path, new)
    buckets = changed_buckets(spark, path, old, new)
    if buckets is not None:
        chosen = F.col("_bucket").isin(*buckets) if buckets else F.lit(False)
        a, b = a.where(chosen), b.where(chosen)
    return diff_snapshots(a.drop("_bucket"), b.drop("_bucket"), key, attrs)


def newest_feed(spark: SparkSession, path: str, key: str, attrs: Sequence[str]) -> DataFrame | None:
    """The change feed of the newest load against the one before; None with fewer than two."""
    loads = [r.load for r in history(spark, path).limit(2).collect()]
    return diff_loads(spark, path, loads[1], loads[0], key, attrs) if len(loads) == 2 else None
