"""Writers and table layouts: CSV/Parquet, partitioned and clustered writes,
partition transforms, bronze landing, lake zones, JDBC loads and topic-style
JSON messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from lakecraft.functions.scalars import partition_expr

ZONES = ("bronze", "silver", "gold")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> None:
    """Parquet write; with ``partition_by`` and overwrite mode only the
    partitions present in ``df`` are replaced (dynamic overwrite), so a re-run
    for one day does not wipe the others."""
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def with_partition_transform(df: DataFrame, spec: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Add derived partition columns for hidden-partitioning specs such as
    ``[("event_month", "month", "event_time"), ("category", "identity", "category")]``."""
    for out, transform, col in spec:
        if out != col:
            df = df.withColumn(out, partition_expr(transform, col))
    return df


def write_transformed(df: DataFrame, path: str, spec: Sequence[tuple[str, str, str]],
                      mode: str = "append") -> None:
    """Partition by transforms (month/day/hour/year/bucket/truncate/identity);
    rows of one partition value are brought together first, so each task writes
    few files, and AQE splits values that hold too much for one task."""
    cols = [out for out, _, _ in spec]
    staged = with_partition_transform(df, spec)
    staged.hint("rebalance", *cols).write.mode(mode).partitionBy(*cols).parquet(path)


def clustered_write(df: DataFrame, path: str, sort_by: Sequence[str], num_files: int | None = None,
                    mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Sort-clustered layout: range-partition on ``sort_by`` and sort inside
    each file, so Parquet min/max statistics let filters on those columns skip
    row groups and files."""
    n = num_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    staged = df.repartitionByRange(n, *sort_by).sortWithinPartitions(*sort_by)
    w = staged.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Bucketed and sorted table: one file per bucket (and partition value). Tables with the same number of buckets of the
    join key are joined without a shuffle on either side (:func:`bucketed_lookup`)."""
    w = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if partition_by:
        w = w.partitionBy(*partition_by)
    (w.option("path", path) if path else w).saveAsTable(table)


def bucketed_lookup(spark: SparkSession, fact: str, dim: str, key: str, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Facts with ``columns`` of the dimension table, both bucketed by ``key`` alike: a sort-merge join of their buckets
    where they lie. (A dimension small enough is broadcast instead, as the session's threshold says.)"""
    return spark.table(fact).join(spark.table(dim).select(key, *columns), key, how)


def bronze_land(df: DataFrame, path: str, ingest_ts=None) -> DataFrame:
    """Land raw rows unchanged plus lineage columns (ingest time, source file)
    into the bronze zone, partitioned by ingest date; returns the landed frame."""
    ts = F.lit(ingest_ts).cast("timestamp") if ingest_ts is not None else F.current_timestamp()
    landed = (df.withColumn("_source_file", F.col("_metadata.file_path"))
              .withColumn("_ingest_ts", ts)
              .withColumn("ingest_date", F.to_date("_ingest_ts")))
    landed.write.mode("append").partitionBy("ingest_date").parquet(path)
    return landed


def create_zones(spark: SparkSession, base: str, zones: Sequence[str] = ZONES) -> list[str]:
    """Namespaces bronze/silver/gold bound to ``<base>/<zone>``."""
    made = []
    for z in zones:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {z} LOCATION '{base.rstrip('/')}/{z}'")
        made.append(z)
    return made


def compact(spark: SparkSession, src: str, dst: str, target_bytes: int = 128 << 20, partition_by: Sequence[str] = ()) -> int:
    """Rewrite a Parquet folder so that every partition value has
    ``ceil(bytes / target_bytes)`` files; returns their number. ``dst`` is
    another folder: readers of ``src`` are not disturbed."""
    from lakecraft.sources.files import file_inventory
    data = spark.read.parquet(src)
    folder = F.regexp_replace("file_path", "/[^/]*$", "")
    bins = (file_inventory(data).groupBy(folder.alias("folder"))
            .agg(F.ceil(F.sum("file_size_in_bytes") / target_bytes).cast("int").alias("n"))
            .withColumn("first", F.sum("n").over(Window.orderBy("folder")) - F.col("n")))      # one row per partition value
    total = bins.agg(F.sum("n")).first()[0] or 0
    if not total:
        return 0
    cols = data.columns
    rows = data.withColumn("_folder", F.regexp_replace("_metadata.file_path", "/[^/]*$", ""))
    rows = rows.join(bins.withColumnRenamed("folder", "_folder"), "_folder")
    place = F.col("first") + F.pmod(F.xxhash64(*cols), F.col("n"))
    placed = rows.withColumn("_file", place.cast("int")).repartitionById(int(total), "_file").select(*cols)
    w = placed.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(dst)
    return int(total)


def load_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None) -> int:
    """Append ``df`` to a database table and return the row count. Spark commits
    each partition separately: for an all-or-nothing load write to a staging
    table of the database and publish it there in one transaction."""
    obs = Observation("jdbc_load")          # counted inside the write job: no second scan
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    observed.write.format("jdbc").option("url", url).option("dbtable", table).options(**(properties or {})) \
        .mode("append").save()
    return int(obs.get["rows"])


def to_json_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as topic messages: ``value`` = JSON of the row, optional ``key``."""
    cols = [F.to_json(F.struct(*df.columns)).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)
