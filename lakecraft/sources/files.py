"""Readers: CSV (validated, inferred, declared), JDBC extraction, file
inventories, catalog listings and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ValidationError(Exception):
    """Input is missing, unreadable, empty or lacks required columns."""


def read_csv_required(spark: SparkSession, path: str, required: Sequence[str],
                      schema: T.StructType | None = None) -> DataFrame:
    """CSV with header, every column read as text (no inference), validated:
    the path must exist, the file must have a header with the ``required``
    columns and at least one data row."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.csv(path)
    except AnalysisException as e:
        raise ValidationError(f"cannot read {path}: {e}") from e
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValidationError(f"missing columns {missing} in {path}")
    if df.isEmpty():
        raise ValidationError(f"{path} has no data rows")
    return df


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header and inferred types (an extra pass over the input; use
    a declared schema for large inputs)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_csv_declared(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """External-table style CSV: declared schema, header skipped, no inference."""
    return spark.read.schema(schema).option("header", True).csv(path)


def extract_jdbc(spark: SparkSession, url: str, table: str, predicate: str | None = None,
                 partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                 num_partitions: int = 1, properties: dict | None = None, limit: int | None = None) -> DataFrame:
    """Parallel JDBC extract. ``predicate`` is a Spark filter that is pushed to
    the database; with a numeric ``partition_column`` the read is split into
    ``num_partitions`` range queries. ``limit`` gives a bounded preview
    extract (pushed down as a LIMIT). A read that is neither split nor limited
    would be one task's work and is refused."""
    if not partition_column and not limit:
        raise ValueError("give partition_column with bounds, or a limit: one task would read the whole table")
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    df = r.load()
    df = df.where(predicate) if predicate else df
    return df.limit(limit) if limit else df


def file_inventory(df: DataFrame) -> DataFrame:
    """Data files behind a file-based DataFrame: path, record count, size.
    Counted with one aggregate over the hidden ``_metadata`` column."""
    return (df.select("_metadata.file_path", "_metadata.file_size")
            .groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("record_count"))
            .select("file_path", "record_count", F.col("file_size").alias("file_size_in_bytes")))


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Every file under ``path`` (recursive) with size and modification time;
    the binary-file source only lists, the file contents are never read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob).load(path)
            .select(F.col("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")))


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Namespaces (``database=None``) or tables of one namespace as a DataFrame."""
    if database is None:
        rows = [(d.name, d.locationUri) for d in spark.catalog.listDatabases()]
        return spark.createDataFrame(rows, "namespace string, location string")
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table_name string, table_type string, is_temporary boolean")


def preview(spark: SparkSession, table: str, n: int = 10) -> DataFrame:
    """Ad-hoc look at a table: the first ``n`` rows (no ordering implied)."""
    return spark.table(table).limit(n)


def synthetic_products(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """The format benchmark's rows: id, name, category 0-9, price in
    [10,000, 1,010,000); generated in parallel from ``range`` with a seed."""
    return spark.range(n).select(
        F.col("id"), F.concat(F.lit("product_"), F.col("id").cast("string")).alias("name"),
        (F.rand(seed) * 10).cast("int").alias("category_id"),
        (F.rand(seed + 1) * 1_000_000 + 10_000).alias("price"))
