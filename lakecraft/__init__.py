"""lakecraft: retail lakehouse analytics expressed as Spark DataFrame plans.

Sub-packages:
    sources    readers and writers (parquet/csv/jdbc/file inventory, zones)
    functions  column-expression helpers (date keys, coercion, JSON fallback)
    operators  DataFrame -> DataFrame building blocks (windows at scale, joins,
               warehouse loads, cleaning, data quality, CDC,
               features)
    plans      the registered analytical queries, each paired with DuckDB SQL
    streaming  Structured Streaming jobs (bronze landing, windows, CDC apply)
"""

from lakecraft.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
