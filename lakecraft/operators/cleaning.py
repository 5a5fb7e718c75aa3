"""Cleaning jobs as column expressions (no Python UDFs).

* :func:`clean_products` - the typed product cleaning (null drop, numeric
  coercion, non-negative price, whitespace strip, empty category, dedup);
* :func:`clean_silver` - the generic bronze->silver pass (trim, key not null,
  numeric casts, exact-duplicate removal);
* :func:`clean_orders` - order rows must carry order and customer ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecraft.functions.scalars import strip_ws, try_number

# The text tokens a default pandas CSV read turns into missing
# values; the product cleaning treats them as null to give the same rows.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

NUMERIC_COLUMNS = ("price", "total_amount", "subtotal")


def na_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn the NA tokens of string columns into nulls."""
    cols = set(columns or [c for c, t in df.dtypes if t == "string"])
    return df.select(*[F.when(F.col(c).isin(NA_TOKENS), F.lit(None)).otherwise(F.col(c)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def clean_products(df: DataFrame, drop_blank_names: bool = False) -> DataFrame:
    """Product cleaning, steps in the reference order:

    1. drop rows without ``product_name`` or ``price`` (NA tokens count as null);
    2. price text -> double, unparsable prices dropped;
    3. keep ``price >= 0`` (NaN is dropped: in Spark NaN >= 0 is true);
    4. strip all leading/trailing whitespace of name and category;
    5. null category -> "";
    6. drop duplicates on (product_name, category, price).
    A name that was only whitespace survives as "" (step 1 precedes step 4)
    unless ``drop_blank_names``.
    """
    d = na_to_null(df, ["product_name", "category", "price"])
    d = d.where(F.col("product_name").isNotNull() & F.col("price").isNotNull())
    d = d.withColumn("price", try_number("price")).where(F.col("price").isNotNull())
    d = d.where((F.col("price") >= 0) & ~F.isnan("price"))
    d = d.withColumn("product_name", strip_ws("product_name")) \
         .withColumn("category", F.coalesce(strip_ws("category"), F.lit("")))
    if drop_blank_names:
        d = d.where(F.col("product_name") != "")
    return d.select("product_name", "category", "price").dropDuplicates(["product_name", "category", "price"])


def clean_silver(df: DataFrame, key: str | None = None,
                 numeric: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Generic silver pass: trim string columns, drop rows whose key (default:
    first column) is null, cast known money columns to double (dirty text ->
    null, while the text ``nan`` is a number and stays NaN), remove exact
    duplicate rows (NaN equals NaN)."""
    key = key or df.columns[0]
    types = dict(df.dtypes)
    d = df.select(*[F.trim(F.col(c)).alias(c) if types[c] == "string" else F.col(c) for c in df.columns])
    d = d.where(F.col(key).isNotNull())
    d = d.select(*[F.col(c).try_cast("double").alias(c) if c in numeric else F.col(c) for c in d.columns])
    return d.dropDuplicates()


def clean_orders(df: DataFrame, dedup: bool = False, normalize: bool = False) -> DataFrame:
    """Keep orders with non-empty ``order_id`` and ``customer_id``; optionally
    drop exact duplicates and normalise types (ids to bigint, amount to double,
    dates to date)."""
    ok = F.lit(True)
    for c in ("order_id", "customer_id"):
        ok = ok & F.col(c).isNotNull() & (F.length(F.trim(F.col(c).cast("string"))) > 0)
    d = df.where(ok)
    if normalize:
        casts = {"order_id": "bigint", "customer_id": "bigint", "total_amount": "double",
                 "order_date": "date"}
        d = d.select(*[F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c) for c in d.columns])
    return d.dropDuplicates() if dedup else d
