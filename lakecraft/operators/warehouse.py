"""Dimensional-warehouse loads as DataFrame -> DataFrame functions.

Parquet tables have no MERGE/UPDATE, so every load returns the new table
content (or the rows to append); callers write it to a new version directory
or with dynamic partition overwrite. All operators are set-based joins and
aggregates: no driver-side loops, no collect.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecraft.functions.scalars import OPEN_END_DATE, date_key, iso_dow, year_month_key
from lakecraft.operators.windows import carry_forward, global_row_number, latest_per_key
from lakecraft.session import materialize


def dim_date(facts: DataFrame, date_col: str, as_of: dt.date, pad_months: int = 12) -> DataFrame:
    """Date dimension spanning ``min(date) - pad .. max(date) + pad`` by day.

    The bounds come from one aggregate over ``facts``; the day sequence is a
    single generated array bounded by the calendar span (not by data size),
    exploded into rows.
    """
    bounds = facts.agg(F.coalesce(F.min(date_col), F.lit(as_of)).alias("lo"),
                       F.coalesce(F.max(date_col), F.lit(as_of)).alias("hi"))
    days = bounds.select(F.explode(F.sequence(
        F.add_months("lo", -pad_months), F.add_months("hi", pad_months),
        F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(
        date_key("d").alias("date_key"),
        F.col("d").cast("timestamp_ntz").alias("date_actual"),      # midnight, like the source dates
        F.year("d").alias("year"),
        F.month("d").alias("month"),
        iso_dow("d").alias("day_of_week"),
        F.dayofmonth("d").alias("day_of_month"),
        F.quarter("d").alias("quarter"),
        year_month_key("d").alias("year_month"),
    )


def scd2_initial(src: DataFrame, key: str, attrs: Sequence[str], as_of: dt.date,
                 created_col: str | None = None) -> DataFrame:
    """First SCD2 load: one open version per key.

    ``valid_from`` is the created date (or ``as_of`` when absent), the version
    is open until 9999-12-31. Duplicate ``(key, valid_from)`` rows keep one
    deterministic row (the conflict rule of the load).
    """
    vf = F.coalesce(F.to_date(created_col), F.lit(as_of)) if created_col else F.lit(as_of)
    rows = src.select(key, *attrs, vf.alias("valid_from"))
    rows = latest_per_key(rows, [key, "valid_from"], list(attrs))
    return rows.select(key, *attrs, "valid_from",
                       F.lit(OPEN_END_DATE).alias("valid_to"), F.lit(True).alias("is_current"))


def with_surrogate_key(df: DataFrame, order: Sequence[str], out: str,
                       start: int | Column = 0) -> DataFrame:
    """Dense, gap-free surrogate keys ``start + 1 ..`` in ``order`` order.

    Parallel global row number (range partitions + per-partition offsets);
    ``start`` is the current ``max(sk)`` of the target for incremental loads.
    """
    numbered = global_row_number(df, list(order), "_sk")
    return numbered.select((F.col("_sk") + start).cast("long").alias(out), *df.columns)


def scd2_apply(dim: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str],
               effective: dt.date, sk: str | None = None) -> DataFrame:
    """Apply one batch of source rows to an SCD2 dimension; returns the new
    dimension content.

    A key's versions and its incoming row stand in one ordered window:

    * attributes equal to those of the version valid on ``effective``: no change;
    * else a version starts on ``effective``. The one valid until then is closed
      there, and the new one ends where the next later version starts, or stays
      open: a back-dated batch lands between its neighbours;
    * a version that starts on ``effective`` is replaced in place (it keeps its
      surrogate key: no zero-length versions);
    * keys absent from the batch stay as they are.

    Re-applying a batch is a no-op. New versions get surrogate keys after the
    current maximum. Versions never overlap; one with a null ``is_current``
    counts by its dates.

    With ``sk`` the versions are stored once (in the shared checkpoint folder)
    before new ones are numbered; else ``dim`` stands once in the plan. Either
    way the plan of a chain of batches grows by a constant per batch.
    """
    cols = dim.columns
    inc = latest_per_key(incoming.select(key, *tracked), [key], list(tracked))
    inc = inc.select(key, *tracked, F.lit(effective).alias("valid_from"), F.lit(OPEN_END_DATE).alias("valid_to"),
                     F.lit(True).alias("is_current"), F.lit(1).alias("_new"))
    rows = dim.withColumn("_new", F.lit(0)).unionByName(inc, allowMissingColumns=True)
    in_order = Window.partitionBy(key).orderBy("valid_from", "_new")
    before = F.lag(F.struct(*cols)).over(in_order)
    rows = rows.withColumn("_before", F.when(F.col("_new") == 1, before)).withColumn(
        "_replaced", (F.col("_new") == 0) & F.coalesce((F.lead("_new").over(in_order) == 1)
                                                       & (F.lead("valid_from").over(in_order) == F.col("valid_from")), F.lit(False)))
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"_before.{c}"))
    covered = F.col("_before.valid_to") > F.col("valid_from")
    rows = rows.withColumn("_same", F.coalesce((F.col("_new") == 1) & covered & same, F.lit(False)))
    rows = rows.withColumn("_noop", F.coalesce(F.lead("_same").over(in_order), F.lit(False)))
    rows = rows.where(~F.col("_same") & (~F.col("_replaced") | F.col("_noop")))
    in_place = (F.col("_new") == 1) & (F.col("_before.valid_from") == F.col("valid_from"))
    for c in cols:
        if c == sk:
            rows = rows.withColumn(c, F.when(in_place, F.col(f"_before.{c}")).otherwise(F.col(c)))
        elif c not in (key, *tracked, "valid_from", "valid_to", "is_current"):
            rows = rows.withColumn(c, F.when(F.col("_new") == 1, F.col(f"_before.{c}")).otherwise(F.col(c)))
    later = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    rows = rows.withColumn("valid_to", F.least("valid_to", later)).withColumn("is_current", F.col("valid_to") == F.lit(OPEN_END_DATE))
    rows = rows.select(*cols, "_new")
    if not sk:
        return rows.select(*cols)
    rows = materialize(rows, "scd2")
    fresh = (F.col("_new") == 1) & F.col(sk).isNull()
    start = rows.select(F.coalesce(F.max(sk), F.lit(0))).scalar()      # scalar subquery; every key of dim is still there
    opened = with_surrogate_key(rows.where(fresh).drop(sk), [key], sk, start=start)
    return rows.where(~fresh).select(*cols).unionByName(opened.select(*cols))


def scd1_apply(dim: DataFrame, incoming: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """SCD1: overwrite attributes in place (no history); new keys are added."""
    inc = latest_per_key(incoming.select(key, *attrs), [key], list(attrs)).alias("i")
    d = dim.alias("d")
    j = d.join(inc, F.col(f"d.{key}") == F.col(f"i.{key}"), "full_outer")
    out = []
    for c in dim.columns:
        if c == key:
            out.append(F.coalesce(F.col(f"d.{key}"), F.col(f"i.{key}")).alias(c))
        elif c in attrs:
            out.append(F.when(F.col(f"i.{key}").isNotNull(), F.col(f"i.{c}"))
                       .otherwise(F.col(f"d.{c}")).alias(c))
        else:
            out.append(F.col(f"d.{c}").alias(c))
    return j.select(*out)


def scd6_apply(dim: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str],
               effective: dt.date, current_cols: Sequence[str], sk: str | None = None) -> DataFrame:
    """SCD6 (1+2+3): SCD2 history for ``tracked`` plus ``current_<col>``
    columns that carry the latest value on every version of the key."""
    base = dim.drop(*[f"current_{c}" for c in current_cols])
    hist = scd2_apply(base, incoming, key, tracked, effective, sk)
    current = F.max(F.when(F.col("is_current"), F.struct(*current_cols))).over(Window.partitionBy(key))
    hist = hist.withColumn("_current", current)
    return hist.select(key, *[c for c in base.columns if c != key], *[F.col(f"_current.{c}").alias(f"current_{c}") for c in current_cols])


def insert_ignore(target: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` to append under ``INSERT ... ON CONFLICT (key) DO
    NOTHING``: one row per new key, none for keys already in ``target``.
    Running the load twice appends nothing the second time."""
    key = list(key)
    rest = [c for c in incoming.columns if c not in key]
    fresh = latest_per_key(incoming, key, rest) if rest else incoming.select(*key).distinct()
    return fresh.join(target.select(*key), key, "left_anti")


def upsert(target: DataFrame, incoming: DataFrame, key: Sequence[str],
           order: Sequence[str] = ()) -> DataFrame:
    """MERGE: rows of ``incoming`` replace target rows with the same key, other
    target rows stay. ``order`` picks the winner among duplicate incoming keys
    (newest first), else the whole row breaks ties."""
    key = list(key)
    rest = [c for c in incoming.columns if c not in key]
    newest = latest_per_key(incoming, key, list(order) or rest)
    return target.join(newest.select(*key), key, "left_anti").unionByName(newest.select(*target.columns))


def with_occurrence(rows: DataFrame, key: Sequence[str], out: str = "occurrence") -> DataFrame:
    """Rows equal in all of ``key`` numbered from 1, so that each of them is told apart
    (the same numbers in every load that holds them all)."""
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(*key).orderBy(*key)))


def fact_sales(items: DataFrame, orders: DataFrame, dim_customer: DataFrame,
               dim_product: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Fact rows at order-item grain with surrogate keys of the *current*
    dimension versions: one for every row of ``items``, equal ones included.
    Facts of keys without a current version are dropped; ``keep`` names more
    columns of ``items`` to carry on."""
    dc = dim_customer.where("is_current").select("customer_id", "customer_sk")
    dp = dim_product.where("is_current").select("product_id", "product_sk")
    return (items.join(orders.select("order_id", "customer_id", "order_date"), "order_id")
            .join(dc, "customer_id").join(dp, "product_id")
            .select("order_id", "line_number", date_key("order_date").alias("date_key"), "customer_sk", "product_sk",
                    "product_id", "quantity", F.col("subtotal").alias("amount"), "created_at", "order_date", *keep))


def validity_lookup(facts: DataFrame, dim: DataFrame, key: str, fact_date: str,
                    keep: Sequence[str]) -> DataFrame:
    """The dimension version valid on each fact's date: ``key`` equal and
    ``valid_from <= date < valid_to`` (half open); null ``keep`` columns where
    there is none. Versions of a key don't overlap; of several that start on
    one day the row that sorts last counts.

    Versions and facts are swept once in (key, day) order, in range segments:
    the newest version at or before a fact is carried to it and holds if it has
    not ended. No pairs of a key's versions and facts are formed, so a hot key
    with many versions costs its rows once, in many tasks. Facts with a null
    key or date, and versions with a null key or start, meet nothing.
    """
    version = F.struct(*[F.col(c).alias(c) for c in dict.fromkeys([*keep, "valid_to"])])
    kind = dim.select(version.alias("v")).schema["v"].dataType
    fact = F.struct(*[F.col(f"`{c}`").alias(c) for c in facts.columns])
    shape = facts.select(fact.alias("f")).schema["f"].dataType
    day = lambda c: F.col(c).cast("timestamp_ntz")
    versions = (dim.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull())
                .groupBy(F.col(key).alias("_k"), day("valid_from").alias("_t")).agg(F.max(version).alias("_version"))
                .select("_k", "_t", F.lit(0).alias("_side"), F.lit(0).cast("long").alias("_tie"), F.lit(None).cast(shape).alias("_fact"), "_version"))
    # equal facts may share a place: which of them comes first makes no difference
    rows = facts.select(F.col(key).alias("_k"), day(fact_date).alias("_t"), F.lit(1).alias("_side"),
                        F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]).alias("_tie"), fact.alias("_fact"),
                        F.lit(None).cast(kind).alias("_version"))
    swept = carry_forward(versions.unionByName(rows), ["_k"], ["_t", "_side", "_tie"], "_version", "_hit").where("_side = 1")
    holds = F.col("_k").isNotNull() & (F.col("_t") < day("_hit.valid_to"))
    return swept.select(*[F.col(f"_fact.`{c}`").alias(c) for c in facts.columns],
                        *[F.when(holds, F.col(f"_hit.{c}")).alias(c) for c in keep])


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Column defaults on load (``status`` -> 'created', ``created_at`` -> now):
    ``coalesce(col, default)``; a missing column is added with the default."""
    out = df
    for c, v in defaults.items():
        dv = v if isinstance(v, Column) else F.lit(v)
        out = out.withColumn(c, F.coalesce(F.col(c), dv) if c in df.columns else dv)
    return out
