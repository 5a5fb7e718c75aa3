"""Change-data operators: decode change envelopes, compute the current state,
the version history, apply changes to a table, and diff two snapshots.

Change rows carry ``op`` (c create, u update, d delete, r snapshot read),
``ts_ms`` (source commit time) and an ``offset``-like sequence that orders
changes with equal ``ts_ms``; ``before``/``after`` hold the row images.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecraft.functions.scalars import from_epoch_millis
from lakecraft.operators.windows import latest_per_key, lead_in_group


def envelope_schema(row: T.StructType) -> T.StructType:
    """``before/after/op/ts_ms/source`` envelope around a row type."""
    source = T.StructType([T.StructField("db", T.StringType()), T.StructField("table", T.StringType()),
                           T.StructField("lsn", T.LongType())])
    return T.StructType([T.StructField("before", row), T.StructField("after", row),
                         T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType()),
                         T.StructField("source", source)])


def decode_envelope(df: DataFrame, row: T.StructType, value: str = "value") -> DataFrame:
    """Parse change messages; accepts the bare envelope or one wrapped in
    ``payload`` (converter with schemas enabled). Undecodable messages keep a
    null ``op`` so callers can route them to a reject path."""
    text = F.col(value).cast("string")
    inner = F.coalesce(F.get_json_object(text, "$.payload"), text)
    parsed = F.from_json(inner, envelope_schema(row), {"mode": "PERMISSIVE"})
    return df.withColumn("_chg", parsed).select(
        *[c for c in df.columns], F.col("_chg.before").alias("before"), F.col("_chg.after").alias("after"),
        F.col("_chg.op").alias("op"), F.col("_chg.ts_ms").alias("ts_ms"))


def row_key(key: str) -> Column:
    """Key of a change: from ``after`` (c/u/r) or ``before`` (d)."""
    return F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}"))


def current_state(changes: DataFrame, key: str, order: Sequence[str] = ("ts_ms", "seq")) -> DataFrame:
    """Latest change per key by ``order`` (an aggregate: combined map-side, so
    a hot key costs one row per task); keys whose latest change is a delete
    are removed. Returns the ``after`` image columns plus ``ts_ms``.
    Duplicate and out-of-order deliveries do not change the result."""
    return live_rows(merge_changes(None, changes, key, order))


def history(changes: DataFrame, key: str, attrs: Sequence[str],
            order: Sequence[str] = ("ts_ms", "seq")) -> DataFrame:
    """Version history (SCD2 view) of each key from its changes: a version
    starts at a c/u/r change and ends at the key's next change (``valid_to``
    null while open); deletes end a version and start none. Duplicate
    deliveries of the same change are collapsed first."""
    keyed = changes.select(row_key(key).alias(key), *order, "op",
                           *[F.col(f"after.{a}").alias(a) for a in attrs])
    # a redelivered change has the same content but a new offset: collapse by content
    keyed = latest_per_key(keyed, [key, order[0], "op", *attrs], list(order[1:])) if len(order) > 1 \
        else keyed.dropDuplicates([key, order[0], "op", *attrs])
    nxt = lead_in_group(keyed, [key], list(order), {"_next_ts": order[0]})
    return nxt.where(F.col("op") != "d").select(
        key, *attrs, from_epoch_millis("ts_ms").alias("valid_from"),
        from_epoch_millis("_next_ts").alias("valid_to"))


def merge_changes(state: DataFrame | None, changes: DataFrame, key: str,
                  order: Sequence[str] = ("ts_ms", "seq")) -> DataFrame:
    """Newest change per key of ``state`` (an earlier result) and ``changes``:
    ``_key``, the order columns, ``op`` and ``after``. Deletes stay as
    tombstones and order columns stay with each row, so batches may be merged
    late, out of order or twice."""
    cols = ["_key", *order, "op", "after"]
    fresh = changes.withColumn("_key", row_key(key)).select(*cols)
    both = fresh if state is None else state.select(*cols).unionByName(fresh)
    return latest_per_key(both, ["_key"], list(order))


def live_rows(state: DataFrame) -> DataFrame:
    """Rows of a merged state without the deleted keys."""
    return state.where(F.col("op") != "d").select("after.*", "ts_ms")


def diff_snapshots(old: DataFrame, new: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Change feed between two snapshots: ``c`` for new keys, ``d`` for
    vanished keys, ``u`` where any attribute differs (null-safe); unchanged
    keys produce nothing. One full outer join on the key."""
    o, n = old.alias("o"), new.alias("n")
    j = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    has_o, has_n = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    differs = F.lit(False)
    for a in attrs:
        differs = differs | ~F.col(f"o.{a}").eqNullSafe(F.col(f"n.{a}"))
    op = (F.when(has_n & ~has_o, "c").when(has_o & ~has_n, "d").when(differs, "u"))
    row = lambda side: F.when(F.col(f"{side}.{key}").isNotNull(),
                              F.struct(*[F.col(f"{side}.{c}").alias(c) for c in [key, *attrs]]))
    return j.select(F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key), op.alias("op"),
                    row("o").alias("before"), row("n").alias("after")).where(F.col("op").isNotNull())
