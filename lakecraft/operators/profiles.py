"""Column profiles that merge: each load is profiled once, history is never scanned again.

A profile has one row per column: exact counts and bounds, and two sketches, for
distinct values (HLL with 2^12 registers: standard error 1.6 %) and for quantiles of
numbers and times (KLL with k = 200: rank error about 1.7 % at 99 % confidence). Rows of
several loads are merged by sums, minima, maxima and unions of the sketches, whatever
the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecraft.sources.loads import append_part, read_parts

LOG_REGISTERS, KLL_K = 12, 200


def _measure(df: DataFrame, c: str) -> tuple[str, Column | None]:
    """Kind of a column, and its values as doubles (seconds for dates and times; null for other kinds)."""
    kind, col = df.schema[c].dataType, F.col(f"`{c}`")
    if isinstance(kind, T.NumericType):
        return "number", col.cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "time", (F.unix_micros(col.cast("timestamp_ntz").cast("timestamp")) / 1e6)
    return "text", None


def profile_state(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column, in one pass: column, kind, n_rows, n_null, lo, hi, lo_text, hi_text, values, quantiles (sketches)."""
    cols = list(columns or df.columns)
    aggs, rows = [F.count(F.lit(1)).alias("_n")], []
    for i, c in enumerate(cols):
        kind, x = _measure(df, c)
        text = F.col(f"`{c}`").cast("string")
        aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"z{i}"), F.hll_sketch_agg(text, F.lit(LOG_REGISTERS)).alias(f"d{i}")]
        if x is None:
            aggs += [F.min(text).alias(f"a{i}"), F.max(text).alias(f"b{i}")]
        else:
            aggs += [F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}"), F.kll_sketch_agg_double(x, KLL_K).alias(f"q{i}")]
        number, word = F.lit(None).cast("double"), F.lit(None).cast("string")
        lo, hi, lo_text, hi_text = (number, number, f"a{i}", f"b{i}") if x is None else (f"a{i}", f"b{i}", word, word)
        pick = lambda v, name: (F.col(v) if isinstance(v, str) else v).alias(name)
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.col("_n").alias("n_rows"), F.col(f"z{i}").alias("n_null"),
                             pick(lo, "lo"), pick(hi, "hi"), pick(lo_text, "lo_text"), pick(hi_text, "hi_text"),
                             F.col(f"d{i}").alias("values"), (F.lit(None).cast("binary") if x is None else F.col(f"q{i}")).alias("quantiles")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def merge_profiles(states: DataFrame) -> DataFrame:
    """Rows of any number of profiles to one per column."""
    return states.groupBy("column", "kind").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.min("lo_text").alias("lo_text"), F.max("hi_text").alias("hi_text"), F.hll_union_agg("values").alias("values"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"))


def report(state: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """column, kind, n_rows, n_null, lo, hi, lo_text, hi_text, n_distinct (estimate), quantiles (estimates at ``ranks``; null for
    text and for columns without a value). Times are seconds since 1970."""
    at = F.array(*[F.lit(float(r)) for r in ranks])
    some = (F.col("kind") != "text") & (F.col("n_null") < F.col("n_rows"))
    return state.select("column", "kind", "n_rows", "n_null", "lo", "hi", "lo_text", "hi_text",
                        F.hll_sketch_estimate("values").alias("n_distinct"),
                        F.when(some, F.kll_sketch_get_quantile_double("quantiles", at)).alias("quantiles"))


def add_profile(spark: SparkSession, df: DataFrame, path: str, columns: Sequence[str] | None = None) -> int:
    """Profile one load and keep the result in ``path``."""
    return append_part(spark, profile_state(df, columns), path, "profile")


def stored_profile(spark: SparkSession, path: str, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame | None:
    """The report over all loads profiled so far; reads nothing but their profiles."""
    states = read_parts(spark, path)
    return None if states is None else report(merge_profiles(states), ranks)
