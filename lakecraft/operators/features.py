"""Feature views and point-in-time retrieval.

* :class:`FeatureView` declares entity key, timestamp, TTL and feature schema
  and validates a source against it.
* :func:`as_of_join` is the training-set join: for each request row the
  latest feature row of the same entity at or before the request time, unless
  it is older than the TTL. Requests and feature rows are unioned and swept in
  (entity, time) order; the sweep is range-partitioned, so one entity's rows
  may span many tasks (no group is pinned to one task, no pairs are formed).
* :func:`materialize_latest` and :func:`lookup` are the offline versions of
  materialization into a serving table and online lookup.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecraft.functions.scalars import ntz
from lakecraft.operators.windows import carry_forward, latest_per_key


@dataclass(frozen=True)
class FeatureView:
    name: str
    entity: str
    timestamp_field: str
    ttl: dt.timedelta
    features: dict   # feature name -> Spark SQL type name

    def validate(self, source: DataFrame) -> list[str]:
        """Problems with ``source`` (missing columns, wrong types); empty if fine."""
        types = dict(source.dtypes)
        problems = []
        for col in [self.entity, self.timestamp_field, *self.features]:
            if col not in types:
                problems.append(f"missing column {col}")
        for col, t in self.features.items():
            if col in types and types[col] != t:
                problems.append(f"{col}: expected {t}, found {types[col]}")
        return problems


def _ttl_seconds(ttl: dt.timedelta | None) -> int | None:
    return None if ttl is None else int(ttl.total_seconds())


def as_of_join(requests: DataFrame, features: DataFrame, key: str, request_ts: str, feature_ts: str,
               feature_cols: Sequence[str], ttl: dt.timedelta | None = None) -> DataFrame:
    """Point-in-time join. Every request row is kept; its features are those
    of the newest feature row with ``feature_ts <= request_ts`` (same key),
    null if none or if older than ``ttl``. Feature timestamps must be unique
    per key. Output: request columns + ``feature_cols`` + ``feature_ts``."""
    req_cols = requests.columns
    feat = F.struct(F.col(feature_ts).alias("_fts"), *[F.col(c) for c in feature_cols])
    r = requests.select(F.col(key).alias("_k"), F.col(request_ts).cast("timestamp_ntz").alias("_t"),
                        F.lit(1).alias("_side"), F.struct(*req_cols).alias("_req"),
                        F.lit(None).cast(features.select(feat.alias("f")).schema["f"].dataType).alias("_feat"))
    f = features.select(F.col(key).alias("_k"), F.col(feature_ts).cast("timestamp_ntz").alias("_t"),
                        F.lit(0).alias("_side"),
                        F.lit(None).cast(requests.select(F.struct(*req_cols).alias("r")).schema["r"].dataType)
                        .alias("_req"), feat.alias("_feat"))
    # feature rows sort before requests at the same instant (<= is inclusive);
    # a hash of the request breaks remaining ties
    # of equal rows it doesn't matter which comes first: both carry the same value
    both = r.unionByName(f).withColumn("_tie", F.xxhash64(F.to_json("_req")))
    swept = carry_forward(both, ["_k"], ["_t", "_side", "_tie"], "_feat", "_hit")
    out = swept.where(F.col("_side") == 1)
    ttl_s = _ttl_seconds(ttl)
    fresh = F.col("_hit").isNotNull()
    if ttl_s is not None:
        fresh = fresh & (F.col("_hit._fts").cast("timestamp_ntz")
                         >= F.col("_t") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(ttl_s)))
    return out.select(*[F.col(f"_req.{c}").alias(c) for c in req_cols],
                      *[F.when(fresh, F.col(f"_hit.{c}")).alias(c) for c in feature_cols],
                      F.when(fresh, F.col("_hit._fts")).alias(feature_ts))


def materialize_latest(features: DataFrame, key: str, ts: str, start=None, end=None) -> DataFrame:
    """Latest feature row per entity with ``start < ts <= end`` (an aggregate).
    Run incrementally with ``start`` = previous ``end`` and upsert the result
    into the serving table."""
    f = features
    if start is not None:
        f = f.where(F.col(ts) > ntz(start))
    if end is not None:
        f = f.where(F.col(ts) <= ntz(end))
    rest = [c for c in f.columns if c not in (key, ts)]
    return latest_per_key(f, [key], [ts, *rest])


def lookup(entities: DataFrame, serving: DataFrame, key: str, ts: str, feature_cols: Sequence[str],
           now, ttl: dt.timedelta | None) -> DataFrame:
    """Features for a list of entities from the serving table; values older
    than ``ttl`` at ``now`` (or missing) come back null."""
    s = serving.select(key, ts, *feature_cols)
    j = entities.join(s, key, "left")
    fresh = F.col(ts).isNotNull()
    if ttl is not None:
        fresh = fresh & (F.col(ts) >= ntz(now) - F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.lit(_ttl_seconds(ttl))))
    return j.select(*entities.columns, *[F.when(fresh, F.col(c)).alias(c) for c in feature_cols],
                    F.when(fresh, F.col(ts)).alias(ts))


def materialize_incremental(serving: DataFrame | None, features: DataFrame, key: str, ts: str,
                            last_end, end) -> DataFrame:
    """One incremental materialization run: the latest rows in ``(last_end,
    end]`` replace the entities' serving rows (upsert); entities without new
    rows keep theirs. Equal to a full run over ``(-inf, end]``."""
    from lakecraft.operators.warehouse import upsert
    fresh = materialize_latest(features, key, ts, last_end, end)
    return fresh if serving is None else upsert(serving, fresh, [key])
