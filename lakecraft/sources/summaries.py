"""Summaries kept up to date by signed deltas.

A summary holds, for each group, the number of rows, exact sums and distinct
counts. Batches of changes (``op``, ``before``, ``after``) are turned into rows that count
+1 (the image after a create or update) or -1 (the image before an update or
delete); grouped, they are a delta that is added to the stored numbers. The
distinct counts rest on a second table with the number of rows of each (group,
column, value), so a value leaves its count when its last row goes.

Both tables are stored by *parts* (one column of the group, as text). A batch reads
the parts that its delta touches and writes their new content as a version of
its own; an entry for each of them, written last, makes the version count. Readers
take each part's newest version. A batch that failed leaves no entry and is
simply run again; one that has entries is not applied twice. Deltas commute, so
batches may come in any order as long as each row's images are right: when all have come the summary is
that of the rows that are left.

Minimum and maximum can't be kept under deletes from numbers alone and are not
offered; rebuild those.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakecraft.session import file_system, materialize

ENTRY = "version long, batch string, part string"
SUM_TYPE = "decimal(38,6)"


@dataclass(frozen=True)
class Summary:
    """``keys``: group columns; ``part``: the one of them that the store is divided by; ``sums`` and
    ``distincts``: result column -> source column."""
    keys: tuple[str, ...]
    part: str
    sums: dict[str, str] = field(default_factory=dict)
    distincts: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.part not in self.keys:
            raise ValueError(f"{self.part} is no group column")


def signed(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of change images with ``_sign``: the image after c, u and r counts +1, the one before u and d -1."""
    image = lambda side, sign: F.struct(F.lit(sign).alias("_sign"), *[F.col(f"{side}.{c}").alias(c) for c in columns])
    plus = F.when(F.col("op").isin("c", "u", "r") & F.col("after").isNotNull(), image("after", 1))
    minus = F.when(F.col("op").isin("u", "d") & F.col("before").isNotNull(), image("before", -1))
    return changes.select(F.explode(F.array_compact(F.array(plus, minus))).alias("r")).select("r.*")


def _part(spec: Summary) -> Column:
    return F.coalesce(F.col(spec.part).cast("string"), F.lit("null")).alias("_part")


def _deltas(rows: DataFrame, spec: Summary) -> tuple[DataFrame, DataFrame]:
    """Group delta and value delta of signed rows (partially aggregated; cancelled rows leave nothing)."""
    n = F.sum("_sign").cast("long")
    sums = [e for i, c in enumerate(spec.sums.values()) for e in (
        F.coalesce(F.sum(F.col("_sign") * F.col(c).cast("decimal(24,6)")), F.lit(0)).cast(SUM_TYPE).alias(f"s{i}"),
        F.sum(F.when(F.col(c).isNotNull(), F.col("_sign")).otherwise(0)).cast("long").alias(f"c{i}"))]
    groups = rows.groupBy(_part(spec), *spec.keys).agg(n.alias("n"), *sums)
    told = F.array(*[F.struct(F.lit(i).alias("_col"), F.col(c).cast("string").alias("_value")) for i, c in enumerate(spec.distincts.values())])
    if not spec.distincts:
        values = groups.where("false").select("_part", *spec.keys, F.lit(0).alias("_col"), F.lit("").alias("_value"), "n")
    else:
        values = (rows.select(_part(spec), *spec.keys, "_sign", F.inline(told)).where("_value IS NOT NULL")
                  .groupBy("_part", *spec.keys, "_col", "_value").agg(n.alias("n")).where("n <> 0"))
    return groups, values


def _entries(spark: SparkSession, path: str) -> list:
    """One row per part and version that touched it (bounded by the parts touched)."""
    try:
        return spark.read.schema(ENTRY).parquet(f"{path}/_entries").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _newest(entries: list) -> dict:
    """version by part."""
    out: dict = {}
    for e in entries:
        out[e.part] = max(out.get(e.part, 0), e.version)
    return out


def _stored(spark: SparkSession, path: str, table: str, schema, versions: dict) -> DataFrame:
    """The given versions of parts; only their folders are read."""
    by_version: dict = {}
    for part, v in versions.items():
        by_version.setdefault(v, []).append(part)
    chosen = F.lit(False)
    for v, parts in sorted(by_version.items()):
        chosen = chosen | ((F.col("version") == v) & F.col("_part").isin(*sorted(parts)))
    shape = schema.add("version", "long").add("_part", "string")
    try:
        return spark.read.schema(shape).parquet(f"{path}/{table}").where(chosen).drop("version")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], shape).drop("version")


def apply_changes(spark: SparkSession, path: str, spec: Summary, changes: DataFrame, batch, strict: bool = False) -> int:
    """Apply one batch of changes (``op``, ``before``, ``after``); returns the number of parts touched (0 for a
    batch applied before). An update may come before the create it follows: what is below zero until then is
    stored and not shown. ``strict`` refuses a batch that takes away rows which were never added."""
    entries = _entries(spark, path)
    if any(e.batch == str(batch) for e in entries):
        return 0
    columns = list(dict.fromkeys([*spec.keys, *spec.sums.values(), *spec.distincts.values()]))
    groups, values = _deltas(signed(changes, columns), spec)
    groups = materialize(groups, "summary-delta")                        # the batch is read once for each table
    touched = [r[0] for r in groups.select("_part").distinct().collect()]      # parts, not rows
    version = max((e.version for e in entries), default=0) + 1
    newest = _newest(entries)
    versions = {p: newest[p] for p in touched if p in newest}
    for table, delta, by in (("groups", groups, ["_part", *spec.keys]), ("values", values, ["_part", *spec.keys, "_col", "_value"])):
        numbers = [c for c in delta.columns if c not in by]
        kept = type(delta.schema)([f for f in delta.schema.fields if f.name != "_part"])
        both = delta if not versions else delta.unionByName(_stored(spark, path, table, kept, versions))
        merged = both.groupBy(*by).agg(*[F.sum(c).cast(delta.schema[c].dataType).alias(c) for c in numbers])
        obs = Observation(table)
        watched = merged.observe(obs, F.count_if(F.col("n") < 0).alias("below"))
        left = " OR ".join(f"`{c}` <> 0" for c in numbers)
        watched.where(left).hint("rebalance", "_part").write.mode("overwrite").partitionBy("_part").parquet(f"{path}/{table}/version={version}")
        if strict and obs.get["below"]:
            raise ValueError(f"batch {batch} takes away rows that {path} never had")
    rows = [(version, str(batch), p) for p in touched]
    if rows:
        spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("overwrite").parquet(f"{path}/_entries/version={version}")
    return len(rows)


def read_summary(spark: SparkSession, path: str, spec: Summary, like: DataFrame) -> DataFrame:
    """The groups with n_rows, sums (double, null where no value is) and distinct counts. ``like`` has the types of
    the source columns (a frame of images; it is not read)."""
    versions = _newest(_entries(spark, path))
    empty = like.where("false").withColumn("_sign", F.lit(1))
    groups, values = _deltas(empty, spec)
    shape = lambda df: type(df.schema)([f for f in df.schema.fields if f.name != "_part"])
    g = _stored(spark, path, "groups", shape(groups), versions)
    v = _stored(spark, path, "values", shape(values), versions)
    counted = v.where("n > 0").groupBy(*spec.keys).agg(*[F.count_if(F.col("_col") == i).alias(f"d{i}") for i in range(len(spec.distincts))], F.count(F.lit(1)).alias("_any"))
    joined = g.where("n > 0").drop("_part")
    same = F.lit(True)
    for k in spec.keys:
        same = same & joined[k].eqNullSafe(counted[k])
    rows = joined.join(counted, same, "left") if spec.distincts else joined
    return rows.select(*[joined[k] for k in spec.keys], F.col("n").alias("n_rows"),
                       *[F.when(F.col(f"c{i}") > 0, F.col(f"s{i}")).cast("double").alias(out) for i, out in enumerate(spec.sums)],
                       *[F.coalesce(F.col(f"d{i}"), F.lit(0)).cast("long").alias(out) for i, out in enumerate(spec.distincts)])


def drop_superseded(spark: SparkSession, path: str) -> list[int]:
    """Remove versions of which no part is the newest (run it when no reader is on them); returns their numbers."""
    entries = _entries(spark, path)
    live = set(_newest(entries).values())
    gone = sorted({e.version for e in entries} - live)
    for v in gone:
        for table in ("groups", "values"):
            fs, place = file_system(spark, f"{path}/{table}/version={v}")
            fs.delete(place, True)
    return gone
