"""Compaction of small files, bucketed tables, bucket checksums, mergeable profiles."""

import math
import os
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from lakecraft.operators import profiles as PR
from lakecraft.operators.cdc import diff_snapshots
from lakecraft.sources import compaction as CP
from lakecraft.sources import sinks as SK
from lakecraft.sources import tables as T
from lakecraft.sources import versions as V
from lakecraft.sources.loads import latest
from tests.conftest import SF_SMALL


def _files(path):
    out = {}
    for base, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                full = os.path.join(base, n)
                out[full] = (os.path.getsize(full), os.path.getmtime(full))
    return out


def _table(spark, path):
    """Partitions with one large file and many small ones, one with a null and one with an odd name."""
    big = spark.range(40_000).select("id", F.rand(1).alias("x"), F.lit("m 1/ü").alias("part"))
    big.coalesce(1).write.partitionBy("part").parquet(path, mode="append")
    for i in range(6):
        rows = spark.range(i * 100, i * 100 + 50).select("id", F.rand(i).alias("x"),
                                                         F.element_at(F.array(F.lit("m 1/ü"), F.lit("b+c"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("part"))
        rows.coalesce(1).write.partitionBy("part").parquet(path, mode="append")
    spark.range(3).select("id", F.rand(9).alias("x"), F.lit("lone").alias("part")).coalesce(1).write.partitionBy("part").parquet(path, mode="append")


def _rows(spark, path):
    return sorted((str(r.id), str(r.x), str(r.part)) for r in spark.read.parquet(path).select("id", "x", "part").collect())


def test_only_small_files_are_merged(spark, tmp):
    path = f"{tmp}/t"
    _table(spark, path)
    before, rows = _files(path), _rows(spark, path)
    small = {f for f, (size, _) in before.items() if size < 20_000 and "lone" not in f}
    got = CP.compact_small(spark, path, ["part"], small_bytes=20_000, target_bytes=1 << 20)
    after = _files(path)
    assert got == {"files_before": 18, "files_after": 3, "bytes_read": sum(before[f][0] for f in small)} and len(small) == 18
    untouched = set(before) - small
    assert {f: after[f] for f in untouched} == {f: before[f] for f in untouched} and len(after) == len(untouched) + 3
    assert _rows(spark, path) == rows
    assert not [n for n in os.listdir(path) if n.startswith("_compact")]
    assert CP.compact_small(spark, path, ["part"], small_bytes=20_000)["files_before"] == 0      # nothing left to merge


def test_predicate_and_target_size(spark, tmp):
    path = f"{tmp}/t"
    _table(spark, path)
    rows, before = _rows(spark, path), _files(path)
    total = sum(s for f, (s, _) in before.items() if "b+c" in unquote(f))
    got = CP.compact_small(spark, path, ["part"], 20_000, target_bytes=total // 2, where="part = 'b+c'")
    assert got["files_before"] == 6 and got["files_after"] == 3 - (total % 2 == 0) and _rows(spark, path) == rows
    assert all(f in _files(path) for f in before if "b+c" not in unquote(f))
    flat = f"{tmp}/flat"
    for i in range(4):
        spark.range(i, i + 2).select("id", F.lit(1.0).alias("x"), F.lit("p").alias("part")).coalesce(1).write.parquet(flat, mode="append")
    assert CP.compact_small(spark, flat)["files_after"] == 1 and spark.read.parquet(flat).count() == 8


@pytest.mark.parametrize("at", ["write", "move", "delete"])
def test_interrupted_runs(spark, tmp, monkeypatch, at):
    path = f"{tmp}/t"
    _table(spark, path)
    rows = _rows(spark, path)
    if at == "write":                                         # merged files are there, the list of replaced ones is not
        os.makedirs(f"{path}/_compact-{'0' * 32}/data/part=lone")
        assert _rows(spark, path) == rows
    else:
        swap = CP._swap
        monkeypatch.setattr(CP, "_swap", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
        with pytest.raises(RuntimeError):
            CP.compact_small(spark, path, ["part"], 20_000)
        monkeypatch.setattr(CP, "_swap", swap)
        if at == "delete":                                    # one merged file moved already, one replaced file gone
            staging = next(n for n in os.listdir(path) if n.startswith("_compact"))
            data = _files(f"{path}/{staging}/data")
            one = sorted(data)[0]
            os.rename(one, one.replace(f"{staging}/data/", "").replace("part-0", f"merged-{staging[9:17]}-part-0"))
            gone = spark.read.parquet(f"{path}/{staging}/replaced").orderBy("path").first().path
            os.remove(urlparse(gone).path)
        else:
            assert _rows(spark, path) == rows
    assert len(CP.recover(spark, path)) == 1
    assert _rows(spark, path) == rows and CP.recover(spark, path) == []


def test_bucketed_lookup_has_no_exchange(spark, tmp):
    from lakecraft.plans.mart import build_mart
    mart = build_mart(spark, SF_SMALL)
    SK.write_bucketed(mart.fact, "fact_b", "customer_sk", 8, f"{tmp}/fact")
    SK.write_bucketed(mart.dim_customer, "dim_customer_b", "customer_sk", 8, f"{tmp}/dim")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = SK.bucketed_lookup(spark, "fact_b", "dim_customer_b", "customer_sk", ["segment"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        per = got.groupBy("customer_sk", "segment").agg(F.sum("amount"))      # grouped by the bucket key: still none
        assert "Exchange" not in per._jdf.queryExecution().executedPlan().toString()
        want = mart.fact.join(mart.dim_customer.select("customer_sk", "segment"), "customer_sk")
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS fact_b")
        spark.sql("DROP TABLE IF EXISTS dim_customer_b")


def test_diff_reads_only_buckets_that_differ(spark, tmp):
    path, attrs = f"{tmp}/v", ["full_name", "segment"]
    c = T.customers(spark, SF_SMALL).select("customer_id", *attrs)
    ids = [r[0] for r in c.select("customer_id").orderBy("customer_id").limit(4).collect()]
    second = c.where(F.col("customer_id") != ids[0]).withColumn(
        "segment", F.when(F.col("customer_id") == ids[1], None).otherwise(F.col("segment"))).unionByName(c.limit(1).withColumn("customer_id", F.lit(-9).cast("long")))
    one, two = V.publish_bucketed(spark, c, path, "customer_id", 64), V.publish_bucketed(spark, second, path, "customer_id", 64)
    buckets = V.changed_buckets(spark, path, one, two)
    want = {r.b for r in spark.createDataFrame([(i,) for i in (ids[0], ids[1], -9)], "i long").select(F.pmod(F.xxhash64("i"), F.lit(64)).alias("b")).collect()}
    assert set(buckets) == want
    feed = V.newest_feed(spark, path, "customer_id", attrs)
    assert sorted(map(str, feed.collect())) == sorted(map(str, diff_snapshots(c, second, "customer_id", attrs).collect())) and feed.count() == 3
    plan = feed._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters: [" in line]
    assert len(scans) >= 2 and all(f"IN ({','.join(map(str, buckets))})" in line for line in scans)
    assert latest(spark, path)[1].where(F.col("_bucket").isin(*buckets)).count() < c.count() / 4
    # equal loads read nothing; a repeated row is seen; loads over other buckets are compared whole
    V.publish_bucketed(spark, second, path, "customer_id", 64)
    assert V.changed_buckets(spark, path, 2, 3) == [] and V.newest_feed(spark, path, "customer_id", attrs).count() == 0
    V.publish_bucketed(spark, second.unionByName(second.limit(1)).unionByName(second.limit(1)), path, "customer_id", 64)
    assert len(V.changed_buckets(spark, path, 3, 4)) == 1
    V.publish_bucketed(spark, c, path, "customer_id", 16)
    assert V.changed_buckets(spark, path, 1, 5) is None and V.diff_loads(spark, path, 1, 5, "customer_id", attrs).count() == 0


def test_merged_profiles(spark, tmp):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumn("maybe", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")))
    o = o.withColumn("never", F.lit(None).cast("double"))
    cols = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "maybe", "never"]
    path = f"{tmp}/p"
    assert PR.stored_profile(spark, path) is None
    for i in range(4):
        PR.add_profile(spark, o.where(F.col("o_orderkey") % 4 == i), path, cols)
    PR.add_profile(spark, o.where("false"), path, cols)                       # an empty load is profiled too
    ranks = (0.05, 0.5, 0.95)
    df = PR.stored_profile(spark, path, ranks)
    assert all("/p/load=" in f for f in df.inputFiles())                      # history itself is not read
    merged = {r.column: r for r in df.collect()}
    once = {r.column: r for r in PR.report(PR.profile_state(o, cols), ranks).collect()}
    n = o.count()
    for c in cols:
        a, b = merged[c], once[c]
        assert (a.kind, a.n_rows, a.n_null, a.lo, a.hi, a.lo_text, a.hi_text) == (b.kind, b.n_rows, b.n_null, b.lo, b.hi, b.lo_text, b.hi_text)
        exact = o.select(c).distinct().where(F.col(f"`{c}`").isNotNull()).count()
        assert abs(a.n_distinct - exact) <= max(1, 0.05 * exact)              # three standard errors
        if a.kind == "text" or a.n_null == n:
            assert a.quantiles is None
            continue
        value = F.col(c).cast("double") if a.kind == "number" else F.unix_micros(F.col(c).cast("timestamp")) / 1e6
        values = sorted(r[0] for r in o.select(value.alias("v")).where("v IS NOT NULL").collect())
        for rank, q in zip(ranks, a.quantiles):
            below, upto = sum(v < q for v in values) / len(values), sum(v <= q for v in values) / len(values)
            assert below - 0.03 <= rank <= upto + 0.03
    assert merged["o_orderstatus"].lo_text == "F" and math.isclose(merged["o_orderkey"].lo, 1.0, abs_tol=2)
