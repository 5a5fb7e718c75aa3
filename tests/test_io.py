import datetime as dt
import json
import os

from pyspark.sql import functions as F

from lakecraft.functions.scalars import json_or_raw, partition_expr, try_number
from lakecraft.operators.warehouse import apply_defaults
from lakecraft.sources import files as IO
from lakecraft.sources import sinks as SK
from lakecraft.sources import tables as T
from lakecraft.streaming import events as SE
from tests.conftest import SF_SMALL


def test_partitioned_dynamic_overwrite(spark, tmp):
    df = spark.createDataFrame([("2025-01-01", 1), ("2025-01-02", 2)], "d string, n int")
    SK.write_parquet(df, f"{tmp}/p", partition_by=["d"])
    SK.write_parquet(spark.createDataFrame([("2025-01-02", 5)], "d string, n int"), f"{tmp}/p", partition_by=["d"])
    got = sorted((r.d, r.n) for r in spark.read.parquet(f"{tmp}/p").collect())
    assert [(str(d), n) for d, n in got] == [("2025-01-01", 1), ("2025-01-02", 5)]


def test_transforms_and_clustered_write(spark, tmp):
    ev = T.events(spark, SF_SMALL)
    SK.write_transformed(ev, f"{tmp}/ev", [("ev_day", "day", "ts"), ("b", "bucket:4", "user_id")])
    back = spark.read.parquet(f"{tmp}/ev")
    assert back.count() == ev.count() and back.select("b").distinct().count() <= 4
    p = back.where(F.col("ev_day") == dt.date(2024, 1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ev_day" in p
    SK.clustered_write(ev, f"{tmp}/sorted", ["user_id", "ts"], num_files=3)
    assert IO.list_files(spark, f"{tmp}/sorted").count() == 3
    row = spark.range(1).select(partition_expr("month", F.lit("2024-03-05 10:00:00").cast("timestamp")).alias("m"),
                                partition_expr("truncate:3", F.lit("abcdef")).alias("t")).first()
    assert (row.m, row.t) == ("2024-03", "abc")


def test_inventory_bronze_zones_preview(spark, tmp):
    inv = IO.file_inventory(spark.read.parquet(f"{SF_SMALL}/orders.parquet")).first()
    assert inv.record_count == T.orders(spark, SF_SMALL).count() and inv.file_size_in_bytes > 0
    landed = SK.bronze_land(spark.read.parquet(f"{SF_SMALL}/region.parquet"), f"{tmp}/bronze",
                            ingest_ts=dt.datetime(2025, 1, 1))
    assert landed.where(F.col("_source_file").contains("region.parquet")).count() == 5
    assert SK.create_zones(spark, f"{tmp}/lake") == ["bronze", "silver", "gold"]
    assert {r.namespace for r in IO.list_tables(spark).collect()} >= {"bronze", "silver", "gold"}
    T.customers(spark, SF_SMALL).createOrReplaceTempView("cust_preview")
    assert IO.preview(spark, "cust_preview", 10).count() == 10


def test_scalars_and_defaults(spark):
    row = spark.range(1).select(
        try_number(F.lit(" 12.5 ")).alias("a"), try_number(F.lit("1d")).alias("b"),
        json_or_raw(F.lit('{"x":1}')).alias("c"), json_or_raw(F.lit("[1,2]")).alias("d")).first()
    assert row.a == 12.5 and row.b is None and json.loads(row.c) == {"x": 1} and json.loads(row.d) == {"raw": "[1,2]"}
    df = spark.createDataFrame([(1, None)], "id int, status string")
    out = apply_defaults(df, {"status": "created", "created_at": F.lit(dt.datetime(2025, 1, 1))}).first()
    assert out.status == "created" and out.created_at == dt.datetime(2025, 1, 1)


def test_messages_and_copy_query(spark, tmp):
    msgs = SK.to_json_messages(spark.createDataFrame([(1, "click")], "user_id int, event string"), key="user_id")
    assert json.loads(msgs.first().value) == {"user_id": 1, "event": "click"}
    src = f"{tmp}/src"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as f:
        for i, e in enumerate(["click", "view", "click"]):
            f.write(json.dumps({"value": json.dumps({"event": e, "page": "/", "user_id": i}), "partition": 0,
                                "offset": i}) + "\n")
        f.write(json.dumps({"value": "{broken", "partition": 0, "offset": 3}) + "\n")
    SE.copy_query(SE.file_source(spark, src), f"{tmp}/all", f"{tmp}/ck0").awaitTermination()
    assert spark.read.json(f"{tmp}/all").count() == 3                       # no all-null row
    SE.rejects_query(SE.file_source(spark, src), f"{tmp}/bad", f"{tmp}/ck1").awaitTermination()
    assert [(r.value, r.offset) for r in spark.read.json(f"{tmp}/bad").collect()] == [("{broken", 3)]
    SE.copy_query(SE.file_source(spark, src), f"{tmp}/sink", f"{tmp}/ck", where="event = 'click'").awaitTermination()
    assert spark.read.json(f"{tmp}/sink").count() == 2


def test_synthetic_rows(spark):
    df = IO.synthetic_products(spark, 1000)
    r = df.agg(F.min("category_id"), F.max("category_id"), F.min("price"), F.max("price")).first()
    assert r[0] >= 0 and r[1] <= 9 and r[2] >= 10000 and r[3] < 1010000
    assert df.where(F.col("name") == "product_7").count() == 1


def test_compact_file_count(spark, tmp):
    df = spark.range(60_000).selectExpr("id", "IF(id < 50000, 'a:b c', 'x') AS p", "sha2(CAST(id AS STRING), 256) AS v")
    df.repartition(23).write.partitionBy("p").parquet(f"{tmp}/many")
    sizes = {}
    for r in IO.list_files(spark, f"{tmp}/many").collect():
        folder = r.path.rsplit("/", 1)[0].rsplit("/", 1)[1]
        sizes[folder] = sizes.get(folder, 0) + r.size
    target = max(sizes.values()) // 3 + 1
    want = {k: -(-v // target) for k, v in sizes.items()}
    assert sorted(want.values()) == [1, 3]
    assert SK.compact(spark, f"{tmp}/many", f"{tmp}/few", target, ["p"]) == sum(want.values())
    found = {}
    for r in IO.list_files(spark, f"{tmp}/few").collect():
        folder = r.path.rsplit("/", 1)[0].rsplit("/", 1)[1]
        found[folder] = found.get(folder, 0) + 1
    assert found == want
    assert sorted(map(tuple, spark.read.parquet(f"{tmp}/few").select("id", "p", "v").collect())) == sorted(map(tuple, df.collect()))


def test_unsplit_jdbc_read_is_refused(spark):
    import pytest
    with pytest.raises(ValueError):
        IO.extract_jdbc(spark, "jdbc:none", "t")


def test_order_dates_are_days(spark, tmp):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    hours = o.withColumn("o_orderdate", F.col("o_orderdate") + F.expr("make_dt_interval(0, cast(pmod(o_orderkey, 24) as int))"))
    hours.write.parquet(f"{tmp}/orders.parquet")
    from lakecraft.plans.dashboards import mv_daily_revenue
    assert sorted(map(tuple, mv_daily_revenue(spark, tmp).collect())) == sorted(map(tuple, mv_daily_revenue(spark, SF_SMALL).collect()))
    day = dt.date(2000, 5, 5)
    assert T.orders(spark, tmp, since=day, until=day).count() == T.orders(spark, SF_SMALL).where(F.to_date("order_date") == F.lit(day)).count()
    plan = T.orders(spark, SF_SMALL, since=day)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_loads_history_time_travel_rollback(spark, tmp):
    import pytest
    from lakecraft.sources import loads as L
    path = f"{tmp}/t"
    assert L.history(spark, path).count() == 0
    L.publish(spark, spark.range(3), path)
    L.publish(spark, spark.range(7), path)
    assert [(r.load, r.n_rows) for r in L.history(spark, path).collect()] == [(2, 7), (1, 3)]
    first = L.history(spark, path).where("load = 1").first().written_at
    assert L.read_load(spark, path, 1).count() == 3 and L.read_load(spark, path, as_of=first).count() == 3
    assert L.read_load(spark, path, as_of=dt.datetime(2100, 1, 1)).count() == 7
    assert L.rollback(spark, path, 1) == 3 and L.latest(spark, path)[0] == 3 and L.latest(spark, path)[1].count() == 3
    for bad in ({"load": 9}, {"as_of": dt.datetime(2000, 1, 1)}, {}):
        with pytest.raises(ValueError):
            L.read_load(spark, path, **bad)


def test_scalar_json_query_returns_the_operators_objects(spark, monkeypatch):
    from lakecraft.plans import loads
    from tests.conftest import SF_SMALL
    assert loads.scalar_json(spark, SF_SMALL).where("event_id % 3 = 0 AND payload IS NULL").count() == 0
    monkeypatch.setattr(loads, "json_or_raw", lambda c: F.to_json(F.struct(c.alias("raw"))))       # wraps objects too
    assert loads.scalar_json(spark, SF_SMALL).where("event_id % 3 = 0 AND payload IS NOT NULL").count() == 0
