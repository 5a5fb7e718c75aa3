"""Loads: empty ones, failed writes, history, retention, parts."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from lakecraft import jobs as J
from lakecraft.session import checkpoint_dir, expire_scratch, file_system, materialize, scratch_path
from lakecraft.sources import loads as L
from lakecraft.sources import tables as T
from tests.conftest import SF_SMALL


def _ids(df):
    return sorted(r[0] for r in df.collect())


def _folders(spark, path):
    fs, place = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place))


def test_a_load_without_rows_is_a_load(spark, tmp):
    path = f"{tmp}/t"
    assert L.latest(spark, path) == (0, None) and L.history(spark, path).count() == 0
    assert L.publish(spark, spark.range(5).toDF("x"), path) == 5
    assert L.publish(spark, spark.range(0).toDF("x"), path) == 0
    n, df = L.latest(spark, path)
    assert n == 2 and df.columns == ["x"] and df.count() == 0
    assert [(r.load, r.n_rows) for r in L.history(spark, path).collect()] == [(2, 0), (1, 5)]
    assert L.publish(spark, spark.range(2).toDF("x"), path) == 2
    assert L.latest(spark, path)[0] == 3
    assert L.read_load(spark, path, 2).count() == 0 and L.read_load(spark, path, 1).count() == 5
    assert L.rollback(spark, path, 2) == 0                       # back to the empty content
    assert L.latest(spark, path)[0] == 4 and L.latest(spark, path)[1].count() == 0
    with pytest.raises(ValueError):
        L.read_load(spark, path, 9)
    with pytest.raises(ValueError):
        L.read_load(spark, path, as_of=dt.datetime(2001, 1, 1))
    first_empty = f"{tmp}/e"
    assert L.publish(spark, spark.range(0).toDF("x"), first_empty) == 0
    assert L.latest(spark, first_empty)[1].count() == 0


def test_an_empty_summary_is_not_stale(spark, tmp):
    orders = T.orders(spark, SF_SMALL)
    L.publish(spark, orders.groupBy("status").count(), f"{tmp}/s")
    L.publish(spark, orders.where("order_id < 0").groupBy("status").count(), f"{tmp}/s")
    assert L.latest(spark, f"{tmp}/s")[1].count() == 0


def test_failed_write_does_not_count(spark, tmp):
    path = f"{tmp}/t"
    L.publish(spark, spark.range(3).toDF("x"), path)
    with pytest.raises(Exception, match="stop"):
        L.publish(spark, spark.range(5).select(F.expr("IF(id < 4, id, CAST(raise_error('stop') AS BIGINT)) AS x")), path)
    assert L.latest(spark, path)[0] == 1
    spark.range(9).toDF("x").write.parquet(f"{path}/load=2", mode="overwrite")      # written, its entry not yet
    assert L.latest(spark, path)[0] == 1 and L.latest(spark, path)[1].count() == 3
    assert L.publish(spark, spark.range(4).toDF("x"), path) == 4
    assert _ids(L.latest(spark, path)[1]) == [0, 1, 2, 3]


def test_expire(spark, tmp):
    path = f"{tmp}/t"
    for n in (1, 2, 3):
        L.publish(spark, spark.range(n).toDF("x"), path)
    time.sleep(0.05)
    later = dt.datetime.now()
    older = L.read_load(spark, path, 2)
    assert L.expire(spark, path, dt.datetime(2001, 1, 1)) == []          # nothing that old
    assert L.expire(spark, path, later, keep=2) == [1]
    assert older.count() == 2                                            # a reader of a kept load goes on
    assert [r.load for r in L.history(spark, path).collect()] == [3, 2]
    assert L.expire(spark, path, later) == [2] and L.expire(spark, path, later) == []     # the newest stays; again: nothing
    assert L.latest(spark, path)[1].count() == 3
    assert _folders(spark, path) == ["_loads", "load=3"]
    spark.range(9).write.parquet(f"{path}/load=2")                       # what an interrupted run left
    L.publish(spark, spark.range(1).toDF("x"), path)
    L.expire(spark, path, dt.datetime.now() + dt.timedelta(hours=1), keep=2)
    assert _folders(spark, path) == ["_loads", "load=3", "load=4"]
    L.append_part(spark, spark.range(1), f"{tmp}/p")
    with pytest.raises(ValueError):
        L.expire(spark, f"{tmp}/p", later)
    with pytest.raises(ValueError):
        L.publish(spark, spark.range(1), f"{tmp}/p")


def test_parts(spark, tmp):
    path = f"{tmp}/p"
    assert L.read_parts(spark, path) is None
    assert L.append_part(spark, spark.range(2).toDF("x"), path) == 2
    assert L.append_part(spark, spark.range(0).toDF("x"), path) == 0
    assert L.append_part(spark, spark.range(5, 6).toDF("x"), path) == 1
    spark.range(9).toDF("x").write.parquet(f"{path}/load=3")             # never counted
    got = L.read_parts(spark, path)
    assert sorted((r.x, r.load) for r in got.collect()) == [(0, 1), (1, 1), (5, 2)]


def test_expire_scratch(spark):
    mine = materialize(spark.range(3), "llm-test")
    other = materialize(spark.range(4), "else")
    base = checkpoint_dir(spark)
    spark.range(1).write.mode("overwrite").parquet(scratch_path(spark, "llm-no-scratch-name"))
    assert expire_scratch(spark, dt.datetime(2001, 1, 1)) == []
    gone = expire_scratch(spark, dt.datetime.now() + dt.timedelta(seconds=2), prefix="llm-test")
    assert len(gone) == 1 and gone[0].startswith("llm-test-")
    assert "llm-no-scratch-name" in _folders(spark, base) and other.count() == 4
    with pytest.raises(Exception):
        mine.count()


def test_late_order_of_the_last_loaded_day_is_loaded_once(spark, tmp):
    d = f"{tmp}/src"
    for t in ("orders", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    o, li = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("orders", "lineitem"))
    top = o.agg(F.max("o_orderdate"), F.max("o_orderkey")).first()
    assert J.run_incremental_items(spark, d, f"{tmp}/i").steps["loaded"] == li.count()

    def more(key, days):
        order = o.limit(1).withColumn("o_orderkey", F.lit(key).cast(o.schema["o_orderkey"].dataType)) \
            .withColumn("o_orderdate", F.lit(top[0] - dt.timedelta(days=days)).cast(o.schema["o_orderdate"].dataType))
        item = li.limit(1).withColumn("l_orderkey", F.lit(key).cast(li.schema["l_orderkey"].dataType))
        order.write.mode("append").parquet(f"{d}/orders.parquet")
        item.unionByName(item).write.mode("append").parquet(f"{d}/lineitem.parquet")      # two equal items

    more(top[1] + 1, 0)
    more(top[1] + 2, 5)
    assert J.run_incremental_items(spark, d, f"{tmp}/i").steps["loaded"] == 4
    assert J.run_incremental_items(spark, d, f"{tmp}/i").steps["loaded"] == 0
    more(top[1] + 3, 0)
    assert J.run_incremental_items(spark, d, f"{tmp}/i", overlap_days=0).steps["loaded"] == 2
    assert L.read_parts(spark, f"{tmp}/i").count() == li.count() + 6
