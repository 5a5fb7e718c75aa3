"""Late events: shuffled files, restarts, replays, agreement with Spark's own watermark, the stream's balance."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecraft.operators.events import windowed_counts
from lakecraft.streaming import events as SE
from lakecraft.streaming import late as L

SCHEMA = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
                       T.StructField("ts", T.TimestampType()), T.StructField("id", T.LongType())])
DELAY = dt.timedelta(minutes=2)
_CLOCK = [1_700_000_000]


def _put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    p = f"{folder}/{name}"
    with open(p, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    _CLOCK[0] += 10
    os.utime(p, (_CLOCK[0], _CLOCK[0]))


def _event(i, second, kind="a"):
    ts = None if second is None else (dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return {"event_type": kind, "value": float(i % 5), "ts": ts, "id": i}


def _stream(spark, src):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)


def _files(seed, n_files=6, per_file=40):
    """Files in order with events shuffled between neighbours: some of them late, some without a time."""
    rng = random.Random(seed)
    out, i = [], 0
    for f in range(n_files):
        rows = []
        for _ in range(per_file):
            second = f * 300 + rng.randint(0, 300) - (rng.randint(200, 900) if rng.random() < .2 else 0)
            rows.append(_event(i, None if rng.random() < .05 else max(0, second)))
            i += 1
        rng.shuffle(rows)
        out.append(rows)
    return out


def _expected(files, size=None):
    """kind of every id, batch by batch."""
    top, kinds = None, {}
    for rows in files:
        wm = None if top is None else top - DELAY.total_seconds()
        for r in rows:
            if r["ts"] is None:
                kinds[r["id"]] = "rejected"
                continue
            s = (dt.datetime.strptime(r["ts"], "%Y-%m-%dT%H:%M:%SZ") - dt.datetime(2024, 1, 1)).total_seconds()
            past = wm is not None and (s < wm if size is None else (s // size + 1) * size <= wm)
            kinds[r["id"]] = "late" if past else "on_time"
            top = s if top is None else max(top, s)
    return kinds


def _stored(spark, path):
    return {r.id: k for k in L.KINDS for r in L.read_kind(spark, path, k, SCHEMA).collect()}


MINUTE = dt.timedelta(minutes=1)


@pytest.mark.parametrize("size", [None, MINUTE])
def test_on_time_late_and_rejected_are_the_input(spark, tmp, size):
    files = _files(3)
    src, path, ck = f"{tmp}/src", f"{tmp}/out", f"{tmp}/ck"
    for i, rows in enumerate(files[:3]):
        _put(src, f"{i:02d}.json", rows)
    flow = L.Flow()
    q = L.divide_query(_stream(spark, src), path, ck, DELAY, size=size)
    q.awaitTermination()
    for p in q.recentProgress:
        flow.note(p)
    for i, rows in enumerate(files[3:]):
        _put(src, f"{i + 3:02d}.json", rows)
    q = L.divide_query(_stream(spark, src), path, ck, DELAY, size=size)          # restarted
    q.awaitTermination()
    for p in q.recentProgress:
        flow.note(p)
    want = _expected(files, None if size is None else 60)
    got = _stored(spark, path)
    assert got == want and {"late", "on_time", "rejected"} == set(want.values())
    assert sum(L.read_kind(spark, path, k, SCHEMA).count() for k in L.KINDS) == sum(map(len, files))
    assert len(flow.entered) == len(files) and flow.reconcile(spark, path) == {}
    # a replayed batch is divided as it was
    batch = spark.createDataFrame([(r["event_type"], r["value"], r["ts"], r["id"]) for r in files[2]], "event_type string, value double, ts string, id long")
    L.divide(batch.withColumn("ts", F.to_timestamp("ts")), 2, path, DELAY, size=size)
    assert _stored(spark, path) == want


def test_windows_of_on_time_and_late_rows(spark, tmp):
    """What Spark's watermark drops is late here too; on-time windows and their corrections are all windows."""
    files = [[_event(i, s) for i, s in enumerate(seconds, 100 * n)] for n, seconds in enumerate(
        [[1, 30, 70], [400, 410, 5], [420, 290, 200, 1], [1000, 281], [2000, 900, 860, 840], [4000, 10]])]
    src, path = f"{tmp}/src", f"{tmp}/out"
    for i, rows in enumerate(files):
        _put(src, f"{i:02d}.json", rows)
    q = L.divide_query(_stream(spark, src), path, f"{tmp}/ck", DELAY, size=MINUTE)
    q.awaitTermination()
    q = (SE.windowed(_stream(spark, src), "1 minute", watermark="2 minutes").writeStream.outputMode("append").format("memory")
         .queryName("own_windows").trigger(processingTime="0 seconds").start())
    try:
        for _ in range(4):
            q.processAllAvailable()
        own = sorted(tuple(r) for r in spark.table("own_windows").collect())
        dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress if p.get("stateOperators"))
    finally:
        q.stop()
    on_time = windowed_counts(L.read_kind(spark, path, "on_time", SCHEMA), "1 minute")
    passed = {r[:3]: r[3] for r in own}
    assert all(passed.get((r.window_start, r.window_end, r.event_type), 10 ** 6) >= r.n_events for r in on_time.collect())
    late = L.read_kind(spark, path, "late", SCHEMA)
    assert late.count() >= dropped > 0
    assert sorted(r.id for r in late.collect()) == sorted(i for i, k in _expected(files, 60).items() if k == "late")
    # finished windows plus their corrections are the windows of all rows
    every = windowed_counts(spark.read.schema(SCHEMA).json(src), "1 minute")
    both = on_time.unionByName(L.window_corrections(spark, path, SCHEMA, "1 minute")).groupBy("window_start", "event_type").agg(F.sum("n_events"))
    assert sorted(tuple(r) for r in both.collect()) == sorted((r.window_start, r.event_type, r.n_events) for r in every.collect())


def test_flow_sees_what_is_missing(spark, tmp):
    path = f"{tmp}/out"
    assert L.batches(spark, path).count() == 0 and L.Flow().reconcile(spark, path) == {}
    df = spark.createDataFrame([("a", 1.0, dt.datetime(2024, 1, 1), 1), ("a", -1.0, dt.datetime(2024, 1, 1), 2)], SCHEMA)
    L.divide(df, 0, path, DELAY, usable=F.col("value") > 0)
    assert [(r.n_in, r.n_on_time, r.n_rejected) for r in L.batches(spark, path).collect()] == [(2, 1, 1)]
    flow = L.Flow()
    flow.entered = {0: 2}
    assert flow.reconcile(spark, path) == {}
    flow.entered = {0: 3, 1: 5}
    assert set(flow.reconcile(spark, path)) == {0, 1}
    with pytest.raises(ValueError):
        L.read_kind(spark, path, "other", SCHEMA)


def test_listener_hears_the_batches(spark, tmp):
    import time
    _put(f"{tmp}/src", "00.json", [_event(i, i) for i in range(7)])
    flow = L.Flow()
    spark.streams.addListener(flow)
    try:
        q = L.divide_query(_stream(spark, f"{tmp}/src"), f"{tmp}/out", f"{tmp}/ck", DELAY)
        q.awaitTermination()
        for _ in range(100):
            if flow.entered:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(flow)
    assert flow.entered == {0: 7} and flow.reconcile(spark, f"{tmp}/out") == {}
