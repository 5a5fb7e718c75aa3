"""Sessionization and the as-of join against brute force when one key holds a
third of all rows (its rows span several range segments)."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from lakecraft.operators import events as E
from lakecraft.operators import features as FS
from lakecraft.operators import windows as W


@pytest.fixture(scope="module")
def clicks():
    rng = np.random.default_rng(3)
    n = 4000
    user = np.where(np.arange(n) < n // 3, 0, rng.integers(1, 30, n))
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 3 * 86400, n), unit="s")
    return pd.DataFrame({"event_id": np.arange(n), "user_id": user.astype("int64"), "ts": ts})


def test_sessionize_matches_brute_force(spark, clicks, monkeypatch):
    monkeypatch.setattr(W, "_num_segments", lambda df, n: 6)
    df = spark.createDataFrame(clicks).selectExpr("event_id", "user_id", "CAST(ts AS TIMESTAMP) AS ts")
    got = E.sessionize(df, 1800).toPandas()
    p = clicks.sort_values(["user_id", "ts", "event_id"])
    gap = p.groupby("user_id")["ts"].diff()
    p["sn"] = (gap.isna() | (gap > pd.Timedelta(minutes=30))).astype(int).groupby(p["user_id"]).cumsum()
    exp = p.groupby(["user_id", "sn"]).agg(window_start=("ts", "min"), last=("ts", "max"), n_events=("ts", "size"))
    exp = exp.reset_index()
    exp["window_end"] = exp["last"] + pd.Timedelta(minutes=30)
    key = lambda f: sorted(zip(f.user_id, pd.to_datetime(f.window_start), pd.to_datetime(f.window_end),
                               f.n_events))
    assert key(got) == key(exp)
    native = E.session_counts_native(df, "30 minutes").toPandas()
    assert key(native) == key(got)
    by_key = E.session_counts_by_key(df, "30 minutes").toPandas()
    assert key(by_key) == key(got)


def test_as_of_join_hot_entity(spark, clicks, monkeypatch):
    monkeypatch.setattr(W, "_num_segments", lambda df, n: 5)
    feats = clicks.drop_duplicates(["user_id", "ts"]).iloc[::3].rename(columns={"ts": "fts"})
    feats = feats.assign(val=feats["event_id"] * 10)[["user_id", "fts", "val"]]
    reqs = clicks.iloc[1::2].rename(columns={"ts": "rts"})[["event_id", "user_id", "rts"]]
    ttl = dt.timedelta(hours=6)
    out = FS.as_of_join(spark.createDataFrame(reqs), spark.createDataFrame(feats), "user_id", "rts", "fts",
                        ["val"], ttl).toPandas()
    exp = pd.merge_asof(reqs.sort_values("rts"), feats.sort_values("fts"), left_on="rts", right_on="fts",
                        by="user_id", direction="backward")
    exp.loc[exp["fts"] < exp["rts"] - pd.Timedelta(ttl), "val"] = np.nan
    got = out.set_index("event_id")["val"].astype(float).sort_index()
    assert got.equals(exp.set_index("event_id")["val"].astype(float).sort_index())
