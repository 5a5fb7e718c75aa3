"""Property tests: segmented window operators equal a direct computation for
random inputs, group skews and range-partition counts."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakecraft.operators import windows as W


@st.composite
def frames(draw):
    n = draw(st.integers(1, 120))
    hot = draw(st.floats(0, 0.9))
    seed = draw(st.integers(0, 10_000))
    rng = np.random.default_rng(seed)
    k = np.where(rng.random(n) < hot, 0, rng.integers(0, 6, n))
    return pd.DataFrame({"id": np.arange(n), "k": k.astype("int64"), "t": rng.integers(0, 20, n).astype("int64"),
                         "v": rng.integers(-5, 10, n).astype("int64")}), draw(st.integers(1, 9))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(frames())
def test_prefix_sums_and_row_number(spark, case):
    pdf, parts = case
    df = spark.createDataFrame(pdf)
    got = W.prefix_sums(df, {"run": F.col("v"), "rn": F.lit(1).cast("long")}, ["t", "id"], ["k"],
                        num_segments=parts).toPandas().set_index("id").sort_index()
    exp = pdf.sort_values(["k", "t", "id"]).copy()
    exp["run"] = exp.groupby("k")["v"].cumsum()
    exp["rn"] = exp.groupby("k").cumcount() + 1
    exp = exp.set_index("id").sort_index()
    assert got["run"].tolist() == exp["run"].tolist() and got["rn"].tolist() == exp["rn"].tolist()
    g = W.global_row_number(df, [W.Desc("t"), "id"], "rn", num_segments=parts).toPandas()
    e = pdf.sort_values(["t", "id"], ascending=[False, True])["id"].tolist()
    assert g.sort_values("rn")["id"].tolist() == e


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(frames())
def test_lead_and_rank(spark, case):
    pdf, parts = case
    df = spark.createDataFrame(pdf)
    got = W.lead_in_group(df, ["k"], ["t", "id"], {"nt": "t"}, num_segments=parts).toPandas()
    exp = pdf.sort_values(["k", "t", "id"]).copy()
    exp["nt"] = exp.groupby("k")["t"].shift(-1)
    assert got.set_index("id")["nt"].astype(float).sort_index().equals(
        exp.set_index("id")["nt"].astype(float).sort_index())
    r = W.rank_in_group(df, ["k"], ["t"], descending=False, out="r", num_segments=parts).toPandas()
    er = pdf.groupby("k")["t"].rank(method="min").astype(int)
    assert r.set_index("id")["r"].sort_index().tolist() == er.set_axis(pdf["id"]).sort_index().tolist()


@st.composite
def clicks(draw):
    n = draw(st.integers(1, 80))
    seed = draw(st.integers(0, 10_000))
    rng = np.random.default_rng(seed)
    users = rng.integers(0, draw(st.integers(1, 4)), n)
    secs = rng.integers(0, draw(st.sampled_from([600, 3600, 20000])), n)   # dense to sparse
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(secs, unit="s")
    return pd.DataFrame({"event_id": np.arange(n), "user_id": users.astype("int64"), "ts": ts}), \
        draw(st.integers(1, 9))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(clicks())
def test_sessions_stitched_equal_brute_force(spark, monkeypatch, case):
    from lakecraft.operators import events as E
    pdf, parts = case
    monkeypatch.setattr(W, "_num_segments", lambda df, n: parts)
    df = spark.createDataFrame(pdf).selectExpr("event_id", "user_id", "CAST(ts AS TIMESTAMP_NTZ) AS ts")
    p = pdf.sort_values(["user_id", "ts", "event_id"])
    gap = p.groupby("user_id")["ts"].diff()
    p = p.assign(sn=(gap.isna() | (gap > pd.Timedelta(minutes=5))).astype(int).groupby(p["user_id"]).cumsum())
    exp = sorted((u, lo, hi + pd.Timedelta(minutes=5), c) for (u, _), lo, hi, c in zip(
        p.groupby(["user_id", "sn"]).groups, p.groupby(["user_id", "sn"])["ts"].min(),
        p.groupby(["user_id", "sn"])["ts"].max(), p.groupby(["user_id", "sn"]).size()))
    for fn in (lambda: E.session_counts_native(df, "5 minutes"), lambda: E.sessionize(df, 300)):
        got = fn().toPandas()
        assert sorted(zip(got.user_id, pd.to_datetime(got.window_start), pd.to_datetime(got.window_end),
                          got.n_events)) == exp
