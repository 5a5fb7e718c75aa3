"""Parallel window operators against brute force (pandas) on skewed data:
key 0 holds a third of all rows, so its group spans several range partitions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakecraft.operators import windows as W


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 3000
    key = np.where(np.arange(n) < n // 3, 0, rng.integers(1, 40, n))
    pdf = pd.DataFrame({"id": np.arange(n), "k": key.astype("int64"),
                        "t": rng.integers(0, 500, n).astype("int64"),
                        "v": rng.integers(-50, 100, n).astype("int64")})
    pdf.loc[pdf.sample(frac=0.1, random_state=1).index, "v"] = None
    return pdf, spark.createDataFrame(pdf.astype({"v": "Int64"}).astype(object).where(pdf.notna(), None))


def test_global_row_number(spark, skewed):
    pdf, df = skewed
    out = W.global_row_number(df, [W.Desc("t"), "id"], "rn", num_segments=7).toPandas()
    exp = pdf.sort_values(["t", "id"], ascending=[False, True]).reset_index(drop=True)
    exp["rn"] = np.arange(1, len(exp) + 1)
    got = out.set_index("id")["rn"]
    assert (got.loc[exp["id"]].to_numpy() == exp["rn"].to_numpy()).all()


def test_prefix_sums_grouped_hot_key(spark, skewed):
    pdf, df = skewed
    out = W.prefix_sums(df, {"run": F.col("v")}, ["t", "id"], ["k"], num_segments=6).toPandas()
    exp = pdf.sort_values(["k", "t", "id"]).copy()
    exp["run"] = exp["v"].fillna(0).groupby(exp["k"]).cumsum()   # SQL SUM skips nulls
    got = out.set_index("id")["run"].astype(float)
    e = exp.set_index("id")["run"].astype(float)
    # SQL running SUM is null until the first non-null value
    first = exp.assign(nn=exp["v"].notna()).groupby("k")["nn"].cumsum()
    e[first.set_axis(exp["id"]).loc[e.index].to_numpy() == 0] = np.nan
    pd.testing.assert_series_equal(got.sort_index(), e.sort_index(), check_names=False)


@pytest.mark.parametrize("dense", [False, True])
def test_rank_in_group(spark, skewed, dense):
    pdf, df = skewed
    out = W.rank_in_group(df, ["k"], ["t"], descending=True, out="r", dense=dense, num_segments=5).toPandas()
    exp = pdf.copy()
    exp["r"] = exp.groupby("k")["t"].rank(method="dense" if dense else "min", ascending=False).astype(int)
    assert out.set_index("id")["r"].sort_index().tolist() == exp.set_index("id")["r"].sort_index().tolist()


def test_lead_in_group(spark, skewed):
    pdf, df = skewed
    out = W.lead_in_group(df, ["k"], ["t", "id"], {"nt": "t"}, num_segments=6).toPandas()
    exp = pdf.sort_values(["k", "t", "id"]).copy()
    exp["nt"] = exp.groupby("k")["t"].shift(-1)
    got = out.set_index("id")["nt"].astype(float).sort_index()
    assert got.equals(exp.set_index("id")["nt"].astype(float).sort_index())


def test_carry_forward(spark, skewed):
    pdf, df = skewed
    out = W.carry_forward(df, ["k"], ["t", "id"], "v", "last_v", num_segments=6).toPandas()
    exp = pdf.sort_values(["k", "t", "id"]).copy()
    exp["last_v"] = exp.groupby("k")["v"].ffill()
    got = out.set_index("id")["last_v"].astype(float).sort_index()
    assert got.equals(exp.set_index("id")["last_v"].astype(float).sort_index())


def test_partition_total_and_latest(spark, skewed):
    pdf, df = skewed
    tot = W.partition_total(df, ["k"], F.col("v"), "s").toPandas()
    exp = pdf.groupby("k")["v"].sum()
    assert tot.groupby("k")["s"].first().astype(float).sort_index().equals(exp.astype(float).sort_index())
    latest = W.latest_per_key(df, ["k"], ["t", "id"]).toPandas().set_index("k").sort_index()
    e = pdf.sort_values(["t", "id"]).groupby("k").tail(1).set_index("k").sort_index()
    assert latest["id"].tolist() == e["id"].tolist()


def test_top_n_per_group(spark, skewed):
    pdf, df = skewed
    out = W.top_n_per_group(df, ["k"], [F.col("t").desc(), F.col("id")], 2).toPandas()
    exp = pdf.sort_values(["t", "id"], ascending=[False, True]).groupby("k").head(2)
    assert sorted(out["id"]) == sorted(exp["id"])
