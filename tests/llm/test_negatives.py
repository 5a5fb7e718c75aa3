"""Hard negatives: the threshold search and the query against exhaustive scoring and SQL."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecraft.llm import negatives as N
from tests.conftest import SF_MID, SF_SMALL

SHAPE = "vec_id long, embedding array<float>, label int"


def exhaustive(rows, every=50, shift=True):
    """Plain Python over (id, vector, label), straight from the definition."""
    fit = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        fit.append((i, [math.floor(256 * float(x)) for x in v], (label + 1) % 10 if shift and i % 7 == 0 else label))
    out = []
    for a, av, al in fit:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(av, v)), i, label) for i, v, label in fit if i != a and len(v) == len(av)]
        scored.sort()
        near = [(i, -s) for s, i, label in scored if label == al][:5]
        for p, ps in near:
            far = [(i, -s) for s, i, label in scored if label != al and 50 * ps <= -100 * s <= 95 * ps][:3]
            out += [(a, p, r + 1, i, ps, s) for r, (i, s) in enumerate(far)]
    return sorted(out)


def test_search_stops_early_and_is_exact():
    """Few dimensions: the threshold ends the search before all rows are met, ties included; more dimensions: all are met."""
    rng = np.random.default_rng(5)
    for dims in (1, 3, 40):
        x = rng.integers(-9, 10, (5000, dims))
        ids, labels = rng.permutation(5000) * 3, rng.integers(0, 4, 5000)
        lists = N.Lists(ids, labels, x)
        anchors = rng.integers(-9, 10, (60, dims))
        anchors[0] = 0
        allowed = [lists.labels != t % 4 for t in range(60)]
        windows = [[(-(1 << 62), 1 << 62), (10, 60), (50, 60), (10 ** 6, 10 ** 7), (5, 4)][t % 3:3 + t % 3] for t in range(60)]
        met = []
        for a, ok, ws, found in zip(anchors, allowed, windows, lists.search(anchors, allowed, windows, 3, met)):
            score = lists.x @ a
            for (lo, hi), (at, got) in zip(ws, found):
                fit = np.flatnonzero(ok & (score >= lo) & (score <= hi))
                want = fit[np.lexsort((lists.ids[fit], -score[fit]))][:3]
                assert at.tolist() == want.tolist() and got.tolist() == score[want].tolist()
        assert len(met) == 60 and (min(met) == 5000) == (dims == 40)


def test_search_with_large_integers():
    x = np.array([[1 << 30, -(1 << 30)], [(1 << 30) + 1, -(1 << 30)], [1 << 30, -(1 << 30) - 1]])
    lists = N.Lists(np.array([3, 2, 1]), np.zeros(3, int), x)
    ((at, score),), = lists.search(x[:1], [np.ones(3, bool)], [[(-(1 << 62), 1 << 62)]], 3)
    assert score.tolist() == [(1 << 61) + (1 << 30), (1 << 61) + (1 << 30), 1 << 61] and at.tolist() == [0, 1, 2]
    wide = np.tile(x, (100, 1))
    (found,), = N.Lists(np.arange(300), np.zeros(300, int), wide).search(x[:1], [np.ones(300, bool)], [[(-(1 << 62), 1 << 62)]], 150)
    assert found[0].tolist() == sorted(i for i in range(300) if i % 3)[:150]


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_equals_exhaustive_and_sql(spark, sf):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    df = N.op11_hard_negatives(spark, sf)
    assert df.columns == names
    got = sorted(tuple(r) for r in df.collect())
    assert got and got == exhaustive(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    cur = con.execute(N.OP11_SQL)
    at = [[c[0] for c in cur.description].index(n) for n in names]
    assert sorted(tuple(r[i] for i in at) for r in cur.fetchall()) == got


def _op(spark, rows, shape=SHAPE, every=10):
    df = spark.createDataFrame(rows, shape)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(tuple(r) for r in N.mine(df, F.col("id") % every == 0, label).collect())


def test_small_blocks_copies_and_hot_labels(spark, monkeypatch):
    """Many blocks and chunks, one label with a third of the rows, a group of copies: the same rows."""
    monkeypatch.setattr(N, "BLOCK", 60)
    monkeypatch.setattr(N, "CHUNK", 16)
    rng = np.random.default_rng(8)
    base = rng.normal(0, 0.2, (400, 6)).astype(np.float32)
    base[100:220] = base[100]
    rows = [(int(i), [float(x) for x in v], 3 if i % 3 == 0 else int(rng.integers(0, 9))) for i, v in enumerate(base)]
    got = _op(spark, rows + rows[:50])
    assert got == exhaustive(rows, 10) and len(got) > 100


def test_odd_rows(spark):
    v = lambda *x: [float(a) if a is not None else None for a in x]
    rows = [(10, v(1, 0), 1), (1, v(0.9, 0), 1), (2, v(0.6, 0), 2), (3, v(0.6, 0), 3), (4, v(0.6, 0), 2), (5, v(0.5, 0), 2),
            (6, v(float("nan"), 0), 2), (8, v(float("inf"), 0), 1), (9, v(None, 0), 2), (11, None, 2), (12, v(0.8, 0), None),
            (13, [], 2), (14, v(1, 0, 0), 0), (15, v(0.7, 0, 0), 2), (None, v(0.6, 0), 2), (20, v(0, 0), 1), (21, v(-1, 0), 1),
            (30, v(1, 0, 0), 5), (31, v(0.5, 0, 0), 5), (40, v(1e12, 0), 2)]
    got = _op(spark, rows)
    small = [r for r in rows if r[0] != 40]
    assert got == exhaustive(small, 10)
    assert {r[0] for r in got} >= {10, 20} and [r[3] for r in got if r[:2] == (10, 1)] == [2, 3, 4]
    # rows of one id count once, the least label and vector; clashing names are not read
    twice = [(*r, "x", 1.5) for r in small] + [(2, v(0.9, 0), 2, "y", 2.5), (2, v(0.1, 0), 9, "z", 0.0)] + [(10, v(1, 0), 1, "x", 1.5)] * 5
    assert _op(spark, twice, SHAPE + ", id string, score double") == got
    assert _op(spark, []) == []
    assert _op(spark, [(i, v(1, 1), 4) for i in range(30) if i % 7]) == []          # no row of another label


def test_windows_of_negative_scores(spark):
    near = spark.createDataFrame([(1, 2, 7), (1, 3, 0), (1, 4, -7), (2, 5, 1 << 60), (2, 6, 101)], "anchor_id long, pid long, ps long")
    got = {(r.anchor_id, w.pid): (w.lo, w.hi) for r in N.negative_windows(near, 50, 95).collect() for w in r.windows}
    for (a, p), (lo, hi) in got.items():
        ps = {2: 7, 3: 0, 4: -7, 5: 1 << 60, 6: 101}[p]
        assert lo == -(-50 * ps // 100) and hi == 95 * ps // 100
