import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecraft.llm.nearest import assign, calibrate, grow, op8_nearest_neighbours, search, visits


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        s = (x * x[q]).sum(1)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def lists(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{path}/embeddings.parquet").orderBy("vec_id").collect()
    rows = [r for r in rows if r.embedding is not None]
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want = brute(ids, x, np.flatnonzero(ids % 20 == 0), 20)
    got = lists(op8_nearest_neighbours(spark, path))
    assert got.keys() == want.keys()
    recall = np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / len(want[q]) for q in want])
    print("recall", sf, recall)
    assert recall >= 0.93
    for q in want:
        score = dict(want[q])
        assert all(abs(s - score[v]) < 1e-12 for v, s in got[q] if v in score)
        assert got[q] == sorted(got[q], key=lambda r: (-r[1], r[0]))


def test_visits_are_best_first_and_complete():
    x = np.random.default_rng(0).normal(size=(3000, 8))
    tree = grow(x)
    seen = list(visits(tree, tree.centres @ x[0]))
    assert sorted(seen) == list(range(tree.leaves)) and tree.leaves > 20
    assert calibrate(tree, x, 10, 0.5) <= calibrate(tree, x, 10, 0.9) <= calibrate(tree, x, 10, 1.0) <= tree.leaves
    assert assign(tree, x).max() < tree.leaves


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [2.0, 1.0]), (9, [-1.0, 0.0]), (10, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [2.0, 1.0]), (20, []), (40, None), (60, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, id int")
    got = lists(search(df, F.col("vec_id") % 20 == 0, k=4))
    assert got == {0: [(8, 2.0), (1, 1.0), (2, 1.0), (60, 0.5)], 60: [(8, 1.5), (0, .5), (1, .5), (2, .5)]}
    assert search(df.limit(0), F.lit(True)).count() == 0
    assert search(df.where("vec_id = 0"), F.lit(True)).count() == 0


def test_many_copies_of_one_vector(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([np.tile(rng.normal(size=(1, 8)), (9000, 1)), rng.normal(size=(1000, 8))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = lists(search(df, F.col("vec_id").isin(5, 9500), k=20))
    want = brute(np.arange(len(x)), x, [5, 9500], 20)
    assert [v for v, _ in got[5]] == [v for v, _ in want[5]]
    assert len(got[9500]) == 20


def test_sample_is_bounded_with_repeated_ids(spark, monkeypatch):
    """An id with a third of all rows adds to the sample what its different vectors do."""
    sizes = []
    monkeypatch.setattr("lakecraft.llm.nearest.calibrate", lambda tree, x, k, target: sizes.append(len(x)) or calibrate(tree, x, k, target))
    hot = spark.range(1, 10_000).where(F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1 << 30)) < (1 << 30) // 50).first().id     # drawn by its id alone
    x = np.random.default_rng(3).normal(size=(2500, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(x[:2000], 20_000)] + [(hot, v.tolist()) for v in x[2000:]] + [(hot, x[2000].tolist())] * 500
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = lists(search(vectors, F.col("vec_id") == hot, k=3, sample=200))
    assert 120 <= sizes[0] <= 280 and len(got[hot]) == 3
