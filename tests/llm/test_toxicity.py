import zlib

import numpy as np

from lakecraft.llm.toxicity import Model, fit, nnpu_fit, op4_toxicity, score


def auc(pos, neg):
    both = np.concatenate([pos, neg])
    rank = np.empty(len(both))
    rank[np.argsort(both, kind="stable")] = np.arange(1, len(both) + 1)
    for v in np.unique(both):
        rank[both == v] = rank[both == v].mean()
    return (rank[:len(pos)].sum() - len(pos) * (len(pos) + 1) / 2) / (len(pos) * len(neg))


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    rows = op4_toxicity(spark, path).collect()
    assert len(rows) == 10_000
    for r in rows[:200]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7)
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    held = [(toxic[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in toxic]
    pos, neg = (np.array([s for y, s, _ in held if y == k]) for k in (1, 0))
    print("auc", auc(pos, neg), "hit", (pos >= .7).mean(), "false", (neg >= .7).mean())
    assert auc(pos, neg) > 0.85
    assert (neg >= 0.7).mean() < 0.01


def test_nnpu_beats_negative_reading():
    rng = np.random.default_rng(1)
    # feature 0 marks positives; half of the unlabelled rows are positive
    pos = [np.array([0]) for _ in range(300)]
    unl = [np.array([0] if rng.random() < 0.5 else [1]) for _ in range(2000)]
    w, b = nnpu_fit(pos, unl, 2, 0.5)
    assert 1 / (1 + np.exp(-(w[0] + b))) > 0.9 and 1 / (1 + np.exp(-(w[1] + b))) < 0.1


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", None), (3, "you Idiotic idiotx", "x"), (None, "idiot", "x"), (3, "fine", "x"),
                                  (4, "nice day " * 50_000, "x")] + [(i, f"hello word{i} idiot{i % 3}" if i % 2 else f"hello word{i}", "x") for i in range(10, 90)],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10, 90)] + [(11, 0), (None, 1), (12, None)], "doc_id long, toxic int")
    model = fit(docs, labels)
    assert model.fitted and 0.4 < model.prior < 0.6
    got = score(docs, model)
    assert got.columns == ["doc_id", "text", "score", "predicted"]
    by = {(r.doc_id, r.text): r.score for r in got.collect()}
    assert by[None, "idiot"] > by[2, ""] == by[1, None]
    assert by[3, "you Idiotic idiotx"] > 0.5 > by[3, "fine"]
    none = spark.createDataFrame([], labels.schema)
    assert [r.score for r in score(docs.limit(2), fit(docs, none)).collect()] == [0.0, 0.0]
    assert score(docs.limit(0), fit(docs.limit(0), labels)).count() == 0
    assert not Model().fitted


def test_sample_is_bounded_with_repeated_ids(spark, monkeypatch):
    """A toxic id with a third of all rows, equal and different ones, is drawn with one text."""
    sizes = []
    monkeypatch.setattr("lakecraft.llm.toxicity.nnpu_fit", lambda pos, unl, n, prior: sizes.append((len(pos), len(unl))) or nnpu_fit(pos, unl, n, prior, steps=2))
    rows = ([(1, f"idiot moron word{i}") for i in range(400)] + [(1, "idiot moron")] * 400
            + [(i, f"idiot moron fool{i}" if i % 2 else f"hello word{i}") for i in range(10, 1610)])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in (1, *range(10, 90))], "doc_id long, toxic int")
    assert fit(docs, labels, max_positive=50, max_unlabelled=100).fitted
    (pos, unl), = sizes
    assert 20 <= pos <= 80 and 50 <= unl <= 150
