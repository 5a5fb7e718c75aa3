import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecraft.llm.fingerprint import differing, edited_fingerprints, fingerprints, likeness, op7_document_fingerprints, tree, with_next


def brute(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for i, (d, t) in enumerate(rows):
        q = len(t) // 4
        e = t[:len(t) - q] + rows[(i + 1) % len(rows)][1][:q]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), e, rows[(i + 1) % len(rows)][1]))
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    path = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    got = {r.doc_id: r for r in op7_document_fingerprints(spark, path).collect()}
    assert len(got) == len(rows)
    assert [(d, got[d].n_chars, got[d].edited_sha256) for d, *_ in want] == [w[:3] for w in want]
    texts = spark.createDataFrame([(d, e) for d, _, _, e, _ in want], "doc_id long, text string")
    prints = {r.doc_id: r.fingerprint for r in fingerprints(docs).collect()}
    edited = {r.doc_id: r.fingerprint for r in fingerprints(texts).collect()}
    for i, (d, *_) in enumerate(want):
        r, after = got[d], want[(i + 1) % len(want)][0]
        assert r.fingerprint == prints[d] and r.edited_fingerprint == edited[d]
        assert r.near_edited == pytest.approx(likeness([prints[d]], [edited[d]])[0])
        assert r.near_next == pytest.approx(likeness([prints[d]], [prints[after]])[0])
    # an edit of the last quarter leaves the fingerprints alike, other texts are not
    near = np.array([got[d].near_edited for d, *_ in want])
    other = np.array([got[d].near_next for d, _, _, _, f in want])
    assert np.median(near) > 0.7 and np.mean(near > 0.5) > 0.95 and np.median(other) < 0.1


def test_many_segments(spark):
    rows = [(i * 7 % 1009, f"text {i} " * (i % 50)) for i in range(1009)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    from lakecraft.llm import fingerprint as M
    out = M.with_next(docs, "doc_id", "text", bytes_each=4000)
    seen = {}
    for part in out.rdd.glom().collect():
        for a, b in zip(part, part[1:]):
            if not a.extra:
                assert a.seg == b.seg
                seen[a.id] = b.id
    assert seen == {i: (i + 1) % 1009 for i in range(1009)}


def test_levels_fold(spark):
    a = " ".join(f"w{i * 37 % 1000}" for i in range(255))
    b = a + " " + " ".join(f"v{i}" for i in range(3))          # the coarser level
    c = " ".join(f"w{i * 37 % 1000}" for i in range(5000))
    docs = spark.createDataFrame(list(enumerate([a, b, c, a + "\n", "", " ", "x"])), "doc_id long, text string")
    p = [r.fingerprint for r in fingerprints(docs).orderBy("doc_id").collect()]
    assert len({x.split(".")[1] for x in p[:2]}) == 2
    assert likeness([p[0]], [p[1]])[0] > 0.9
    assert likeness([p[0]], [p[0]])[0] == likeness([p[4]], [p[4]])[0] == 1
    assert p[0] != p[3] and 0.9 < likeness([p[0]], [p[3]])[0] <= 1
    assert likeness([p[4]], [p[5]])[0] == likeness([p[4]], [p[6]])[0] == 0


def test_edges(spark):
    rows = [(5, None), (1, ""), (3, "Ünï cödé\n\ntwo"), (3, "again"), (2, "long wörd\n" * 40_000), (None, "none"), (4, "\n \t"), (4, "\n \t")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, fingerprint string")
    got = edited_fingerprints(docs).collect()
    assert sorted((tuple(r)[:3] for r in got), key=str) == sorted((w[:3] for w in brute(rows)), key=str)
    assert fingerprints(docs).columns == ["doc_id", "text", "fingerprint"]
    one = edited_fingerprints(docs.limit(0).unionByName(docs.where("doc_id = 3 and text = 'again'"))).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert edited_fingerprints(docs.limit(0)).count() == 0


def test_differing_branches_locate_edits(spark):
    lines = [f"line {i} " + "word " * (i % 7) for i in range(60)]
    new = lines[:20] + ["changed"] + lines[21:40] + lines[41:]
    left = tree(spark.createDataFrame([(1, "\n".join(lines)), (2, "same")], "doc_id long, text string"))
    right = tree(spark.createDataFrame([(1, "\n".join(new)), (2, "same")], "doc_id long, text string"))
    assert sorted((r.doc_id, r.paragraph) for r in differing(left, right).collect()) == [(1, 20), (1, 40)]
    assert sorted((r.doc_id, r.paragraph) for r in differing(right, left).collect()) == [(1, 20)]


def test_segments_hold_like_bytes(spark):
    rows = [(i, "word " * (2000 if i < 300 else 10)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = with_next(docs, "doc_id", "text").where("extra = 0").groupBy("seg").agg(F.sum(F.length("text")).alias("n"), F.min("id").alias("a"), F.max("id").alias("z")).collect()
    total = sum(5 * (2000 if i < 300 else 10) for i in range(3000))
    assert len(got) > 8 and max(r.n for r in got) < 3 * total / len(got)
    spans = sorted((r.a, r.z) for r in got)
    assert all(z < a for (_, z), (a, _) in zip(spans, spans[1:]))       # consecutive ids
