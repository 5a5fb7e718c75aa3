import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lakecraft.llm.mixing import mix, mix_texts, op2_source_mixing, permuted, placed, slots
from lakecraft.llm.tools import stored

SEP = re.compile(r"[^\x20\x09-\x0D]+")


def want_targets(sizes, weights=(1, 2, 3), cap=3):
    """Iterative resharing, as the contract words it."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out = {}
    total = sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in out]
        left = total - sum(out.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return out | share
        out |= {s: cap * sizes[s] for s in over}


def check(rows, docs, block=32):
    size = Counter()
    for d, t, s in docs:
        size[s] += len(SEP.findall(t or ""))
    target = want_targets(size)
    source = defaultdict(list)
    for d, t, s in docs:
        source[d, len(SEP.findall(t or ""))].append(s)
    taken = Counter()
    assert len(rows) == len(docs)
    for r in rows:
        s = next(x for x in source[r.doc_id, r.size] if size[x] == r.source_size)
        assert r.target == pytest.approx(target[s], rel=1e-9, abs=1e-6)
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in size:
        assert abs(taken[s] - target[s]) <= 1.5 * block + 1e-6, (s, taken[s], target[s])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    path = f"/root/testdata/{sf}"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    rows = op2_source_mixing(spark, path).collect()
    check(rows, docs)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op2_source_mixing(spark, path).collect()))


def test_query_shows_the_shards_drawn(spark):
    path = "/root/testdata/sf0.001"
    rows = stored(placed(spark.read.parquet(f"{path}/documents.parquet")), "t")
    at = defaultdict(list)
    for r in mix(rows).join(rows.where("size > 0").select("id", "sid", "start"), ["sid", "start"]).collect():
        at[r.id].append(r.shard)
    got = op2_source_mixing(spark, path).collect()
    assert {r.doc_id for r in got if r.taken} == set(at)
    assert all((r.first_shard, r.last_shard) == ((min(at[r.doc_id]), max(at[r.doc_id])) if r.taken else (None, None)) for r in got)
    words = sum(r.taken for r in got)
    assert {s for x in at.values() for s in x} == set(range(max(r.last_shard or 0 for r in got) + 1)) and words > 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257, 1000])
def test_permutation(spark, n):
    got = spark.range(n).select(permuted(F.col("id"), F.lit(n), F.lit(5)).alias("p")).collect()
    assert sorted(r.p for r in got) == list(range(n))
    if n > 200:
        assert sum(r.p == i for i, r in enumerate(got)) < 10


def test_edges(spark, tmp_path):
    docs = [(1, "one two three", "b"), (2, None, "a"), (3, "", "a"), (None, "x " * 500, None), (4, "y " * 4000, "a"), (4, "y " * 4000, "a"),
            (5, "z", "c"), (6, "é\x85è  w", "d"), (7, "v " * 70, "e")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, source string, size int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    check(op2_source_mixing(spark, str(tmp_path)).collect(), docs)
    df.limit(0).write.parquet(str(tmp_path / "e" / "documents.parquet"))
    assert op2_source_mixing(spark, str(tmp_path / "e")).count() == 0
    spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string").write.parquet(str(tmp_path / "z" / "documents.parquet"))
    assert [tuple(r) for r in op2_source_mixing(spark, str(tmp_path / "z")).collect()] == [(1, 0, 0, 0.0, 0, None, None)]


def test_shards_and_blocks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = stored(placed(docs), "t")
    got = mix(rows, block=64, shard_blocks=100).collect()
    places = Counter()
    for r in got:
        places[r.shard, r.slot, r.sid, r.block] += r.words
    used = sorted((s, t) for s, t, *_ in places)
    assert len(set(used)) == len(used) == len(places)                      # a slot holds one block
    assert [s * 100 + t for s, t in used] == list(range(len(used)))         # and none is left out
    assert all(n <= 64 for n in places.values())
    again = Counter((s, b) for _, _, s, b in places)
    size = {r.sid: r.source_size for r in rows.collect()}
    for sid, n in size.items():
        times = [again[sid, b] for b in range(-(-n // 64))]
        assert max(times) - min(times) <= 1 and max(times) <= 3            # pass by pass
    by = defaultdict(Counter)
    for s, t, sid, _ in places:
        by[s][sid] += 1
    assert len(by) > 3 and any(a != b for a, b in zip(list(by.values()), list(by.values())[1:]))


def test_mixed_texts(spark):
    rows = [(i, " ".join(f"{i}_{k}" for k in range(1 + 37 * i % 300)), "ab"[i % 2] if i % 7 else None, "en", 5) for i in range(40)] + [(102, "same text", "a", "x", 1)] * 2 + [(99, None, "a", "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    out = mix_texts(docs, length_col="n_chars", block=50)
    assert out.columns == docs.columns
    texts = {r[0]: r[1] for r in rows}
    size, taken = Counter(), Counter()
    for r in rows:
        size[r[2]] += len((r[1] or "").split())
    for r in out.collect():
        assert r.text and r.text in texts[r.doc_id] and r.n_chars == len(r.text) and len(r.text.split()) <= 50
        taken[r.source] += len(r.text.split())
    target = want_targets(size)
    assert all(abs(taken[s] - target[s]) <= 75 for s in size)
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()
