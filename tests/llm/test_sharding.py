from collections import Counter

import pytest

from lakecraft.llm.sharding import SHARDS, SIZE, fill, op5_sharding, place


def brute(names, size):
    """Turn by turn, each shard's whole order of preference written out."""
    import hashlib
    order = []
    for n in names:
        d = hashlib.sha256(n.encode()).digest()
        a, s = int.from_bytes(d[:8], "big") % size, int.from_bytes(d[8:16], "big") % (size - 1) + 1
        order.append([(a + j * s) % size for j in range(size)])
    out = {}
    while len(out) < size:
        for shard, slots in enumerate(order):
            if len(out) < size:
                out[next(x for x in slots if x not in out)] = shard
    return [out[i] for i in range(size)]


def test_table():
    names = [f"n{i}" for i in range(7)]
    owner = fill(names, 211)
    assert owner == brute(names, 211)
    share = Counter(owner)
    assert max(share.values()) - min(share.values()) <= 1
    big = fill([f"s{i}" for i in range(20)], 10_007)
    less = fill([f"s{i}" for i in range(19)], 10_007)
    moved = sum(a != b for a, b in zip(big, less) if a != 19)
    assert moved < 0.1 * 10_007                        # the rest mostly stays
    heavy = Counter(fill(["a", "b", "c"], 10_007, [1, 1, 2]))
    assert abs(heavy[2] - 10_007 / 2) <= 2
    for bad in (([], 211), (["a", "a"], 211), (["a"], 210)):
        with pytest.raises(ValueError):
            fill(*bad)


def test_query(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    got = op5_sharding(spark, path).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    owner = fill([f"shard-{i:03d}" for i in range(SHARDS)], SIZE)
    assert all(owner[r.slot] == r.shard for r in got)
    slots = {r.doc_id: r.s for r in docs.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {SIZE}) s").collect()}
    assert all(slots[r.doc_id] == r.slot for r in got)
    assert max(Counter(r.shard for r in got).values()) < 3 * len(got) / SHARDS


def test_edges(spark):
    df = spark.createDataFrame([(1, "a", "x"), (None, None, "y"), (None, "b", None), (1, "a", "x")], "k long, shard string, Slot string")
    got = place(df, ["k"], ["a", "b", "c"], 101)
    assert sorted(got.columns) == ["k", "shard", "slot"]
    by = Counter((r.k, r.shard) for r in got.collect())
    assert sorted(by.values()) == [2, 2]
    assert place(df.limit(0), ["k"], ["a"], 101).count() == 0
    assert len(place(df, ["k", "shard"], ["a", "b"], 101).collect()) == 4
    assert "Python" not in got._jdf.queryExecution().toString()
