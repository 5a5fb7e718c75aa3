import re
from collections import defaultdict

import pytest

from lakecraft.llm.components import components, joined_components
from lakecraft.llm.minhash import drop_near_duplicates, near_duplicates, op6_minhash_near_dedup

SEP = re.compile(r"[^\x20\x09-\x0D]+")


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def sets_of(rows, width):
    out = []
    for _, t in rows:
        w = SEP.findall(fold(t or ""))
        out.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    return out


def brute(rows, width, percent=80):
    sets = sets_of(rows, width)
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        near = defaultdict(int)
        for x in s:
            for k in where[x]:
                if k < i:
                    near[k] += 1
        for k, n in near.items():
            if 100 * n >= percent * (len(s) + len(sets[k]) - n):
                parent[root(i)] = root(k)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = root(i)
            least[r] = min(d, least.get(r, d))
    return sorted(((d, len(s), least.get(root(i)), d == least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = sorted(map(tuple, op6_minhash_near_dedup(spark, path).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    assert got == brute(rows, 2)
    assert any(not r[3] for r in got)


def test_chain_around_a_hub(spark):
    """Near copies of one text: many link to it, some only to another copy."""
    import random
    rng = random.Random(3)
    base = [f"w{rng.randrange(10_000)}" for _ in range(60)]
    rows = [(0, " ".join(base))]
    for i in range(1, 160):
        w = list(base if i % 5 else rows[rng.randrange(len(rows))][1].split())
        for k in rng.sample(range(len(w)), rng.choice([1, 2, 3, 4])):
            w[k] = f"x{i}_{k}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, near_duplicates(docs, width=2).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    assert got == brute(rows, 2)


def test_near_misses_of_a_hub(spark, monkeypatch):
    """Texts just below the threshold to the hub and to each other stay apart, over many small blocks."""
    import random
    from lakecraft.llm import minhash
    monkeypatch.setattr(minhash, "BLOCK", 24)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 70):
        w = list(base)
        for k in rng.sample(range(len(w)), rng.choice([2, 5, 6, 7, 8, 9])):
            w[k] = f"x{i}_{k}" if rng.random() < .7 else f"y{k}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, near_duplicates(docs, width=2).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    assert got == brute(rows, 2)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, "One"), (4, "one"), (5, "a b"), (6, "A  b\n"), (7, "a b a b a b"), (None, "a b"), (8, long), (9, long + " tail"),
            (6, "A  b\n"), (10, "É x"), (11, "é x"), (12, " \t"), (None, None)]
    docs = spark.createDataFrame([(*r, 5, "z") for r in rows], "doc_id long, text string, n int, key string")
    got = sorted(map(tuple, near_duplicates(docs, width=2).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    want = [(d, n, c, True if d is None and c is None else k) for d, n, c, k in brute(rows, 2)]
    assert got == sorted(want, key=str)
    out = drop_near_duplicates(docs, width=2)
    assert out.columns == docs.columns
    left = sorted((r.doc_id for r in out.collect() if r.doc_id is not None))
    assert left == [1, 2, 3, 5, 7, 8, 10, 11, 12]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7), (None, 3)] + [(1000, k) for k in range(1001, 1050)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 150: 100, 200: 100, **{k: 1000 for k in range(1000, 1050)}}


def test_joined_components(spark):
    """New edges between, inside and beside known components give what all edges give at once."""
    old = [(1, 2), (2, 3), (10, 11), (20, 21), (30, 31)] + [(40, k) for k in range(41, 60)]
    new = [(3, 10), (11, 2), (21, 45), (70, 71), (71, 31), (1, 3), (80, 80)]
    table = lambda rows: spark.createDataFrame(rows, "u long, v long")
    as_dict = lambda df: {r.node: r.component for r in df.collect()}
    got = as_dict(joined_components(components(table(old)), table(new)))
    assert got.pop(80) == 80
    assert got == as_dict(components(table(old + new)))
    assert as_dict(joined_components(components(table(old)), table([]))) == as_dict(components(table(old)))
