import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakecraft.llm.packing import LIMIT, Plan, look_up, op3_best_fit_packing, pack_documents, vocabulary


def check_layout(rows, limit=LIMIT):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= limit
    return len(by)


def expected(docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(vocabulary())
    out = Counter()
    for d, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for p, s in enumerate(range(0, len(ids), LIMIT)):
            part = ids[s:s + LIMIT]
            out[d, p, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return out


def got(rows):
    return Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    path = f"/root/testdata/{sf}"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    rows = op3_best_fit_packing(spark, path).collect()
    assert got(rows) == expected(docs)
    total = sum(r.length for r in rows)
    assert check_layout(rows) <= -(-total // LIMIT) + 1


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "Hello  <|endoftext|> World x\x1cy don't ÉÀ é 12 日本"), (None, "a b"), (3, "x"), (3, "x"),
            (4, "word " * 9000), (5, "\x0b\x0c\r\n"), (6, "ΑΣ ΟΔΟΣ İ <|startoftext|>a")]
    docs = spark.createDataFrame([(*r, 9, "k") for r in rows], "doc_id long, text string, length int, extra string")
    out = pack_documents(docs, with_ids=True)
    assert set(out.columns) == {"doc_id", "text", "extra", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"}
    out = out.collect()
    assert got(out) == expected(rows)
    check_layout(out)
    for r in out:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_plan(seed):
    rng = random.Random(seed)
    limit = rng.choice([7, 64, 500])
    counts = {n: rng.choice([1, 1, 2, 5, 60]) for n in rng.sample(range(1, limit + 1), rng.randint(1, limit))}
    if seed % 3 == 0:
        counts = {n: c for n, c in counts.items() if n > limit // 3} or {limit: 3}
    plan = Plan.best(counts, limit)
    table = plan.table()
    seen = defaultdict(list)
    for length, n in counts.items():
        seq, off = look_up(table, np.full(n, length), np.arange(n))
        for s, o in zip(seq.tolist(), off.tolist()):
            seen[s].append((o, length))
    assert sum(map(len, seen.values())) == sum(counts.values()) and len(seen) == plan.sequences
    for parts in seen.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= limit
    # no more than first-fit decreasing
    bins = []
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        for i, b in enumerate(bins):
            if b >= n:
                bins[i] -= n
                break
        else:
            bins.append(limit - n)
    assert plan.sequences <= len(bins) * 1.02 + 1


def test_exact_complements():
    plan = Plan({60: 5, 40: 5, 50: 2, 30: 2, 20: 2, 45: 1, 25: 1, 18: 1, 12: 1}, 100)
    assert plan.sequences == 5 + 2 + 1
