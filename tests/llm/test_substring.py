import hashlib
import re
from collections import Counter

import pytest

from lakecraft.llm.substring import op9_substring_dedup, remove_repeats

SEP = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=35):
    split = [SEP.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = sorted(map(tuple, op9_substring_dedup(spark, path).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 0


def test_edges(spark):
    long = " ".join(f"w{i % 9000}" for i in range(20_000))
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, None, "x"), (2, "", None), (3, passage, "x"), (4, f"a b {passage}\n\nc", "x"), (5, "one", "x"),
            (None, passage, None), (6, long, "x"), (7, "same " * 300, "x"), (8, f"é {passage[:-1]}", "x"), (3, passage, "x")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lang string, kept_text string, n_words int")
    got = remove_repeats(docs, bucket_bytes=2000)
    assert set(got.columns) == {"doc_id", "text", "lang", "kept_text", "n_words", "n_removed"}
    have = sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got.collect()), key=str)
    assert have == brute([r[:2] for r in rows])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(docs).count() == 0


def test_repeated_rows_give_their_ranges_once(spark, monkeypatch):
    from lakecraft.llm import substring
    made, spans = [], substring._spans
    monkeypatch.setattr(substring, "_spans", lambda ranges: made.append((ranges, spans(ranges))) or made[0][1])
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(1, passage)] * 200 + [(i, f"other{i} text") for i in range(2, 300)], "doc_id long, text string")
    assert {r.n_removed for r in remove_repeats(docs).where("doc_id = 1").collect()} == {60}
    (ranges, got), = made
    assert ranges.count() >= 200 > max(len(r["_llm_spans"]) for r in got.collect())
    assert got.count() == 1 and all(len(r["_llm_spans"]) == len(set(map(tuple, r["_llm_spans"]))) for r in got.collect())
