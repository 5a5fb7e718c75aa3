import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakecraft.llm import language as LG
from lakecraft.llm.language import Model, fit, level, op1_language_id, predict


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    rows = op1_language_id(spark, path).collect()
    true = {r.doc_id: r.lang for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    assert len(rows) == len(true)
    for r in rows[:200]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == true[r.doc_id] for r in held) >= 0.95 * len(held)


def test_back_off():
    import numpy as np
    v = lambda a, b: np.array([a, b], np.float32)
    m = Model(["a", "b"], {"cat": v(0, -5)}, {4: {"^cat": v(0, -1)}, 3: {"dog": v(-2, 0)}, 1: {"z": v(-1, 0)}})
    assert list(m.vector("cat")) == [0, -5]
    assert list(m.vector("cats")) == [0, -.5]        # ^cat is known among its 4-grams
    assert list(m.vector("dog")) == [-1, 0]          # only the 3-gram is
    assert list(m.vector("xz")) == [-.5, 0]
    assert list(m.vector("qq")) == [0, 0]


def test_edges(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "", None), (5, "12 ² ½ _ !!", "de"),
                                  (None, "the dog", "en"), (6, "the", None), (7, "und die " * 60_000, None), (1, "the cat and the dog", "en"), (8, "ДОМ", None)],
                                 "doc_id long, text string, lang string").selectExpr("*", "'x' AS score")
    model = fit(docs)
    assert model.langs == ["de", "en"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in predict(docs, model).collect()}
    assert got[3] == got[4] == got[5] == ("und", 0.0)
    assert got[1][0] == got[6][0] == got[None][0] == "en" and got[2][0] == got[7][0] == "de"
    assert got[8][0] in ("de", "en")
    empty = fit(docs.limit(0))
    assert {r.lang_pred for r in predict(docs, empty).collect()} == {"und"}
    assert predict(docs.limit(0), model).count() == 0


def test_level():
    assert level([30, 100, 20_000], 330) == 200 and level([3, 4], 100) == 4 and level([10, 10, 10], 15) == 5


def _many_and_few(spark, n=21_000, few=36):
    """A common language, and one of a few dozen rows; each row holds six words of its language."""
    word = lambda a, b: F.concat(F.lit(a), F.conv(F.pmod(F.xxhash64("id", "x"), F.lit(b)).cast("string"), 10, 20))
    rows = spark.range(n + few).withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(6))))
    rows = rows.withColumn("w", F.when(F.col("id") < n, word("ab", 3_000)).otherwise(word("yz", 40)))
    # words are of letters only
    rows = rows.withColumn("w", F.translate("w", "0123456789", "klmnopqrst"))
    return rows.groupBy("id").agg(F.concat_ws(" ", F.collect_list("w")).alias("text")).select(
        F.col("id").alias("doc_id"), "text", F.when(F.col("id") < n, "common").otherwise("rare").alias("lang"))


def test_rare_language_is_learned(spark):
    docs = _many_and_few(spark).cache()
    for sizes in (dict(max_rows=200), dict(max_words=100, max_grams=100), dict(max_rows=200, max_words=100, max_grams=100)):
        model = fit(docs, **sizes)
        assert model.langs == ["common", "rare"]
        assert any(w.startswith("yz") for w in model.words), sizes
        got = {(r.lang, r.lang_pred): r.n for r in predict(docs, model).groupBy("lang", "lang_pred").agg(F.count("*").alias("n")).collect()}
        assert got == {("common", "common"): 21_000, ("rare", "rare"): 36}, sizes
    docs.unpersist()


def test_repeated_rows_train_once(spark):
    docs = spark.createDataFrame([(1, "uno dos uno", "es")] * 500 + [(2, "one two one", "en"), (1, "tres tres", "es")], "doc_id long, text string, lang string")
    once, many = fit(docs.distinct()), fit(docs)
    assert {w: list(v) for w, v in once.words.items()} == {w: list(v) for w, v in many.words.items()}


def test_rare_languages_keep_words_seen_once(spark):
    """A language with few words keeps all of them, a large one only those seen again; without bounds all are kept."""
    big = [(i, f"alpha beta w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x", "big") for i in range(500)]
    rare = [(900, "uno dos tres", "rare"), (901, "cuatro uno", "rare")]
    df = spark.createDataFrame(big + rare, "doc_id long, text string, lang string")
    model = LG.fit(df, max_words=200, max_grams=10_000)
    assert {"uno", "dos", "tres", "cuatro"} <= set(model.words) and "waax" not in model.words and len(model.words) <= 200
    every = LG.fit(df, max_words=None, max_grams=None)
    assert set(every.words) == {w for _, t, _ in big + rare for w in t.split()}
    assert sum(map(len, every.by_order.values())) == len({(n, g) for w in every.words for n in LG.ORDERS for g in LG.grams(w, n)})


def test_whole_prediction_recomputed(spark):
    """Counting, log frequencies, back-off and the choice in plain Python, for every document (nothing is cut at this size)."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    counts, known = {}, {}
    for d in docs:
        if zlib.crc32(str(d.doc_id).encode()) % 4 != 2 and d.lang is not None and d.text is not None:
            known[d.doc_id, d.text, d.lang] = re.findall(r"[^\W\d_]+", d.text.lower())
    for (_, _, lang), words in known.items():
        for w in words:
            for n in range(5):
                edge = f"^{w}$" if n > 1 else w
                for key in [w] if n == 0 else [edge[i:i + n] for i in range(len(edge) - n + 1)]:
                    counts.setdefault(n, {}).setdefault(lang, Counter())[key] += 1
    langs = sorted({lang for _, _, lang in known})
    sums = {(n, x): sum(c.values()) for n, by in counts.items() for x, c in by.items()}
    unseen = {n: 0.5 / max(sums[n, x] for x in langs) for n in counts}
    assert all(len(c) <= LG.MAX_WORDS / len(langs) for c in counts[0].values())

    def logs(n, key):
        v = [math.log(counts[n][x][key] / sums[n, x] + unseen[n]) for x in langs]
        return [a - max(v) for a in v]

    model = fit(spark.createDataFrame([(i, t, x) for i, t, x in known], "doc_id long, text string, lang string"), max_grams=None)
    got = {r.doc_id: r for r in predict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"), model).collect()}
    for d in docs:
        words = re.findall(r"[^\W\d_]+", (d.text or "").lower())
        total = [0.0] * len(langs)
        for w in words:
            vectors = [logs(0, w)] if any(counts[0][x][w] for x in langs) else []
            half = not vectors
            for n in (4, 3, 2, 1) if half else ():
                edge = f"^{w}$" if n > 1 else w
                vectors = [logs(n, edge[i:i + n]) for i in range(len(edge) - n + 1) if any(counts[n][x][edge[i:i + n]] for x in langs)]
                if vectors:
                    break
            total = [t + sum(v[j] for v in vectors) * (0.5 if half else 1) for j, t in enumerate(total)]
        if not words:
            assert got[d.doc_id].lang_pred == "und"
            continue
        best = max(total)
        assert got[d.doc_id].lang_pred == langs[total.index(best)] or sorted(total)[-1] - sorted(total)[-2] < 1e-2
        score = 1 / sum(math.exp((t - best) / math.sqrt(len(words))) for t in total)
        assert got[d.doc_id].score == pytest.approx(score, abs=1e-3)
