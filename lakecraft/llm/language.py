"""Language identification by words first, then ever shorter character n-grams.

A word seen in training scores each language by the log of its frequency
there. An unseen word falls back to its 4-character n-grams (with word
boundaries); where none is known, to 3, 2 and 1 characters. A text's score is
the sum over its words.

The model is fitted on a bounded sample: expected ``max_rows`` labelled texts
(by a hash of id and text), shared evenly among the languages; those with fewer
are taken whole, and each may have ``MIN_ROWS`` however many languages there
are. At most ``max_words`` words and ``max_grams`` n-grams are kept, by the best
rank that a key has among a language's keys of its order, so that no language's
most frequent keys give way to another's rare ones. Keys seen once in all are kept
only for languages whose words (n-grams) are no more than their even share of that
number; a rare language keeps all it has. Prediction is one pass
without a shuffle over whole texts; workers memoise words in a bounded cache.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
rows with null lang, text or id don't train, and rows equal in id, text and
lang train once; without any training row all
texts are ``und``; equal scores take the first language by code point; columns
named like a result, in any case, are replaced; a very long text is read whole, word by word.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecraft.llm.tools import documents, stored
from lakecraft.llm.toxicity import fold

MAX_ROWS = 20_000
MIN_ROWS = 50             # texts that every language may have
MAX_WORDS = 150_000
MAX_GRAMS = 100_000
ORDERS = (4, 3, 2, 1)
ALL = (1 << 31) - 1
CACHE = 300_000
WORD = re.compile(r"[^\W\d_]+")


def grams(word: str, n: int) -> list[str]:
    w = f"^{word}$" if n > 1 else word
    return [w[i:i + n] for i in range(len(w) - n + 1)] if len(w) >= n else []


class Model:
    """Log frequencies: ``words`` and ``grams[n]`` map a key to one value per language."""

    def __init__(self, langs: list[str], words: dict, by_order: dict):
        self.langs, self.words, self.by_order = langs, words, by_order

    def vector(self, word: str) -> np.ndarray:
        v = self.words.get(word)
        if v is not None:
            return v
        for n in ORDERS:
            table = self.by_order.get(n, {})
            known = [table[g] for g in grams(word, n) if g in table]
            if known:
                return sum(known) * 0.5
        return np.zeros(len(self.langs), np.float32)


class _Memo(dict):
    """Word -> row of a growing matrix of score vectors."""

    def __init__(self, model: Model):
        self.model, self.rows = model, np.zeros((CACHE, len(model.langs)), np.float32)

    def __missing__(self, word):
        i = len(self)
        self.rows[i] = self.model.vector(word)
        self[word] = i
        return i

    def total(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(self.model.langs))
        for i in range(0, len(words), CACHE // 4):
            part = words[i:i + CACHE // 4]
            if len(self) + len(part) > CACHE:
                self.clear()
            out += self.rows[np.fromiter(map(self.__getitem__, part), np.int64, len(part))].sum(0, dtype=np.float64)
        return out


def level(sizes: list[int], total: int) -> float:
    """The bound on each size with which the sizes sum to ``total`` (or to all there is)."""
    left, bound = float(total), 0.0
    for i, n in enumerate(sorted(sizes)):
        bound = left / (len(sizes) - i)
        if n > bound:
            break
        left -= n
        bound = float(n)
    return bound


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS,
        max_words: int | None = MAX_WORDS, max_grams: int | None = MAX_GRAMS) -> Model:
    """Learn from texts with a language, at most about ``max_rows`` of them. Without ``max_words`` or
    ``max_grams`` (None) every word or n-gram of these texts is kept."""
    max_words, max_grams = (ALL if m is None else m for m in (max_words, max_grams))
    known = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where(
        "_id IS NOT NULL AND t IS NOT NULL AND l IS NOT NULL")
    mark = F.xxhash64(F.lit(11), "_id", "t")
    sizes = {r.l: r.n for r in known.groupBy("l").agg(F.count_distinct(mark).alias("n")).collect()}      # one row per language
    if not sizes:
        return Model([], {}, {})
    bound = max(MIN_ROWS, level(list(sizes.values()), max_rows))
    parts = docs.sparkSession.createDataFrame([(x, int(min(1.0, bound / n) * (1 << 30))) for x, n in sizes.items()], "l string, part long")
    drawn = known.join(F.broadcast(parts), "l").where(F.pmod(mark, F.lit(1 << 30)) < F.col("part")).select("_id", "t", "l").distinct().select("t", "l")

    def count(batches):
        for b in batches:
            by: dict[str, Counter] = {}
            for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by.setdefault(lang, Counter()).update(WORD.findall(t.lower()))
            out = Counter()
            for lang, words in by.items():
                for w, c in words.items():
                    out[lang, 0, w] += c
                    for n in ORDERS:
                        for g in grams(w, n):
                            out[lang, n, g] += c
            keys = list(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([k[2] for k in keys], pa.string()), pa.array(list(out.values()), pa.int64())], ["l", "n", "k", "c"])

    counts = stored(drawn.mapInArrow(count, "l string, n int, k string, c long").groupBy("l", "n", "k")
                    .agg(F.sum("c").alias("c")), "language-counts")
    # a key's rank in its language and order: the keys with a higher count, and a hashed place among those with its own;
    # a table of the distinct counts, which are fewer than the square root of twice the sample's words
    ties = counts.groupBy("l", "n", "c").agg(F.count("*").alias("same"))
    higher = F.sum("same").over(Window.partitionBy("l", "n").orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, -1))
    ties = ties.withColumn("higher", F.coalesce(higher, F.lit(0)))
    ranked = counts.join(F.broadcast(ties), ["l", "n", "c"]).withColumn("rank", F.col("higher") + F.pmod(F.xxhash64("k"), F.col("same")))
    # one row per key, best ranks first; bounded by the two parameters
    word = F.col("n") == 0
    held = counts.groupBy("l", word.alias("word")).agg(F.count(F.lit(1)).alias("keys")).collect()          # two rows per language
    few = {w: [r.l for r in held if r.word == w and r["keys"] <= share / len(sizes)] for w, share in ((True, max_words), (False, max_grams))}
    small = F.when(word, F.col("l").isin(few[True])).otherwise(F.col("l").isin(few[False]))
    keyed = ranked.groupBy("n", "k").agg(F.sum("c").alias("all"), F.min("rank").alias("rank"), F.bool_or(small).alias("small"),
                                         F.map_from_entries(F.collect_list(F.struct("l", "c"))).alias("by"))
    keyed = keyed.where("all > 1 OR small")
    totals = counts.groupBy("l", "n").agg(F.sum("c").alias("c")).collect()
    words = keyed.where("n = 0").orderBy("rank", F.desc("all"), "k").limit(max_words).collect()
    parts = keyed.where("n > 0").orderBy("rank", F.desc("all"), "n", "k").limit(max_grams).collect()
    langs = sorted({r.l for r in totals})
    sums = {(r.l, r.n): r.c for r in totals}
    # what an unseen key counts: the same for all languages, else one learned from few texts would win by what it hasn't seen
    unseen = {n: 0.5 / max(c for (_, m), c in sums.items() if m == n) for n in {m for _, m in sums}}

    def vector(r):
        v = np.array([np.log(r["by"].get(x, 0) / sums.get((x, r.n), 1) + unseen[r.n]) for x in langs])
        return (v - v.max()).astype(np.float32)

    by_order: dict[int, dict] = {}
    for r in parts:
        by_order.setdefault(r.n, {})[r.k] = vector(r)
    return Model(langs, {r.k: vector(r) for r in words}, by_order)


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus lang_pred and score, the predicted
    language's share of the length-tempered likelihood."""
    cols = [c for c in (keep or docs.columns) if c.lower() not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.words, model.by_order))      # bounded by max_words and max_grams
    left = docs.select(*[F.col(f"`{c}`") for c in cols], F.col(text_col).alias("_llm_text"))

    def run(batches):
        memo = _Memo(Model(*shared.value))
        langs = memo.model.langs
        for b in batches:
            pred, scores = [], []
            for t in b.column(b.num_columns - 1):
                t = t.as_py()
                words = WORD.findall(t.lower()) if t and langs else []
                if not words or not any(map(str.isalpha, t)):
                    pred.append("und")
                    scores.append(0.0)
                    continue
                z = memo.total(words)
                best = int(z.argmax())
                pred.append(langs[best])
                scores.append(float(1 / np.exp((z - z[best]) / np.sqrt(len(words))).sum()))
            yield pa.RecordBatch.from_arrays(b.columns[:-1] + [pa.array(pred, pa.string()), pa.array(scores, pa.float64())],
                                             b.schema.names[:-1] + ["lang_pred", "score"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return left.mapInArrow(run, ", ".join([f"`{c}` {kinds[c]}" for c in cols] + ["lang_pred string", "score double"]))


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """Contract op1: ids whose fold is 2 of 4 are held out of training."""
    docs = documents(spark, sf_dir)
    held = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = fit(docs.where(~held))
    return predict(docs.select("doc_id", "text", held.alias("held_out")), model, keep=["doc_id", "held_out"])
