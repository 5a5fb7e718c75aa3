"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples (P) and unlabelled text (U, a draw from the corpus as
it is) train a linear classifier in numpy. With class prior ``pi`` and sigmoid
loss ``l`` the risk is

    pi * E_P[l(f, +)] + max(0, E_U[l(f, -)] - pi * E_P[l(f, -)])

and when the bracket turns negative a step goes against its gradient, so that
the model doesn't fit the positives hidden in U as negatives.

Features say whether a word, a word beginning of 4 to 8 or a word ending of 4
to 6 bytes occurs in the whole text (lower-cased), and whether it is dense
there: at least ``DENSE_COUNT`` times and in ``DENSE_SHARE`` of the words.
Those kept are over-represented in P. One abusive word counts in a long text;
a stem that clean texts hold now and then counts where it is frequent.

Training reads a bounded sample: expected ``max_positive`` confirmed ids with one
text each, and ``max_unlabelled`` unlabelled rows, taken by a hash of id and
text, rows equal in both being one; the prior is counted over all labelled rows
given. Feature counts are summed by Spark; the
driver receives at most ``max_features`` features and the sample's entries in
them. Scoring is one pass without a shuffle.

Defined cases: null and empty texts get the score of a text without features;
a very long text is scored whole, in one slice;
rows with null ids are scored and never train; several labels for one id count
once, toxic winning; without any toxic example every score is 0; columns named
like a result, in any case, are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecraft.llm.tools import documents, stored, without
from lakecraft.llm.words import U64, Words, column_bytes, mix64, slices

MAX_POSITIVE = 4_000
MAX_UNLABELLED = 12_000
MAX_FEATURES = 1_024
MIN_POSITIVE = 4          # positive sample rows that a feature needs
MIN_LIFT = 4.0            # its rate in P over its rate in U (which 1 / prior bounds: less for a high prior)
THRESHOLD = 0.7
SLICE = 1 << 19           # bytes of text whose features are held at once
BEGINNINGS, ENDINGS = (4, 5, 6, 7, 8), (4, 5, 6)
DENSE_COUNT, DENSE_SHARE = 2, 0.006

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature hash) pairs: whole words, their beginnings and endings. The
    lowest bit is 0; with 1 the hash names the dense form of the feature."""
    prefix = words._prefix()
    size = words.end - words.start
    rows, found = [words.row], [words.spans_hash(words.start, words.end, prefix)]
    for n in sorted({*BEGINNINGS, *ENDINGS}):
        ok = size > n
        s, e, r = words.start[ok], words.end[ok], words.row[ok]
        if n in BEGINNINGS:
            rows.append(r)
            found.append(mix64(words.spans_hash(s, s + n, prefix) + U64(1)))
        if n in ENDINGS:
            rows.append(r)
            found.append(mix64(words.spans_hash(e - n, e, prefix) + U64(2)))
    return np.concatenate(rows), np.concatenate(found) & ~U64(1)


def _dense(count: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    return (count >= DENSE_COUNT) & (count >= DENSE_SHARE * n_words)


def _parts(col):
    """Slices of a text column as lower-case letter runs; letters are lowered slice by slice."""
    _, offsets = column_bytes(col)
    for i, j in slices(offsets, SLICE):
        data, at = column_bytes(pc.utf8_lower(col.slice(i, j - i)))
        yield i, j, Words(data, at, _LETTER)


@dataclass
class Model:
    """Feature hashes (sorted), their weights, bias; ``fitted`` is False without toxic examples."""
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    prior: float = 0.0
    fitted: bool = False

    def __post_init__(self):
        self.base = np.unique(self.keys & ~U64(1))
        self.table = np.zeros(1 << 20, bool)
        self.table[self.base >> U64(44)] = True

    def found(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Sorted (row, key index) pairs of the features that hold."""
        rows, hashes = _features(words)
        maybe = np.flatnonzero(self.table[hashes >> U64(44)])
        maybe = maybe[np.isin(hashes[maybe], self.base)]
        # equal features of a row meet by sorting; few are left by now
        order = maybe[np.lexsort((hashes[maybe], rows[maybe]))]
        r, h = rows[order], hashes[order]
        first = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (h[1:] != h[:-1])]) if len(r) else [])
        count = np.diff(np.append(first, len(r)))
        r, h = r[first], h[first]
        dense = _dense(count, words.counts()[r])
        r, h = np.concatenate([r, r[dense]]), np.concatenate([h, h[dense] | U64(1)])
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        known = self.keys[at] == h
        r, at = r[known], at[known]
        order = np.lexsort((at, r))
        return r[order], at[order]

    def scores(self, words: Words) -> np.ndarray:
        if not self.fitted:
            return np.zeros(words.n_rows)
        row, at = self.found(words)
        z = np.bincount(row, weights=self.weights[at], minlength=words.n_rows)
        return 1.0 / (1.0 + np.exp(-np.clip(z + self.bias, -30, 30)))


def nnpu_fit(pos: list[np.ndarray], unl: list[np.ndarray], n_features: int, prior: float, steps: int = 500,
             batch: int = 3000, rate: float = 0.1, decay: float = 3e-5, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear model under the non-negative PU risk
    (sigmoid loss, Adam). ``pos`` and ``unl`` hold each row's feature indexes."""
    rng = np.random.default_rng(seed)

    def dense(rows):
        x = np.zeros((len(rows), n_features + 1), np.uint8)
        for i, r in enumerate(rows):
            x[i, r] = 1
        x[:, -1] = 1
        return x

    def draw(x):
        return (x if len(x) <= batch else x[rng.choice(len(x), batch, replace=False)]).astype(np.float32)

    all_p, all_u = dense(pos), dense(unl)
    w = np.zeros(n_features + 1, np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, steps + 1):
        p, u = draw(all_p), draw(all_u)
        fp, fu = p @ w, u @ w
        sp, su = sigmoid(fp), sigmoid(fu)                 # losses of calling the rows negative
        dp, du = sp * (1 - sp), su * (1 - su)
        rest = su.mean() - prior * sp.mean()
        grad_rest = du @ u / len(u) - prior * (dp @ p) / len(p)
        grad = -prior * (dp @ p) / len(p) + grad_rest if rest >= 0 else -grad_rest
        grad = grad + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = rate * min(1.0, 2 * (1 - t / (steps + 1)))
        w = (w - step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return w[:-1].astype(float), float(w[-1])


def _share(col, share: float):
    """Whether the hash of a column falls into the lower ``share`` of its range."""
    return F.pmod(F.xxhash64(F.lit(11), col), F.lit(1 << 30)) < F.lit(int(min(1.0, share) * (1 << 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, max_features: int = MAX_FEATURES) -> Model:
    """Fit on ``docs`` (unlabelled text) and the rows of ``labels`` with ``label_col`` = 1; the prior is
    the share of toxic rows among labelled ids."""
    marked = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y")).where("_id IS NOT NULL AND _y IS NOT NULL")
              .groupBy("_id").agg(F.max("_y").alias("_y")))
    seen = marked.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col("_y") == 1).cast("long")), F.lit(0)).alias("pos")).first()
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_llm_text")).where("_id IS NOT NULL")
    mark = F.xxhash64(F.lit(12), "_id", "_llm_text")
    total = texts.select(mark).distinct().count() if seen.pos else 0
    if not total:
        return Model()
    prior = min(0.95, seen.pos / seen.n)
    # ids of the bounded sample: the expected size is a parameter, so broadcasting it is safe
    pos_ids = marked.where("_y = 1").where(_share(F.col("_id"), max_positive / seen.pos)).select("_id", F.lit(1).alias("_p"))
    # one row per id, whatever it holds; rows equal in id and text are one
    chosen = texts.join(F.broadcast(pos_ids), "_id").groupBy("_id").agg(F.min(mark).alias("_m"), F.first("_p").alias("_p"))
    drawn = (texts.withColumn("_m", mark).join(F.broadcast(chosen), ["_id", "_m"], "left")
             .withColumn("_u", _share(F.col("_m"), max_unlabelled / total)).where("_u OR _p = 1").distinct())

    def lists(row, values, n_rows):
        n = np.bincount(row, minlength=n_rows)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(values))

    def extract(batches):
        for b in batches:
            names = b.schema.names
            p, u = (b.column(names.index(c)) for c in ("_p", "_u"))
            for i, j, words in _parts(b.column(names.index("_llm_text"))):
                r, h = _features(words)
                order = np.lexsort((h, r))
                r, h = r[order], h[order]
                first = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (h[1:] != h[:-1])]) if len(r) else [])
                count = np.diff(np.append(first, len(r)))
                r, h = r[first], h[first]
                dense = _dense(count, words.counts()[r])
                r, h = np.concatenate([r, r[dense]]), np.concatenate([h, h[dense] | U64(1)])
                order = np.argsort(r, kind="stable")
                yield pa.RecordBatch.from_arrays([p.slice(i, j - i), u.slice(i, j - i), lists(r[order], h[order].view(np.int64), j - i)], ["p", "u", "f"])

    rows = stored(drawn.mapInArrow(extract, "p int, u boolean, f array<long>"), "toxicity-sample")
    counts = rows.select("p", "u", F.explode("f").alias("f")).groupBy("f").agg(
        F.count_if(F.col("p") == 1).alias("np"), F.count_if("u").alias("nu"))
    sizes = rows.agg(F.count_if(F.col("p") == 1).alias("np"), F.count_if("u").alias("nu")).first()
    if not sizes.np or not sizes.nu:
        return Model()
    rate_p, rate_u = F.col("np") / sizes.np, (F.col("nu") + 0.5) / sizes.nu
    lift = min(MIN_LIFT, 0.5 + 0.5 / prior)
    chosen = (counts.where((F.col("np") >= min(MIN_POSITIVE, sizes.np)) & (rate_p >= lift * rate_u))
              .orderBy(F.desc(F.col("np") * F.log(rate_p / rate_u)), "f").limit(max_features).select("f").collect())
    keys = np.sort(np.array([r.f for r in chosen], np.int64).view(U64))
    if not len(keys):
        return Model(prior=prior)
    model = Model(keys=keys, prior=prior, fitted=True)

    def reduce(batches):
        for b in batches:
            f = b.column(2)
            flat = f.flatten().to_numpy(zero_copy_only=False).view(U64)
            own = np.repeat(np.arange(len(f)), f.value_lengths().to_numpy(zero_copy_only=False))
            at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
            hit = keys[at] == flat
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists(own[hit], at[hit].astype(np.int32), len(f))], ["p", "u", "f"])

    sample = rows.mapInArrow(reduce, "p int, u boolean, f array<int>").collect()
    order = sorted(((r.p == 1, bool(r.u), tuple(r.f)) for r in sample))     # independent of partition order
    pos = [np.array(f, np.int64) for p, _, f in order if p]
    unl = [np.array(f, np.int64) for _, u, f in order if u]
    model.weights, model.bias = nnpu_fit(pos, unl, len(keys), prior)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD,
          keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus score (0 to 1) and predicted (1 at ``threshold`` or above).
    Only the text goes to Python and only its score comes back."""
    def values(col):
        found = [model.scores(words) for _, _, words in _parts(col)]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    rows = without(docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("_llm_scored")) if keep
                   else docs.withColumn("_llm_scored", F.col(f"`{text_col}`")), "score", "predicted")
    names = [c for c in rows.columns if c != "_llm_scored"]
    # not deterministic for the optimiser: a filter on the score must not compute it again
    scored = F.arrow_udf(values, "double").asNondeterministic()(F.col("_llm_scored")).alias("score")
    out = rows.select(*[F.col(f"`{c}`") for c in names], scored)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def fold(id_col: str, parts: int):
    """crc32 of the id as text, modulo ``parts`` (null for a null id)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract op4: ids whose fold is 1 of 3 are held out of training."""
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    train = fold("doc_id", 3) != 1
    model = fit(docs.where(train), labels.where(train))
    marked = docs.select("doc_id", "text", F.coalesce(~train, F.lit(False)).alias("held_out"))
    return score(marked, model, keep=["doc_id", "held_out"])
