"""Hard-negative mining by Fagin's threshold algorithm on integer scores.

Vectors become integers, ``floor(scale * x)``; a row's score for an anchor is
their integer inner product. Rows are dealt to blocks of about ``BLOCK`` by a hash of
the id, anchors to chunks of about ``CHUNK``; every block meets every chunk once.
In a block stand one list of its rows per dimension, sorted by that component.

For an anchor the lists are read from the end that its sign favours (highest
components first where the anchor's is positive, lowest where it is negative;
dimensions where it is zero are left out). Rows met there are scored exactly
(random access). The *threshold*, the sum of the anchor's products with the last
entries read, bounds the score of every row not yet met. The anchor is done
where the threshold falls strictly below the k-th best score within each of
its windows, or below a window's lower end: rows not met can neither enter nor
tie. Where reading that far would take more entries than the block has rows -
with many dimensions of like weight the threshold falls late - the block's rows
are all scored instead, for many anchors in one product. Scores are
integers, so nothing is rounded and ties are real ones; they go to the smaller id.

Two such passes: the best rows with the anchor's label are its positives, then
each (anchor, positive) is a window of scores in which rows of other labels are
its negatives. Blocks return at most ``k`` rows a window; the best of them are kept. No
label, id or group of copies is dealt to one task, and nothing is collected.

Defined cases: rows with a null id or label, a null or empty vector, null or
non-finite components, or components so large that a sum of products could
leave 64 bits take no part; rows with the same id count as one, the one with
the least label and vector; vectors of different lengths never meet; an
all-zero anchor scores 0 with every row; ties go to the smaller id; anchors
without positives or positives without negatives give no rows; other columns,
whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecraft.llm.tools import documents, stored

BLOCK, CHUNK = 8192, 8192
TOGETHER = 64             # anchors whose scores with a whole block are held at once


class Lists:
    """A block's rows in order of their ids: labels, integer vectors, and per dimension the rows in ascending order of the component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[order], labels[order], np.ascontiguousarray(x[order])
        ascending = np.argsort(self.x, axis=0, kind="stable")
        self.values = np.take_along_axis(self.x, ascending, axis=0)
        self.ascending = np.ascontiguousarray(ascending.T.astype(np.int32))
        self.top = int(np.abs(self.x).max(initial=0))

    def _numbers(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and anchors as floats while every sum of products is exact in them (below 2^53), else as integers."""
        if self.top * int(np.abs(anchors).max(initial=0)) * anchors.shape[1] < 1 << 53:
            return self.x.astype(np.float64), anchors.astype(np.float64)
        return self.x, anchors

    def _thresholds(self, anchors: np.ndarray, depths: list[int]) -> np.ndarray:
        """Per anchor and depth: what no row that stands deeper in all of the anchor's lists can exceed."""
        n = len(self.ids)
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return np.stack([up @ self.values[n - t] + down @ self.values[t - 1] for t in depths], axis=1)

    def _heads(self, a: np.ndarray, used: np.ndarray, depth: int) -> np.ndarray:
        """Mask of the rows among the first ``depth`` entries of the anchor's lists, each read from the end its sign favours."""
        met = np.zeros(len(self.ids), bool)
        met[self.ascending[used[a[used] > 0], len(self.ids) - depth:].ravel()] = True
        met[self.ascending[used[a[used] < 0], :depth].ravel()] = True
        return met

    def search(self, anchors: np.ndarray, allowed: list[np.ndarray], windows: list[list[tuple[int, int]]], k: int, met_of: list | None = None) -> list:
        """For each anchor and each of its windows (lo, hi) the allowed rows with the ``k`` best scores in lo..hi, best first,
        ties by id: (row numbers, scores). ``met_of`` receives how many rows were scored for each anchor.

        An anchor's first rows give a lower bound of its windows' k-th scores, and with it the depth at which the threshold
        will have fallen strictly below them. The lists are read to that depth when that is fewer entries than the block
        has rows; else every row is met at once, and no threshold is needed."""
        n = len(self.ids)
        x, a_numbers = self._numbers(anchors)
        depths = sorted({min(n, 1 << e) for e in range(n.bit_length() + 1)})
        thresholds = self._thresholds(anchors, depths)
        out, dense = [None] * len(anchors), []
        for i, a in enumerate(anchors):
            used = np.flatnonzero(a)
            depth = n // (8 * len(used)) if len(used) else 0
            stop = None
            if depth:
                met = self._heads(a, used, depth)
                at = np.flatnonzero(met)
                score = (x[at] @ a_numbers[i]).astype(np.int64)
                need = min((self._bound(score[allowed[i][at]], w, k) for w in windows[i]), default=1 << 62)
                below = np.flatnonzero(thresholds[i] < need)
                stop = max(depths[below[0]], depth) if len(below) else None
            if stop is None or stop * len(used) >= n:
                dense.append(i)
                continue
            if stop > depth:
                fresh = np.flatnonzero(self._heads(a, used, stop) & ~met)
                at, score = np.concatenate([at, fresh]), np.concatenate([score, (x[fresh] @ a_numbers[i]).astype(np.int64)])
                order = np.argsort(at)
                at, score = at[order], score[order]
            out[i] = self._windows(at, score, allowed[i][at], windows[i], k)
            if met_of is not None:
                met_of.append(len(at))
        every = np.arange(n)
        for cut in range(0, len(dense), TOGETHER):
            some = dense[cut:cut + TOGETHER]
            scores = (a_numbers[some] @ x.T).astype(np.int64)
            for i, score in zip(some, scores):
                out[i] = self._windows(every, score, allowed[i], windows[i], k)
                if met_of is not None:
                    met_of.append(n)
        return out

    @staticmethod
    def _bound(own: np.ndarray, window: tuple[int, int], k: int) -> int:
        """Rows that score below this can neither enter the window's ``k`` best nor tie with them."""
        lo, hi = window
        own = own[(own >= lo) & (own <= hi)]
        return lo if len(own) < k else int(np.partition(own, len(own) - k)[len(own) - k])

    @staticmethod
    def _windows(at: np.ndarray, score: np.ndarray, allowed: np.ndarray, windows: list[tuple[int, int]], k: int) -> list:
        at, score = at[allowed], score[allowed]
        found = []
        for lo, hi in windows:
            mine = np.flatnonzero((score >= lo) & (score <= hi))
            if len(mine) > k:
                own = score[mine]
                mine = mine[own >= np.partition(own, len(own) - k)[len(own) - k]]
            mine = mine[np.argsort(-score[mine], kind="stable")][:k]            # rows are in order of their ids
            found.append((at[mine], score[mine]))
        return found


def usable(vectors: DataFrame, id_col: str, vec_col: str, label: Column, scale: int) -> DataFrame:
    """id, label, v (integers), d (their number) of the rows that take part, one per id."""
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), vec.alias("w"))
    largest = F.sqrt(F.lit(float(1 << 62)) / F.size("w"))
    fine = F.forall("w", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) + 1 < largest))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("w").isNotNull() & (F.size("w") > 0)).where(fine)
    whole = F.transform("w", lambda x: F.floor(x * scale).cast("long"))
    one = rows.select("id", "label", whole.alias("v")).groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
    return one.select("id", "r.label", "r.v", F.size("r.v").alias("d"))


def _ints(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0), np.int64)


def _pass(rows: DataFrame, asks: DataFrame, same_label: bool, k: int) -> DataFrame:
    """Blocks of ``rows`` against chunks of ``asks`` (id, label, v, d, windows: array of (pid, lo, hi)): anchor_id, pid, id, score
    of the ``k`` best rows a window within each block."""
    n, m = (df.groupBy("d").agg(F.count(F.lit(1)).alias("n")) for df in (rows, asks))
    sizes = n.join(m.withColumnRenamed("n", "m"), "d").select(
        "d", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("m") / CHUNK).cast("int").alias("chunks"))
    sizes = F.broadcast(sizes)                                      # one row per length of a vector
    own = lambda by, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(by)).cast("int")
    every = lambda by: F.explode(F.sequence(F.lit(0), F.col(by) - 1))
    left = rows.join(sizes, "d").select("d", own("blocks", 21).alias("b"), every("chunks").alias("c"), "id", "label", "v")
    right = asks.join(sizes, "d").select(F.col("d").alias("ad"), every("blocks").alias("ab"), own("chunks", 22).alias("ac"),
                                         F.col("id").alias("aid"), F.col("label").alias("alabel"), F.col("v").alias("av"), "windows")
    shape = "anchor_id long, pid long, id long, score long"

    def meet(block: pa.Table, chunk: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if block.num_rows and chunk.num_rows:
            take = lambda t, c: t.column(c).combine_chunks().to_numpy(zero_copy_only=False)
            lists = Lists(take(block, "id"), take(block, "label"), _ints(block.column("v").combine_chunks()))
            anchors, a_ids, a_labels = _ints(chunk.column("av").combine_chunks()), take(chunk, "aid"), take(chunk, "alabel")
            asked = chunk.column("windows").to_pylist()
            of_label = {c: lists.labels == c if same_label else lists.labels != c for c in set(a_labels.tolist())}
            allowed = [of_label[c] & (lists.ids != i) if same_label else of_label[c] for i, c in zip(a_ids, a_labels.tolist())]
            found = lists.search(anchors, allowed, [[(w["lo"], w["hi"]) for w in ws] for ws in asked], k)
            for i, ws, mine in zip(a_ids, asked, found):
                for w, (at, score) in zip(ws, mine):
                    for o, v in zip(out, (np.full(len(at), i), np.full(len(at), w["pid"]), lists.ids[at], score)):
                        o.append(v)
        return pa.table([pa.array(np.concatenate(o) if o else np.zeros(0, np.int64), pa.int64()) for o in out], ["anchor_id", "pid", "id", "score"])

    return left.groupBy("d", "b", "c").cogroup(right.groupBy("ad", "ab", "ac")).applyInArrow(meet, shape)


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding", positives: int = 5,
         negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """For every row for which ``anchors`` (a condition on ``id``) holds: its ``positives`` best rows of the same label, and for each of
    them the first ``negatives`` rows of other labels whose score lies between ``low`` and ``high`` per cent of the positive's:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = stored(usable(vectors, id_col, vec_col, label, scale), "negatives-rows")
    asked = rows.where(anchors)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("pid"), F.lit(-(1 << 62)).cast("long").alias("lo"), F.lit(1 << 62).cast("long").alias("hi")))
    near = _pass(rows, asked.withColumn("windows", everything), True, positives)
    near = stored(_best(near.drop("pid"), ["anchor_id"], positives).select("anchor_id", F.col("id").alias("pid"), F.col("score").alias("ps")), "negatives-positives")
    windows = negative_windows(near, low, high)
    asks = asked.join(windows, asked["id"] == windows["anchor_id"]).drop("anchor_id")
    far = _best(_pass(rows, asks, False, negatives), ["anchor_id", "pid"], negatives)
    return far.join(near, ["anchor_id", "pid"]).select(
        "anchor_id", F.col("pid").alias("positive_id"), F.col("rank").cast("int"), F.col("id").alias("negative_id"),
        F.col("ps").alias("positive_score"), F.col("score").alias("negative_score"))


def negative_windows(near: DataFrame, low: int, high: int) -> DataFrame:
    """(anchor_id, pid, ps) to one row per anchor with its windows: whole scores s with low * ps <= 100 * s <= high * ps."""
    lo = -F.floor(-F.col("ps").cast("decimal(38,0)") * low / 100)
    hi = F.floor(F.col("ps").cast("decimal(38,0)") * high / 100)
    one = F.struct("pid", lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
    return near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(one)).alias("windows"))      # at most ``positives`` a row


#: Contract op11 in DuckDB: every anchor with every row.
OP11_SQL = """
WITH fit AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * r.v[i])) AS BIGINT) AS score
  FROM fit a JOIN fit r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
near AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
far AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank
  FROM near JOIN scored USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM far WHERE rank <= 3
"""


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Contract op11: negatives for every row of ``embeddings`` whose id 50 divides; labels of ids that 7 divides move on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(documents(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), F.col("id") % 50 == 0, label)
