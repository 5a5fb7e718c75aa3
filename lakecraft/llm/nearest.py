"""Approximate nearest neighbours by inner product: a hierarchical k-means tree
searched best bin first.

The tree is fitted on a bounded sample (at most about ``SAMPLE`` vectors): each
node is split by k-means into ``BRANCH`` until it holds ``LEAF`` sample vectors or
fewer. Every row of the table is assigned to a leaf. A query walks the tree
with a priority queue, the node with the largest inner product of query and
centre first, and visits leaves until the calibrated number is reached: the
least number that gives ``target`` recall for sample queries against an
exhaustive search of the sample. Visits go on while the leaves seen hold fewer
vectors than asked for.

A query's ``k``-th best score among the sample vectors in the leaves that it visits
bounds its result from below; blocks return nothing under it.

Leaves are searched in blocks of at most ``BLOCK`` vectors and ``QUERIES`` queries,
so neither a leaf full of copies nor a leaf that all queries visit meets in one
task. Each block returns its ``k`` best per query; ties go to the smaller id.
Scores are inner products of the original vectors in double precision.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part, nor do rows without an id, nor vectors whose length is
not the most common one; rows with the same id count as one, by their best
score, and are never each other's neighbours; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecraft.llm.tools import documents, partitions, stored

SAMPLE = 20_000
BRANCH, LEAF = 8, 100
BLOCK, QUERIES = 4096, 4096
TARGET = 0.95
CALIBRATION = 300


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id and v (array of doubles) of the rows that take part."""
    v = F.col(vec_col)
    fine = (F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))
    rows = vectors.where(fine).select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"))
    size = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("v") == (size.d if size else 0))


class Tree:
    """centres (nodes x dimension), children per node (empty: a leaf), leaf number per node."""

    def __init__(self, centres: np.ndarray, children: list[list[int]]):
        self.centres, self.children = centres, children
        self.leaf = np.cumsum([not c for c in children]) - 1
        self.leaves = int(self.leaf[-1]) + 1


def _split(x: np.ndarray, rng) -> np.ndarray:
    """k-means labels."""
    centres = x[rng.choice(len(x), BRANCH, replace=False)]
    label = np.zeros(len(x), int)
    for _ in range(12):
        label = ((centres ** 2).sum(1) - 2 * x @ centres.T).argmin(1)
        for k in range(BRANCH):
            own = x[label == k]
            if len(own):
                centres[k] = own.mean(0)
    return label


def grow(x: np.ndarray, seed: int = 1) -> Tree:
    rng = np.random.default_rng(seed)
    centres, children = [x.mean(0)], [[]]
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= LEAF:
            continue
        label = _split(x[rows].copy(), rng)
        parts = [rows[label == k] for k in range(BRANCH)]
        parts = [p for p in parts if len(p)]
        if len(parts) < 2:                   # copies of one vector
            continue
        for p in parts:
            children[node].append(len(centres))
            todo.append((len(centres), p))
            centres.append(x[p].mean(0))
            children.append([])
    return Tree(np.array(centres), children)


def assign(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Leaf of each vector: the nearest centre at every branching."""
    at = np.zeros(len(x), int)
    while True:
        moved = False
        for node in np.unique(at):
            kids = tree.children[node]
            if kids:
                own = np.flatnonzero(at == node)
                c = tree.centres[kids]
                at[own] = np.array(kids)[((c ** 2).sum(1) - 2 * x[own] @ c.T).argmin(1)]
                moved = True
        if not moved:
            return tree.leaf[at]


def visits(tree: Tree, priority: np.ndarray):
    """Leaves of one query, best bin first; ``priority`` holds its inner products with all centres."""
    queue = [(-priority[0], 0)]
    while queue:
        _, node = heapq.heappop(queue)
        kids = tree.children[node]
        if not kids:
            yield int(tree.leaf[node])
        for k in kids:
            heapq.heappush(queue, (-priority[k], k))


def calibrate(tree: Tree, x: np.ndarray, k: int, target: float) -> int:
    """Leaves to visit for ``target`` recall of the ``k`` nearest within the sample."""
    own = assign(tree, x)
    some = np.linspace(0, len(x) - 1, min(CALIBRATION, len(x))).astype(int)
    found = np.zeros(tree.leaves)
    total = 0
    for q in some:
        s = x @ x[q]
        s[q] = -np.inf
        best = np.argsort(-s, kind="stable")[:min(k, len(x) - 1)]
        rank = np.empty(tree.leaves, int)
        rank[list(visits(tree, tree.centres @ x[q]))] = np.arange(tree.leaves)
        np.add.at(found, rank[own[best]], 1)
        total += len(best)
    if not total:
        return tree.leaves
    return int(np.searchsorted(np.cumsum(found) / total, target)) + 1


def _matrix(col) -> np.ndarray:
    flat = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1)


def _search(k: int):
    def run(members: pa.Table, queries: pa.Table) -> pa.Table:
        q_out, v_out, s_out = [], [], []
        if members.num_rows and queries.num_rows:
            ids, x = members.column("id").to_numpy(), _matrix(members.column("v"))
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            twice = bool((ids[1:] == ids[:-1]).any())     # then all are ranked before the k best distinct ids are taken
            q_ids, q, low = queries.column("qid").to_numpy(), _matrix(queries.column("qv")), queries.column("low").to_numpy()
            for i in range(0, len(q), 512):
                rough = q[i:i + 512] @ x.T
                for j, s in enumerate(rough, i):
                    s[ids == q_ids[j]] = -np.inf
                    if len(s) > k and not twice:
                        least = np.partition(s, len(s) - k)[len(s) - k]
                        near = np.flatnonzero(s >= least - 1e-9 * (1 + abs(least)))
                    else:
                        near = np.arange(len(s))
                    near = near[(ids[near] != q_ids[j]) & (s[near] >= low[j] - 1e-9 * (1 + abs(low[j])))] if low[j] > -np.inf else near[ids[near] != q_ids[j]]
                    score = (x[near] * q[j]).sum(axis=1)      # the same sum whatever the block
                    top = np.lexsort((ids[near], -score))
                    if twice:
                        top = top[np.sort(np.unique(ids[near][top], return_index=True)[1])]
                    top = top[:k]
                    q_out.append(np.full(len(top), q_ids[j]))
                    v_out.append(ids[near][top])
                    s_out.append(score[top])
        cat = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.table([cat(q_out, pa.int64()), cat(v_out, pa.int64()), cat(s_out, pa.float64())], ["query_id", "vec_id", "score"])
    return run


def search(vectors: DataFrame, queries, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           target: float = TARGET, sample: int = SAMPLE) -> DataFrame:
    """The ``k`` nearest rows (largest inner product) of every row of ``vectors`` for which the
    column ``queries`` holds: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    asked = vectors.withColumn("_asked", F.coalesce(queries, F.lit(False)))
    rows = usable(vectors, id_col, vec_col)
    mark = F.xxhash64(F.lit(5), "id", "v")
    n = rows.select(mark).distinct().count()
    if not n:
        return spark.createDataFrame([], result)
    drawn = rows.where(F.pmod(mark, F.lit(1 << 30)) < int(min(1.0, sample / n) * (1 << 30))) if n > sample else rows
    # expected ``sample`` rows, those equal in id and vector being one
    some = drawn.distinct().orderBy("id", "v").collect() or rows.orderBy("id", "v").limit(LEAF).collect()
    x, x_ids = np.array([r.v for r in some]), np.array([r.id for r in some])
    tree = grow(x)
    least = calibrate(tree, x, k, target)
    one = np.unique(x_ids, return_index=True)[1]
    shape = spark.sparkContext.broadcast((tree.centres, tree.children, x[one], x_ids[one], assign(tree, x[one])))   # bounded by the sample

    def to_leaf(batches):
        t = Tree(*shape.value[:2])
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(assign(t, _matrix(b.column(1))).astype(np.int32))], ["id", "v", "leaf"])

    indexed = stored(rows.mapInArrow(to_leaf, "id long, v array<double>, leaf int"), "ann-index")
    held = np.zeros(tree.leaves, np.int64)
    for r in indexed.groupBy("leaf").agg(F.count("*").alias("n")).collect():   # at most one row per leaf
        held[r.leaf] = r.n

    def to_visits(batches):
        t = Tree(*shape.value[:2])
        xs, xs_ids, xs_leaf = shape.value[2:]
        for batch in batches:
            for cut in range(0, batch.num_rows, 256):
                b = batch.slice(cut, 256)
                q, q_ids = _matrix(b.column(1)), b.column(0).to_numpy()
                scores, known = q @ t.centres.T, q @ xs.T
                own, leaf, low = [], [], []
                for i, s in enumerate(scores):
                    seen, mine = 0, np.zeros(t.leaves, bool)
                    for c, at in enumerate(visits(t, s)):
                        if c >= least and seen > 2 * k:
                            break
                        seen += held[at]
                        mine[at] = True
                    at = np.flatnonzero(mine)
                    near = known[i][mine[xs_leaf] & (xs_ids != q_ids[i])]
                    bound = np.partition(near, len(near) - k)[len(near) - k] if len(near) >= k else -np.inf
                    own.append(np.full(len(at), i))
                    leaf.append(at)
                    low.append(np.full(len(at), bound))
                own = pa.array(np.concatenate(own))
                yield pa.RecordBatch.from_arrays([b.column(0).take(own), b.column(1).take(own), pa.array(np.concatenate(leaf), pa.int32()),
                                                  pa.array(np.concatenate(low))], ["qid", "qv", "leaf", "low"])

    wanted = asked.where("_asked").select(F.col(id_col).cast("long").alias("id"), F.col("_asked").alias("_q")).distinct()
    first = indexed.join(wanted.select("id"), "id", "left_semi").groupBy("id").agg(F.min("v").alias("v"))
    first = first.repartition(partitions(spark), F.xxhash64("id"))      # few bytes, much work for each
    stops = stored(first.mapInArrow(to_visits, "qid long, qv array<double>, leaf int, low double"), "ann-visits")
    load = {r.leaf: r.n for r in stops.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    blocks = [(i, int(-(-max(h, 1) // BLOCK)), int(-(-load.get(i, 1) // QUERIES))) for i, h in enumerate(held.tolist())]
    grid = F.broadcast(spark.createDataFrame(blocks, "leaf int, mb int, qb int"))        # one row per leaf
    members = indexed.join(grid, "leaf").select("leaf", F.pmod(F.xxhash64("id", F.lit(3)), F.col("mb")).cast("int").alias("i"),
                                                F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("j"), "id", "v")
    asks = stops.join(grid, "leaf").select(F.col("leaf").alias("ql"), F.explode(F.sequence(F.lit(0), F.col("mb") - 1)).alias("qi"),
                                           F.pmod(F.xxhash64("qid", F.lit(4)), F.col("qb")).cast("int").alias("qj"), "qid", "qv", "low")
    near = (members.groupBy("leaf", "i", "j").cogroup(asks.groupBy("ql", "qi", "qj"))
            .applyInArrow(_search(k), "query_id long, vec_id long, score double"))
    best = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op8_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """Contract op8: the 20 nearest rows of each row of ``embeddings`` whose id 20 divides."""
    return search(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
