"""MinHash near-dedup with tensored banding.

A text's set holds its distinct word shingles. Instead of ``tables`` x
``rows`` minhashes, two collections of ``side`` bands are computed, each band
of ``half`` minhashes, and every pair of a band of the first and one of the
second collection forms a table key: ``side``^2 tables of 2 * ``half`` minhashes
for 2 * ``side`` * ``half`` of them. At a similarity of 0.8 a pair meets in some
table with probability (1 - (1 - 0.8^half)^side)^2: 0.998 for 10 and 3.

1. One pass over the texts gives each row's set size, a 128-bit hash of the
   whole set and its bands. Equal sets collapse to one class here, so copies,
   however many, take part once.
2. In each key with several classes, the one that shares most keys is the
   centre; the others are checked against it on their full sets. Keys of a
   group of near copies mostly agree on one centre: pairs are as many as
   members, not their square.
3. Where a centre's members still fall into several components, those outside
   the largest are compared with all others in blocks of ``BLOCK`` x ``BLOCK`` inside
   tasks, on full sets: no link between two texts that share a table is lost,
   and no pair is emitted that is none.
4. Connected components of the links; nothing about them is collected. Links of
   step 3 are drawn between the components that the others leave.

What one table key, centre, class or component shares (its count, its name) is
stored before it is joined to the rows, so that both sides are plain shuffles
and adaptive execution splits a key that holds a large share of all rows.

Sets are rebuilt only for classes that take part in some pair, found by a
bitmap of fixed size (a filter that may pass too much, never too little).

Sets are compared by 64-bit shingle hashes. Defined cases: null and empty texts
have the empty set and link with nothing; fewer words than a shingle count as
one shingle, the whole sequence; repeated rows are copies like any other; a
null id is never the least of a component with others; extra columns pass
through where a caller keeps them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecraft.llm.components import components, joined_components
from lakecraft.llm.tools import bitmap_test, documents, hash_bitmap, partitions, row_keys, stored, tidy
from lakecraft.llm.words import LOWER, U64, Words, column_bytes, mix64, slices, window_hash

SIDE, HALF = 10, 3
PERCENT = 80
BLOCK = 512
CLASSES_PER_TASK = 4096


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (row, shingle hash) pairs."""
    hashes, rows = [], []
    n = len(words.row) - width + 1
    if n > 0:
        inside = words.row[:n] == words.row[width - 1:]
        hashes.append(window_hash(words.hash, width, 0x9E3779B97F4A7C15)[inside])
        rows.append(words.row[:n][inside])
    count, first = words.counts(), words.first()
    for k in range(1, width):                       # whole sequences of fewer words
        own = np.flatnonzero(count == k)
        if len(own):
            h = np.full(len(own), k, U64)
            for i in range(k):
                h = mix64(h * U64(0x100000001B3) + words.hash[first[own] + i])
            hashes.append(h)
            rows.append(own)
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    h, r = np.concatenate(hashes), np.concatenate(rows)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    return r[new], h[new]


def _row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    c = np.zeros(len(values) + 1, U64)
    np.cumsum(values, out=c[1:])
    return c[first[1:]] - c[first[:-1]]


def _set_hash(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(first).astype(U64)
    return (mix64(_row_sums(mix64(h + U64(0x51ED27)), first) + n),
            mix64(_row_sums(mix64(h ^ U64(0xA0761D6478BD642F)), first) ^ n))


def bands(h: np.ndarray, first: np.ndarray, side: int, half: int) -> np.ndarray:
    """(rows, 2 * side) band hashes; rows without shingles get zeros."""
    rows = len(first) - 1
    out = np.zeros((rows, 2 * side), U64)
    full = np.flatnonzero(np.diff(first))
    if not len(full):
        return out
    starts = first[:-1][full]
    for b in range(2 * side):
        band = np.full(len(full), b + 1, U64)
        for k in range(half):
            seed = mix64(np.array([b * half + k + 1], U64) * U64(0x9E3779B97F4A7C15))[0]
            low = np.minimum.reduceat((h ^ seed) * (mix64(np.array([seed], U64))[0] | U64(1)), starts)
            band = mix64(band * U64(0x100000001B3) + low)
        out[full, b] = band
    return out


def _each_slice(col, width: int):
    data, offsets = column_bytes(col)
    for i, j in slices(offsets):
        words = Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], fold=LOWER)
        r, h = shingles(words, width)
        first = np.concatenate([[0], np.cumsum(np.bincount(r, minlength=j - i))])
        yield i, j, h, first


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values.view(np.int64)))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).astype(U64).view(np.int64))


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int, side: int, half: int) -> DataFrame:
    """Per row: id, _llm_k1, _llm_k2, n, c1, c2 (hash of the set), bands."""
    left = row_keys(docs, id_col, text_col).select(F.col(id_col).alias("id"), "_llm_k1", "_llm_k2", F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for i, j, h, first in _each_slice(batch.column(3), width):
                c1, c2 = _set_hash(h, first)
                b = bands(h, first, side, half)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(i, j - i) for k in range(3)]
                    + [pa.array(np.diff(first)), _long(c1), _long(c2), _lists(b.ravel(), np.arange(j - i + 1) * 2 * side)],
                    ["id", "_llm_k1", "_llm_k2", "n", "c1", "c2", "bands"])

    kind = docs.schema[id_col].dataType.simpleString()
    return left.mapInArrow(tidy(run), f"id {kind}, _llm_k1 long, _llm_k2 long, n long, c1 long, c2 long, bands array<long>")


def _sets(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """c1, c2, n and the full set of each class in ``reps`` (id, c1, c2)."""
    bits = hash_bitmap(reps.select(F.xxhash64("id")))
    left = docs.select(F.xxhash64(F.col(id_col)).alias("h"), F.col(text_col).alias("text"))

    def run(batches):
        wanted = bitmap_test(bits)
        for batch in batches:
            part = batch.filter(pa.array(wanted(batch.column(0).to_numpy())))
            if part.num_rows:
                for i, j, h, first in _each_slice(part.column(1), width):
                    c1, c2 = _set_hash(h, first)
                    yield pa.RecordBatch.from_arrays([_long(c1), _long(c2), pa.array(np.diff(first)), _lists(h, first)], ["c1", "c2", "n", "s"])

    found = left.mapInArrow(tidy(run), "c1 long, c2 long, n long, s array<long>")
    return (found.join(reps.select("c1", "c2"), ["c1", "c2"], "left_semi").groupBy("c1", "c2").agg(F.first("n").alias("n"), F.first("s").alias("s"))
            .withColumn("node", F.concat(F.hex("c1"), F.lit("-"), F.hex("c2"))))


def _block_links(percent: int):
    """Links between the queries and the members of a block that are in other components: per query one to each component."""
    def run(members: pa.Table, queries: pa.Table) -> pa.Table:
        us, vs = [], []
        if members.num_rows and queries.num_rows:
            m, q = members.combine_chunks(), queries.combine_chunks()
            ms = m.column("s").combine_chunks()
            size = ms.value_lengths().to_numpy(zero_copy_only=False)
            token, place = np.unique(ms.flatten().to_numpy(), return_inverse=True)
            order = np.argsort(place, kind="stable")
            owner = np.repeat(np.arange(len(size)), size)[order]
            start = np.searchsorted(place[order], np.arange(len(token) + 1))
            m_comp, names, q_comp, q_names = (t.column(c).to_pylist() for t, c in ((m, "comp"), (m, "node"), (q, "qcomp"), (q, "qnode")))
            codes, m_code = np.unique(np.array(m_comp, object).astype(str), return_inverse=True)
            qs = q.column("qs").combine_chunks()
            flat, ends = qs.flatten().to_numpy(), np.concatenate([[0], np.cumsum(qs.value_lengths().to_numpy(zero_copy_only=False))])
            for i in range(len(q_names)):
                own = flat[ends[i]:ends[i + 1]]
                at = np.searchsorted(token, own)
                at[at == len(token)] = 0
                at = at[token[at] == own]
                if not len(at):
                    continue
                hits = np.bincount(np.concatenate([owner[start[t]:start[t + 1]] for t in at]), minlength=len(size))
                linked = np.flatnonzero(100 * hits >= percent * (size + len(own) - hits))
                _, one = np.unique(m_code[linked], return_index=True)
                for k in linked[one]:
                    if m_comp[k] != q_comp[i]:
                        us.append(q_names[i])
                        vs.append(names[k])
        return pa.table([pa.array(us, pa.string()), pa.array(vs, pa.string())], ["u", "v"])
    return run


def _rest(pairs: DataFrame, sets: DataFrame, comps: DataFrame, percent: int) -> DataFrame | None:
    """Links between members of one centre that the first links leave in different components (None: there are no such members)."""
    named = sets.select("c1", "node").join(comps, "node", "left").select("c1", "node", F.coalesce("component", "node").alias("comp"))
    group = pairs.select(F.col("a").alias("c"), F.col("b").alias("m")).unionByName(pairs.select(F.col("a").alias("c"), F.col("a").alias("m")).distinct())
    group = stored(group.join(named, group.m == named.c1).select("c", "node", "comp"), "groups")
    per = group.groupBy("c", "comp").agg(F.count("*").alias("n")).groupBy("c").agg(
        F.sum("n").alias("n"), F.count("*").alias("k"), F.max_by("comp", F.struct("n", "comp")).alias("big"), F.max("n").alias("top"))
    mixed = stored(per.where("k > 1").select(F.col("c").alias("g"), "big", F.ceil(F.col("n") / BLOCK).cast("int").alias("mb"),
                                             F.ceil((F.col("n") - F.col("top")) / BLOCK).cast("int").alias("qb")), "mixed")
    if mixed.isEmpty():
        return None
    rows = group.join(mixed, group.c == mixed.g).drop("g")
    own = F.xxhash64("node")
    members = rows.select("c", "node", "comp", F.pmod(own, F.col("mb")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("j"))
    queries = rows.where("comp <> big").select(F.col("c").alias("qc"), F.col("node").alias("qnode"), F.col("comp").alias("qcomp"),
                                               F.explode(F.sequence(F.lit(0), F.col("mb") - 1)).alias("qi"), F.pmod(own, F.col("qb")).cast("int").alias("qj"))
    here = members.join(sets.select("node", "s"), "node")
    there = queries.join(sets.select(F.col("node").alias("qnode"), F.col("s").alias("qs")), "qnode")
    return (here.groupBy("c", "i", "j").cogroup(there.groupBy("qc", "qi", "qj"))
            .applyInArrow(_block_links(percent), "u string, v string").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = PERCENT,
                    side: int = SIDE, half: int = HALF) -> DataFrame:
    """One row per row of ``docs``: id column, _llm_k1, _llm_k2, n_shingles, component_id (least id of the
    linked rows), kept. Rows link where 100 * intersection >= percent * union."""
    sig = stored(signatures(docs, id_col, text_col, width, side, half), "signatures")
    classes = stored(sig.where("n > 0").groupBy("c1", "c2").agg(F.min("id").alias("id"), F.first("bands").alias("bands")), "classes")
    table_keys = F.flatten(F.transform(F.slice("bands", 1, side), lambda a: F.transform(F.slice("bands", side + 1, side), lambda b: F.xxhash64(a, b))))
    # a class becomes side^2 rows: deal the few bytes of the classes to enough tasks first
    tasks = max(partitions(docs.sparkSession), classes.count() // CLASSES_PER_TASK)
    keyed = classes.repartition(tasks, "c1").select(F.col("c1").alias("node"), F.explode(table_keys).alias("key"))
    shared = stored(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    hits = stored(keyed.join(shared, "key"), "hits")
    popular = hits.groupBy("node").agg(F.sum("n").alias("p"))
    centres = stored(hits.join(popular, "node").groupBy("key").agg(F.max(F.struct("p", "node")).alias("top"))
                     .select("key", F.col("top.node").alias("a")), "centres")
    pairs = stored(hits.join(centres, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct(), "pairs")
    nodes = pairs.select(F.col("a").alias("c1")).unionByName(pairs.select(F.col("b").alias("c1"))).distinct()
    reps = stored(classes.select("c1", "c2", "id").join(nodes, "c1", "left_semi"), "reps")
    sets = stored(_sets(docs, reps, id_col, text_col, width), "sets")
    one = sets.select(F.col("c1").alias("a"), F.col("node").alias("u"), F.col("n").alias("na"), F.col("s").alias("sa"))
    two = sets.select(F.col("c1").alias("b"), F.col("node").alias("v"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    checked = pairs.join(two, "b").join(one, "a").select("u", "v", "na", "nb", both.alias("x"))
    links = stored(checked.where(F.col("x") * 100 >= (F.col("na") + F.col("nb") - F.col("x")) * percent).select("u", "v"), "links")
    comps = stored(components(links), "components")
    rest = _rest(pairs, sets, comps, percent)
    if rest is not None:
        comps = joined_components(comps, rest)
    linked = stored(comps.join(sets.select("node", "c1", "c2"), "node").join(reps, ["c1", "c2"]), "linked")
    least = stored(linked.groupBy("component").agg(F.min("id").alias("least")), "least")
    named = linked.join(least, "component").select("c1", "c2", "least")
    owner = stored(classes.select("c1", "c2", "id").join(named, ["c1", "c2"], "left")
                   .select("c1", "c2", F.coalesce("least", "id").alias("component_id")), "owners")
    out = sig.select("id", "_llm_k1", "_llm_k2", "n", "c1", "c2").join(owner, ["c1", "c2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "_llm_k1", "_llm_k2", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near duplicates (of equal rows, one)."""
    kept = near_duplicates(docs, id_col, text_col, **options).where("kept").select("_llm_k1", "_llm_k2").distinct()
    cols = docs.columns
    return (row_keys(docs, id_col, text_col).join(kept, ["_llm_k1", "_llm_k2"], "left_semi").dropDuplicates(["_llm_k1", "_llm_k2"])
            .select(*[F.col(f"`{c}`") for c in cols]))


#: Contract op6 in DuckDB: distinct shingle sets, shared shingles counted by a self-join, a recursive walk over the links.
OP6_SQL = r"""
WITH RECURSIVE txt AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 1 THEN w ELSE list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) END AS s FROM txt),
class AS (SELECT min(doc_id) AS c, s FROM sets GROUP BY s),
part AS (SELECT c, len(s) AS n, unnest(s) AS x FROM class),
common AS (
  SELECT a.c AS a, b.c AS b, any_value(a.n) AS an, any_value(b.n) AS bn, COUNT(*) AS k FROM part a JOIN part b
  ON a.x = b.x AND a.c < b.c AND 100 * LEAST(a.n, b.n) >= 80 * GREATEST(a.n, b.n) GROUP BY ALL),
link AS (SELECT a, b FROM common WHERE 100 * k >= 80 * (an + bn - k)),
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
walk(a, b) AS (SELECT a, a FROM both_ways UNION SELECT walk.a, both_ways.b FROM walk JOIN both_ways ON walk.b = both_ways.a),
root AS (SELECT a AS c, min(b) AS r FROM walk GROUP BY a),
member AS (SELECT doc_id, len(sets.s) AS n, CASE WHEN len(sets.s) = 0 THEN doc_id ELSE COALESCE(r, class.c) END AS component
           FROM sets JOIN class ON class.s = sets.s LEFT JOIN root ON root.c = class.c)
SELECT doc_id, n::BIGINT AS n_shingles, component AS component_id, component = doc_id AS kept FROM member
"""


def op6_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract op6: shingles of two words, similarity of 0.8 or more, whole ``documents``."""
    return near_duplicates(documents(spark, sf_dir), width=2).drop("_llm_k1", "_llm_k2")
