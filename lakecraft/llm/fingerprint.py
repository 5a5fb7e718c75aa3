"""Document fingerprints: a Merkle tree over paragraphs and sections.

A text is cut without remainder into words (with the space behind them),
paragraphs (up to a line break) and sections (up to a paragraph whose hash ends
in two zero bits, so that cuts follow content and survive edits elsewhere). A
paragraph's hash covers its bytes, a section's its paragraphs' hashes, the root
the sections': equal roots mean equal texts, and from unequal ones the branches
that differ lead to the edited paragraphs (``tree``, ``differing``).

The fingerprint string is ``root.level.leaves``. Its leaves summarise the words:
runs of words that end at a word (bound to the word before it) whose hash ends
in ``level`` zero bits, line breaks counting as four more. The level grows with
the text, which keeps the leaves at roughly ``LEAVES`` to twice as many plus
long runs of short paragraphs; each leaf is 24 bits of its hash and the level
of its end. Leaves of a finer level fold into those of a coarser one, so any
two fingerprints can be compared by themselves: ``likeness`` is the share of
common leaves (Dice, 0 to 1), at the coarser of both levels.

Defined cases: a null text counts as empty; the empty text has no leaf and is
like the empty text only; repeated rows have equal fingerprints; an input
column named like a result is replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakecraft.llm.tools import documents, partitions
from lakecraft.llm.words import SLICE_BYTES, U64, Words, column_bytes, mix64, powers, slices

LEAVES = 64
#: Segments of consecutive ids at most: what the driver holds and broadcasts of them is bounded by it.
SEGMENTS = 1 << 16
#: Rows that a segment is not made smaller than to busy more tasks.
SEGMENT_ROWS = 64
_CODE = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", np.uint8)
_VALUE = np.zeros(256, np.uint32)
_VALUE[_CODE] = np.arange(64)
_R1, _R2 = U64(0x9E3779B97F4A7C15), U64(0xD1342543DE82EF95)


def _zeros(h: np.ndarray) -> np.ndarray:
    """Number of zero bits at the end, at most 15."""
    low = h & (~h + U64(1))
    return np.minimum(np.bitwise_count(low - U64(1)), 15).astype(np.int64)


def _merge(values: np.ndarray, first: np.ndarray, base: U64) -> np.ndarray:
    """Hash of each run of values; runs begin at ``first``."""
    if not len(first):
        return values[:0]
    size = np.diff(np.append(first, len(values)))
    place = np.arange(len(values)) - np.repeat(first, size)
    p = powers(base, int(size.max()))
    return mix64(np.add.reduceat(values * p[place], first) + (size.astype(U64) << U64(40)))


def _ends(mark: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Marks plus the last element of each row."""
    out = mark.copy()
    out[:-1] |= row[1:] != row[:-1]
    out[-1:] = True
    return out


def _firsts(ends: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], ends[:-1]])) if len(ends) else np.zeros(0, np.int64)


class Tree:
    """Nodes of a slice of texts: words, paragraphs, sections, roots."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets)
        self.n_rows = words.n_rows
        size = np.diff(offsets)
        blank = np.flatnonzero((words.counts() == 0) & (size > 0))     # white space only: one node
        start = words.start.copy()
        first = words.first()[:-1]
        has = np.flatnonzero(words.counts() > 0)
        start[first[has]] = offsets[has]
        start = np.concatenate([start, offsets[blank]])
        row = np.concatenate([words.row, blank])
        order = np.argsort(start, kind="stable")
        start, row = start[order], row[order]
        stop = np.append(start[1:], len(data)) if len(start) else start
        prefix = words._prefix()
        lines = np.zeros(len(data) + 1, np.int64)
        np.cumsum(data == 10, out=lines[1:])
        h = words.spans_hash(start, stop, prefix)
        para_end = lines[stop] > lines[start]
        before = np.zeros(len(h), U64)
        before[1:] = np.where(row[1:] == row[:-1], h[:-1], U64(0))
        self.row, bound = row, mix64(h + before * _R2)
        self.level = np.minimum(_zeros(bound) + 4 * para_end, 15)
        self.leaf = bound >> U64(40)
        # paragraphs, sections, roots
        ends = _ends(para_end, row)
        p_first = _firsts(ends)
        self.p_row, self.p_start, self.p_stop = row[p_first], start[p_first], stop[ends] if len(ends) else stop
        self.p_hash = words.spans_hash(self.p_start, self.p_stop, prefix)
        s_ends = _ends(_zeros(self.p_hash) >= 2, self.p_row)
        self.s_first = _firsts(s_ends)
        self.s_row = self.p_row[self.s_first]
        self.s_hash = _merge(self.p_hash, self.s_first, _R1)
        r_first = _firsts(_ends(np.zeros(len(self.s_row), bool), self.s_row))
        with_root = self.s_row[r_first]
        self.root = np.zeros((self.n_rows, 2), U64)
        self.root[with_root, 0] = _merge(self.s_hash, r_first, _R1)
        self.root[with_root, 1] = _merge(_merge(mix64(self.p_hash ^ _R1), self.s_first, _R2), r_first, _R2)
        # leaves at each row's level
        n = np.bincount(row, minlength=self.n_rows)
        self.k = np.maximum(0, np.floor(np.log2(np.maximum(n, 1) / LEAVES))).astype(np.int64)
        self.leaf, self.level, self.leaf_row = coarsen(self.leaf, self.level, row, np.zeros(self.n_rows, np.int64), self.k)

    def strings(self) -> list[str]:
        v = self.leaf.astype(np.uint32)
        text = np.empty((len(v), 5), np.uint8)
        for i in range(4):
            text[:, i] = _CODE[(v >> np.uint32(18 - 6 * i)) & np.uint32(63)]
        text[:, 4] = _CODE[self.level]
        raw = text.tobytes().decode()
        stop = np.cumsum(np.bincount(self.leaf_row, minlength=self.n_rows)) * 5
        start = np.append(0, stop[:-1])
        return [f"{a:016x}{b:016x}.{k}.{raw[i:j]}" for (a, b), k, i, j in
                zip(self.root.tolist(), self.k.tolist(), start.tolist(), stop.tolist())]

    def leaves(self, rows: np.ndarray):
        """Roots, levels and leaves of the given rows, as ``likeness`` takes them."""
        return _pick(self.root, self.k, self.leaf, self.level, self.leaf_row, rows)


def _pick(root, k, leaf, level, row, rows):
    n = np.bincount(row, minlength=len(k))
    at = np.concatenate([[0], np.cumsum(n)])
    size = n[rows]
    take = np.arange(int(size.sum())) + np.repeat(at[rows] - (np.cumsum(size) - size), size)
    return root[rows], k[rows], leaf[take], level[take], np.repeat(np.arange(len(rows)), size)


def coarsen(leaf, level, row, have: np.ndarray, want: np.ndarray):
    """Fold each row's leaves from level ``have`` to level ``want``, one level after another."""
    for step in range(int(want.max(initial=0))):
        fold = (have <= step) & (want > step)
        if not fold.any() or not len(leaf):
            continue
        active = fold[row]
        ends = _ends((level > step) | ~active, row)
        first = _firsts(ends)
        merged = _merge(leaf, first, _R1) >> U64(40)
        leaf = np.where(active[first], merged, leaf[first])
        level, row = level[ends], row[ends]
    return leaf, level, row


def _common(a, b) -> np.ndarray:
    """Likeness of paired fingerprints given as (root, level, leaf, end level, row)."""
    (ra, ka, la, ea, wa), (rb, kb, lb, eb, wb) = a, b
    k = np.maximum(ka, kb)
    la, ea, wa = coarsen(la, ea, wa, ka, k)
    lb, eb, wb = coarsen(lb, eb, wb, kb, k)
    n = len(k)
    xa, na = np.unique((wa.astype(U64) << U64(24)) | la, return_counts=True)
    xb, nb = np.unique((wb.astype(U64) << U64(24)) | lb, return_counts=True)
    both, i, j = np.intersect1d(xa, xb, assume_unique=True, return_indices=True)
    shared = np.bincount((both >> U64(24)).astype(np.int64), weights=np.minimum(na[i], nb[j]), minlength=n)
    total = np.bincount(wa, minlength=n) + np.bincount(wb, minlength=n)
    equal = (ra == rb).all(axis=1)
    return np.where(equal, 1.0, 2.0 * shared / np.maximum(total, 1))


def _parse(strings: list[str]):
    root, k, leaf, level, row = [], [], [], [], []
    for i, s in enumerate(strings):
        r, lvl, text = s.split(".")
        root.append((int(r[:16], 16), int(r[16:], 16)))
        k.append(int(lvl))
        v = _VALUE[np.frombuffer(text.encode(), np.uint8).reshape(-1, 5)]
        leaf.append((v[:, 0] << 18 | v[:, 1] << 12 | v[:, 2] << 6 | v[:, 3]).astype(U64))
        level.append(v[:, 4].astype(np.int64))
        row.append(np.full(len(v), i, np.int64))
    none = [np.zeros(0, np.int64)]
    return (np.array(root, U64).reshape(-1, 2), np.array(k, np.int64), np.concatenate([x.astype(U64) for x in none] + leaf),
            np.concatenate(none + level), np.concatenate(none + row))


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """Likeness (0 to 1) of paired fingerprint strings; roots equal: 1."""
    return _common(_parse(left), _parse(right))


def _join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])


def fingerprints(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) plus fingerprint."""
    cols = [c for c in (docs.columns if keep is None else keep) if c != "fingerprint"]
    left = docs.select(*[F.col(f"`{c}`") for c in cols], F.col(text_col).alias("_llm_text"))

    def run(batches):
        for b in batches:
            data, offsets = column_bytes(b.column(b.num_columns - 1))
            for i, j in slices(offsets):
                tree = Tree(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([c.slice(i, j - i) for c in b.columns[:-1]] + [pa.array(tree.strings(), pa.string())], cols + ["fingerprint"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return left.mapInArrow(run, ", ".join([f"`{c}` {kinds[c]}" for c in cols] + ["fingerprint string"]))


def tree(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per paragraph: id column, root, section, section_hash, paragraph, paragraph_hash, start, stop (bytes)."""
    left = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_llm_text"))

    def run(batches):
        for b in batches:
            data, offsets = column_bytes(b.column(1))
            for i, j in slices(offsets):
                part = offsets[i:j + 1] - offsets[i]
                t = Tree(data[offsets[i]:offsets[j]], part)
                size = np.diff(np.append(t.s_first, len(t.p_row)))
                section = np.repeat(np.arange(len(t.s_first)), size)
                s_begin = np.searchsorted(t.s_row, t.p_row)
                p_begin = np.searchsorted(t.p_row, t.p_row)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i).take(pa.array(t.p_row)),
                     pa.array([f"{a:016x}{c:016x}" for a, c in t.root[t.p_row].tolist()], pa.string()),
                     pa.array((section - s_begin).astype(np.int32)), pa.array(t.s_hash[section].view(np.int64)),
                     pa.array((np.arange(len(t.p_row)) - p_begin).astype(np.int32)), pa.array(t.p_hash.view(np.int64)),
                     pa.array(t.p_start - part[t.p_row]), pa.array(t.p_stop - part[t.p_row])],
                    ["_id", "root", "section", "section_hash", "paragraph", "paragraph_hash", "start", "stop"])

    kind = docs.schema[id_col].dataType.simpleString()
    return left.mapInArrow(run, f"_id {kind}, root string, section int, section_hash long, paragraph int, paragraph_hash long, start long, stop long"
                           ).withColumnRenamed("_id", id_col)


def differing(left: DataFrame, right: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Paragraphs of the ``left`` trees that the ``right`` tree of the same id lacks:
    equal roots, then equal sections drop out before paragraphs are compared."""
    roots = right.select(F.col(id_col), "root").distinct()
    changed = left.join(roots, [id_col, "root"], "left_anti")
    changed = changed.join(right.select(id_col, "section_hash").distinct(), [id_col, "section_hash"], "left_anti")
    return changed.join(right.select(id_col, "paragraph_hash").distinct(), [id_col, "paragraph_hash"], "left_anti")


def with_next(docs: DataFrame, id_col: str, text_col: str, bytes_each: int = 16 << 20) -> DataFrame:
    """Rows (seg, extra, id, text) in segments of consecutive ids, each followed by the first row of
    the next segment (``extra`` = 1; after the last, of the first), so that every row meets its
    successor inside one segment. Segments are cut by sampled ids and sizes; texts move once."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = base.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    # segments of about bytes_each; smaller ones where there would be fewer than a few for every task
    want = min(SEGMENTS, max(1, -(-(total.b or 0) // bytes_each), min(4 * partitions(spark), total.n // SEGMENT_ROWS)))
    cuts = []
    if want > 1:
        share = min(1.0, 40.0 * want / total.n)
        sample = base.where("id IS NOT NULL").sample(share, seed=3).select("id", (F.octet_length("text") + 1).alias("size")).collect()
        sample.sort(key=lambda r: r.id)
        reach = np.cumsum([r.size for r in sample])
        if sample:      # cuts at equal shares of the sampled bytes
            cuts = sorted({sample[at].id for at in np.searchsorted(reach, reach[-1] * np.arange(1, want) / want)})
    cuts = np.array(cuts)

    @F.pandas_udf("int")
    def segment(ids: pd.Series) -> pd.Series:
        out = np.zeros(len(ids), np.int32)
        if len(cuts):
            ok = ids.notna().to_numpy()
            out[ok] = np.searchsorted(cuts, ids[ok].to_numpy().astype(cuts.dtype), side="right")
        return pd.Series(out)

    placed = base.withColumn("seg", segment(F.col("id")) if len(cuts) else F.lit(0))
    # the least row of each segment: at most one per segment
    least = placed.groupBy("seg").agg(F.count_if(F.col("id").isNull()).alias("nulls"), F.min("id").alias("least")).collect()
    heads = sorted((r.seg, None if r.nulls else r.least) for r in least)
    if not heads:
        return placed.select("seg", F.lit(0).alias("extra"), "id", "text")
    follows = [(heads[k - 1][0], heads[k][0], heads[k][1]) for k in range(len(heads))]     # after the last: the first
    kind = docs.schema[id_col].dataType.simpleString()
    links = F.broadcast(spark.createDataFrame(follows, f"to int, at int, first {kind}"))
    extra = (placed.join(links, (F.col("seg") == F.col("at")) & F.col("id").eqNullSafe(F.col("first")))
             .groupBy("to").agg(F.first("id").alias("id"), F.min("text").alias("text"))
             .select(F.col("to").alias("seg"), F.lit(1).alias("extra"), "id", "text"))
    rows = placed.select("seg", F.lit(0).alias("extra"), "id", "text").unionByName(extra)
    return rows.repartition(max(partitions(spark), len(heads)), "seg").sortWithinPartitions("seg", "extra", F.asc_nulls_first("id"), "text")


def _pairs(batches):
    """Chunks of (ids, texts, text after the last) from rows sorted by segment."""
    seg, ids, texts, size = None, [], [], 0
    for b in batches:
        for s, extra, i, t in zip(*(c.to_pylist() for c in b.columns)):
            if s != seg:
                assert not ids
                seg = s
            if size > SLICE_BYTES or extra:
                if ids:
                    yield ids, texts, t
                ids, texts, size = [], [], 0
            if not extra:
                ids.append(i)
                texts.append(t)
                size += 4 * len(t)
    assert not ids


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint beside that of an edited form: its last quarter of code
    points (rounded down) replaced by as many first ones of the next text by id."""
    def run(batches):
        for ids, texts, after in _pairs(batches):
            follow = texts[1:] + [after]
            n = [len(t) for t in texts]
            edited = [(t[:len(t) - len(t) // 4] + f[:len(t) // 4]).encode() for t, f in zip(texts, follow)]
            own = Tree(*_join([t.encode() for t in texts + [after]]))
            new = Tree(*_join(edited))
            rows = np.arange(len(texts))
            a = own.leaves(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, kind), pa.array(n, pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
                 pa.array(own.strings()[:-1], pa.string()), pa.array(new.strings(), pa.string()),
                 pa.array(_common(a, new.leaves(rows))), pa.array(_common(a, own.leaves(rows + 1)))],
                ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    name = docs.schema[id_col].dataType.simpleString()
    kind = to_arrow_type(docs.schema[id_col].dataType)
    return with_next(docs, id_col, text_col).mapInArrow(
        run, f"id {name}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    ).withColumnRenamed("id", id_col)


def op7_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Contract op7 over every whole text of ``documents``."""
    return edited_fingerprints(documents(spark, sf_dir))
