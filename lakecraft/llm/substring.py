"""Substring dedup: repeated word windows found by super-k-mer partitioning.

A window is ``window`` consecutive words of one text. Its minimiser is the
smallest hash among the ``mer``-word runs inside it; consecutive windows that
share their minimiser travel as one packed string (a super-k-mer: the words
that they cover) to the bucket of that minimiser. Equal windows have equal
minimisers, so each bucket alone decides which of its windows occur more than
once: it sorts them and compares the words of equal neighbours.

Scale. The numbers of buckets and of the tasks that sort them follow the corpus
size, so that a bucket holds about ``bucket_bytes`` of text and a task about
``TASK_BUCKETS`` buckets however large the input. Equal super-k-mers of
one map task travel once, marked as repeated, and the task itself flags their
places: a passage copied into a third of all documents reaches its bucket once
per flush, not once per document. Runs of words found to be frequent in a
sample rank last as minimisers, so windows that only touch a common passage go
to buckets of their own rare words; the sample steers this dealing alone and
never the result, which is exact over all windows. Texts without a repeated
window are finished where they are read (a bitmap of fixed size tells them,
erring on the safe side); only the others are shuffled to their ranges.

Defined cases: null, empty and shorter texts have no window and keep all their
words; repeated rows are occurrences like any other; extra columns pass
through, and an input column named like a result column is replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecraft.llm.tools import bitmap_test, documents, give_back, hash_bitmap, row_keys, stored, tidy
from lakecraft.llm.words import U64, Words, column_bytes, mix64, slices, sliding_min, window_hash

WINDOW = 35
MER = 3
BUCKET_BYTES = 1 << 20
FLUSH_BYTES = 20 << 20
TASK_BUCKETS = 16
#: Packed bytes of a bucket from which memory is given back.
TIDY_BYTES = 1 << 18
#: Text that is worked on at once: arrays over its bytes take some fifty times as much.
SLICE_BYTES = 1 << 18
#: Steering sample: at most about so many rows; runs this frequent in it rank last.
SAMPLE_ROWS = 20_000
COMMON = 24
MAX_COMMON = 100_000


def _mers(words: Words, mer: int) -> np.ndarray:
    return window_hash(words.hash, mer, 0x2545F4914F6CDD1D)


def _ranked(values: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Order of minimisers: by hash, runs listed in ``common`` (sorted) after all others."""
    ranked = values >> U64(1)
    if len(common):
        at = np.searchsorted(common, values)
        at[at == len(common)] = 0
        ranked |= (common[at] == values).astype(U64) << U64(63)
    return ranked


def _super_kmers(words: Words, window: int, mer: int, common: np.ndarray):
    """First window, last window and minimiser of each super-k-mer."""
    n = len(words.row) - window + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z, z, z.astype(U64)
    least = sliding_min(_ranked(_mers(words, mer), common), window - mer + 1)
    valid = words.row[:n] == words.row[window - 1:]
    fresh = np.ones(n, bool)
    fresh[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
    first = np.flatnonzero(fresh & valid)
    stop = np.ones(n, bool)
    stop[:-1] = fresh[1:] | ~valid[1:]
    last = np.flatnonzero(stop & valid)
    return first, last, least[first]


class _Flush:
    """Super-k-mers of some slices: distinct ones by bucket, places of repeated ones."""

    def __init__(self, window: int, buckets: int):
        self.window, self.buckets, self.size, self.rows = window, buckets, 0, 0
        self.seen: dict[bytes, int] = {}
        self.k1, self.k2, self.at, self.n, self.bucket = [], [], [], [], []
        self.multi: list[bool] = []
        self.places: list[tuple[int, int, int, int]] = []

    def add(self, words: Words, k1: np.ndarray, k2: np.ndarray, first, last, least) -> None:
        if not len(first):
            return
        text, to, lens = words.joined()
        end = last + self.window - 1
        a, b = to[first].tolist(), (to[end] + lens[end]).tolist()
        row = words.row[first]
        at = (first - words.first()[row]).tolist()
        n = (last - first + 1).tolist()
        bucket = (mix64(least) % U64(self.buckets)).astype(np.int64).tolist()
        c1, c2 = k1[row].tolist(), k2[row].tolist()
        seen, w = self.seen, self.window
        for i in range(len(a)):
            s = text[a[i]:b[i]]
            j = seen.setdefault(s, len(self.at))
            if j == len(self.at):
                self.k1.append(c1[i])
                self.k2.append(c2[i])
                self.at.append(at[i])
                self.n.append(n[i])
                self.bucket.append(bucket[i])
                self.multi.append(False)
                self.size += len(s) + 120
            else:
                if not self.multi[j]:
                    self.multi[j] = True
                    self.places.append((self.k1[j], self.k2[j], self.at[j], self.at[j] + self.n[j] - 1 + w))
                self.places.append((c1[i], c2[i], at[i], at[i] + n[i] - 1 + w))

    def take(self):
        """Record batches (bucket, blob); places found here have negative bucket numbers."""
        pack = zstandard.ZstdCompressor(level=6).compress
        out_b, out = [], []
        if self.at:
            texts = list(self.seen)
            bucket = np.array(self.bucket)
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.diff(bucket[order])) + 1
            k1, k2 = np.array(self.k1, np.int64), np.array(self.k2, np.int64)
            at, multi = np.array(self.at, np.int64), np.array(self.multi, np.uint8)
            for ids in np.split(order, cut):
                part = [texts[i] for i in ids]
                blob = b"".join([np.int64(len(ids)).tobytes(), k1[ids].tobytes(), k2[ids].tobytes(), at[ids].tobytes(),
                                 np.array([len(x) for x in part], np.int64).tobytes(), multi[ids].tobytes(), *part])
                out_b.append(int(bucket[ids[0]]))
                out.append(pack(blob))
        if self.places:
            p = np.array(self.places, np.int64)
            out_b.append(-1 - int(mix64(p[:1, 0].astype(U64))[0] % U64(self.buckets)))
            out.append(pack(p.tobytes()))
        self.__init__(self.window, self.buckets)
        yield pa.RecordBatch.from_arrays([pa.array(out_b, pa.int64()), pa.array(out, pa.binary())], ["bucket", "blob"])


def _extract(window: int, mer: int, buckets: int, common: np.ndarray):
    def run(batches):
        flush = _Flush(window, buckets)
        for batch in batches:
            data, offsets = column_bytes(batch.column(0))
            k1, k2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for i, j in slices(offsets, SLICE_BYTES):
                part = offsets[i:j + 1] - offsets[i]
                words = Words(data[offsets[i]:offsets[j]], part)
                flush.add(words, k1[i:j], k2[i:j], *_super_kmers(words, window, mer, common))
                if flush.size > FLUSH_BYTES:
                    yield from flush.take()
                    give_back()
        yield from flush.take()
    return run


def _count(window: int):
    """Bucket -> word ranges [start, stop) of its windows that occur more than once."""
    def run(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        blobs = [unpack(x) for x in table.column("blob").to_pylist()]
        if not blobs or table.column("bucket")[0].as_py() < 0:
            p = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 4) for x in blobs] or [np.zeros((0, 4), np.int64)])
            return _places(p[:, 0], p[:, 1], p[:, 2], p[:, 3])
        k1, k2, at, lens, multi, text = [], [], [], [], [], []
        for x in blobs:
            n = int(np.frombuffer(x, np.int64, 1)[0])
            cols = np.frombuffer(x, np.int64, 4 * n, 8).reshape(4, n)
            for to, c in zip((k1, k2, at, lens), cols):
                to.append(c)
            multi.append(np.frombuffer(x, np.uint8, n, 8 + 32 * n))
            text.append(x[8 + 33 * n:])
        k1, k2, at, lens = (np.concatenate(x) for x in (k1, k2, at, lens))
        multi = np.concatenate(multi).astype(bool)
        raw, ends = b"".join(text), np.concatenate([[0], np.cumsum(lens)])
        data = np.frombuffer(raw, np.uint8)
        parts = []                         # per window: two hashes, byte range, super-k-mer, place in it
        for i, j in slices(ends, SLICE_BYTES):
            words = Words(data[ends[i]:ends[j]], ends[i:j + 1] - ends[i])
            n = len(words.row) - window + 1
            here = np.flatnonzero(words.row[:n] == words.row[window - 1:])
            parts.append((window_hash(words.hash, window, 0x9E3779B97F4A7C15)[here],
                          window_hash(mix64(words.hash + U64(7)), window, 0xC2B2AE3D27D4EB4F)[here],
                          words.start[here] + ends[i], words.end[here + window - 1] + ends[i],
                          words.row[here] + i, here - words.first()[words.row[here]]))
        h1, h2, a, b, row, off = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((h2, h1))
        same = np.zeros(len(order), bool)
        same[1:] = (h1[order[1:]] == h1[order[:-1]]) & (h2[order[1:]] == h2[order[:-1]])
        left, right = order[np.flatnonzero(same) - 1], order[same]
        if any(raw[p:q] != raw[r:s] for p, q, r, s in zip(a[left].tolist(), b[left].tolist(), a[right].tolist(), b[right].tolist())):
            by: dict[bytes, int] = {}      # two hashes of 64 bits collided: group by the words themselves
            ids = np.array([by.setdefault(raw[p:q], len(by)) for p, q in zip(a.tolist(), b.tolist())])
            order = np.argsort(ids, kind="stable")
            same = np.concatenate([[False], ids[order[1:]] == ids[order[:-1]]])
        group = np.cumsum(~same) - 1
        size = np.bincount(group, minlength=1)
        any_multi = np.zeros(len(size), bool)
        any_multi[group[multi[row[order]]]] = True
        again = np.zeros(len(row), bool)
        again[order] = ((size > 1) | any_multi)[group]
        again &= ~multi[row]               # places of those were flagged by their map task
        # runs of repeated windows; windows lie in order, each super-k-mer's from place 0
        edge = np.diff(np.concatenate([[0], (again * (row + 1)), [0]]))
        start = np.flatnonzero(again & (edge[:-1] != 0))
        stop = np.flatnonzero(again & (edge[1:] != 0))
        r = row[start]
        return _places(k1[r], k2[r], at[r] + off[start], at[r] + off[stop] + window)
    return run


def _tidy_count(window: int):
    """``_count``, giving its memory back after each bucket that held much."""
    count = _count(window)

    def run(table: pa.Table) -> pa.Table:
        try:
            return count(table)
        finally:
            if table.nbytes > TIDY_BYTES:
                give_back()
    return run


def _places(k1, k2, start, stop) -> pa.Table:
    return pa.table([pa.array(np.ascontiguousarray(x), pa.int64()) for x in (k1, k2, start, stop)],
                    ["_llm_k1", "_llm_k2", "start", "stop"])


def _common_mers(docs: DataFrame, mer: int, rows: int) -> np.ndarray:
    """Runs of ``mer`` words that a bounded sample shows often (steering only)."""
    share = min(1.0, SAMPLE_ROWS / max(rows, 1))
    texts = docs.sample(share, seed=5) if share < 1 else docs

    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(0))
            for i, j in slices(offsets):
                words = Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                v, n = np.unique(_mers(words, mer), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(n.astype(np.int64))], ["m", "n"])

    found = (texts.mapInArrow(tidy(run), "m long, n long").where("n > 1").groupBy("m").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= COMMON).orderBy(F.desc("n"), "m").limit(MAX_COMMON).select("m").collect())
    return np.sort(np.array([r.m for r in found], np.int64).view(U64))


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    mer: int = MER, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Word ranges covered by repeated windows: row keys ``_llm_k1, _llm_k2`` (see
    ``tools.row_keys``), start, stop. Ranges of a row may overlap."""
    if not 2 <= mer <= window:
        raise ValueError("2 <= mer <= window is needed")
    keyed = row_keys(docs, id_col, text_col).select(F.col(text_col).alias("text"), "_llm_k1", "_llm_k2")
    total = keyed.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).first()
    buckets = max(1, (total.bytes or 0) // bucket_bytes)
    common = _common_mers(keyed.select("text"), mer, total.n)
    dealt = keyed.mapInArrow(tidy(_extract(window, mer, buckets, common)), "bucket long, blob binary")
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, buckets // TASK_BUCKETS)
    return dealt.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_tidy_count(window), "_llm_k1 long, _llm_k2 long, start long, stop long")


def _cut(text_col: str, digest: bool):
    """Removes the ranges; yields counts and the kept words, or only their SHA-256."""
    def run(batches):
        for batch in batches:
            names = batch.schema.names
            at = names.index("_llm_text")
            data, offsets = column_bytes(batch.column(at))
            spans = batch.column(names.index("_llm_spans"))
            rest = [i for i, x in enumerate(names) if x not in ("_llm_text", "_llm_spans")]
            for i, j in slices(offsets, SLICE_BYTES):
                words = Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                first, n = words.first(), words.counts()
                part = spans.slice(i, j - i)
                flat = part.flatten()
                owner = np.repeat(np.arange(j - i), np.diff(_list_offsets(part)))
                edge = np.zeros(len(words.row) + 1, np.int64)
                np.add.at(edge, first[owner] + flat.field(0).to_numpy(zero_copy_only=False), 1)
                np.add.at(edge, first[owner] + flat.field(1).to_numpy(zero_copy_only=False), -1)
                keep = np.cumsum(edge)[:-1] == 0
                text, to, lens = words.joined(keep)
                row = words.row[keep]
                kept = np.bincount(row, minlength=j - i)
                stop = np.cumsum(kept)
                ends = np.concatenate([to, [len(text)]])
                pieces = [text[ends[s - c]:ends[s] - 1] if c else b"" for s, c in zip(stop.tolist(), kept.tolist())]
                made = (pa.array([hashlib.sha256(x).hexdigest() for x in pieces], pa.string()) if digest
                        else pa.array(pieces, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(x).slice(i, j - i) for x in rest]
                    + [pa.array(n.astype(np.int64)), pa.array((n - kept).astype(np.int64)), made],
                    [names[x] for x in rest] + ["n_words", "n_removed", "kept_sha256" if digest else "kept_text"])
    return run


def _marked(bits: bytes, wanted: bool, then=None):
    """Batches with the rows whose second key is in the bitmap (or the others), handed to ``then`` without their keys."""
    def run(batches):
        test = bitmap_test(bits)

        def parts():
            for batch in batches:
                names = batch.schema.names
                part = batch.filter(pa.array(test(batch.column(names.index("_llm_k2")).to_numpy()) == wanted))
                if part.num_rows:
                    yield part if then is None else part.drop_columns(["_llm_k1", "_llm_k2"])
        yield from parts() if then is None else then(parts())
    return run


def _list_offsets(col: pa.ListArray) -> np.ndarray:
    lens = col.value_lengths().to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(np.nan_to_num(lens).astype(np.int64))])


def _spans(ranges: DataFrame) -> DataFrame:
    """Ranges per row key. Repeated rows have the same ranges under the same key: one of each is kept, before the shuffle."""
    own = ranges.select("_llm_k1", "_llm_k2", "start", "stop").distinct()
    return own.groupBy("_llm_k1", "_llm_k2").agg(F.collect_list(F.struct("start", "stop")).alias("_llm_spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   mer: int = MER, bucket_bytes: int = BUCKET_BYTES, digest: bool = False,
                   keep: list[str] | None = None) -> DataFrame:
    """``docs`` without the words that repeated windows cover.

    Returns ``keep`` (default: all columns) plus n_words, n_removed and
    kept_text (kept words joined by one space; with ``digest`` kept_sha256).
    """
    result = ["n_words", "n_removed", "kept_sha256" if digest else "kept_text"]
    ranges = stored(repeated_ranges(docs, id_col, text_col, window, mer, bucket_bytes), "repeated-ranges")
    spans = _spans(ranges)
    cols = [c for c in (keep or docs.columns) if c not in result]
    left = row_keys(docs, id_col, text_col).select(*[F.col(f"`{c}`") for c in cols], F.col(text_col).alias("_llm_text"), "_llm_k1", "_llm_k2")
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in cols] + ["n_words long", "n_removed long", f"{result[2]} string"])
    # texts without a range stay where they are read; only the others move to their ranges
    bits = hash_bitmap(ranges.select("_llm_k2"))
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    whole = left.withColumn("_llm_spans", none).mapInArrow(tidy(_marked(bits, False, _cut(text_col, digest))), schema)
    moved = left.mapInArrow(tidy(_marked(bits, True)), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema.fields))
    both = moved.join(spans, ["_llm_k1", "_llm_k2"], "left").drop("_llm_k1", "_llm_k2").withColumn("_llm_spans", F.coalesce("_llm_spans", none))
    return whole.unionByName(both.mapInArrow(tidy(_cut(text_col, digest)), schema))


#: Contract op9 in DuckDB: every window's hash, counted; a word goes if a repeated window begins at it or at one of the 34 before.
OP9_SQL = r"""
WITH txt AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM txt),
win AS (SELECT doc_id, i, CASE WHEN COUNT(*) OVER p = 35 THEN sha256(string_agg(word, ' ') OVER p) END AS h FROM word
        WINDOW p AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
often AS (SELECT h FROM win WHERE h IS NOT NULL GROUP BY h HAVING COUNT(*) > 1),
marked AS (SELECT doc_id, i, h IN (SELECT h FROM often) AS hit FROM win),
cover AS (SELECT doc_id, i, COALESCE(bool_or(hit) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), FALSE) AS gone FROM marked),
kept AS (SELECT doc_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE gone) AS r, COALESCE(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS t
         FROM cover JOIN word USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, COALESCE(n, 0)::BIGINT AS n_words, COALESCE(r, 0)::BIGINT AS n_removed, sha256(COALESCE(t, '')) AS kept_sha256
FROM txt LEFT JOIN kept USING (doc_id)
"""


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract op9: windows of 35 words over every whole text of ``documents``."""
    return remove_repeats(documents(spark, sf_dir), digest=True, keep=["doc_id"])
