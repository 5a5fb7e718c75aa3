"""Best-fit packing of token sequences by exact-complement hashing.

Texts become token ids (plus an end id); only those longer than ``limit`` are
cut into ``limit``-token pieces. Which lengths share a sequence is planned on
the histogram of lengths, at most ``limit`` numbers however large the corpus:

1. From the longest down, the gap that a length leaves is looked up among the
   single lengths, then the sums of two, then of three, and as many sequences
   as the availability counts allow are filled exactly.
2. What remains is placed by best fit, longest first: into the open sequence
   with the smallest gap that holds it, else into a new one.

Filling by three can spend the short pieces that other gaps need, so plans
with sums of at most three, two, one and no further lengths are made, and the
one with the fewest sequences holds.

The plan says for each run of ranks within a length which sequences and which
offset they get. Pieces learn their rank from per-task counts: the stored
pieces know the map task that made them, so no length, however common, meets
in one task.

Defined cases: null texts count as empty (they hold the end id alone);
repeated rows are packed each; null ids stay null; an empty table gives no
rows; columns named like a result are replaced.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecraft.llm.tools import documents, stored, tidy
from lakecraft.llm.token_ids import TokenIds
from lakecraft.llm.words import column_bytes, slices

LIMIT = 4096
END_ID = 1


def vocabulary(path: str | None = None) -> str:
    """A tokenizer file; by default the public lower-case word vocabulary."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    return path


def pieces(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, limit: int = LIMIT,
           end_id: int = END_ID, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``limit`` ids: ``keep`` columns, piece, start, length, ids_crc32 (and ids)."""
    path = vocabulary(tokenizer)
    made = ["piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    cols = [c for c in (docs.columns if keep is None else keep) if c not in (*made, "sequence_id", "offset")]
    left = docs.select(*[F.col(f"`{c}`") for c in cols], F.col(text_col).alias("_llm_text"))

    def run(batches):
        tokens = TokenIds.of_worker(path)
        for b in batches:
            data, offsets = column_bytes(b.column(b.num_columns - 1))
            for i, j in slices(offsets):
                found, n = tokens.slice_ids(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                stop = np.cumsum(n)
                found = np.insert(found, stop, end_id).astype("<u4")
                own, piece, start, length, crc, ids = [], [], [], [], [], []
                at = 0
                for r, total in enumerate((n + 1).tolist(), i):
                    for p, s in enumerate(range(0, total, limit)):
                        part = found[at + s:at + min(s + limit, total)]
                        own.append(r)
                        piece.append(p)
                        start.append(s)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(part.astype(np.int32))
                    at += total
                own = pa.array(own, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [c.take(own) for c in b.columns[:-1]]
                    + [pa.array(piece, pa.int32())] + [pa.array(x, pa.int64()) for x in (start, length, crc)]
                    + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), cols + made)

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return left.mapInArrow(tidy(run), ", ".join([f"`{c}` {kinds[c]}" for c in cols]
                                                + ["piece int", "start long", "length long", "ids_crc32 long"] + ["ids array<int>"] * with_ids))


class Plan:
    """Which ranks of which length go to which sequences at which offset."""

    def __init__(self, counts: dict[int, int], limit: int, depth: int = 3):
        self.limit, self.rows, self.sequences, self.depth = limit, [], 0, depth
        self.left = np.zeros(limit + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.used = np.zeros(limit + 1, np.int64)
        self._exact()
        self._best_fit()

    @classmethod
    def best(cls, counts: dict[int, int], limit: int) -> Plan:
        least = -(-sum(length * n for length, n in counts.items()) // limit)
        found = None
        for depth in (3, 2, 1, 0):
            plan = cls(counts, limit, depth)
            if found is None or plan.sequences < found.sequences:
                found = plan
            if found.sequences <= least:
                break
        return found

    def _place(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.rows.append((int(length), int(self.used[length]), int(sequence), int(offset)))
        self.used[length] += n
        self.left[length] -= n

    def _fill(self, *lengths: int) -> int:
        """As many sequences of these lengths as there are pieces for."""
        n = min(int(self.left[x]) // lengths.count(x) for x in lengths)
        if n > 0:
            at = 0
            for x in lengths:
                self._place(x, n, self.sequences, at)
                at += x
            self.sequences += n
        return n

    def _pair(self, total: int, *spent: int):
        """Two available lengths with this sum, the longest first; ``spent`` are lengths already used in the sequence."""
        if total < 2:
            return None
        have = self.left[:total].copy()
        for x in spent:
            if x < total:
                have[x] -= 1
        a = np.arange((total + 1) // 2, total)
        ok = (have[a] > 0) & (have[total - a] > 0) & ((a * 2 != total) | (have[a] > 1))
        hit = np.flatnonzero(ok)
        return (int(a[hit[-1]]), total - int(a[hit[-1]])) if len(hit) else None

    def _exact(self) -> None:
        limit = self.limit
        self._fill(limit)
        for big in range(limit - 1, limit // 4, -1):
            gap = limit - big
            if self.left[big] > 0 and self.depth > 0:
                self._fill(big, gap)
            while self.depth > 1 and self.left[big] > 0 and (two := self._pair(gap, big)):
                self._fill(big, *two)
            third = gap - 2 if self.depth > 2 else 0
            while self.left[big] > 0 and third > 0:
                two = self._pair(gap - third, big, third) if self.left[third] > (third == big) else None
                if two:
                    self._fill(big, third, *two)
                else:
                    third -= 1

    def _best_fit(self) -> None:
        open_by_gap: dict[int, list[tuple[int, int]]] = {}     # gap -> ranges (first sequence, how many)
        gaps: list[int] = []

        def add(gap: int, first: int, n: int) -> None:
            if n > 0 and gap > 0:
                if gap not in open_by_gap:
                    open_by_gap[gap] = []
                    insort(gaps, gap)
                open_by_gap[gap].append((first, n))

        for length in range(self.limit, 0, -1):
            while (c := int(self.left[length])) > 0:
                at = bisect_left(gaps, length)
                if at < len(gaps):
                    gap = gaps[at]
                    first, n = open_by_gap[gap].pop()
                    if not open_by_gap[gap]:
                        del open_by_gap[gap], gaps[at]
                else:
                    gap, first, n = self.limit, self.sequences, -(-c // (self.limit // length))
                    self.sequences += n
                each = gap // length                     # a tighter sequence takes the next of this length too
                whole = min(n, c // each)
                for k in range(each if whole else 0):
                    self._place(length, whole, first, self.limit - gap + k * length)
                add(gap - each * length, first, whole)
                if whole < n:
                    some = c - whole * each
                    for k in range(some):
                        self._place(length, 1, first + whole, self.limit - gap + k * length)
                    add(gap - some * length, first + whole, 1)
                    add(gap, first + whole + 1, n - whole - 1)

    def table(self) -> tuple[np.ndarray, ...]:
        """Runs of ranks by length and first rank: key, first rank, first sequence, offset."""
        rows = sorted(self.rows)
        return (np.array([length << 44 | rank for length, rank, *_ in rows], np.int64),
                *(np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3)))


def look_up(table, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces with these ranks within their lengths."""
    key, first, sequence, offset = table
    at = np.searchsorted(key, length << 44 | rank, side="right") - 1
    return sequence[at] + rank - first[at], offset[at]


def pack(made: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Pieces (with a ``length`` of 1 to ``limit``) plus sequence_id and offset."""
    spark = made.sparkSession
    cols = made.columns
    made = stored(made.withColumn("_task", F.spark_partition_id()), "pieces")
    counts = made.groupBy("_task", "length").agg(F.count("*").alias("n"))
    total = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()        # at most ``limit`` rows
    plan = spark.sparkContext.broadcast(Plan.best({r.length: r.n for r in total}, limit).table())
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    # names of its own: both sides come from one table, and columns must not be taken for each other
    starts = counts.select(F.col("_task").alias("_of"), F.col("length").alias("of_length"), F.coalesce(before, F.lit(0)).alias("before"))

    def place(rows: pa.Table, starts: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return rows.drop_columns(["_task"]).append_column("sequence_id", pa.array([], pa.int64())).append_column("offset", pa.array([], pa.int64()))
        flat = [c for c in rows.column_names if not pa.types.is_nested(rows.schema.field(c).type)]
        rows = rows.sort_by([("length", "ascending"), *((c, "ascending") for c in flat if c not in ("length", "_task"))])
        length = rows.column("length").to_numpy()
        first = np.searchsorted(length, length, side="left")
        base = np.zeros(limit + 1, np.int64)
        base[starts.column("of_length").to_numpy()] = starts.column("before").to_numpy()
        sequence, offset = look_up(plan.value, length, base[length] + np.arange(len(length)) - first)
        return (rows.drop_columns(["_task"]).append_column("sequence_id", pa.array(sequence, pa.int64()))
                .append_column("offset", pa.array(offset, pa.int64())))

    kinds = {f.name: f.dataType.simpleString() for f in made.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in cols] + ["sequence_id long", "offset long"])
    return made.groupBy("_task").cogroup(starts.groupBy("_of")).applyInArrow(place, schema)


def pack_documents(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, limit: int = LIMIT,
                   end_id: int = END_ID, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs``."""
    return pack(pieces(docs, text_col, keep, limit, end_id, tokenizer, with_ids), limit)


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Contract op3: sequences of 4096 tokens over every whole text of ``documents``."""
    return pack_documents(documents(spark, sf_dir), keep=["doc_id"])
