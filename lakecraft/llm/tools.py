"""Small shared helpers: stored tables, column hygiene, memory of Python workers."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecraft.session import materialize


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back
    (cuts lineage; the files survive executor loss)."""
    return materialize(df, f"llm-{name}")


def documents(spark, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_keys(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Two 64-bit hashes that identify a row by its id and text. Rows equal in
    both share them, which every user of these keys wants."""
    return df.withColumns({"_llm_k1": F.xxhash64(F.lit(1), F.col(id_col)),
                           "_llm_k2": F.xxhash64(F.lit(2), F.col(text_col), F.col(id_col))})


BITMAP_BITS = 23


def hash_bitmap(hashes: DataFrame) -> bytes:
    """A bitmap of fixed size (1 MB) with the bits of the values of the one long column ``hashes``:
    a filter that passes all of them, and others at random. At most 2^BITMAP_BITS / 64 rows reach the driver."""
    name = hashes.columns[0]
    at = f"pmod(`{name}`, {1 << BITMAP_BITS})"
    rows = hashes.groupBy(F.expr(f"cast(shiftright({at}, 6) as int)").alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod({at}, 64) as int))")).alias("b")).collect()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for r in rows:
        out[r.w] = r.b
    return out.tobytes()


def bitmap_test(bits: bytes):
    """The bitmap as a function from hashes to booleans."""
    table = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)
    return lambda hashes: table[np.asarray(hashes) & ((1 << BITMAP_BITS) - 1)]


def give_back() -> None:
    """Hand the free memory of this Python process back to the system. Else a worker keeps, beside the
    executor's heap, what its largest task took, also while it waits and in stages without Python."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # the GNU library has it
    if trim is not None:
        trim(0)


def tidy(run):
    """``run``, a function from batches to batches, giving its memory back when a task ends."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return tidied


def partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns whose names an operator is about to produce."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
