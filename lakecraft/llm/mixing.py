"""Mixing sources to target weights, in blocks of words.

1. Words of a source stand in one row, text after text, and are cut into blocks
   of ``block`` words. A text's place in its source is a prefix sum in two steps
   (texts are dealt to many chunks of a source by hash, chunks follow each
   other), so a source with a third of all rows is not one task's work.
2. Targets: sources by name weigh 1, 2, 3, repeating (nulls last), and share
   all words; none is taken more than ``cap`` times, the excess going to the
   others by weight (the water level is found in one ordered pass).
3. The mix has as many slots of a source as its target has blocks. Output
   shards of ``shard_blocks`` slots draw from them: every slot goes to a
   pseudorandom place, so a shard's counts by source are a multinomial draw
   given the totals, and the totals hold the targets to a block.
4. Slots are mapped to block numbers by a pseudorandom permutation of each
   source's index, a new one for each pass through the source, and joined with
   the blocks by number. No block is taken twice before all are taken once.

Permutations are swap-or-not networks on keyed hashes, exact for every length.
The main path is DataFrame functions only. Sources form a small table that is
ordered in one task; nothing else is ordered as a whole.

Defined cases: null and empty texts have size 0 and are taken 0 times; null
sources are one source; repeated rows are texts of their own; if there are no
words at all, targets are 0; results depend on the rows alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecraft.llm.tools import documents, partitions, stored

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 32
SHARD_BLOCKS = 4096
#: Rows in a chunk of a source, on average.
CHUNK_ROWS = 512
ROUNDS = 14


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """Image of ``x`` under a pseudorandom permutation of 0 .. n - 1 chosen by ``key``."""
    def swap(at, r):
        other = F.pmod(F.pmod(F.xxhash64(r, *key), n) - at, n)
        return F.when(F.pmod(F.xxhash64(F.greatest(at, other), r, *key), F.lit(2)) == 1, other).otherwise(at)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), swap)


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``sizes`` (source, source_size) plus sid and target."""
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    t = sizes.withColumn("sid", F.row_number().over(by_name) - 1)
    t = t.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod("sid", F.lit(len(weights))) + 1).cast("int")))
    t = t.withColumn("most", F.col("source_size") * cap).withColumn("bound", F.col("most") / F.col("weight"))
    rising = Window.orderBy("bound", "sid")
    t = t.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    t = t.withColumn("level", F.col("left") / F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)))
    t = t.withColumn("water", F.min(F.when(F.col("level") <= F.col("bound"), F.struct("bound", "sid", "level"))).over(everything)["level"])
    full = F.col("water").isNull() | (F.col("bound") < F.col("water"))
    return t.select("source", "source_size", *[c for c in sizes.columns if c not in ("source", "source_size")], "sid", F.when(full, F.col("most").cast("double")).otherwise(F.col("weight") * F.col("water")).alias("target"))


def placed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=(1, 2, 3), cap: int = 3,
           keep_keys: bool = False) -> DataFrame:
    """Per row: id, size, sid, source_size, target and start, its first word's place in the source."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)).cast("long"), F.lit(0).cast("long")).alias("size"),
                       F.xxhash64(F.lit(2), F.col(text_col), F.col(id_col), F.col(source_col)).alias("_llm_k2"), F.xxhash64(F.lit(1), F.col(id_col)).alias("_llm_k1"))
    rows = stored(rows, "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.ceil(F.count("*") / CHUNK_ROWS).alias("chunks"))
    sources = stored(targets(sizes, weights, cap), "mix-sources")
    rows = (rows.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of", "source")
            .withColumn("chunk", F.pmod(F.xxhash64(F.lit(9), "_llm_k2"), F.col("chunks"))))
    total = rows.groupBy("sid", "chunk").agg(F.sum("size").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    base = total.select(F.col("sid").alias("s"), F.col("chunk").alias("c"), F.coalesce(earlier, F.lit(0)).alias("base"))
    inside = F.sum("size").over(Window.partitionBy("sid", "chunk").orderBy("_llm_k2", "_llm_k1", "size").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("inside", F.coalesce(inside, F.lit(0))).join(base, (F.col("sid") == F.col("s")) & (F.col("chunk") == F.col("c")))
    out = ["id", "size", "sid", "source_size", "target"] + ["_llm_k1", "_llm_k2"] * keep_keys
    return rows.select(*out, (F.col("base") + F.col("inside")).alias("start"))


def slots(rows_sources: DataFrame, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, seed: int = 1) -> DataFrame:
    """Slots of the mix: sid, block (number within the source), shard, slot."""
    spark = rows_sources.sparkSession
    s = rows_sources.where("source_size > 0").withColumn("n", F.ceil(F.col("source_size") / block).cast("long"))
    s = s.withColumn("passes", F.floor(F.col("target") / F.col("source_size")).cast("long"))
    some = F.round((F.col("target") - F.col("passes") * F.col("source_size")) / block).cast("long")
    s = s.withColumn("slots", F.col("passes") * F.col("n") + F.least(some, F.col("n")))
    before = F.sum("slots").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1))
    s = s.withColumn("before", F.coalesce(before, F.lit(0))).withColumn("all", F.sum("slots").over(Window.partitionBy())).where("slots > 0")
    part = 4096
    s = s.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / part).cast("long"))))
    s = s.repartition(partitions(spark), "sid", "part")
    s = s.withColumn("j", F.explode(F.sequence(F.col("part") * part, F.least(F.col("part") * part + part, F.col("slots")) - 1)))
    turn = F.floor(F.col("j") / F.col("n")).cast("long")
    place = permuted(F.col("before") + F.col("j"), F.col("all"), F.lit(seed), F.lit(77))
    return s.select("sid", permuted(F.pmod("j", "n"), F.col("n"), F.col("sid"), turn, F.lit(seed)).alias("block"),
                    F.floor(place / shard_blocks).cast("long").alias("shard"), F.pmod(place, F.lit(shard_blocks)).cast("int").alias("slot"))


def mix(rows: DataFrame, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, seed: int = 1) -> DataFrame:
    """The mix from ``placed`` rows: shard, slot, sid, block, start (names the text within its source),
    skip and words (the part of the text that lies in the block)."""
    sources = rows.select("sid", "source_size", "target").distinct()
    full = rows.where("size > 0")
    b = F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)))
    blocks = full.select("sid", "start", "size", b.alias("block"))
    low, high = F.greatest("start", F.col("block") * block), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    blocks = blocks.select("sid", "block", "start", (low - F.col("start")).alias("skip"), (high - low).alias("words"))
    # both sides grow with the words; the plan's estimate for the slots, made from few rows, is far too low to broadcast by
    return slots(sources, block, shard_blocks, seed).hint("merge").join(blocks.hint("merge"), ["sid", "block"])


def mix_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str | None = None,
              weights=(1, 2, 3), cap: int = 3, block: int = 1024, seed: int = 1) -> DataFrame:
    """The mix as rows of ``docs``: each taken part of a text is a row with the columns of its
    text, holding the whole text as it is or the part's words joined by one space (and its length in
    ``length_col``)."""
    rows = stored(placed(docs, id_col, text_col, source_col, weights, cap, keep_keys=True), "mix-rows")
    parts = mix(rows, block, seed=seed).groupBy("sid", "start").agg(F.collect_list(F.struct("skip", "words")).alias("_llm_parts"))
    # a text's parts: at most ``cap`` times its own blocks; of equal rows each is taken as often as its place is
    mine = rows.where("size > 0").join(parts, ["sid", "start"]).groupBy("_llm_k1", "_llm_k2").agg(F.flatten(F.collect_list("_llm_parts")).alias("_llm_parts"))
    cols = docs.columns
    whole = (docs.withColumns({"_llm_k1": F.xxhash64(F.lit(1), F.col(id_col)), "_llm_k2": F.xxhash64(F.lit(2), F.col(text_col), F.col(id_col), F.col(source_col))})
             .join(mine, ["_llm_k1", "_llm_k2"]).dropDuplicates(["_llm_k1", "_llm_k2"]))
    cut = whole.withColumn("_llm_words", F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})"), F.lit(1))).withColumn("_llm_p", F.explode(F.sort_array("_llm_parts")))
    text = F.array_join(F.slice("_llm_words", (F.col("_llm_p.skip") + 1).cast("int"), F.col("_llm_p.words").cast("int")), " ")
    cut = cut.withColumn("_llm_text", F.when(F.col("_llm_p.words") == F.size("_llm_words"), F.col(text_col)).otherwise(text))
    made = {text_col: F.col("_llm_text")} | ({length_col: F.length("_llm_text").cast("long")} if length_col else {})
    return cut.select(*[made[c].alias(c) if c in made else F.col(f"`{c}`") for c in cols])


def op2_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Contract op2 over all ``documents``, with first_shard and last_shard: the output shards that the draw
    put a document's first and last parts in (null if none of it is taken)."""
    rows = stored(placed(documents(spark, sf_dir)), "mix-rows")
    taken = mix(rows).groupBy("sid", "start").agg(
        F.sum("words").alias("taken"), F.min("shard").alias("first_shard"), F.max("shard").alias("last_shard")).withColumn("some", F.lit(True))
    out = rows.withColumn("some", F.col("size") > 0).join(taken, ["sid", "start", "some"], "left")
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                      "first_shard", "last_shard")
