"""Training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept. The first four return the columns of ``documents``; the last returns the
packed sequences.

Defined cases, for every stage: an empty table gives an empty table; further
columns, whatever their names, are not carried on; very long texts are read
whole; null texts count as empty and are never toxic, alike or cut; rows with
null ids, languages or sources go through like others. What each stage does
with ties and repeated rows is said there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecraft.llm.minhash import drop_near_duplicates
from lakecraft.llm.mixing import mix_texts
from lakecraft.llm.packing import pack_documents
from lakecraft.llm.substring import remove_repeats
from lakecraft.llm.tools import documents, stored
from lakecraft.llm.toxicity import fit, score

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Texts that go to Python at once: a batch lies several times in an executor's memory beside the heap.
BATCH_ROWS, BATCH_BYTES = 2_000, 4 << 20
_BATCH, _BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def _texts(docs: DataFrame) -> DataFrame:
    """The columns of documents; the session's Arrow batches hold ``BATCH_ROWS`` rows unless it asks for fewer, and
    about ``BATCH_BYTES`` unless it says how many."""
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(_BATCH)) <= BATCH_ROWS:
        conf.set(_BATCH, str(BATCH_ROWS))
    if conf.get(_BYTES, None) is None:
        conf.set(_BYTES, str(BATCH_BYTES))
    return docs.select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic (it learns from all labels). Repeated rows are judged alike
    and each of them stays or goes; a score equal to the threshold is toxic; without a toxic label all stay."""
    docs = _texts(docs)
    model = fit(docs, documents(spark, sf_dir, "labels"))
    return score(docs, model).where("predicted = 0").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a similarity of 0.8 or more on shingles of five words: the one with the least
    id, also of equal texts; of rows equal in id and text one. Texts without words all stay."""
    return drop_near_duplicates(_texts(docs), width=5)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat anywhere; the text of others stays as it is. Every place of a
    repeated passage goes, none is favoured; a document that is all repeats stays with an empty text."""
    cut = remove_repeats(_texts(docs))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return cut.select("doc_id", text.alias("text"), "lang", "source",
                      F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to target weights; each taken part of a document is a row. A null source is a source of its own,
    the last; documents without words are not taken; reruns agree."""
    return mix_texts(docs.select(*COLUMNS), length_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: per piece its row's document and source, span, sequence and offset. An empty
    text is a piece of its end token; rows of one document are packed one by one; equal lengths in any order."""
    return pack_documents(_texts(docs), keep=["doc_id", "source"])


STAGES = [
    ("toxicity", toxicity),
    ("minhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", packing),
]

#: Learned scores, hashes and tokens are beyond SQL; tests/llm/test_pipeline.py checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(*COLUMNS)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
