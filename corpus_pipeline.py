"""A corpus from documents to packed sequences: every stage is one operator, written before the next reads it.

Language identification, exact deduplication, near-duplicate removal, removal of repeated passages,
packing. Each function takes (spark, docs, sf_dir); all but the last return the columns of documents.
Extra columns pass through to the last stage; an empty table gives no pieces; null texts have no
language and go in the first stage.

All stages share executors, whose Java heap stays as large as any stage made it, so every stage begins with
a full collection there. What Arrow holds beside the heap and in the Python workers is bounded by ``BATCH_ROWS``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spendcast.llm import exact_dedup, language, ngram_join, packing, suffix_dedup
from spendcast.llm.catalog import vocabulary
from spendcast.llm.common import shrink_heaps
from spendcast.session import materialize


#: Rows that travel to a Python worker at once. Whole texts, so batches of Spark's 10 000 rows take tens of MB each, on both sides.
BATCH_ROWS = 1000


def bound_memory(spark: SparkSession) -> None:
    """Hand back what earlier stages left, and lower the session's rows per Arrow batch to ``BATCH_ROWS``.

    A smaller setting stays. It holds until the session ends, since a stage's last table is written after
    its function returned.
    """
    shrink_heaps(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language has a probability below one half, go."""
    bound_memory(spark)
    return language.confident(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    bound_memory(spark)
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest doc_id stays."""
    bound_memory(spark)
    return ngram_join.representatives(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that also start elsewhere are cut out of the texts."""
    bound_memory(spark)
    cut = suffix_dedup.cleaned(docs)
    if "n_chars" not in cut.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts with their token ids (32-bit, little-endian), placed in sequences of 2048 tokens."""
    bound_memory(spark)
    return packing.pieces(packing.pack(docs, vocabulary("word_bpe_49k.json")), with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_passages),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs


#: The language model, the tokenizer and the cuts cannot be put into SQL.
ORACLE_SQL = None
