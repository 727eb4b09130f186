"""The corpus pipeline: documents in, sampled pieces of the clean ones out.

Each stage is written as Parquet and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitmill.llm import decontaminate, langid, pieces, secrets, simhash
from pitmill.plans.staging import mark, release, stage


#: Rows of an Arrow batch: whole texts go to Python workers, and a batch of them must fit beside others.
BATCH_ROWS = 2000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the others go."""
    _small_batches(spark)
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts (five-word shingles, 0.8), the one with the smallest id."""
    _small_batches(spark)
    return simhash.keep_first(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    _small_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked in the text."""
    return secrets.mask_secrets(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` and the sampled pieces of every document."""
    _small_batches(spark)
    return pieces.encode(docs).select("doc_id", "pieces")


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("secret_scans", mask_secrets),
    ("sentencepiece", encode_pieces),
]

#: Trained language labels and sampled pieces have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table; what the stages before it have written is deleted as soon as the next one stands."""
    since = mark()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
        release(spark, since, keep=1)
    return docs
