"""From raw documents to token ids: quality, near duplicates, benchmark passages, personal data, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the
last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.llm import common, decontaminate, pieces, pii, quality, simhash


def _prepare(spark: SparkSession) -> None:
    """One session runs all stages, so what a stage leaves in the executors' memory meets the next one's needs."""
    common.ship(spark)
    common.bound_batches(spark)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  Null and empty texts are judged as such, a score that equals the threshold is kept."""
    _prepare(spark)
    return quality.good_documents(docs, common.table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    _prepare(spark)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with too much of a benchmark item go."""
    _prepare(spark)
    return decontaminate.clean_documents(docs, common.table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts."""
    _prepare(spark)
    return pii.masked_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding the ids gives the text again."""
    _prepare(spark)
    coded = pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

#: Trained and hashing stages have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; the outcome of each is a Parquet table in the shared folder."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = common.work_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
