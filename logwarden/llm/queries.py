"""Registered queries of the corpus operators; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.llm import byte_bpe, common, decontaminate, katz, licenses, negatives, phrases, pieces, pii, quality, simhash, spelling, suffixes, token_counts

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")
    found = decontaminate.judged(decontaminate.find_occurrences(docs, items))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op3_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.compare_with_next(common.table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(common.table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(common.table(spark, sf_dir, "documents"))


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(common.table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.deduplicated(common.table(spark, sf_dir, "documents"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    return found.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(common.table(spark, sf_dir, "documents"))
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", shown.alias("fingerprint"), "component_id")


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ids_sha256: of the ids, comma-joined; round_trip: whether decoding gave the text again."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = pieces.encode(common.table(spark, sf_dir, "documents"), path)
    text = F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    both = pieces.decode(encoded.select("doc_id", "ids", text), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(common.table(spark, sf_dir, "documents"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(common.table(spark, sf_dir, "embeddings"), moved)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.round_trip(common.table(spark, sf_dir, "documents"), path)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        common.ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    name: _shipped(query)
    for name, query in {
        "op1_decontamination": op1_decontamination,
        "op2_quality": op2_quality,
        "op3_phrases": op3_phrases,
        "op4_licenses": op4_licenses,
        "op5_pii": op5_pii,
        "op6_katz": op6_katz,
        "op7_token_counts": op7_token_counts,
        "op8_suffixes": op8_suffixes,
        "op9_simhash": op9_simhash,
        "op10_pieces": op10_pieces,
        "op11_spelling": op11_spelling,
        "op12_negatives": op12_negatives,
        "op13_byte_bpe": op13_byte_bpe,
    }.items()
}
