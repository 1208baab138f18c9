"""One query per operator over its whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlab.llm import (
    binary_records,
    decontamination,
    fingerprints,
    jaccard_join,
    lm_backoff,
    merkle,
    mixing,
    pii,
    prefix_counts,
    quality_rules,
    substring_dedup,
    toxicity,
    whitening,
)
from stationlab.llm.common import table


def op1_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.fertility_rules(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_windows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("hit_spans", "items")


def op3_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts.count_tokens(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def op5_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_records.binary_output(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.learn_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    places = F.array_join(F.transform("sentences", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return scored.select("doc_id", (~toxicity.in_training(F.col("doc_id"))).alias("held_out"), "score", "predicted",
                         places.alias("offending"))


def op7_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_private(table(spark, sf_dir, "documents"), pii.train(pii.labelled_table(spark)))


def op8_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_backoff.backoff_scores(table(spark, sf_dir, "documents"), least_count=1)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.pareto_mix(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_rows(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_versions(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_tokeniser_fertility, op2_benchmark_decontamination, op3_prefix_token_counts, op4_substring_dedup, op5_binary_records,
    op6_toxicity, op7_private_data, op8_stupid_backoff, op9_jaccard_join, op10_source_mixing,
    op11_merkle_manifest, op12_embedding_whitening, op13_document_fingerprints)}
