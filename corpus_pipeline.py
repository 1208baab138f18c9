"""The corpus pipeline: from raw documents to shuffled-read binary token records.

Each stage calls one operator of ``stationlab.llm``, works on all rows that the stage
before it kept, and its decisions take effect; all but the last return the columns of
``documents``.  A stage's result is written as Parquet to the shared folder and read
again as the next one's ``docs``, so a lost executor costs one stage's work at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stationlab.llm import binary_records, decontamination, jaccard_join, mixing, quality_rules
from stationlab.llm.common import shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tokeniser fertility rules reject go."""
    return quality_rules.keep_fertile(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with five-word shingles of Jaccard similarity 0.8 or more stays."""
    return jaccard_join.one_of_each(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with passages of ``benchmark`` go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def binary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in record files, read back: doc_id, start, n_tokens, ids_crc32."""
    return binary_records.binary_output(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", binary),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs


# Token ids are beyond SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None
