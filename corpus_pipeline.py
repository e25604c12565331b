"""The training-data pipeline: documents in, packed token sequences out.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; all but the last return the columns of ``documents``. Each
result is written as Parquet to the session's shared checkpoint folder and
read again, so a lost executor never costs more than the stage at hand; a
stage's folder goes once the next stage stands. The last one stays for the caller.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from customer360.llm.decontam import remove_leaks
from customer360.llm.linededup import dedup_lines
from customer360.llm.ngramjoin import keep_one
from customer360.llm.packing import pack_documents
from customer360.llm.toxcnn import drop_toxic
from customer360.plans import checkpoint_dir, release_unreachable, remove_stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold of their language; all labels train."""
    release_unreachable(spark)  # what the stage before left
    return drop_toxic(docs, docs, _table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without near-duplicate lines but the first of each class."""
    release_unreachable(spark)  # what the stage before left
    return dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicate links."""
    release_unreachable(spark)  # what the stage before left
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    release_unreachable(spark)  # what the stage before left
    return remove_leaks(docs, _table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in packed sequences."""
    release_unreachable(spark)  # what the stage before left
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: A trained network, edit distances and subword ids are beyond SQL; tests
#: hold every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from ``documents`` of ``sf_dir``."""
    docs = _table(spark, sf_dir, "documents")
    folder, before = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}", None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:  # the stage that read it stands
            remove_stored(spark, before)
        before = f"{folder}/{name}"
    return docs
