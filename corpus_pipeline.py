"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns the rows the next one works on; the last
returns the pieces with their places in sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advisory_lake.llm import minhash, packing, secrets, substring, toxicity
from advisory_lake.llm.shared import table, text_key, written

TOXIC = 0.5
NEAR_PERCENT = 80  # similarity of five-word shingles from which a document is a near copy


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``; the labels of the tables train the model."""
    score = toxicity.scorer(toxicity.train(docs, table(spark, sf_dir, "labels")))
    return docs.where(score(F.col("text").cast("string")) < TOXIC)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every group linked at ``NEAR_PERCENT`` or more."""
    gone = minhash.near_duplicates(docs, NEAR_PERCENT).where("not kept").select(
        F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")
    )
    return docs.join(gone, (F.col("doc_id") == F.col("_gone_id")) & (text_key() == F.col("_gone_key")), "left_anti")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that documents with smaller doc_id have."""
    return _counted(substring.without_repeats(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in place of every secret."""
    return _counted(secrets.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    return docs.withColumn("n_chars", F.length(F.col("text").cast("string")).cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeats),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: No SQL: every stage is a trained model or a search; tests/llm holds it against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
