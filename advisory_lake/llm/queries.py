"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advisory_lake.llm import bpe, html, minhash, negatives, neighbours, packing, periodic, quality, secrets, substring, topk, toxicity, warc
from advisory_lake.llm.shared import table


def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages")).drop("digest_agrees")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removed_words(table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_private_key", "n_signed_token")


def op8_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trips(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(periodic.with_planted_runs(table(spark, sf_dir, "documents"))))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(negatives.labelled(table(spark, sf_dir, "embeddings")), F.expr("vec_id % 50 = 0"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = neighbours.usable(table(spark, sf_dir, "embeddings"))
    return neighbours.nearest(vectors, F.expr("vec_id % 100 = 0"), 10)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_warc_round_trip,
        op2_exact_top_k,
        op3_quality_rules,
        op4_best_fit_packing,
        op5_html_extraction,
        op6_substring_dedup,
        op7_secret_scans,
        op8_minhash_near_duplicates,
        op9_bpe_round_trip,
        op10_toxicity,
        op11_periodic_runs,
        op12_hard_negatives,
        op13_nearest_neighbours,
    )
    return {query.__name__: query for query in registered}
