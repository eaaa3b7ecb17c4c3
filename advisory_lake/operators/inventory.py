"""Counts over a file listing. None of these read file contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advisory_lake.functions.paths import path_segment
from advisory_lake.functions.scalars import percent_of
from advisory_lake.sources.tree import list_files_if_present

EXPECTED_FILES = 317_623  # fixed value: files of the published tree


def json_files(listing: DataFrame) -> DataFrame:
    return listing.filter(F.col("relative_path").like("%.json"))


def files_per_year(listing: DataFrame, position: int = 1) -> DataFrame:
    """JSON files by the folder that names the year, ``position`` segments below the root."""
    return (
        json_files(listing)
        .withColumn("year", path_segment(F.col("relative_path"), position))
        .groupBy("year")
        .count()
        .withColumnRenamed("count", "file_count")
        .orderBy("year")
    )


def files_total(per_year: DataFrame) -> DataFrame:
    return per_year.agg(F.coalesce(F.sum("file_count"), F.lit(0)).alias("total_files"))


def progress(counted: DataFrame, expected: int) -> DataFrame:
    """Turn a one-row ``found`` count into a progress report."""
    target = F.lit(expected).cast("long")
    return counted.select(
        "found",
        target.alias("expected"),
        percent_of(F.col("found"), target).alias("percent"),
        (F.col("found") >= target).alias("complete"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("checked_at"),
    )


def arrival_progress(spark: SparkSession, root: str, expected: int = EXPECTED_FILES) -> DataFrame:
    """How much of an expected tree is there; a folder not created yet counts as empty."""
    found = list_files_if_present(spark, root).agg(F.count(F.lit(1)).alias("found"))
    return progress(found, expected)
